"""Sharding and fingerprints against plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakewright.llm import fingerprints, sharding
from lakewright.llm.queries import QUERIES
from lakewright.llm.rows import keyed, number_rows

ODD_ROWS = [(3, "a\n\nb c", "x"), (None, None, "y"), (3, "", "y"), (3, "", "y"), (-7, "é" * 5000, None), (9, "日本 " * 40, "z")]
ODD_SCHEMA = "doc_id long, text string, rid string"  # an extra column named like an inner one


def test_rows_get_numbers_without_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(13)
    rows, n = number_rows(df, F.desc("k"))
    assert n == 1000 and all(r.row_no == 999 - r.k for r in rows.collect())
    rows, n = number_rows(df.where("false"), "k")
    assert n == 0 and rows.count() == 0


def test_keys_follow_ids_and_survive_repeats(spark):
    odd = keyed(spark.createDataFrame(ODD_ROWS, ODD_SCHEMA), "doc_id", "text").orderBy("rid").collect()
    assert [r.id for r in odd] == [None, -7, 3, 3, 3, 9] and len({r.rid for r in odd}) == 6
    names = spark.createDataFrame([("b", "x"), ("a", None)], "doc_id string, text string")
    assert [(r.id, r.text) for r in keyed(names, "doc_id", "text").orderBy("rid").collect()] == [("a", ""), ("b", "x")]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 17, 101, 1000])
def test_permutation_is_the_one_of_plain_python(spark, n):
    rows = spark.range(n).withColumnRenamed("id", "row_no")
    placed = {r.row_no: r.place for r in sharding.with_place(rows, n, 3).collect()}
    assert sorted(placed.values()) == list(range(n))
    assert all(sharding.place_of(row, n, 3) == place for row, place in placed.items())


def test_shards(spark, sf):
    got = QUERIES["op4_feistel_shards"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for number, row in enumerate(sorted(got, key=lambda r: r.doc_id)):
        data = (texts[row.doc_id] or "").encode()
        place = sharding.place_of(number, len(texts))
        assert (row.size, row.text_crc32, row.shard, row.slot) == (len(data) + 1, zlib.crc32(data), place % 8, place // 8)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_shards_of_odd_rows(spark, tmp_path):
    df = spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)
    got = sharding.shard(df, 4).collect()
    counts = [sum(r.shard == s for r in got) for s in range(4)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 6
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(counts[s])) for s in range(4))
    assert sharding.shard(df.where("false"), 4).count() == 0
    sharding.write_shards(df.withColumn("shard", F.lit(1)), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 6 and {"shard", "shard_", "slot", "rid"} <= set(back.columns)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fingerprint(text):
    sections, nodes = [], ""
    for section in text.split("\n\n"):
        paragraphs, below = [], ""
        for paragraph in section.split("\n"):
            words = paragraph.split(" ")
            leaves = [sha(" ".join(words[i : i + 8])) for i in range(0, len(words), 8)]
            paragraphs.append(sha("".join(leaves)))
            below += f" P{paragraphs[-1][:16]}" + "".join(f" L{leaf[:8]}" for leaf in leaves)
        sections.append(sha("".join(paragraphs)))
        nodes += f" S{sections[-1][:16]}" + below
    return f"R{sha(''.join(sections))}{nodes}"


def plain_likeness(a, b):
    a, b = set(a.split(" ")), set(b.split(" "))
    return len(a & b) / len(a | b)


def check_fingerprints(texts, got):
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    assert len(got) == len(texts)
    for row in got:
        text, after = texts[row.id], texts[following[row.id]]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        prints = [plain_fingerprint(t) for t in (text, edited, after)]
        assert (row.n_chars, row.edited) == (len(text), edited)
        assert [row.fingerprint, row.edited_fingerprint] == prints[:2]
        assert row.near_edited == pytest.approx(plain_likeness(prints[0], prints[1]))
        assert row.near_next == pytest.approx(plain_likeness(prints[0], prints[2]))


def test_fingerprints(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = fingerprints.compare_with_edits(docs).collect()
    check_fingerprints({r.doc_id: r.text for r in docs.collect()}, got)
    assert sum(r.near_edited for r in got) > 5 * sum(r.near_next for r in got)


def test_fingerprints_of_odd_rows(spark):
    texts = {-5: "", 2: "one", 3: "a\n\nb c\n" * 40, 10**15: "日本 é\n" * 30, 10**15 + 1: " \n\n\n x" * 9}
    df = spark.createDataFrame([(k, v or None, 1) for k, v in texts.items()], "doc_id long, text string, bucket int")
    check_fingerprints(texts, fingerprints.compare_with_edits(df).collect())
    assert fingerprints.compare_with_edits(df.where("false")).count() == 0
    (single,) = fingerprints.compare_with_edits(df.where("doc_id = 2")).collect()
    assert single.near_next == 1 and single.edited == "ono"
    assert fingerprints.compare_with_edits(spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)).count() == 6


def test_edits_are_located(spark):
    before = "\n".join(f"line {i} has some words in it" for i in range(20))
    df = spark.createDataFrame([(before, before.replace("line 7 has", "line 7 had"))], "a string, b string")
    prints = df.select(fingerprints.fingerprint(F.col("a")).alias("a"), fingerprints.fingerprint(F.col("b")).alias("b"))
    (row,) = prints.select(fingerprints.changed_paragraphs(F.col("a"), F.col("b")).alias("gone"), "a").collect()
    assert row.gone == [[n for n in row.a.split(" ") if n.startswith("P")][7]]
