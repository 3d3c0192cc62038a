"""Near-duplicates against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewright.llm import minhash
from lakewright.llm.queries import QUERIES


def plain_components(texts):
    """``key -> (shingles, component)`` by comparing every pair that shares a shingle."""
    sets = {}
    for key, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[key] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    holders, parent = {}, {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for key, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(key)
    for key in sorted(sets):
        near = {}
        for s in sets[key]:
            for other in holders[s]:
                near[other] = near.get(other, 0) + 1
        for other, shared in near.items():
            if other != key and 100 * shared >= 75 * (len(sets[key]) + len(sets[other]) - shared):
                a, b = sorted((root(key), root(other)))
                parent[b] = a
    return {k: (len(s), root(k)) for k, s in sets.items()}


def check(got, texts):
    assert len(got) == len(texts)
    want = plain_components(texts)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.id], r.id
        assert r.kept == (r.id == r.component_id)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = [r for r in QUERIES["op8_tensored_minhash"](spark, sf).withColumnRenamed("doc_id", "id").collect()]
    check(got, {r.doc_id: r.text for r in docs.collect()})
    assert any(not r.kept for r in got)


def varied(base, changes, draw):
    words = list(base)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def test_chains_hot_groups_and_short_texts(spark):
    """Members of a group are often too far from each other to be linked themselves."""
    draw, texts = random.Random(5), {}
    base = [f"b{draw.randrange(5000)}" for _ in range(200)]
    for i in range(300):
        texts[1000 + i] = varied(base, 4, draw)
    step = list(base)
    for i in range(40):  # a chain that wanders off
        step = varied(step, 3, draw).split(" ")
        texts[2000 + i] = " ".join(step)
    texts |= {1: "One two\tTHREE", 2: "one TWO three", 3: "one two", 4: "", 5: None, 6: " \n", 7: "A B C D E", 8: "a b c d e f", 9: "É b c d e", 10: "é b c d e"}
    texts |= {3000 + i: "same words " * 20000 for i in range(3)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("key", F.lit(1)).repartition(5)
    got = minhash.near_groups(df).collect()
    check(got, texts)
    assert len({r.component_id for r in got if r.id >= 1000 and r.id < 2000}) < 20


def test_parts_of_a_long_list_are_all_compared(spark):
    draw = random.Random(6)
    base = [f"b{i}" for i in range(100)]
    texts = {i: varied(base, 2, draw) for i in range(60)}
    check(minhash.near_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), settings=minhash.Settings(members=7)).collect(), texts)


def test_texts_of_one_template_are_not_paired(spark, monkeypatch):
    """Every two of them share most of their shingles, few are alike enough; rows grow with the texts, not with their pairs."""
    written, real = {}, minhash.stage

    def counted(df, name):
        out = real(df, name)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(minhash, "stage", counted)
    template = [f"t{i}" for i in range(30)]
    for n in (400, 1600):
        written.clear()
        texts = {i: " ".join(template + [f"o{i}x{k}" for k in range(7 if i % 2 else 8)]) for i in range(n)}
        texts |= {n + i: " ".join(template + [f"s{i}x{k}" for k in range(2)]) for i in range(n // 4)}  # these are alike
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {r.id: r.component_id for r in minhash.near_groups(df).collect()}
        assert got == {i: min(i, n) for i in texts}
        assert sum(written["meeting_cells"]) < 100
        stars, crossed = written["pairs"]  # at most two for each table a text is in
        assert stars <= 2 * minhash.Settings().halves ** 2 * len(texts) and crossed == 0
        assert all(sum(found) <= 2 * minhash.Settings().halves ** 2 * len(texts) for found in written.values())


def test_meeting_cells_leave_out_no_link(spark):
    """Two sets that are alike enough meet in a cell, at all sizes and percentages."""
    draw = random.Random(8)
    for percent in (50, 75, 100):
        base = [f"b{i}" for i in range(60)]
        texts = {i: " ".join(base[draw.randrange(6) : 60 - draw.randrange(6)] + [f"o{i}x{k}" for k in range(draw.randrange(9))]) for i in range(60)}
        settings = minhash.Settings(percent=percent)
        df = spark.createDataFrame([(k, k, v.encode()) for k, v in texts.items()], "rid long, c long, bytes binary")
        pairs = {(r.a, r.b) for r in minhash.crossing(df.select("rid", "c"), df.select("rid", "bytes"), settings).collect()}
        sets = {k: set(minhash.shingles(v.encode()).tolist()) for k, v in texts.items()}
        want = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}
        assert want <= pairs and (percent == 100 or want)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, 150), (170, 150), (150, 201)] + [(5000, 5000 + i) for i in range(1, 500)]
    random.Random(1).shuffle(edges)
    got = dict(minhash.components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(91)} | dict.fromkeys([150, 170, 200, 201], 150) | {5000 + i: 5000 for i in range(500)}
    assert got == want
    assert minhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    rows = [(None, "a b c d e f", 1), (2, "a b c d e f", 1), (2, "x", 1), (2, "x", 1), (3, None, 1)]
    df = spark.createDataFrame(rows, "doc_id int, text string, rid int")
    got = sorted(((r.id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(df).collect()))
    assert got == [(0, 2, None, True), (2, 1, 2, False), (2, 1, 2, True), (2, 2, None, False), (3, 0, 3, True)]
    assert minhash.near_groups(df.where("false")).count() == 0
    left = minhash.drop_near_copies(df)
    assert left.columns == df.columns and left.count() == 3


def test_half_keys_agree_as_often_as_sets_do():
    draw = np.random.default_rng(2)
    settings = minhash.Settings(per_half=1, halves=1000)
    a = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], draw.integers(0, 1 << 63, 100, dtype=np.uint64)])
    same = (minhash.half_keys(a, settings) == minhash.half_keys(b, settings)).mean()
    assert abs(same - 0.6) < 0.05
