"""What a Python worker keeps between tasks."""

import random
import re
import sys
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakewright.llm import minhash, packing, rows as llm_rows, substring_dedup, toxicity, units
from lakewright.llm.rows import PIECE_BYTES, forget_in_worker, in_worker, keyed, pieces


def test_a_worker_keeps_two_things_and_forgets_them():
    forget_in_worker()
    built = []
    for name in ("a", "b", "a", "c", "a", "b"):
        assert in_worker(name, lambda: built.append(name) or name) == name
    assert built == ["a", "b", "c", "b"]  # b was asked for longest ago when c came
    forget_in_worker()
    in_worker("a", lambda: built.append("again") or "a")
    assert built[-1] == "again"
    forget_in_worker()


def test_operators_that_keep_nothing_drop_what_others_left(spark):
    docs = spark.createDataFrame([(i, f"one two three four five six {i}") for i in range(40)], "doc_id long, text string")
    rows = keyed(docs.coalesce(1), "doc_id", "text")

    def fill(batches):
        for batch in batches:
            in_worker("big", lambda: bytearray(1000))
            yield batch

    def left(batches):
        for batch in batches:
            yield batch.slice(0, 0)
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array(["_lakewright_worker" in sys.modules])], names=["left"])

    def held() -> int:
        probe = spark.range(64).repartition(8).mapInArrow(lambda b: ([*b], left([]))[1], "left boolean")
        return probe.where("left").count()

    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    for run in (
        lambda: minhash.signatures(rows, minhash.Settings()).collect(),
        lambda: units.held_units(rows, lambda text: [text[:16]]).collect(),
        lambda: toxicity.score_documents(docs.coalesce(1), labels).select("score").collect(),
    ):
        spark.range(64).repartition(8).mapInArrow(fill, "id long").collect()
        before = held()
        run()
        assert before > 0 and held() < before


def test_freed_memory_goes_back_to_the_system():
    rollup = Path("/proc/self/smaps_rollup")
    if not rollup.exists():
        pytest.skip("memory can't be read here")

    def held() -> float:
        return int(re.search(r"\nAnonymous:\s+(\d+)", rollup.read_text())[1]) / 1024

    blocks = [bytes(1000) for _ in range(100_000)]
    last = blocks.pop()  # keeps the end of the heap in use
    blocks.clear()
    before = held()
    llm_rows.release_memory()
    assert before - held() > 50 and len(last) == 1000


def test_tasks_of_the_pipeline_hand_back_what_they_freed(spark, tmp_path, monkeypatch):
    marks = str(tmp_path / "released")

    def note() -> None:  # travels in place of the real one
        with open(marks, "a") as file:
            file.write("x")

    monkeypatch.setattr(llm_rows, "release_memory", note)
    docs = spark.createDataFrame([(i, f"one two three four five six {i % 30}") for i in range(40)], "doc_id long, text string")
    rows, labels = keyed(docs, "doc_id", "text"), docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    texts = rows.select("rid", F.col("text").cast("binary").alias("bytes"))
    pairs = spark.createDataFrame([(0, 30), (1, 31)], "a long, b long")
    open(marks, "w").close()
    for run in (
        lambda: toxicity.score_documents(docs, labels).select("score").collect(),
        lambda: minhash.signatures(rows, minhash.Settings()).collect(),
        lambda: minhash.confirmed(pairs, texts, minhash.Settings()).collect(),
        lambda: minhash.crossing(rows.select("rid", F.col("rid").alias("c")), texts, minhash.Settings()).collect(),
        lambda: units.held_units(rows, lambda text: [text[:16]]).collect(),
        lambda: substring_dedup._deduplicated(rows, "id", substring_dedup.Settings(), 2).collect(),
        lambda: packing.cut_documents(rows, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, 2048, False).collect(),
    ):
        before = Path(marks).stat().st_size
        run()
        assert Path(marks).stat().st_size > before


def test_pieces_hold_whole_rows_and_few_bytes():
    def cut(*sizes):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes)), pa.int64()), pa.array([b"x" * n for n in sizes], pa.binary())], names=["rid", "bytes"])
        return [[*zip(piece.column("rid").to_pylist(), map(len, piece.column("bytes").to_pylist()))] for piece in pieces(batch, "bytes", 10)]

    assert cut() == []
    assert cut(0, 0, 0) == [[(0, 0), (1, 0), (2, 0)]]
    assert cut(4, 6, 1, 0, 30, 0, 10, 1) == [[(0, 4), (1, 6)], [(2, 1), (3, 0)], [(4, 30)], [(5, 0), (6, 10)], [(7, 1)]]


def test_substring_steps_take_long_texts_piece_by_piece(spark, monkeypatch):
    """What is made of a batch at once does not grow with the length of its texts."""
    rows, runs = keyed(spark.createDataFrame([(1, "one")], "doc_id long, text string"), "doc_id", "text"), []
    plain = type(rows).mapInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, run, schema: runs.append(run) or plain(self, run, schema))
    settings = substring_dedup.Settings()
    substring_dedup._deduplicated(rows, "id", settings, 2)
    cut, rebuild = runs

    def digests(text):
        return substring_dedup.chunk_digests(text, substring_dedup.chunk_ends(text, settings))

    random.seed(3)
    texts = [" ".join(random.choices("abcdefghij", k=50_000)).encode() for _ in range(30)] + [b""]
    gone = [sorted({*digests(text)})[::2] or None for text in texts]
    ids = pa.array(range(len(texts)), pa.int64())
    whole = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts, pa.binary()), pa.array(gone, pa.list_(pa.binary()))], names=["rid", "id", "bytes", "units"])

    found = [*cut(iter([whole]))]
    assert sorted((r["rid"], r["unit"]) for b in found for r in b.to_pylist()) == sorted((k, d) for k, t in enumerate(texts) for d in {*digests(t)})
    assert max(b.nbytes for b in found) < PIECE_BYTES

    found = [*rebuild(iter([whole]))]
    singly = [r for k in range(len(texts)) for b in rebuild(iter([whole.slice(k, 1)])) for r in b.to_pylist()]
    assert [r for b in found for r in b.to_pylist()] == singly and [r["id"] for r in singly] == [*range(len(texts))]
    assert max(sum(map(len, b.column("text").to_pylist())) for b in found) <= PIECE_BYTES
