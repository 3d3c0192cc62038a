"""Token files against the tokenizers library and against the memory they are mapped to."""

import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakewright.llm import token_files
from lakewright.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    """``(id, start, n, crc)`` of ``(id, text)`` rows in their order."""
    whole, start, out = Tokenizer.from_file(FILE), 0, []
    for key, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    return out


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    got = QUERIES["op11_arrow_token_files"](spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(rows)


@pytest.mark.parametrize("length, batch, file_tokens", [(1, 1, 1), (3, 2, 20), (16, 4, 1 << 25)])
def test_documents_across_sequences_batches_and_files(spark, tmp_path, length, batch, file_tokens):
    rows = [(i, "word " * (i * 7 % 40) + "<|endoftext|>" * (i % 3 == 0) + "é日" * (i % 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    token_files.write_tokens(df, f"{tmp_path}/t", FILE, public_tokenizers.PATTERN, length=length, batch=batch, file_tokens=file_tokens)
    assert sorted(map(tuple, token_files.read_documents(spark, f"{tmp_path}/t").collect())) == expected(rows)
    sequences = token_files.read_sequences(spark, f"{tmp_path}/t").orderBy("sequence_id").collect()
    assert [s.sequence_id for s in sequences] == list(range(len(sequences)))
    assert all(len(s.ids) == len(s.mask) == length for s in sequences)
    stream = [i for s in sequences for i, here in zip(s.ids, s.mask) if here]
    whole = Tokenizer.from_file(FILE)
    assert stream == [i for _, text in rows for i in [*whole.encode(text, add_special_tokens=False).ids, 0]]
    files = token_files.token_files(spark, f"{tmp_path}/t").orderBy("start").collect()
    assert sum(f.n_docs for f in files) == 30 and sum(f.n_sequences for f in files) == len(sequences)
    assert all(sum(s.mask) in (length, f.n_tokens % length) for f in files for s in sequences[f.first_sequence :][: f.n_sequences])


def test_views_of_the_mapped_file(spark, tmp_path):
    df = spark.createDataFrame([(i, "some words here " * 300) for i in range(40)], "doc_id long, text string").coalesce(1)
    token_files.write_tokens(df, f"{tmp_path}/t", FILE, public_tokenizers.PATTERN, length=64, batch=8)
    (found,) = token_files.token_files(spark, f"{tmp_path}/t").where("start = 0").collect()
    path = f"{tmp_path}/t/data/{found.name}"
    file, held = token_files.TokenFile(path), pa.total_allocated_bytes()
    views = [file.sequence(k) for k in (len(file) - 1, 0, len(file) // 2)]
    assert len(file) == found.n_sequences and pa.total_allocated_bytes() == held
    assert all(len(ids) == len(mask) == 64 and not ids.flags.owndata and ids.dtype == np.uint16 for ids, mask in views)
    with pytest.raises(IndexError):
        file.sequence(len(file))
    stream = np.concatenate([file.sequence(k)[0] for k in range(len(file))])
    first = next(iter(file.documents()))
    assert zlib.crc32(stream[: first[2]].astype("<u4").tobytes()) == first[3]
    assert not views[0][1][-1].as_py() or found.n_tokens % 64 == 0  # padding is masked


def test_odd_rows(spark, tmp_path):
    rows = [(None, "a b", 1), (2, None, 1), (2, "", 1), (2, "", 1), (3, "word " * 40_000, 1)]
    df = spark.createDataFrame(rows, "doc_id int, text string, ids int")
    token_files.write_tokens(df, f"{tmp_path}/t", FILE)
    got = sorted(token_files.read_documents(spark, f"{tmp_path}/t", "int").collect(), key=lambda r: r.start)
    want = expected((r[0], r[1]) for r in rows)
    assert [tuple(r) for r in got] == want
    token_files.write_tokens(df.where("false"), f"{tmp_path}/e", FILE)
    assert token_files.read_documents(spark, f"{tmp_path}/e").count() == 0
    assert token_files.read_sequences(spark, f"{tmp_path}/e").count() == 0
    named = df.where("doc_id = 3").withColumn("doc_id", F.lit("x"))
    token_files.write_tokens(named, f"{tmp_path}/s", FILE)
    assert token_files.read_documents(spark, f"{tmp_path}/s", "string").first().id == "x"


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    token_files.write_tokens(df, f"{tmp_path}/t", FILE)
    for name in ("stray.arrow", "half.arrow"):
        with open(f"{tmp_path}/t/data/{name}", "wb") as file:
            file.write(b"ARROW1" + os.urandom(20))
    assert [tuple(r) for r in token_files.read_documents(spark, f"{tmp_path}/t").collect()] == expected([(1, "a b c")])


def test_id_type():
    assert token_files.id_type(1 << 16) == pa.uint16() and token_files.id_type((1 << 16) + 1) == pa.uint32()
