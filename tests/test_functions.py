import base64
import hashlib
import subprocess
import sys

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lakewright.functions import (
    b58encode,
    b58encode_checked,
    epoch_day,
    from_epoch_millis,
    path_or_null,
    register_functions,
)
from lakewright.functions.base58 import ALPHABET, encode_array

KNOWN_KEY = base64.b64decode("AI4B2MNOkMZkGyMbTG1h8ktdcNlVOhJvwTgMmdkhwmuV")
KNOWN_TEXT = "1125YPFi3YP2cPFRCrSnPzC6RCo3NvhFjGbB5DjFqoRZVmE1f7V8"


def plain_base58(raw: bytes) -> str:
    n, text = int.from_bytes(raw, "big"), ""
    while n:
        n, d = divmod(n, 58)
        text = ALPHABET[d] + text
    return "1" * (len(raw) - len(raw.lstrip(b"\0"))) + text


def plain_check(raw: bytes) -> str:
    body = b"\0" + raw
    return plain_base58(body + hashlib.sha256(hashlib.sha256(body).digest()).digest()[:4])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.binary(max_size=80)), max_size=12))
def test_base58_equals_plain_definition(keys):
    got = encode_array(pa.array(keys, pa.binary())).to_pylist()
    assert got == [None if k is None else plain_base58(k) for k in keys]


def test_base58_edges():
    keys = [b"", b"\0", b"\0" * 40, b"\xff" * 64, b"\0\0\x01", b"\xff", None, b"\0" + b"\xff" * 36]
    got = encode_array(pa.array(keys, pa.binary())).to_pylist()
    assert got == [None if k is None else plain_base58(k) for k in keys]
    sliced = pa.array([b"x", b"yy", None, b"yy"], pa.binary()).slice(1)
    assert encode_array(sliced).to_pylist() == [plain_base58(b"yy"), None, plain_base58(b"yy")]


def test_check_known_vector(spark):
    df = spark.createDataFrame([(0, bytearray(KNOWN_KEY)), (1, bytearray()), (2, None)], "i int, k binary")
    rows = df.select("i", b58encode_checked("k").alias("c"), b58encode("k").alias("b")).orderBy("i").collect()
    assert [r.c for r in rows] == [KNOWN_TEXT, "1Wh4bh", None]
    assert [r.b for r in rows] == [plain_base58(KNOWN_KEY), "", None]


def test_sql_names(spark):
    register_functions(spark)
    register_functions(spark)
    row = spark.sql(
        """select b58encodeChecked(unbase64('AI4B2MNOkMZkGyMbTG1h8ktdcNlVOhJvwTgMmdkhwmuV')) c,
                  b58encode(X'0001') b, from_epoch_millis(1700000000123) t,
                  from_epoch_millis(cast(1700000000123 as decimal(23,0))) td,
                  from_epoch_millis(null) tn, b58encodeChecked(null) cn,
                  b58encode('abc') s, b58encodeChecked('abc') sc"""
    ).first()
    assert row.c == KNOWN_TEXT and row.b == plain_base58(b"\0\1")
    assert row.t == row.td and row.t.microsecond == 123000
    assert row.tn is None and row.cn is None
    assert row.s == plain_base58(b"abc") and row.sc == plain_check(b"abc")


def test_epoch_day(spark):
    df = spark.createDataFrame(
        [(0, None), (1, 1700000000123), (2, 86_400_000), (3, 2**63 - 1)], "i int, e bigint"
    ).withColumn("u", F.col("e").cast("decimal(23,0)"))
    rows = df.where("i < 3").select(
        "i",
        epoch_day("e").cast("string").alias("ms"),
        epoch_day("u").cast("string").alias("dec"),
        epoch_day("e", 1).cast("string").alias("huge"),
        from_epoch_millis("u").cast("string").alias("ts"),
    ).orderBy("i").collect()
    assert [r.ms for r in rows] == [r.dec for r in rows] == ["1970-01-01", "2023-11-14", "1970-01-02"]
    assert rows[1].huge is None
    assert rows[1].ts == "2023-11-14 22:13:20.123"
    assert df.where("i = 3").select(epoch_day("e", 1).alias("d")).first().d is None


def test_task_functions_need_no_package_on_executors():
    """What is sent to tasks loads where the package cannot be imported."""
    from lakewright.plans.sample_messages import event_report_format
    from lakewright.sources.messages import _Decoder

    payload = cloudpickle.dumps((encode_array, _Decoder, event_report_format()))
    code = (
        "import sys, pickle, pyarrow as pa\n"
        "encode, decoder, fmt = pickle.loads(sys.stdin.buffer.read())\n"
        "assert list(decoder(fmt).batches(iter([]))) == [] and not any('lakewright' in m for m in sys.modules)\n"
        "print(encode(pa.array([b'\\0\\1']))[0])"
    )
    done = subprocess.run([sys.executable, "-c", code], input=payload, capture_output=True, cwd="/", check=True)
    assert done.stdout.decode().strip() == plain_base58(b"\0\1")


def test_path_or_null(spark):
    df = spark.sql("select named_struct('b', named_struct('c', 5), 'l', array(named_struct('x', 1))) a, 1 as `d`")
    got = df.select(*(path_or_null(df, p).alias(p) for p in ("a.b.c", "d", "a.l.x", "a.z", "d.e", "q"))).first()
    assert tuple(got) == (5, 1, None, None, None, None)
