"""Base58 and Base58Check column functions.

The checksum is plain Spark SQL. Only the change of base runs in Python, on whole
Arrow batches with numpy, and once per distinct key of a batch: a key that holds a
third of the rows costs as much as one that occurs once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the Base58 alphabet.
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

_SYMBOLS = np.frombuffer(ALPHABET.encode(), dtype=np.uint8)
_GROUP = 5  # digits taken per division; 58**5 < 2**30 keeps every step inside 64 bits
_DIVISOR = np.uint64(58**_GROUP)
_GROUP_BITS = math.log2(58) * _GROUP


def _digits(raw: np.ndarray) -> np.ndarray:
    """Base-58 digits, most significant first, of each row of big-endian bytes."""
    rows, width = raw.shape
    pad = -width % 4
    padded = np.zeros((rows, width + pad), dtype=np.uint8)
    padded[:, pad:] = raw
    # one contiguous vector per 32-bit word, so each step below is a linear scan
    words = np.ascontiguousarray(padded.view(">u4").T).astype(np.uint64)
    groups = math.ceil(width * 8 / _GROUP_BITS)
    out = np.empty((rows, groups * _GROUP), dtype=np.uint8)
    for g in range(groups):
        # words that earlier divisions have certainly emptied are skipped
        live = min(len(words), max(1, math.ceil((width * 8 - g * _GROUP_BITS) / 32) + 1))
        rest = np.zeros(rows, dtype=np.uint64)
        for w in range(len(words) - live, len(words)):
            value = (rest << np.uint64(32)) | words[w]
            words[w] = value // _DIVISOR
            rest = value - words[w] * _DIVISOR
        for d in range(_GROUP):
            out[:, out.shape[1] - 1 - g * _GROUP - d] = rest % np.uint64(58)
            rest //= np.uint64(58)
    return out


def _encode_same_length(raw: np.ndarray) -> pa.Array:
    rows, width = raw.shape
    if width == 0:
        return pa.array([""] * rows, pa.string())
    digits = _digits(raw)
    total = digits.shape[1]
    lead = lambda m: np.where((m != 0).any(axis=1), (m != 0).argmax(axis=1), m.shape[1])
    # every leading zero byte is written as the zero digit, other zero digits are dropped
    length = total - lead(digits) + lead(raw)
    keep = np.arange(total) >= (total - length)[:, None]
    offsets = np.zeros(rows + 1, dtype=np.int32)
    np.cumsum(length, out=offsets[1:])
    return pa.StringArray.from_buffers(
        rows, pa.py_buffer(offsets), pa.py_buffer(_SYMBOLS[digits][keep])
    )


def encode_array(keys: pa.Array) -> pa.Array:
    """Base58 text of a binary Arrow array; null stays null."""
    coded = keys.cast(pa.binary()).dictionary_encode()
    distinct = coded.dictionary
    if len(distinct) == 0:
        return pa.nulls(len(keys), pa.string())
    _, offsets_buf, data_buf = distinct.buffers()
    first = distinct.offset
    offsets = np.frombuffer(offsets_buf, dtype=np.int32)[first : first + len(distinct) + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf else np.empty(0, np.uint8)
    lengths = np.diff(offsets)
    parts, order = [], []
    for length in np.unique(lengths):
        where = np.flatnonzero(lengths == length)
        raw = data[offsets[where][:, None] + np.arange(length)]
        parts.append(_encode_same_length(raw))
        order.append(where)
    place = np.empty(len(distinct), dtype=np.int64)
    place[np.concatenate(order)] = np.arange(len(distinct))
    return pa.concat_arrays(parts).take(pa.array(place)).take(coded.indices)


@F.arrow_udf(T.StringType())
def _b58(keys: pa.Array) -> pa.Array:
    return encode_array(keys)


def b58encode(key: Column | str) -> Column:
    """Base58 text of a binary column. Null gives null, empty gives the empty string."""
    return _b58(F.col(key) if isinstance(key, str) else key)


def b58check_payload(key: Column | str) -> Column:
    """The bytes Base58Check encodes: a zero byte, the key, four checksum bytes."""
    body = F.concat(F.unhex(F.lit("00")), F.col(key) if isinstance(key, str) else key)
    checksum = F.unhex(F.sha2(F.unhex(F.sha2(body, 256)), 256))
    return F.concat(body, F.substring(checksum, 1, 4))


def b58encode_checked(key: Column | str) -> Column:
    """Base58Check text of a binary column; null gives null."""
    return b58encode(b58check_payload(key))
