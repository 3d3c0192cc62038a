"""The filter audit against its SQL and against a plain count, the word table against sets."""

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check_oracles import compare
from lakewright.llm import filter_audit as fa

TEXT = st.text(st.sampled_from("aAbB  \n\t\x0b\x1c#|é日\xa0") | st.characters(codec="utf-8"), max_size=40)


def plain_measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)), len(set(words))]


def test_query_equals_sql(spark, sf):
    assert compare(spark, sf, ["op13_transducer_filter_audit"]) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=8), st.sampled_from([1, 7, 30, 1000]))
def test_measures(texts, block):
    got = fa.measure([t.encode() for t in texts], block)
    assert got.T.tolist() == [plain_measure(t) for t in texts]


@pytest.mark.parametrize("bits", [1, 3, 64])
def test_words_are_verified(bits):
    """However many hashes collide, words are told apart by their bytes."""
    long = ["x" * 20 + c + "y" * 20 for c in "abc"] + ["z" * 5000 + c + "z" * 5000 for c in "ab"] + ["q" * 8, "q" * 9, "q" * 16, "q" * 17, "q" * 24, "q" * 25]
    words = [*long, *(f"w{i % 50}" for i in range(200)), *long]
    texts = [" ".join(words), " ".join(words[::-1]), "w1 w1"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    _, table = fa.measure_block(data, np.cumsum([0, *map(len, texts)]))
    spans = fa.WordTable(data, table.begins, table.begins + table.lengths, table.texts, bits=bits)
    found = sorted((int(spans.texts[i]), spans.bytes_of(i)) for i in spans.inserted)
    assert found == sorted({(i, w.encode()) for i, t in enumerate(texts) for w in t.split()})


def test_long_texts():
    texts = ["word " * 300_000, "A" * 3_000_000, " ".join(f"w{i % 1000}é" for i in range(400_000)) + "\x1c", ""]
    assert fa.measure([t.encode() for t in texts], 1 << 20).T.tolist() == [plain_measure(t) for t in texts]


def plain_audit(rows, labels):
    """The report of ``(id, part, text)`` rows, by its definition."""
    seen, docs, out = {}, [], set()
    for key, _, text in rows:
        if key is not None:
            seen[text or ""] = min(key, seen.get(text or "", key))
    for key, part, text in rows:
        words, capitals, points, symbols, distinct = plain_measure(text or "")
        fails = {f for f, bad in zip("ABCDE", (words < 100, 100 * distinct < 80 * words, 100 * capitals > 10 * points, symbols, key is not None and seen[text or ""] < key)) if bad}
        docs.append((part or "", fails, *(any(r[i] == 1 for r in labels if r[0] == key and key is not None) for i in (1, 2))))
    for part in {d[0] for d in docs}:
        own, found, shapley = [d for d in docs if d[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for i, f in enumerate(order):
                gone, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                counts = len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)
                found.append((part, "".join(order), i + 1, *counts, f))
        out |= {(*x[:-1], shapley[x[-1]]) for x in found}
    return out


def test_odd_rows(spark):
    clean = " ".join(f"word{i}" for i in range(120))
    rows = [
        (1, "en", clean), (1, "en", clean), (2, "en", clean), (3, "de", clean), (None, "en", clean), (None, None, "a b #"), (4, None, None),
        (5, "", ""), (6, "en", "UP " * 40), (7, "en", clean.upper()), (8, "en", clean + " | &"), (9, "fr", "same same " * 70_000), (0, "xx", clean + " x"), (-3, "fr", clean + " x"),
    ]
    labels = [(1, 1, 0), (1, 0, 0), (2, 1, None), (7, None, 1), (None, 1, 1), (6, 0, 1), (77, 1, 1)]
    df = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id int, lang string, text string, n int, mask string")
    marked = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, n int")
    got = fa.audit_filters(df.repartition(3), marked).collect()
    assert len(got) == 600 * 5 and set(map(tuple, got)) == plain_audit(rows, labels)
    assert fa.audit_filters(df.where("false"), marked).count() == 0
    unlabelled = fa.audit_filters(df, marked.where("false")).collect()
    assert set(map(tuple, unlabelled)) == plain_audit(rows, [])
