"""Source divergence against its SQL, skybands against all dominators, and odd rows."""

import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check_oracles import compare
from lakewright.llm import source_divergence as sd


def plain(rows, min_docs, top):
    """The report of ``(lang, source, text)`` rows, by its definition."""
    split = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    docs = [(lang or "", source or "", split(text)) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(w for d in own for w in set(d[2]))
        kept = sorted(w for w in held if held[w] >= min_docs)
        def share(words, kept=kept):
            n = Counter(w for w in words if w in kept)
            total = sum(n.values()) + 2 * len(kept)
            return {w: 1 + floor(Fraction(10**9 * (n[w] + 2), total)) for w in kept}, n
        whole = share([w for d in own for w in d[2]])[0]
        groups = {s: share([w for d in own if d[1] == s for w in d[2]]) for s in {d[1] for d in own}}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for source, (p, n) in groups.items():
            pairs = [(-sum(f(p[w], q[w]) for w in kept), other) for other, (q, _) in groups.items() if other != source]
            terms = [(-f(p[w], whole[w]), w) for w in kept if n[w] and p[w] > whole[w]]
            order = lambda found: sorted(found, key=lambda x: (x[0], x[1].encode()))
            out |= {(lang, source, "pair", item, -v, i) for i, (v, item) in enumerate(order(pairs), 1)}
            out |= {(lang, source, "term", item, -v, i) for i, (v, item) in enumerate(order(terms)[:top], 1)}
    return out


def test_query_equals_sql(spark, sf):
    assert compare(spark, sf, ["op12_skyband_source_audit"]) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abé日", min_size=1, max_size=3), st.integers(1, 6), st.integers(1, 6)), max_size=80), st.integers(1, 4))
def test_skyband_keeps_what_fewer_than_k_dominate(rows, k):
    rows = list({r[0]: r for r in rows}.values())
    table = pa.table({"term": [r[0] for r in rows], "n": pa.array([r[1] for r in rows], pa.int64()), "lang_n": pa.array([r[2] for r in rows], pa.int64())}, schema=pa.schema([("term", pa.string()), ("n", pa.int64()), ("lang_n", pa.int64())]))
    def dominates(a, b):
        return a != b and a[1] >= b[1] and a[2] <= b[2] and a[0].encode() < b[0].encode()
    want = {r for r in rows if sum(dominates(o, r) for o in rows) < k}
    got = sd.skyband(table, k)
    if len(rows) > k:
        assert set(zip(*(got[c].to_pylist() for c in ("term", "n", "lang_n")))) == want
    else:
        assert len(got) == len(rows)


def test_skyband_of_many_blocks():
    draw = np.random.default_rng(1)
    n = draw.integers(1, 3000, 6000)
    lang_n = n + draw.integers(0, 3000, 6000)
    terms = [f"t{x:05d}" for x in draw.permutation(6000)]
    rank = np.argsort(np.argsort(terms))
    got = sd.skyband(pa.table({"term": terms, "n": n, "lang_n": lang_n}), 10)
    above = (n[:, None] >= n) & (lang_n[:, None] <= lang_n) & (rank[:, None] < rank)
    assert set(got["term"].to_pylist()) == {terms[i] for i in np.flatnonzero(above.sum(0) < 10)}


def test_shares_are_exact():
    counts, totals = np.array([0, 1, 10**12, 4 * 10**15]), np.array([2, 7, 3 * 10**12 + 1, 9 * 10**15])
    want = [1 + 10**9 * (int(c) + 2) // int(t) for c, t in zip(counts, totals)]
    assert sd.shares(counts, totals).tolist() == want


ROWS = [
    ("en", "a", "One two two THREE é é Ünder_score"), ("en", "a", "one two x1y"), ("en", "b", "two two two"), ("en", None, None),
    ("en", "b", "one one three"), ("en", "c", ""), (None, "a", "one two"), ("", "b", "one two"), ("", None, "two"), ("fr", "z", "Seul ÉTÉ été"),
] * 2 + [("en", "long", "two one three four " * 30_000), ("en", "a\nb", "four three")]


@pytest.mark.parametrize("min_docs, top, width", [(2, 10, 256), (2, 1, 2), (3, 2, 1), (100, 10, 256)])
def test_odd_rows(spark, monkeypatch, min_docs, top, width):
    monkeypatch.setattr(sd, "CELLS", 5)  # several tasks per language
    df = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "lang string, source string, text string, n int, term string")
    got = sd.audit_sources(df.repartition(5), min_docs=min_docs, top=top, width=width).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == plain(ROWS, min_docs, top)


def test_empty_table_and_small_buffers(spark):
    df = spark.createDataFrame(ROWS, "lang string, source string, text string")
    assert sd.audit_sources(df.where("false")).count() == 0
    rows = df.fillna("")
    whole = sorted(map(tuple, sd.count_terms(rows).collect()))
    assert whole == sorted(map(tuple, sd.count_terms(rows, held=2).collect()))
    entries = sd.count_terms(rows).withColumnRenamed("docs", "lang_n").repartition(40)
    assert sorted(sd.skybands(entries, 2, held=1).collect()) == sorted(sd.skybands(entries.coalesce(1), 2).collect())
