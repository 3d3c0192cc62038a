"""Toxicity and language-model scoring: held-out accuracy and a model in plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakewright.llm import lm_scoring, toxicity
from lakewright.llm.queries import QUERIES


def plain_scores(texts, train, settings):
    """The interpolated pair model, token by token, with Python's own counters."""

    def tokens(text):
        return [*text.encode().lower().split(), b"\n"]

    single, pairs = Counter(), Counter()
    for key, text in texts.items():
        if train(key):
            single.update(tokens(text))
            pairs.update(zip([b"\n", *tokens(text)], tokens(text)))
    n, v = sum(single.values()), len(single)
    contexts = {w for w, c in single.items() if c >= settings.share * n}
    kept = {p: c for p, c in pairs.items() if c >= settings.least and set(p) <= contexts}
    rest = {h: 1.0 for h in contexts}
    for (h, _), c in kept.items():
        rest[h] -= (c - settings.discount) / single[h]
    found = {}
    for key, text in texts.items():
        own, base, score, before = tokens(text), 0.0, 0.0, b"\n"
        for w in own:
            p = (single[w] + 1) / (n + v + 1)
            base += math.log10(p)
            if before in contexts:
                p = rest[before] * p + max(kept.get((before, w), settings.discount) - settings.discount, 0) / single[before]
            score += math.log10(p)
            before = w
        found[key] = (len(own), sum(single[w] > 0 for w in own), n, base, score)
    return found


def check_scores(got, want):
    assert len(got) == len(want)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.id][:3]
        assert r.base_score == pytest.approx(want[r.id][3], abs=1e-9) and r.score == pytest.approx(want[r.id][4], abs=1e-9)


@pytest.mark.parametrize("share, block", [(1e-5, 32 << 20), (2e-3, 1 << 16)])
def test_lm_scores(spark, sf, share, block):
    settings = lm_scoring.Settings(share=share, block_bytes=block)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = lm_scoring.score_documents(docs, F.col("id") % 5 != 0, settings=settings).collect()
    check_scores(got, plain_scores({r.doc_id: r.text for r in docs.collect()}, lambda k: k % 5 != 0, settings))


def test_lm_scores_of_odd_rows(spark):
    settings = lm_scoring.Settings(share=0.01)
    texts = {-3: "", 1: "A b\x0bc", 2: "a b c a b c " * 50, 3: " a\n", 10**12: "ÄB äb ÄB " + "x" * 9999}
    df = spark.createDataFrame([(k, v or None, 1) for k, v in texts.items()], "doc_id long, text string, block int")
    for train in (lambda k: k != 3, lambda k: k > 0, lambda k: False):
        condition = F.col("id").isin([k for k in texts if train(k)])
        check_scores(lm_scoring.score_documents(df, condition, settings=settings).collect(), plain_scores(texts, train, settings))
    assert lm_scoring.score_documents(df.where("false"), F.lit(True)).count() == 0
    twice = df.unionByName(spark.createDataFrame([(None, "a b", 1), (1, "A b\x0bc", 1)], df.schema))
    assert sorted(r.n_tokens for r in lm_scoring.score_documents(twice, F.lit(True)).collect()) == [1, 2, 3, 4, 4, 5, 301]


def test_probabilities_sum_to_one():
    """Over all known words and one unknown word, in every state."""
    words, counts = lm_scoring.word_keys([b"a b a c", b"a b d", b"e a b"])
    keys, c = np.unique(words, return_counts=True)
    pairs = lm_scoring.pairs_of(lm_scoring.find(keys, words), counts, int(lm_scoring.find(keys, np.array([lm_scoring.END_KEY]))[0]))
    pair, pc = np.unique(pairs, return_counts=True)
    pair, pc = pair[pc > 1], pc[pc > 1]
    rest = np.ones(len(keys))
    np.subtract.at(rest, pair >> 32, (pc - 0.75) / c[pair >> 32])
    contexts = lm_scoring.Contexts(keys, c, np.log10(rest), int(c.sum()), len(keys))
    none = np.array([], np.int64)
    automaton = lm_scoring.Automaton(contexts, lm_scoring.Settings(), none, none, pair, pc)
    for context in keys:
        everything = [*keys, 12345]
        steps = [automaton.run(np.array([context, w]), np.array([2]))[2][0] - automaton.run(np.array([context]), np.array([1]))[2][0] for w in everything]
        assert sum(10**s for s in steps) == pytest.approx(1)


def test_lm_query(spark, sf):
    got = QUERIES["op5_backoff_scoring"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got) and len(got) == 200
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op3_subword_toxicity"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(got[r.doc_id], r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    wrong = sum(r.predicted != toxic for r, toxic in held)
    assert wrong <= 0.01 * len(held) and sum(t for _, t in held) > 50


def made_up(n, bad_words, seed):
    draw = random.Random(seed)
    good = ["the", "river", "stone", "runs", "along", "quiet", "fields", "morning", "light"]
    texts, labels = [], []
    for i in range(n):
        words = [draw.choice(good) for _ in range(draw.randint(1, 80))]
        if i % 3 == 0:
            words[draw.randrange(len(words))] = draw.choice(bad_words)
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_unseen_spellings_share_ngrams():
    model = toxicity.fit(*made_up(600, ["horrible", "nastiness", "wretched"], 1), toxicity.Settings(sample=600))
    scorer = toxicity.Scorer(model)
    odd, labels = made_up(150, ["horribble", "nastinesss", "wretcheed"], 2)
    right = sum((scorer.score(t) >= 0.3) == bool(y) for t, y in zip(odd, labels))
    assert right >= 145 and scorer.score("") < 0.5


def test_toxicity_score_is_the_formula():
    settings = toxicity.Settings(buckets=97, dim=3, bag=2, sharpness=0.5)
    model = toxicity.Model(np.linspace(-2, 3, 97).astype(np.float32), -0.4, settings)

    def odds(word):
        word = f"<{word.lower().strip(toxicity.EDGES)}>"
        grams = [word[i : i + n] for n in (3, 4, 5, 6) for i in range(len(word) - n + 1) if n < len(word)] or [word]
        return sum(float(model.odds[zlib.crc32(g.encode()) % 97]) for g in grams) / len(grams)

    for text in ("One two, THREE four five!", "a", "", "x " * 501, "é ** <b> réeux"):
        words = text.split()
        bags = [words[i : i + 2] for i in range(0, len(words), 2)]
        each = [math.exp(0.5 * sum(map(odds, bag)) / len(bag)) for bag in bags]
        pooled = math.log(sum(each) / len(each)) / 0.5 if each else 0.0
        assert toxicity.Scorer(model).score(text) == pytest.approx(1 / (1 + math.exp(0.4 - pooled)))


def test_toxicity_gradients():
    settings = toxicity.Settings(buckets=23, dim=3, bag=2, sharpness=0.7)
    sample = toxicity.Sample(["one two three", "", "two two four five six", "SEVEN!"], settings)
    draw = np.random.default_rng(1)
    values, y = (draw.normal(size=(23, 3)), draw.normal(size=(3, 2)), draw.normal(size=2)), np.array([1.0, 0.0, 1.0])
    chosen = np.array([2, 1, 0])
    _, steps = toxicity.gradients(values, sample, chosen, y, settings)
    for value, step in zip(values, steps):
        for at in np.ndindex(*value.shape):
            kept, losses = value[at], []
            for moved in (1e-6, -1e-6):
                value[at] = kept + moved
                losses.append(toxicity.gradients(values, sample, chosen, y, settings)[0])
            value[at] = kept
            assert step[at] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-7)


def test_toxicity_needs_no_package_in_tasks():
    """Everything a task gets: the function by value, and a broadcast that names no class of the package."""
    import pickle

    model = toxicity.fit(*made_up(30, ["horrible"], 1), toxicity.Settings(buckets=64))
    assert b"lakewright" not in pickle.dumps((model.odds, model.intercept, toxicity.asdict(model.settings)))


def test_toxicity_of_odd_rows(spark):
    texts, labels = made_up(90, ["horrible"], 3)
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, None, "x"), (5, "", None), (5, "", None), (6, "horrible " * 30000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(1, None), (None, 1), (3, 1)], "doc_id long, toxic int")
    got = toxicity.score_documents(df, marks).collect()
    assert len(got) == 94 and all(0 <= r.score <= 1 for r in got)
    kept = toxicity.drop_toxic(df, marks)
    assert kept.columns == df.columns and 0 < kept.count() < 94
    assert toxicity.score_documents(df.where("false"), marks).count() == 0
    assert {r.score for r in toxicity.score_documents(df, marks.where("false")).collect()} == {0.5}
    assert {r.score for r in toxicity.score_documents(df, marks.where("toxic = 0")).collect()} == {0.0}


def test_pairs_of_rare_words_count(spark):
    """In a long corpus a pair of words far below 1e-5 of all tokens counts as any other."""
    texts = {i: "the cat sat " * 3400 for i in range(30)} | {100 + i: "rara avis" for i in range(3)} | {200: "rara avis", 201: "avis rara"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    settings = lm_scoring.Settings(block_bytes=1 << 17)
    got = lm_scoring.score_documents(df, F.col("id") < 200, settings=settings).collect()
    assert 3 / got[0].train_tokens < 1e-5
    check_scores(got, plain_scores(texts, lambda k: k < 200, lm_scoring.Settings(share=0.0)))
    score = {r.id: r.score - r.base_score for r in got}
    assert score[200] > 5 > 0 > score[201]


def test_pairs_seen_once_count(spark):
    texts = {1: "one two three", 2: "four five", 3: "one two", 4: "two one"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = lm_scoring.score_documents(df, F.col("id") < 3).collect()
    check_scores(got, plain_scores(texts, lambda k: k < 3, lm_scoring.Settings(least=1)))
    score = {r.id: r.score - r.base_score for r in got}
    assert score[3] > 0 > score[4]


def test_requests_hold_a_pair_in_some_ten_bytes():
    """A pair of a block used to take 32 bytes of the shuffle."""
    draw = random.Random(7)
    texts = [" ".join(f"w{int(draw.paretovariate(0.6)) % 30_000}" for _ in range(800)) for _ in range(250)]
    batch = pa.RecordBatch.from_pydict({"block": pa.array([3] * 250, pa.int32()), "train": [True] * 250, "bytes": [t.encode() for t in texts]})
    dealing = lm_scoring.Dealing(4, np.unique(lm_scoring.word_keys([b"w1 w2 w3"])[0]))
    requests = list(lm_scoring._asked(dealing)(iter([batch])))
    words, pairs = set(), Counter()
    for text in texts:
        tokens = text.split()
        words.update(tokens)
        pairs.update(zip(["\n", *tokens], [*tokens, "\n"]))
    found = [lm_scoring.unsqueezed(x.as_py()) for r in requests for x in r.column("bytes")]
    assert sum(len(f[0]) for f in found) == len(words) + 1 and sum(len(f[3]) for f in found) == len(pairs)
    assert sum(f[4].sum() for f in found) == sum(pairs.values()) == sum(f[1].sum() for f in found)
    assert sum(len(x.as_py()) for r in requests for x in r.column("bytes")) < 12 * len(pairs) + 9 * len(words)


def test_what_is_staged_stays_below_the_texts(spark, monkeypatch, tmp_path):
    """Counts of pairs used to be written as 24 bytes for each pair of a block, more than the texts themselves."""
    draw = random.Random(8)
    rows = [(i, " ".join(str(draw.randrange(40_000)) for _ in range(1000))) for i in range(200)]
    size = sum(len(t) for _, t in rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def stage(df, label):
        df.write.parquet(str(tmp_path / label))
        return spark.read.schema(df.schema).parquet(str(tmp_path / label))

    monkeypatch.setattr(lm_scoring, "stage", stage)
    assert lm_scoring.score_documents(df, F.col("id") % 3 != 0).count() == 200
    assert 0 < sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < size / 2


@pytest.mark.parametrize("spread", [0, 2, 4096])
def test_where_pairs_are_counted_changes_nothing(spark, monkeypatch, spread):
    monkeypatch.setattr(lm_scoring, "SPREAD", spread)
    monkeypatch.setattr(lm_scoring, "SAMPLE", 1000)
    draw = random.Random(9)
    texts = {i: " ".join(f"{int(draw.paretovariate(0.8))}" for _ in range(draw.randrange(60))) for i in range(300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for settings in (lm_scoring.Settings(block_bytes=4000), lm_scoring.Settings(least=2, block_bytes=9000)):
        got = lm_scoring.score_documents(df, F.col("id") % 4 != 0, settings=settings).collect()
        check_scores(got, plain_scores(texts, lambda k: k % 4 != 0, settings))
