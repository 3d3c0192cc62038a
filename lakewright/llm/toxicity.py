"""Toxicity classifier: words as averages of subword embeddings, averaged in turn into a linear softmax, trained jointly in numpy.

A word is the mean of the embeddings of its character n-grams, all hashed to one table, so that an unseen spelling is placed by the
n-grams it shares with known ones; words have no entry of their own, which would only learn them by heart. A bag is the
mean of some consecutive words, one unless told otherwise, and the softmax over two classes gives its log odds. A
document's log odds pool those of its bags: a soft average (the log of their mean exponential, at a low sharpness) in which a few telling
words still mark a long text. Embeddings and softmax learn together, by Adagrad on the document's label, with decaying embeddings.

Training takes a bounded sample of labelled documents to the driver (``Settings.sample``, ``Settings.sample_bytes``); scoring runs on
all rows where they are and sends one number per hash bucket along.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.rows import Memo, forget_in_worker, lean

EDGES = ".,;:!?\"'()[]{}<>|*_-#`~…«»“”‘’¿¡/\\$%&@+="


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled documents trained on, half of them of each label where there are enough.

    ``sample_bytes``: longer documents are not trained on (they are scored like all others).
    """

    sample: int = 3000
    sample_bytes: int = 50_000
    buckets: int = 1 << 16
    dim: int = 8
    shortest: int = 3  # characters of an n-gram
    longest: int = 6
    bag: int = 1  # words
    epochs: int = 9
    batch: int = 50  # at most; a twentieth of a small sample, but ten documents at least
    updates: int = 360  # a small sample is gone through more often
    rate: float = 0.3
    decay: float = 0.001  # of the embeddings at each update, so that what few documents hold fades
    sharpness: float = 0.28  # of pooling: 0 would be the mean of the log odds, infinity their maximum
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """What scoring needs: the log odds that each bucket stands for, and the intercept."""

    odds: np.ndarray
    intercept: float
    settings: Settings


def words_of(text: str) -> list[str]:
    return text.lower().split()


def word_features(word: str, settings: Settings) -> list[int]:
    """The buckets of the n-grams of a word, without punctuation at its ends and with marks for start and end; a short word is its own."""
    word = f"<{word.strip(EDGES)}>"
    data, size, crc, buckets = word.encode("utf-8", "replace"), len(word), zlib.crc32, settings.buckets
    lengths = range(settings.shortest, min(settings.longest, size - 1) + 1)
    if not lengths:
        return [crc(data) % buckets]
    if len(data) == size:
        return [crc(data[i : i + n]) % buckets for n in lengths for i in range(size - n + 1)]
    at = [0, *accumulate(len(c.encode("utf-8", "replace")) for c in word)]  # where characters begin
    return [crc(data[at[i] : at[i + n]]) % buckets for n in lengths for i in range(size - n + 1)]


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + counts[i] - 1 for every i, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _sums(rows: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(of, weights=rows[:, k], minlength=n) for k in range(rows.shape[1])], axis=1)


class Sample:
    """Texts as numbers: the words of each, and the buckets of each word."""

    def __init__(self, texts: list[str], settings: Settings) -> None:
        vocabulary: dict[str, int] = {}
        self.docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t) or [""]]) for t in texts]
        features = [np.array(word_features(w, settings)) for w in vocabulary]
        self.counts = np.array([len(f) for f in features])
        self.first, self.flat = np.cumsum(self.counts) - self.counts, np.concatenate(features)


def gradients(values: tuple, sample: Sample, chosen: np.ndarray, y: np.ndarray, settings: Settings) -> tuple[float, tuple]:
    """Mean log loss of the ``chosen`` documents with labels ``y``, and its gradients by table, softmax weights and biases."""
    table, out, bias = values
    tokens = np.concatenate([sample.docs[i] for i in chosen])
    lengths = np.array([len(sample.docs[i]) for i in chosen])
    bags_of = -(-lengths // settings.bag)  # bags per document
    bag_sizes = np.full(bags_of.sum(), settings.bag)
    bag_sizes[np.cumsum(bags_of) - 1] = lengths - (bags_of - 1) * settings.bag
    words, place = np.unique(tokens, return_inverse=True)
    counts = sample.counts[words]
    buckets = sample.flat[_spans(sample.first[words], counts)]
    vectors = np.add.reduceat(table[buckets], np.cumsum(counts) - counts) / counts[:, None]
    bags = np.add.reduceat(vectors[place], np.cumsum(bag_sizes) - bag_sizes) / bag_sizes[:, None]
    logits = bags @ out + bias
    odds = settings.sharpness * (logits[:, 1] - logits[:, 0])
    doc_of, starts = np.repeat(np.arange(len(chosen)), bags_of), np.cumsum(bags_of) - bags_of
    top = np.maximum.reduceat(odds, starts)
    raised = np.exp(odds - top[doc_of])
    total = np.add.reduceat(raised, starts)
    pooled = (top + np.log(total / bags_of)) / settings.sharpness
    loss = float(np.mean(np.logaddexp(0, np.where(y, -pooled, pooled))))
    miss = 1 / (1 + np.exp(-pooled)) - y
    slope = (miss / len(chosen))[doc_of] * raised / total[doc_of]
    by_class = np.stack([-slope, slope], axis=1)
    of_word = np.repeat(by_class @ out.T / bag_sizes[:, None], bag_sizes, axis=0)
    of_vector = _sums(of_word, place, len(words)) / counts[:, None]
    return loss, (_sums(np.repeat(of_vector, counts, axis=0), buckets, settings.buckets), bags.T @ by_class, by_class.sum(axis=0))


def fit(texts: list[str], labels: list[int], settings: Settings, prior: float | None = None) -> Model:
    """Train on whole texts. ``prior``, the true share of label 1, corrects the intercept for how the sample was drawn.

    Without texts of both labels every text gets the share of label 1 as its score, one half without any.
    """
    y = np.array(labels, dtype=float)
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        odds = 0.0 if not len(y) else math.inf if share else -math.inf
        return Model(np.zeros(settings.buckets, np.float32), odds, settings)
    sample = Sample(texts, settings)
    random = np.random.default_rng(settings.seed)
    table = random.uniform(-1 / settings.dim, 1 / settings.dim, (settings.buckets, settings.dim))
    out, bias = np.zeros((settings.dim, 2)), np.zeros(2)
    out[:, 1] = random.uniform(-1, 1, settings.dim)
    values = (table, out, bias)
    past = [np.full_like(x, 1e-8) for x in values]
    batch = min(settings.batch, max(10, len(y) // 20))
    epochs = max(settings.epochs, -(-settings.updates // -(-len(y) // batch)))
    odds, intercept, kept = np.zeros(settings.buckets), 0.0, 0
    for epoch in range(epochs):
        order = random.permutation(len(y))
        for at in range(0, len(y), batch):
            chosen = order[at : at + batch]
            _, steps = gradients(values, sample, chosen, y[chosen], settings)
            for value, grad, seen in zip(values, steps, past):
                seen += grad * grad
                value -= settings.rate * grad / np.sqrt(seen)
            table *= 1 - settings.decay
        if 3 * epoch >= epochs:  # the model is the mean of what the last two thirds of the epochs end with
            odds, intercept, kept = odds + table @ (out[:, 1] - out[:, 0]), intercept + bias[1] - bias[0], kept + 1
    odds, intercept = odds / kept, intercept / kept
    if prior is not None and 0 < prior < 1:
        intercept += math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    return Model(odds.astype(np.float32), float(intercept), settings)


class Scorer:
    """Scores texts; remembers the log odds of words."""

    def __init__(self, model: Model, remembered: int = 300_000) -> None:
        self.model, self.memo, self.odds = model, Memo(remembered), model.odds.tolist()

    def word(self, word: str) -> float:
        value = self.memo.recall(word)
        if value is None:
            buckets = word_features(word, self.model.settings)
            value = sum([self.odds[b] for b in buckets]) / len(buckets)
            if len(word) <= 64:
                self.memo.put(word, value)
        return value

    def score(self, text: str) -> float:
        words, known = words_of(text), self.memo.young
        pooled = 0.0
        if words:
            values = [known.get(w) for w in words]
            if None in values:
                values = [self.word(w) if v is None else v for w, v in zip(words, values)]
            starts = np.arange(0, len(words), self.model.settings.bag)
            sizes = np.minimum(len(words) - starts, self.model.settings.bag)
            odds = self.model.settings.sharpness * np.add.reduceat(values, starts) / sizes
            top = odds.max()
            pooled = (top + math.log(np.exp(odds - top).mean())) / self.model.settings.sharpness
        odds = pooled + self.model.intercept
        return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def held_out(id_col: str) -> Column:
    """Whether a row is kept from training: crc32 of its id as text leaves 2 when divided by 4. Null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, settings: Settings) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out, the same at every run.

    Labels that are null count for nothing; a document labelled twice is taken once for each.
    """
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)").where(~held_out("id"))
    counts = {r.y: r.n for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    half = settings.sample // 2
    size = {1: min(counts.get(1, 0), max(half, settings.sample - counts.get(0, 0)))}
    size[0] = min(counts.get(0, 0), settings.sample - size[1])
    chosen = [usable.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in size.items()]
    sample = chosen[0].unionByName(chosen[1])  # at most settings.sample rows of two numbers
    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.where(F.octet_length("text") <= settings.sample_bytes)
    rows = texts.join(F.broadcast(sample), "id").orderBy(F.xxhash64("id"), "id", "y", F.xxhash64("text")).limit(settings.sample).collect()
    prior = counts.get(1, 0) / sum(counts.values()) if counts else None
    return fit([r.text for r in rows], [r.y for r in rows], settings, prior)


def score_documents(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = 0.3,
    settings: Settings = Settings(),
) -> DataFrame:
    """All columns of ``df`` as the struct ``row``, with ``score`` (0 to 1), ``predicted`` (score >= threshold) and ``held_out``.

    Empty and null texts get the score of a text that says nothing: the intercept's. Rows are scored
    one by one, so repeated rows and null ids need no rule; an empty table gives no rows.
    """
    model = train(df, labels, id_col, text_col, label_col, settings)
    # plain values: a broadcast is pickled by reference, and executors may have no copy of the package
    sent = df.sparkSession.sparkContext.broadcast((model.odds, model.intercept, asdict(settings)))

    @F.pandas_udf("double")
    @lean
    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget_in_worker()
        odds, intercept, known = sent.value
        scorer = Scorer(Model(odds, intercept, Settings(**known)))
        for texts in series:
            yield pd.Series([scorer.score(t) if t else scorer.score("") for t in texts], dtype="float64")

    scored = df.select(F.struct("*").alias("row")).withColumn("score", score(F.col(f"row.{text_col}")))
    return scored.withColumns(
        {"predicted": (F.col("score") >= threshold).cast("int"), "held_out": held_out(f"row.{id_col}")}
    )


def drop_toxic(df: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that are not predicted toxic; options and rules as in ``score_documents``."""
    return score_documents(df, labels, **options).where("predicted = 0").select("row.*")
