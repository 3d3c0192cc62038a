"""Language-model scoring by a weighted backoff automaton over words.

The model interpolates word pairs with single words by absolute discounting::

    p(w)     = (c(w) + 1) / (N + V + 1)
    p(w | h) = max(c(h w) - D, 0) / c(h) + rest(h) * p(w)      for pairs seen at least ``least`` times

where ``rest(h)`` is what the discounted pairs leave, so that each p( | h) sums to 1 over the V known words and one
unknown. As an automaton: a state for each context word and a root; from a state an arc for each of its
pairs, weighted log10 p(w | h), and a failure arc to the root, weighted log10 rest(h); from the root an arc for each word,
weighted log10 p(w). Every arc leads to the state of its word, or to the root if that is no context. A text is read
once from left to right, starting in the state of the end mark, following an arc or the failure arc and
then the root's, and adding up weights.

Nothing that grows with the corpus is held in one place. Every word is a context and every pair is keyed by the keys of
its two words. Documents are read in blocks of neighbouring ids. A block sends the words and pairs that occur in it, with its own
counts, to the parts that keep them: a word and the pairs behind it belong to the part that the word's key names, but the pairs behind one of the most
frequent words are dealt by their second word. A part adds up all blocks and answers each with bare counts, in the order of
the block's own words and pairs; the block, which finds that order again in its texts, runs on the part of the automaton that they can
reach. So a pair travels once, packed, as its second key and the place of its first; texts travel compressed.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.fingerprints import bucket_of
from lakewright.llm.rows import keyed
from lakewright.scratch import stage

END = b"\n"  # no word holds white space
AT_ONCE = 4 << 20  # bytes of texts whose words a task holds together when it scores
SENT = 512 << 10  # and of texts that travel in a row: compressed, it is no humongous object for an executor's heap
COUNTED = 8 << 20  # and when it counts
OUT_ROWS = 100_000  # of counts handed over together
PARTS = 2  # that keep words and pairs, for each block
SPREAD = 4096  # most frequent words, whose pairs are spread over all parts
SAMPLE = 16 << 20  # bytes of texts in which these words are looked for; they settle only where pairs are counted


@dataclass(frozen=True)
class Settings:
    """``least``: a pair's least count. ``block_bytes``: text per block. ``share``: 0, or a context word's least share of all tokens for a smaller model."""

    share: float = 0.0
    least: int = 1
    discount: float = 0.75
    block_bytes: int = 32 << 20


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of all words of all texts, each text followed by the end mark; and the tokens of each text."""
    key, found = xxhash.xxh3_64_intdigest, [np.array([], np.uint64)]
    for text in texts:
        own = text.lower().split()  # of bytes: A-Z, and white space from 9 to 13 and 32
        own.append(END)
        found.append(np.array([key(w) for w in own], np.uint64))
    return np.concatenate(found).view(np.int64), np.array([len(x) for x in found[1:]], np.int64)


END_KEY = int(word_keys([b""])[0][0])


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in an ascending table, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def pairs_of(states: np.ndarray, counts: np.ndarray, end_state: int) -> np.ndarray:
    """State before each token and the token's own state in one long, or -1 where one of them is the root."""
    before = np.empty_like(states)
    before[1:] = states[:-1]
    before[np.cumsum(counts) - counts] = end_state  # every text starts behind an end mark
    return np.where((before >= 0) & (states >= 0), before << 32 | states, -1)


def _parts(batches: Iterator[pa.RecordBatch]):
    """Of batches of ``block, train, bytes``: each block, its words, the tokens of each text, and 1 for each token to learn from."""
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        train = batch.column("train").to_numpy(zero_copy_only=False).astype(np.int64)
        for block in np.unique(blocks).tolist():
            rows = np.flatnonzero(blocks == block)
            own = batch.column("bytes").take(pa.array(rows))
            sizes = np.cumsum([len(x.as_buffer()) for x in own])
            for first, last in runs_of(sizes // COUNTED):
                words, counts = word_keys(own.slice(first, last - first).to_pylist())
                yield block, words, counts, np.repeat(train[rows[first:last]], counts)


def _handed_over(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), OUT_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + OUT_ROWS]) for x in columns], names=names)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's distinct words, how often its texts hold them and how often its training texts do."""
    for _, words, _, learnt in _parts(batches):
        known, n, times = np.unique(words, return_inverse=True, return_counts=True)
        yield from _handed_over([known, times, summed(n, learnt, len(known))], ["key", "seen", "learnt"])


def summed(places: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(places, weights=values, minlength=n).astype(np.int64)


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, each in the smallest type that holds it, compressed."""
    body = []
    for column in columns:
        least, most = (int(column.min()), int(column.max())) if len(column) else (0, 0)
        code = next(c for c in "BHIq" if np.iinfo(c).min <= least and most <= np.iinfo(c).max)
        body += [ord(code).to_bytes(1, "little"), len(column).to_bytes(7, "little"), column.astype(code).tobytes()]
    body = b"".join(body)
    return len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def unsqueezed(packed: bytes) -> list[np.ndarray]:
    """The columns, in the types they were squeezed to."""
    body = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    at, columns = 0, []
    while at < len(body):
        code, n = chr(body[at]), int.from_bytes(body[at + 1 : at + 8], "little")
        columns.append(np.frombuffer(body, code, n, at + 8))
        at += 8 + n * np.dtype(code).itemsize
    return columns


@dataclass(frozen=True)
class Dealing:
    """Which part keeps what. ``spread``: ascending keys of words whose pairs go by their second word."""

    parts: int
    spread: np.ndarray

    def of_words(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) % np.uint64(self.parts)).astype(np.uint16 if self.parts <= 1 << 16 else np.int64)

    def of_pairs(self, known: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Of pairs of places among known words."""
        part, spread = self.of_words(known), find(self.spread, known) >= 0
        found = np.empty(len(pairs), part.dtype)
        for some in pieces(len(pairs)):
            before, word = pairs[some] >> 32, pairs[some] & 0xFFFFFFFF
            found[some] = np.where(spread[before], part[word], part[before])
        return found


def pieces(n: int) -> list[slice]:
    """Of long columns, so that what is made on the way stays small."""
    return [slice(at, at + OUT_ROWS) for at in range(0, n, OUT_ROWS)]


def by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by their part, otherwise as they are, and where each part starts in it."""
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _asked(dealing: Dealing, frequent=None):
    """A function giving, for each block and part, a request: words with their counts in the block's training texts, and pairs with theirs.

    The first word of a pair is written as its place among the request's words, or behind them among the spread ones, less the
    place of the pair before. ``frequent``: only pairs of these words, if given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, words, counts, learnt in _parts(batches):
            known, own = np.unique(words, return_inverse=True)
            times = summed(own, learnt, len(known))
            del words
            pairs = block_pairs(known, own, counts, frequent)
            del own
            pairs <<= 1  # a word's number in a block has fewer than 31 bits; what is negative stays so
            pairs |= learnt
            pairs.sort()
            pairs = pairs[np.searchsorted(pairs, 0) :]
            starts = changes(pairs >> 1)
            pair_times = np.add.reduceat(pairs & 1, starts) if len(pairs) else pairs
            pairs = pairs[starts] >> 1
            order, at = by_part(dealing.of_words(known), dealing.parts)
            place = np.empty_like(order)
            place[order] = np.arange(len(order)) - np.repeat(at[:-1], np.diff(at))
            pair_order, pair_at = by_part(dealing.of_pairs(known, pairs), dealing.parts)
            pairs, pair_times = pairs[pair_order], pair_times[pair_order]
            spread, before = find(dealing.spread, known)[pairs >> 32], place[pairs >> 32]
            behind = np.repeat(np.diff(at), np.diff(pair_at)) + spread
            before, keys = np.where(spread >= 0, behind, before), known[pairs & 0xFFFFFFFF]
            requests, found = [], np.flatnonzero((np.diff(at) > 0) | (np.diff(pair_at) > 0)).tolist()
            for part in found:
                mine, some = order[at[part] : at[part + 1]], slice(pair_at[part], pair_at[part + 1])
                requests.append(squeezed(known[mine], times[mine], np.diff(before[some], prepend=0), keys[some], pair_times[some]))
            columns = [pa.array(found, pa.int32()), pa.array([block] * len(found), pa.int32()), pa.array(requests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "bytes"])

    return run


def block_pairs(known: np.ndarray, own: np.ndarray, counts: np.ndarray, frequent=None) -> np.ndarray:
    """``pairs_of`` texts whose tokens are given by their places among known words."""
    end = own[counts[0] - 1]  # behind the first text comes an end mark
    if frequent is not None:
        own = np.where(find(frequent.value, known) >= 0, np.arange(len(known)), -1)[own]
        end = own[counts[0] - 1]
    return pairs_of(own, counts, end)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows start."""
    if not len(columns[0]):
        return np.array([], np.int64)
    new = np.any([x[1:] != x[:-1] for x in columns], axis=0)
    return np.flatnonzero(np.concatenate([[True], new]))


def added(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of runs."""
    return np.add.reduceat(values, starts, dtype=np.int64) if len(starts) else np.array([], np.int64)


def answers_of(requests: list[tuple[int, bytes]], settings: Settings, spread: np.ndarray) -> pa.RecordBatch:
    """What a part makes of all requests, given with their blocks. For each block an answer: of its words in this part, but the spread ones, the
    count, the tokens its pairs do not account for and the number of its pairs; and the count of each pair, 0 for fewer than
    ``least``; all in the order of the keys. And rows without a block: the same numbers of each spread word, as far as this part knows, and the tokens and
    distinct words of the others."""
    words, pairs = [], []
    while requests:
        block, packed = requests.pop()
        own, times, before, keys, pair_times = unsqueezed(packed)
        words.append([own.astype(np.int64), times, np.full(len(own), block, np.int32)])
        first = np.concatenate([own.astype(np.int64), spread])[np.cumsum(before, dtype=np.int64)]
        pairs.append([first, keys.astype(np.int64), pair_times, np.full(len(keys), block, np.int32)])
    word, times, blocks = [np.concatenate(x) for x in zip(*words)]
    del words
    order = np.lexsort((blocks, word))
    word, times, blocks = word[order], times[order], blocks[order]
    starts = changes(word)
    c = added(times, starts)
    entry = changes(word, blocks)
    entry_of, entry_block, word = np.searchsorted(starts, entry, "right") - 1, blocks[entry], word[starts]

    columns = [*zip(*pairs)]
    del pairs
    before, keys, times, blocks = [np.concatenate(columns.pop(0)) for _ in range(4)]
    order = np.lexsort((blocks, keys, before))
    before, keys, times, blocks = before[order], keys[order], times[order], blocks[order]
    del order
    starts = changes(before, keys)
    total = added(times, starts)
    total[total < settings.least] = 0
    pair_entry = changes(before, keys, blocks)
    pair_block, pair_total = blocks[pair_entry], total[np.searchsorted(starts, pair_entry, "right") - 1]
    some = np.flatnonzero(total)
    context, taken = before[starts[some]], total[some]
    at = changes(context)
    taken, arcs, context = added(taken, at), np.diff(np.append(at, len(context))), context[at]

    behind, by_pairs, n_arcs = find(word, context), np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
    own = behind >= 0
    by_pairs[behind[own]], n_arcs[behind[own]] = taken[own], arcs[own]
    is_spread, far = find(spread, word) >= 0, np.flatnonzero(~own)  # contexts kept elsewhere are spread ones
    parts = [(word[is_spread], c[is_spread], by_pairs[is_spread], n_arcs[is_spread]), (context[far], 0 * far, taken[far], arcs[far])]
    key, count, by, n = [np.concatenate(x) for x in zip(*parts)]
    others = c[~is_spread]

    mine = np.flatnonzero(~is_spread[entry_of])
    mine = mine[np.argsort(entry_block[mine], kind="stable")]
    entry_of, entry_block = entry_of[mine], entry_block[mine]
    order = np.argsort(pair_block, kind="stable")
    pair_block, pair_total = pair_block[order], pair_total[order]
    found, answers = np.union1d(entry_block, pair_block), []
    ends = [np.searchsorted(x, found, side) for x in (entry_block, pair_block) for side in ("left", "right")]
    for a, b, first, last in zip(*ends):
        held = entry_of[a:b]
        answers.append(squeezed(c[held], c[held] - by_pairs[held], n_arcs[held], pair_total[first:last]))
    none, n_all = len(answers), len(answers) + len(key) + 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*found.tolist(), *[None] * (n_all - none)], pa.int32()),
            pa.array([*answers, *[None] * (n_all - none)], pa.binary()),
            pa.array([*[None] * none, *key.tolist(), None], pa.int64()),
            pa.array([*[None] * none, *count.tolist(), int(others.sum())], pa.int64()),
            pa.array([*[None] * none, *by.tolist(), 0], pa.int64()),
            pa.array([*[None] * none, *n.tolist(), int(np.count_nonzero(others))], pa.int64()),
        ],
        names=["block", "bytes", "key", "c", "by_pairs", "arcs"],
    )


ANSWERS = "part int, block int, bytes binary, key long, c long, by_pairs long, arcs long"


def _answered(settings: Settings, spread: np.ndarray):
    """A function over requests sorted by part, each part's answers."""

    def answers(part: int, requests: list) -> pa.RecordBatch:
        rows = answers_of(requests, settings, spread)
        return rows.add_column(0, "part", pa.array([part] * rows.num_rows, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            parts = batch.column("part").to_numpy()
            blocks, requests = batch.column("block").to_pylist(), batch.column("bytes")
            for at, to in runs_of(parts):
                if parts[at] != part:
                    if held:
                        yield answers(part, held)
                    part, held = int(parts[at]), []
                held += [(blocks[i], requests[i].as_py()) for i in range(at, to)]
        if held:
            yield answers(part, held)

    return run


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``id, train, bytes`` of neighbouring documents of a block, compressed together."""
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        for block in np.unique(blocks).tolist():
            own = batch.select(["id", "train", "bytes"]).take(pa.array(np.flatnonzero(blocks == block)))
            sizes = np.cumsum([len(x.as_buffer()) for x in own.column("bytes")])
            for first, last in runs_of(sizes // SENT):
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(own.slice(first, last - first))
                columns = [pa.array([block], pa.int32()), pa.array([sink.getvalue()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "bytes"])


@dataclass(frozen=True)
class Contexts:
    """Ascending keys of a block's context words, their counts, log10 of what their pairs leave; N and V."""

    keys: np.ndarray
    counts: np.ndarray
    rest: np.ndarray
    tokens: int
    words: int


def score_documents(
    df: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """``id, train, n_tokens, n_known, train_tokens, base_score, score`` per row.

    ``train``, a condition on the column ``id``, says which documents the model learns from (null: not).
    ``base_score`` is the sum of log10 p(w), ``score`` the automaton's weight. Null and empty texts are one end mark. Rows of
    equal or null ids are texts of their own. Without any training document every word is
    unknown and p is 1. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = keyed(df, id_col, text_col).withColumn("train", F.coalesce(train, F.lit(False)))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / settings.block_bytes))
    shares = [i / n_blocks for i in range(1, n_blocks)] or [0.5]
    bounds = rows.agg(F.percentile_approx("rid", shares, 100 * n_blocks)).first()[0] or []
    rows = rows.withColumn("block", bucket_of(F.col("rid"), sorted(set(bounds)) if n_blocks > 1 else []))
    texts = rows.select("block", "train", F.col("text").cast("binary").alias("bytes"))

    counted = "key long, seen long, learnt long"
    frequent = None
    if settings.share > 0:  # at most 1 / share of them
        totals = stage(texts.mapInArrow(_words, counted).groupBy("key").agg(F.sum("learnt").alias("c")).where("c > 0"), "word_counts")
        least = settings.share * (totals.agg(F.sum("c")).first()[0] or 0)
        keys = [r.key for r in totals.where(F.col("c") >= least).orderBy("key").collect()]
        frequent = spark.sparkContext.broadcast(np.array(keys, np.int64))
    some = texts.sample(SAMPLE / size, 0) if size > SAMPLE else texts
    often = some.mapInArrow(_words, counted).groupBy("key").agg(F.sum("seen").alias("n")).orderBy(F.desc("n"), "key").limit(SPREAD)
    dealing = Dealing(PARTS * n_blocks, np.array(sorted(r.key for r in often.collect()), np.int64))

    asked = texts.mapInArrow(_asked(dealing, frequent), "part int, block int, bytes binary")
    asked = asked.repartitionById(dealing.parts, "part").sortWithinPartitions("part")
    answers = stage(asked.mapInArrow(_answered(settings, dealing.spread), ANSWERS), "answers")
    known = answers.where("block is null").groupBy("key").agg(*[F.sum(c).alias(c) for c in ("c", "by_pairs", "arcs")])
    facts, tokens, distinct = [], 0, 0
    for r in known.collect():  # a row for each spread word and one for all others
        tokens += r.c
        distinct += r.arcs if r.key is None else r.c > 0
        if r.key is not None:
            facts.append((r.key, r.c, r.c - r.by_pairs, r.arcs))

    answers = answers.where("block is not null").select("block", F.lit(1).alias("kind"), "part", "bytes")
    docs = rows.select("block", "id", "train", F.col("text").cast("binary").alias("bytes"))
    docs = docs.mapInArrow(_sent, "block int, bytes binary").select("block", F.lit(0).alias("kind"), F.lit(0).alias("part"), "bytes")
    together = docs.unionByName(answers).repartitionById(n_blocks, "block").sortWithinPartitions("block", "kind", "part")
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    facts = np.array(sorted(facts), np.int64).reshape(-1, 4).T
    return together.mapInArrow(_scored(settings, dealing, frequent, facts, tokens, distinct), schema)


class Automaton:
    """The part of the automaton that a block's texts can reach."""

    def __init__(self, contexts: Contexts, settings: Settings, words, word_counts, pairs, pair_counts) -> None:
        self.contexts, self.discount = contexts, settings.discount
        order = np.argsort(words)
        self.words, self.word_counts = words[order], word_counts[order]
        if np.any(pairs[1:] < pairs[:-1]):
            order = np.argsort(pairs)
            pairs, pair_counts = pairs[order], pair_counts[order]
        self.pairs, self.pair_counts = pairs, pair_counts
        self.start = int(find(contexts.keys, np.array([END_KEY]))[0])

    def run(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, the sum of root weights and the weight of its path."""
        return self.weigh(*np.unique(words, return_inverse=True), counts)

    def weigh(self, known: np.ndarray, own: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``run`` over tokens given by their places among ascending words.

        The state behind a token is the token's own, so the steps of all texts are taken at once, and equal steps once.
        """
        c = self.contexts
        states, rare = find(c.keys, known), find(self.words, known)
        seen = np.where(states >= 0, np.append(c.counts, 0)[states], np.append(self.word_counts, 0)[rare])
        root = np.log10((seen + 1) / (c.tokens + c.words + 1))
        # in front of a text stands an end mark, here the place behind all words
        steps, step = np.unique(pairs_of(own.astype(np.int64), counts, len(known)), return_inverse=True)
        before, word = np.append(states, self.start)[steps >> 32], steps & 0xFFFFFFFF
        failed = np.append(c.rest, 0.0)[before]  # nothing is added in the root itself
        weight = root[word] + failed
        arc = find(self.pairs, np.where((before >= 0) & (states[word] >= 0), before << 32 | states[word], -1))
        hit = np.flatnonzero(arc >= 0)
        weight[hit] = np.log10((self.pair_counts[arc[hit]] - self.discount) / c.counts[before[hit]] + 10 ** weight[hit])
        starts = np.cumsum(counts) - counts
        return tuple(np.add.reduceat(x, starts) for x in ((seen > 0)[own], root[own], weight[step]))


def runs_of(values: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal values start and end."""
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def placed(part: np.ndarray, answers: list[np.ndarray]) -> np.ndarray:
    """Answers of all parts in ascending order, put where each row's part says."""
    found = np.concatenate(answers) if answers else np.array([], np.int64)
    if len(found) != len(part):
        raise ValueError(f"{len(found)} answers for {len(part)} words or pairs of a block")
    values = np.empty_like(found)
    values[np.argsort(part, kind="stable")] = found
    return values


@dataclass(frozen=True)
class Model:
    """What all blocks share. ``facts``: keys of the spread words with counts, tokens not taken by pairs and numbers of pairs."""

    settings: Settings
    dealing: Dealing
    facts: np.ndarray
    tokens: int
    words: int

    def automaton(self, known: np.ndarray, pairs: np.ndarray, answers: list[bytes]) -> Automaton:
        """Of a block's words and pairs, both ascending, and the answers of all parts."""
        answers = [*map(unsqueezed, answers)]
        at = find(self.facts[0], known)
        numbers = np.append(self.facts[1:], np.zeros((3, 1), np.int64), axis=1)[:, at]
        others = np.flatnonzero(find(self.dealing.spread, known) < 0)
        part = self.dealing.of_words(known[others])
        for i in range(3):
            numbers[i, others] = placed(part, [a[i] for a in answers])
        times = placed(self.dealing.of_pairs(known, pairs), [a[3] for a in answers])
        c, left, arcs = numbers
        context = (c > 0) & (c >= self.settings.share * self.tokens)
        rest = np.log10((left[context] + self.settings.discount * arcs[context]) / c[context])
        contexts = Contexts(known[context], c[context], rest, self.tokens, self.words)
        rare = (c > 0) & ~context
        state = np.where(context, np.cumsum(context) - 1, -1)
        pairs, times = pairs[times > 0], times[times > 0]
        for some in pieces(len(pairs)):
            pairs[some] = state[pairs[some] >> 32] << 32 | state[pairs[some] & 0xFFFFFFFF]
        return Automaton(contexts, self.settings, known[rare], c[rare], pairs, times)


class Block:
    """A block's texts, as places among the words of each run of them, until all its answers are there."""

    def __init__(self, frequent) -> None:
        self.frequent, self.docs, self.size = frequent, [], 0
        self.runs, self.pairs, self.answers = [], [], []

    def add(self, packed: pa.Buffer) -> None:
        for docs in pa.ipc.open_stream(packed):
            self.docs.append(docs)
            self.size += docs.nbytes
        if self.size >= AT_ONCE:
            self.end_run()

    def end_run(self) -> None:
        if not self.docs:
            return
        words, counts = word_keys([text for docs in self.docs for text in docs.column("bytes").to_pylist()])
        docs = pa.Table.from_batches([d.select(["id", "train"]) for d in self.docs]).combine_chunks().to_batches()[0]
        self.docs, self.size = [], 0
        known, own = np.unique(words, return_inverse=True)
        pairs = block_pairs(known, own, counts, self.frequent)
        pairs.sort()
        pairs = pairs[np.searchsorted(pairs, 0) :]
        self.pairs.append(pairs[changes(pairs)])
        self.runs.append((docs, counts, known, own.astype(np.int32)))

    def automaton(self, model: Model) -> Automaton:
        known = np.unique(np.concatenate([r[2] for r in self.runs]))
        for (_, _, own, _), pairs in zip(self.runs, self.pairs):
            place = np.searchsorted(known, own)
            for some in pieces(len(pairs)):
                pairs[some] = place[pairs[some] >> 32] << 32 | place[pairs[some] & 0xFFFFFFFF]
        pairs, self.pairs = np.concatenate(self.pairs), []
        pairs.sort()
        answers, self.answers = self.answers, []
        return model.automaton(known, pairs[changes(pairs)], answers)

    def scores(self, model: Model) -> Iterator[pa.RecordBatch]:
        self.end_run()
        if not self.runs:
            return
        automaton = self.automaton(model)
        for docs, counts, known, own in self.runs:
            n_known, base, score = automaton.weigh(known, own, counts)
            total = np.full(len(counts), model.tokens)
            columns = [pa.array(counts), pa.array(n_known.astype(np.int64)), pa.array(total, pa.int64()), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(
                [*docs.columns, *columns],
                names=["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )


def _scored(settings: Settings, dealing: Dealing, frequent, facts: np.ndarray, tokens: int, distinct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, number, block = Model(settings, dealing, facts, tokens, distinct), None, Block(frequent)
        for batch in batches:
            blocks, kinds, packed = batch.column("block").to_numpy(), batch.column("kind").to_numpy(), batch.column("bytes")
            for i in range(batch.num_rows):
                if blocks[i] != number:
                    yield from block.scores(model)
                    number, block = blocks[i], Block(frequent)
                if kinds[i]:
                    block.answers.append(packed[i].as_py())
                else:  # a block's texts come before its answers
                    block.add(packed[i].as_buffer())
        yield from block.scores(model)

    return run
