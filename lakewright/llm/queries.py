"""The registered queries of the text operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm import bpe, exact_dedup, filter_audit, fingerprints, line_dedup, lm_scoring, minhash, packing, sharding, source_divergence, substring_dedup, token_files, toxicity
from lakewright.scratch import scratch_dir

QUERIES, ORACLES = {}, {}


def query(fn):
    """Register a query under its own name."""
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", sha256("text").alias("kept_sha256"))


# Blanks and control characters 9 to 13 go at both ends; only A-Z change case.
ORACLES["op1_line_dedup"] = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keys as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
often as (
  select key, min(doc_id) as first from keys
  where length(key) >= 10 group by key having count(distinct doc_id) >= 2),
marked as (
  select k.*, o.key is not null and k.doc_id <> o.first as gone
  from keys k left join often o on k.key = o.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


@query
def op2_gear_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup_substrings(documents(spark, sf_dir))
    return kept.withColumn("kept_sha256", sha256("text")).withColumnRenamed("id", "doc_id")


@query
def op3_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_documents(documents(spark, sf_dir), labels)
    return scored.select(F.col("row.doc_id").alias("doc_id"), "held_out", "score", "predicted")


@query
def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(documents(spark, sf_dir), 8)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The checksum's table holds the remainders of the reflected CRC-32 polynomial (a fixed value), byte by byte.
ORACLES["op4_feistel_shards"] = r"""
with recursive crc_table as (
  select list(list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as t
  from range(256) r(i)),
docs as (
  select doc_id, octet_length(encode(coalesce(text, '')))::bigint + 1 as size, hex(encode(coalesce(text, ''))) as h,
         row_number() over (order by doc_id) - 1 as row_no, count(*) over () as n
  from documents),
sums as (
  select doc_id, size, row_no, n, ceil(sqrt(n))::bigint as side,
         xor(list_reduce(list_transform(range(0, length(h), 2), lambda i: ('0x' || h[i + 1 : i + 2])::bigint),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295), 4294967295) as text_crc32
  from docs, crc_table),
walk as (
  select row_no, n, side, row_no as x, false as done from sums
  union all
  select row_no, n, side, l4 * side + r4, l4 * side + r4 < n
  from (select *, r3 as l4, (l3 + ('0x' || left(md5('0:3:' || r3), 12))::bigint) % side as r4
  from (select *, r2 as l3, (l2 + ('0x' || left(md5('0:2:' || r2), 12))::bigint) % side as r3
  from (select *, r1 as l2, (l1 + ('0x' || left(md5('0:1:' || r1), 12))::bigint) % side as r2
  from (select *, x % side as l1, (x // side + ('0x' || left(md5('0:0:' || (x % side)), 12))::bigint) % side as r1
  from walk where not done))))),
places as (select row_no, x as place from walk where done)
select doc_id, size, text_crc32::bigint as text_crc32, 'rows' as law, (place % 8)::int as shard, (place // 8)::bigint as slot,
       null::int as grown_shard
from sums join places using (row_no)
"""


@query
def op5_backoff_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 2
    scored = lm_scoring.score_documents(documents(spark, sf_dir), ~held_out)
    return scored.select(
        F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


@query
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return coded.withColumnRenamed("id", "doc_id")


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(documents(spark, sf_dir), carry={"text_sha256": sha256("text")})
    return groups.withColumnRenamed("id", "doc_id")


ORACLES["op7_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


@query
def op8_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


# All pairs that share a shingle.
ORACLES["op8_tensored_minhash"] = r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
sets as (
  select doc_id, list_distinct(list_transform(range(greatest(len(w) - 4, least(len(w), 1))), lambda i: array_to_string(w[i + 1 : i + 5], ' '))) as s
  from words),
shingles as (select doc_id, len(s) as n, unnest(s) as x from sets),
links as (
  select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on l.a = r.b),
components as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, len(s) as n_shingles, component_id, doc_id = component_id as kept from sets join components using (doc_id)
"""


@query
def op9_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(documents(spark, sf_dir), tokenizer, public_tokenizers.PATTERN)
    return pieces.withColumnRenamed("id", "doc_id")


@query
def op10_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare_with_edits(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", sha256("edited").alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


ORACLES["op10_merkle_fingerprints"] = r"""
with docs as (
  select doc_id, coalesce(text, '') as text, row_number() over (order by doc_id desc) as k, count(*) over () as n
  from documents),
pairs as (
  select d.doc_id, d.text, e.text as following,
         left(d.text, length(d.text) - length(d.text) // 3) || left(e.text, length(d.text) // 3) as edited
  from docs d join docs e on e.k = d.k % d.n + 1),
texts as (select distinct t from (select text as t from pairs union all select edited from pairs)),
leaves as (
  select t, list_transform(string_split(t, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
    lambda p: list_transform(range(0, len(string_split(p, ' ')), 8),
      lambda i: sha256(array_to_string(string_split(p, ' ')[i + 1 : i + 8], ' '))))) as tree
  from texts),
paragraphs as (
  select t, list_transform(tree, lambda s: list_transform(s, lambda l: {
    'digest': sha256(array_to_string(l, '')),
    'below': array_to_string(list_transform(l, lambda x: ' L' || left(x, 8)), '')})) as tree
  from leaves),
sections as (
  select t, list_transform(tree, lambda s: {
    'digest': sha256(array_to_string(list_transform(s, lambda p: p.digest), '')),
    'below': array_to_string(list_transform(s, lambda p: ' P' || left(p.digest, 16) || p.below), '')}) as tree
  from paragraphs),
prints as (
  select t, 'R' || sha256(array_to_string(list_transform(tree, lambda s: s.digest), ''))
    || array_to_string(list_transform(tree, lambda s: ' S' || left(s.digest, 16) || s.below), '') as f
  from sections),
nodes as (
  select p.doc_id, p.text, p.edited, a.f as own, b.f as other,
         list_distinct(string_split(a.f, ' ')) as x, list_distinct(string_split(b.f, ' ')) as y,
         list_distinct(string_split(c.f, ' ')) as z
  from pairs p join prints a on a.t = p.text join prints b on b.t = p.edited join prints c on c.t = p.following)
select doc_id, length(text) as n_chars, sha256(edited) as edited_sha256, own as fingerprint, other as edited_fingerprint,
       len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) as near_edited,
       len(list_intersect(x, z)) / len(list_distinct(list_concat(x, z))) as near_next
from nodes
"""


@query
def op11_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, tokenizer = scratch_dir(spark, "token-files"), public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(documents(spark, sf_dir), path, tokenizer, public_tokenizers.PATTERN)
    return token_files.read_documents(spark, path).withColumnRenamed("id", "doc_id")


@query
def op12_skyband_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit_sources(documents(spark, sf_dir))


ORACLES["op12_skyband_source_audit"] = r"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
words as (
  select r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (select lang, term, count(*) as n from words group by lang, term having count(distinct r) >= 10),
own as (select lang, source, term, count(*) as n from words group by lang, source, term),
members as (select distinct lang, source from docs),
counts as (
  select m.lang, m.source, k.term, coalesce(o.n, 0) as n, k.n as lang_n
  from members m join kept k on k.lang = m.lang
  left join own o on o.lang = m.lang and o.source = m.source and o.term = k.term),
sums as (
  select *, sum(n) over same as total, sum(lang_n) over same as lang_total, count(*) over same as v
  from counts window same as (partition by lang, source)),
shares as (
  select lang, source, term, n, 1 + (1000000000::hugeint * (n + 2)) // (total + 2 * v) as p,
         1 + (1000000000::hugeint * (lang_n + 2)) // (lang_total + 2 * v) as q
  from sums),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::bigint as value
  from members a join members b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source
  left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by a.lang, a.source, b.source),
terms as (
  select lang, source, term as item, (((p - q) * (p - q)) // (p + q))::bigint as value from shares where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank
  from pairs
  union all
  select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) from terms)
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 10
"""


@query
def op13_transducer_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLES["op13_transducer_filter_audit"] = r"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
marks as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
  from labels group by doc_id),
fails as (
  select t.part, coalesce(m.good, false) as good, coalesce(m.toxic, false) as toxic,
         (len(words) < 100)::int
         + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::int
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::int
         + 8 * regexp_matches(text, '[#$%&*|]')::int
         + 16 * (t.doc_id > min(t.doc_id) over (partition by text))::int as mask
  from texts t left join marks m on m.doc_id = t.doc_id),
filters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as bit),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from filters a join filters b on b.f <> a.f join filters c on c.f not in (a.f, b.f)
  join filters d on d.f not in (a.f, b.f, c.f) join filters e on e.f not in (a.f, b.f, c.f, d.f)),
steps as (
  select filter_order, i as step, bits[i] as bit, coalesce(list_sum(bits[1 : i - 1]), 0)::int as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as i)),
counts as (
  select part, filter_order, step, bit,
         count(*) filter (mask & bit = 0 and mask & before = 0) as kept,
         count(*) filter (mask & bit <> 0 and mask & before = 0) as removed,
         count(*) filter (mask & bit <> 0 and mask & before <> 0) as redundant,
         count(*) filter (mask = bit) as unique_fails,
         count(*) filter (mask & bit <> 0 and mask & before = 0 and good) as good_lost,
         count(*) filter (mask & bit <> 0 and mask & before = 0 and toxic) as toxic_lost
  from fails, steps group by part, filter_order, step, bit)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from counts
"""
