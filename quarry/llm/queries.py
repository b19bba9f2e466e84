"""The queries of this package and, where SQL can express them, their DuckDB SQL.

Each query applies one operator with production parameters to its whole table
and derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (byte_bpe, fill_middle, hyperminhash, metric_join, mixing, mtree, packing,
                        quality_forest, resampling, secret_ledger, sharding, toxicity, warc)
from quarry.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_prefix_sum_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of near-equal bytes."""
    shards = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 16)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_hyperminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_splittable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back by byte ranges."""
    back = warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_bin_completion_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in as few sequences of 1024 as bin completion finds."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path(), capacity=1024, end_id=2)


@query
def op5_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words, weights 3, 1, 2, takes of each document."""
    mix = mixing.mix_report(table(spark, sf_dir, "documents"), weights=(3, 1, 2), budget_share=1.5,
                            max_repeat=2)
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op6_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document, learnt from the labels outside the held-out fold."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_rank_merge_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    return byte_bpe.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path(), limit=512)


@query
def op8_rule_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every whole document and the isolation forest's verdict."""
    judged = quality_forest.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_forest.BASE, "base_failed", "kept")


@query
def op9_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of each label, exactly."""
    return metric_join.range_join(table(spark, sf_dir, "embeddings"), least_cosine=0.93)


@query
def op10_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, scanned once per distinct text."""
    found = secret_ledger.scan(table(spark, sf_dir, "documents"))
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    joined = F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.transform(spans, lambda s: s["kind"])

    def count(kind):
        return F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, secret_ledger.KINDS),
        F.sha2(joined.cast("binary"), 256).alias("base_sha256"), joined.alias("spans"))


@query
def op11_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products of every hundredth vector with all others."""
    return mtree.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10, scale=1024)


@query
def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 % of all documents of 20 words or more, drawn by likeness to the benchmark's texts."""
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                percent=5, least_words=20, seed=42, buckets=10_000)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_boundary_set_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two token boundaries and rearranged, with what is restored from that."""
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"), seed=1, fim_share=90, spm_share=20)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.encode("output", "utf-8"), 256).alias("output_sha256"),
                       F.sha2(F.encode(fill_middle.restored(), "utf-8"), 256).alias("restored_sha256"))


# -- DuckDB SQL ------------------------------------------------------------

# A CRC-32 by its definition: the table from the bit rule, then byte by byte.
ORACLE["op1_prefix_sum_shards"] = """
WITH bits AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
sized AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size,
    ('0x' || md5(coalesce(text, ''))[1:15])::BIGINT AS h FROM documents),
texts AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(text)),
      lambda i: ('0x' || hex(encode(text))[2 * i + 1 : 2 * i + 2])::BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT text FROM sized), bits),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY h NULLS FIRST, doc_id NULLS FIRST, size
      ROWS UNBOUNDED PRECEDING) - size AS start_byte, sum(size) OVER () AS all_bytes FROM sized),
cut AS (
  SELECT *, least(15, (2 * start_byte + size) * 16 // (2 * all_bytes))::INT AS shard FROM summed)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY start_byte, h NULLS FIRST, doc_id NULLS FIRST) - 1 AS slot,
  NULL::INT AS grown_shard
FROM cut JOIN texts USING (text)
"""

ORACLE["op5_fair_queue_mix"] = r"""
WITH packets AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || md5(concat_ws(':', '7', doc_id, coalesce(text, '')))[1:15])::BIGINT AS place FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][(row_number() OVER (
    ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS no
  FROM packets GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - (sum(2 * source_size) OVER w - 2 * source_size))::DOUBLE
      / (sum(weight) OVER (ORDER BY 2 * source_size / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM sources WINDOW w AS (ORDER BY 2 * source_size / weight, no ROWS UNBOUNDED PRECEDING)),
fill AS (SELECT arg_min(level, (2 * source_size / weight, no)) AS fill FROM levels
  WHERE level * weight < 2 * source_size),
targets AS (SELECT source, no, source_size, coalesce(least(2.0::DOUBLE * source_size, CASE WHEN
    (2 * source_size / weight) >= fill THEN fill * weight END), 2.0::DOUBLE * source_size) AS target FROM levels, fill),
ends AS (
  SELECT p.doc_id, p.size, p.place, t.no, r.round,
    floor((sum(p.size) OVER (PARTITION BY t.no, r.round ORDER BY p.place, p.doc_id ROWS UNBOUNDED PRECEDING)
      + r.round * t.source_size)::DOUBLE / t.target * 1099511627776.0::DOUBLE) AS tick
  FROM packets p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source, range(2) r(round) WHERE p.size > 0),
mixed AS (
  SELECT *, sum(size) OVER (ORDER BY tick, no, round, place, doc_id ROWS UNBOUNDED PRECEDING) AS running FROM ends),
counts AS (
  SELECT no, doc_id, place, count(*) AS copies FROM mixed
  WHERE running <= (SELECT 1.5 * sum(source_size) FROM sources) GROUP BY ALL)
SELECT p.doc_id, p.size, t.source_size, t.target, (p.size * coalesce(c.copies, 0))::BIGINT AS taken, p.source,
  coalesce(c.copies, 0)::INT AS copies
FROM packets p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
LEFT JOIN counts c ON c.no = t.no AND c.doc_id = p.doc_id AND c.place = p.place AND p.size > 0
"""

# Positions from the pieces between matches: starts are running lengths.
_KIND_SQL = r"""
{kind}_m AS (SELECT doc_id, regexp_extract_all(t, {pat}) AS m, {ok} AS g, regexp_split_to_array(t, {pat}) AS gaps FROM d),
{kind}_s AS (SELECT doc_id, unnest(list_filter(list_transform(range(len(m)), lambda i: struct_pack(
    s := list_sum(list_transform(gaps[:i + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i], lambda x: length(x))), 0),
    n := length(m[i + 1]), k := length(g[i + 1]))), lambda x: x.k >= {least})) AS x FROM {kind}_m WHERE len(m) > 0)"""
_ASSIGN_SQL = r"""'(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
ORACLE["op10_blob_ledger_secrets"] = "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)," + ",".join([
    _KIND_SQL.format(kind="assign", pat=_ASSIGN_SQL, ok=f"regexp_extract_all(t, {_ASSIGN_SQL}, 2)", least=6),
    _KIND_SQL.format(kind="access", pat="'AKIA[A-Z0-9]+'", ok="m", least=20),
    _KIND_SQL.format(kind="hex", pat="'[0-9a-f]{24,}'", ok="m", least=24)]) + r""",
spans AS (
  SELECT doc_id, 0 AS o, 'assign' AS kind, x.s::BIGINT AS s, (x.s + x.n)::BIGINT AS e FROM assign_s
  UNION ALL SELECT doc_id, 1, 'access', x.s, x.s + x.n FROM access_s
  UNION ALL SELECT doc_id, 2, 'hex', x.s, x.s + x.n FROM hex_s),
joined AS (
  SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans, count(*) FILTER (o = 0) AS n_assign,
    count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (doc_id)
"""

ORACLE["op3_splittable_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top,
  list_aggregate(list_transform(range(40), lambda i: lpad(bin(('0x' || h[i + 1])::INT), 4, '0')), 'string_agg', '') AS bits
  FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, list_aggregate(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', list_reduce(list_prepend(0, list_transform(range(5),
      lambda j: bits[5 * i + j + 1]::INT)), lambda a, b: 2 * a + b)::BIGINT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM g
"""

ORACLE["op9_metric_range_join"] = """
WITH RECURSIVE v AS (
  SELECT DISTINCT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.w FROM r JOIN l ON r.b = l.u),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
  e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.u = e.vec_id
"""

ORACLE["op2_hyperminhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(len(w) - 4, 1)),
    lambda i: array_to_string(w[i + 1 : i + 5], ' '))) AS sh FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
  GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.v FROM r JOIN e ON r.b = e.u),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""

ORACLE["op11_mtree_top_k"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

# The checksum of every distinct feature, by CRC-32's definition, byte by byte.
ORACLE["op12_importance_resample"] = r"""
WITH bits AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
texts AS (SELECT 0 AS side, row_number() OVER () AS row_id, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), item_id, text FROM benchmark),
words AS (SELECT side, row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (SELECT side, row_id, unnest(list_concat(w, list_transform(range(len(w) - 1), lambda i: w[i + 1] || ' ' || w[i + 2]),
  list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]))) AS f FROM words),
features AS (SELECT side, row_id, f, count(*) AS n FROM runs GROUP BY ALL),
sums AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(f)),
    lambda i: ('0x' || hex(encode(f))[2 * i + 1 : 2 * i + 2])::BIGINT)),
  lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features), bits),
held AS (SELECT side, row_id, bucket, sum(n) AS n FROM features JOIN sums USING (f) GROUP BY ALL),
counts AS (SELECT b.bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t
  FROM range(10000) b(bucket) LEFT JOIN held USING (bucket) GROUP BY b.bucket),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
  / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS g FROM counts),
weights AS (SELECT row_id, sum(n * g) AS weight, sum(n) AS n_features FROM held JOIN gain USING (bucket)
  WHERE side = 0 GROUP BY row_id),
scored AS (SELECT row_id, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
  coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
    (('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (row_id) WHERE side = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS r,
  5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS k FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= k THEN r END::BIGINT AS rank FROM ranked
"""

ORACLE["op13_boundary_set_fim"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS t,
  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, len(t)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(t) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(t) + 1) AS y,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
    WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT doc_id, text, n, form, array_to_string(t[1:least(x, y)], '') AS p,
  array_to_string(t[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(t[greatest(x, y) + 1:], '') AS s FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""
