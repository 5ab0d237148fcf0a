"""The operators as registered queries over their whole tables, and the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm import bpe, jpeg, line_dedup, lm_scoring, mixing, pii, ranked_search, sharding, simhash, token_counts, topk, toxicity, vector_codes
from rillmark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents")).rows
    return rows.select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_scoring.score(table(spark, sf_dir, "documents"), good)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_classes(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.summary(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents"), 8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integers(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors, vectors.filter("vec_id % 50 = 0"), 5)


@query
def op9_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = jpeg.media_columns(jpeg.store_texts(table(spark, sf_dir, "documents")), "doc_id", "n_bytes")
    size = F.octet_length("thumbnail").cast("long")
    feature = F.concat_ws(":", "width", "height", "pictures", "thumb_hash")
    return media.select(
        "doc_id", "n_bytes", size.alias("payload_bytes"), F.sha2("thumbnail", 256).alias("payload_sha256"),
        F.crc32(F.substring("thumbnail", -64, 64)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


ORACLES["op1_mixing"] = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS w FROM s),
r AS (SELECT *, 3e0 * source_size / w AS ratio, sum(source_size) OVER () AS every FROM w),
o AS (SELECT *, row_number() OVER (ORDER BY ratio, source NULLS LAST) AS pos,
             coalesce(sum(3e0 * source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS full_,
             sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM r),
l AS (SELECT *, (every - full_) / rest AS level FROM o),
f AS (SELECT min_by(level, pos) AS level, min(pos) AS pos FROM l WHERE level <= ratio),
t AS (SELECT l.source, l.source_size, CASE WHEN l.pos < f.pos THEN 3e0 * l.source_size ELSE f.level * l.w END AS target FROM l, f),
x AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS lim,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (CASE WHEN size = 0 THEN 0 ELSE
  greatest(0, least(size, lim - start)) + greatest(0, least(size, lim - source_size - start)) + greatest(0, least(size, lim - 2 * source_size - start)) END)::BIGINT AS taken
FROM x"""

ORACLES["op4_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM d),
k AS (SELECT doc_id, pos, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS stripped FROM l),
n AS (SELECT *, translate(stripped, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM k),
f AS (SELECT key, max(doc_id) AS last FROM n WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT n.doc_id, n.pos, n.line, f.key IS NOT NULL AND n.doc_id <> f.last AS gone FROM n LEFT JOIN f ON n.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""

ORACLES["op8_topk"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""

ORACLES["op11_ranked_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
c AS (SELECT count(*) FILTER (len(ts) > 0) AS docs, sum(len(ts))::BIGINT AS terms FROM d),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
i AS (SELECT item_id, t, count(*) AS times FROM q GROUP BY item_id, t),
p AS (SELECT r, doc_id, 25 + (75 * len(ts) * docs) // terms AS m, unnest(ts) AS t FROM d, c),
f AS (SELECT r, doc_id, m, t, count(*) AS tf FROM p WHERE t IN (SELECT t FROM i) GROUP BY r, doc_id, m, t),
w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY t),
s AS (SELECT item_id, doc_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM i JOIN w ON i.t = w.t JOIN f ON f.t = i.t GROUP BY item_id, doc_id, r),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 10"""


def _codes_sql(rounds: int) -> str:
    """Rounds of assignment and floored means, one after the other; all numbers stay exact in doubles and 64 bits."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT p.r, p.part, min((p.xx - 2 * list_inner_product(p.x, c.x) + c.xx)::BIGINT * 256 + c.entry) AS best
           FROM p JOIN c{i} c ON p.part = c.part GROUP BY p.r, p.part)""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT p.part, a.best % 256 AS entry, generate_subscripts(p.x, 1) AS pos, unnest(p.x)::BIGINT AS x
           FROM p JOIN a{i} a ON p.r = a.r AND p.part = a.part),
m{i} AS (SELECT part, entry, pos, sum(x)::BIGINT AS s, count(*) AS n FROM s{i} GROUP BY part, entry, pos),
l{i} AS (SELECT part, entry, list(((s - (s % n + n) % n) // n)::DOUBLE ORDER BY pos) AS x FROM m{i} GROUP BY part, entry),
c{i + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(l.x, c.x) AS x, list_inner_product(coalesce(l.x, c.x), coalesce(l.x, c.x)) AS xx
           FROM c{i} c LEFT JOIN l{i} l ON c.part = l.part AND c.entry = l.entry)""")
    return f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT *, row_number() OVER (ORDER BY vec_id, v) AS r FROM e),
q AS (SELECT r, part, list_slice(v, part * len(v) // 4 + 1, (part + 1) * len(v) // 4) AS x FROM n, range(4) t(part)),
p AS MATERIALIZED (SELECT *, list_inner_product(x, x) AS xx FROM q),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x, xx FROM p WHERE r <= 256),
{(chr(44) + chr(10)).join(steps)},
k AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: y::BIGINT::VARCHAR), ','), ',' ORDER BY part, entry)) AS sha FROM c{rounds}),
f AS (SELECT r, string_agg(printf('%02x', (best % 256)::INTEGER), '' ORDER BY part) AS code, sum(best // 256)::BIGINT AS error FROM a{rounds} GROUP BY r),
j AS (SELECT n.vec_id, n.label, f.code, f.error FROM n JOIN f ON n.r = f.r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT sha FROM k) AS codebooks_sha256 FROM j"""


ORACLES["op13_vector_codes"] = _codes_sql(vector_codes.ROUNDS)
