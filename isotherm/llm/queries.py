"""The registered queries of this subpackage: each derives its columns from its operator's output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.llm import (centroid_clusters, fm_index, licence_scan, maxent_lm, mixing, near_copies, quality, sharding,
                          sketch_search, token_counts, token_files, toxicity, vector_join)
from isotherm.llm.common import bucket_of_id, table
from isotherm.session import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
COUNT_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512


def op1_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_documents(table(spark, sf_dir, "documents"), bucket_of_id("doc_id", 5) == 1)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn_quality(docs, labels.filter(bucket_of_id("doc_id", 5) != 0))
    return docs.select("doc_id", (bucket_of_id("doc_id", 5) == 0).alias("held_out"),
                       quality.quality_score(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= quality.CUT).cast("int"))


def op4_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the licences found, comma-joined in order, the number of matches and the best coefficient (0: none)."""
    found = licence_scan.scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct("licences.licence")), ",").alias("licences"),
        F.size("licences").cast("long").alias("n_matches"),
        F.round(F.coalesce(F.array_max("licences.dice"), F.lit(0.0)), 6).alias("best_dice"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("leaks.n_words").alias("n_words"), fm_index.leaked_words("leaks").alias("n_hit"),
        F.size("leaks.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leaks.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("leaks.spans") > 0).alias("contaminated"))


def op8_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_vectors(table(spark, sf_dir, "embeddings")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, VOCABULARY)
    return token_files.token_digest(token_files.read_tokens(spark, path))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn_toxicity(docs, labels.filter(bucket_of_id("doc_id", 3) != 1))
    return docs.select("doc_id", (bucket_of_id("doc_id", 3) == 1).alias("held_out"),
                       toxicity.toxicity_score(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int"))

def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), COUNT_VOCABULARY).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op12_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = sketch_search.index_documents(table(spark, sf_dir, "documents"))
    return sketch_search.search(index, table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_maxent_lm": op1_maxent_lm,
    "op2_sharding": op2_sharding,
    "op3_quality": op3_quality,
    "op4_near_copies": op4_near_copies,
    "op5_licence_scan": op5_licence_scan,
    "op6_mixing": op6_mixing,
    "op7_fm_index": op7_fm_index,
    "op8_vector_join": op8_vector_join,
    "op9_token_files": op9_token_files,
    "op10_toxicity": op10_toxicity,
    "op11_token_counts": op11_token_counts,
    "op12_sketch_search": op12_sketch_search,
    "op13_centroid_clusters": op13_centroid_clusters,
}

# The sources are few, so the oracle orders every row by hash, where the query compares thresholds.
_OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '#' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
            - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest,
         sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS weights
  FROM s),
level AS (
  SELECT rest, weights FROM o WHERE weight * rest / weights <= 2 * source_size
  ORDER BY source_size / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT s.source, source_size,
         coalesce(least(2.0::DOUBLE * source_size, weight * level.rest / level.weights), 2.0::DOUBLE * source_size)
           AS target
  FROM s LEFT JOIN level ON true),
b AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS passes,
         target - CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END * source_size AS budget
  FROM t),
g AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
r AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
k AS (
  SELECT r.source, r.h, coalesce(upto <= budget OR (upto - words <= budget AND upto - budget < budget - (upto - words)),
                                 false) AS more
  FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (b.passes * d.size + CASE WHEN k.more THEN d.size ELSE 0 END)::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.h = k.h
"""

_OP7_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
t AS (
  SELECT kind, id, row_number() OVER () AS row_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM w),
item AS (
  SELECT DISTINCT id AS item_id, least(len(words), 10) AS size,
         unnest([words[k : k + least(len(words), 10) - 1] for k in range(1, greatest(len(words) - 9, 1) + 1)]) AS win
  FROM t WHERE kind = 'i' AND len(words) > 0),
size AS (SELECT DISTINCT size FROM item),
spot AS (
  SELECT row_id, size.size, unnest(range(1, len(words) - size.size + 2)) AS k
  FROM t, size WHERE kind = 'd' AND len(words) >= size.size),
hit AS (
  SELECT spot.row_id, spot.k, spot.size, item.item_id
  FROM spot JOIN t USING (row_id) JOIN item ON item.win = t.words[spot.k : spot.k + spot.size - 1]),
cover AS (
  SELECT row_id, count(*) AS n_hit
  FROM (SELECT DISTINCT row_id, unnest(range(k, k + size)) AS word FROM hit) GROUP BY row_id),
named AS (
  SELECT row_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row_id, item_id::VARCHAR AS item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY row_id)
SELECT t.id AS doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN cover USING (row_id) LEFT JOIN named USING (row_id) WHERE kind = 'd'
"""

_OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT vec_id, label, e, len(e) AS dims, sqrt(list_inner_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND a.dims = b.dims AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach(vec_id, other) AS (
  SELECT a, b FROM link UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON r.other = l.a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(low, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(low, v.vec_id) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) ON v.vec_id = a
LEFT JOIN (SELECT vec_id AS r, min(other) AS low FROM reach GROUP BY vec_id) ON v.vec_id = r
"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATE_ROWS = ", ".join(
    f"({k}, {_quoted(name)}, {_quoted(text)})" for k, (name, text) in enumerate(licence_scan.TEMPLATES))

_OP5_SQL = f"""
WITH t AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) AS t(k, licence, text)),
clean AS (
  SELECT 'd' AS kind, row_number() OVER () AS id, doc_id, NULL AS licence, text FROM documents
  UNION ALL SELECT 't', k, NULL, licence, text FROM t),
norm AS (
  SELECT kind, id, doc_id, licence, regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\n]+', ' ', 'g') AS x FROM clean),
unit AS (
  SELECT DISTINCT kind, id, trim(regexp_replace(u, '[ \\n]+', ' ', 'g')) AS u FROM (
    SELECT kind, id, unnest(CASE WHEN kind = 't' THEN [replace(x, chr(10), ' ')] ELSE list_concat(
           string_split(x, chr(10)), list_transform(regexp_split_to_array(x, '\\n ?\\n'), lambda p: replace(p, chr(10), ' ')),
           [replace(x, chr(10), ' ')]) END) AS u FROM norm)),
words AS (SELECT kind, id, row_number() OVER () AS unit, string_split(u, ' ') AS w FROM unit),
gram AS (
  SELECT kind, id, unit, len(w) - 1 AS n, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g
  FROM words WHERE len(w) > 1),
counted AS (SELECT kind, id, unit, n, g, count(*) AS c FROM gram GROUP BY ALL),
pair AS (
  SELECT d.id, d.unit, t.id AS k, 2.0 * sum(least(d.c, t.c)) / (d.n + t.n) AS dice
  FROM counted d JOIN counted t ON d.kind = 'd' AND t.kind = 't' AND d.g = t.g GROUP BY d.id, d.unit, d.n, t.id, t.n),
hit AS (
  SELECT id, licence, dice FROM (SELECT *, max(dice) OVER (PARTITION BY unit) AS best FROM pair) JOIN t USING (k)
  WHERE dice >= 0.8 AND dice = best),
named AS (SELECT id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM hit GROUP BY id),
total AS (SELECT id, count(*) AS n_matches, max(dice) AS best FROM hit GROUP BY id)
SELECT norm.doc_id, coalesce(licences, '') AS licences, coalesce(n_matches, 0)::BIGINT AS n_matches,
       round(coalesce(best, 0)::DOUBLE, 6) AS best_dice
FROM norm LEFT JOIN named USING (id) LEFT JOIN total USING (id) WHERE kind = 'd'
"""

_OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (
  SELECT row_number() OVER () AS q, item_id, unnest(list_distinct(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
s AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS words FROM d WHERE len(t) > 0),
m AS (SELECT r, 100 - 90 + (90 * len(t)::BIGINT * docs) // words AS m FROM d, s WHERE len(t) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM p, s WHERE term IN (SELECT term FROM i) GROUP BY term, docs),
score AS (
  SELECT q, item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY q, item_id, r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM score JOIN d USING (r) WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


def _op13_sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, start: str = "3:") -> str:
    """The rounds one after the other, over one row per vector and dimension."""
    steps = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, unnest(range(0, {dims})) AS d, unnest(x) AS x FROM v),
first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('{start}' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS c FROM v),
c0 AS MATERIALIZED (SELECT c, d, x FROM first JOIN x USING (r) WHERE c < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, c, distance FROM (
    SELECT r, c, distance, row_number() OVER (PARTITION BY r ORDER BY distance, c) AS place
    FROM (SELECT r, c{i}.c, sum((x.x - c{i}.x) * (x.x - c{i}.x))::BIGINT AS distance
          FROM x JOIN c{i} USING (d) GROUP BY r, c{i}.c)) WHERE place = 1)""")
        if i < rounds:
            steps.append(f"""
s{i} AS MATERIALIZED (SELECT c, d, sum(x)::BIGINT AS s, count(*) AS n FROM x JOIN a{i} USING (r) GROUP BY c, d),
c{i + 1} AS MATERIALIZED (
  SELECT c, d, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{i} LEFT JOIN s{i} USING (c, d))""")
    return "WITH " + ",".join(steps) + f""",
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN h USING (c)
"""


ORACLE_SQL = {"op5_licence_scan": _OP5_SQL, "op6_mixing": _OP6_SQL, "op7_fm_index": _OP7_SQL, "op8_vector_join": _OP8_SQL,
              "op12_sketch_search": _OP12_SQL, "op13_centroid_clusters": _op13_sql()}
