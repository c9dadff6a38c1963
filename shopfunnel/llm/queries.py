"""The registered queries of this package, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfunnel.llm import quality
from shopfunnel.llm.best_fit import best_fit_pack
from shopfunnel.llm.centroids import centroid_digest, cluster_vectors
from shopfunnel.llm.common import table
from shopfunnel.llm.decontaminate import find_leaks
from shopfunnel.llm.html import extract
from shopfunnel.llm.licenses import scan_licenses
from shopfunnel.llm.lm import score_texts
from shopfunnel.llm.negatives import mine
from shopfunnel.llm.ngram_join import near_groups
from shopfunnel.llm.packing import pack
from shopfunnel.llm.shards import read_shards, write_shards
from shopfunnel.llm.spotsigs import edited_pairs
from shopfunnel.llm.substrings import dedup_substrings
from shopfunnel.session import work_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents selected, with their scores."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = table(spark, sf_dir, "labels").select("doc_id", quality.grade().alias("grade"))
    chosen = quality.select(docs, quality.train_on_all(docs, ratings, top=2), wanted=2)
    return chosen.select("doc_id", "expected_grade", "tail_probability")


@query
def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token-shards")
    write_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    back = read_shards(spark.read.parquet(path))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("ids")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items leaked into them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark"))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


@query
def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), apart=True)


@query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = near_groups(docs, n=3, similarity=Fraction(9, 10))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = dedup_substrings(docs, join_all=True)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("ids")


@query
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    found = found.withColumn("centroid_sha256", centroid_digest())
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label")))


#: Words of each document, in DuckDB.
_WORDS = r"""
words AS (SELECT doc_id, list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)
"""

_OP10 = f"""
WITH {_WORDS.format(text="coalesce(text, '')")},
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 48, 1))) AS i FROM words)),
firsts AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN firsts USING (k) WHERE f < doc_id),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS text
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM words)
  ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

_OP9 = f"""
WITH RECURSIVE {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")},
grams AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM words),
each AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM grams),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND 9 * a.n <= 10 * b.n AND 9 * b.n <= 10 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, len(g)::BIGINT AS n_shingles, least(doc_id, coalesce(min(b), doc_id)) AS component_id
FROM grams LEFT JOIN reach ON doc_id = a GROUP BY doc_id, g
"""



def _op12(clusters: int = 8, rounds: int = 10) -> str:
    """One group of expressions a round: distances, assignment, means."""
    parts = [
        """kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, x FROM kept
  ORDER BY sha256('3:' || vec_id) LIMIT {clusters})""",
    ]
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, any_value(k.x) AS x, min(struct_pack(d := list_sum(list_transform(list_zip(k.x, c{k}.x),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, c := c)) AS best
  FROM kept k CROSS JOIN c{k} GROUP BY vec_id)""")
        if k < rounds:
            parts.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT c, coalesce(m, c{k}.x) AS x FROM c{k} LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM (
      SELECT c, i, sum(v) AS s, count(*) AS n FROM (
        SELECT best.c AS c, unnest(x) AS v, unnest(range(1, 65)) AS i FROM a{k}) GROUP BY c, i) GROUP BY c) USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
       (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.c = c{rounds}.c
"""


_OP13 = """
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike,
         list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLE = {"op12_centroid_clustering": _op12(), "op13_hard_negatives": _OP13, "op9_ngram_jaccard_join": _OP9, "op10_substring_dedup": _OP10}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
