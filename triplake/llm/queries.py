"""The registered queries of the training-data operators.

Each query applies its operator, with production parameters, to its whole
table and returns the digest columns of the full result.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from triplake.llm import best_fit, collocations, ctw, decontaminate, near_dedup, packing, pii, quality, runs, sharding, token_files, vector_dedup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_packing": op2_packing,
        "op3_decontamination": op3_decontamination,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_warc": op5_warc,
        "op6_near_dedup": op6_near_dedup,
        "op7_vector_dedup": op7_vector_dedup,
        "op8_sharding": op8_sharding,
        "op9_quality": op9_quality,
        "op10_token_files": op10_token_files,
        "op11_collocations": op11_collocations,
        "op12_best_fit": op12_best_fit,
        "op13_periodic_runs": op13_periodic_runs,
        "pipeline": corpus_pipeline.run,
    }


# All phrases of all pieces, counted and compared without bounds.
_COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS p, piece FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), words AS (
    SELECT lang, p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang
), phrases AS (
    SELECT lang, g, count(*)::HUGEINT AS f FROM (
        SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda m:
            list_transform(range(1, len(w) - m + 2), lambda i: w[i : i + m - 1])))) AS g
        FROM words)
    GROUP BY lang, g HAVING count(*) >= 100
), cuts AS (
    SELECT lang, g, f, unnest(range(1, len(g))) AS k FROM phrases WHERE len(g) >= 2
), scored AS (
    SELECT c.lang, c.g, c.f AS a, c.k, l.f AS l, r.f AS r, t.n, 1000 * c.f * t.n // (l.f * r.f) AS score
    FROM cuts c JOIN totals t USING (lang)
    JOIN phrases l ON l.lang = c.lang AND l.g = c.g[1 : c.k]
    JOIN phrases r ON r.lang = c.lang AND r.g = c.g[c.k + 1 : len(c.g)]
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inside AS (
    SELECT lang, g[1 : len(g) - 1] AS g, f FROM phrases WHERE len(g) > 2
    UNION SELECT lang, g[2 : len(g)], f FROM phrases WHERE len(g) > 2
), ranked AS (
    SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM lowest
    WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = lowest.lang AND i.g = lowest.g AND i.f = lowest.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
    a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_collocations": _COLLOCATIONS_SQL}
