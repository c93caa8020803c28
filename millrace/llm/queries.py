"""The queries of the text operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import compare_neighbours

    return compare_neighbours(table(spark, sf_dir, "documents"))


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ppm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepieces import encode_pieces

    return encode_pieces(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rans import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_toxicity": op3_toxicity,
    "op4_urls": op4_urls,
    "op5_mixing": op5_mixing,
    "op6_fingerprints": op6_fingerprints,
    "op7_ppm": op7_ppm,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_licenses": op9_licenses,
    "op10_rans": op10_rans,
}

ORACLES: dict[str, str] = {
    "op5_mixing": """
WITH RECURSIVE sizes AS (
  SELECT coalesce(source, '') AS s, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY 1
), rates AS (
  SELECT s, (SELECT sum(n) FROM sizes) * pow(n, 0.5) / ((SELECT sum(pow(n, 0.5)) FROM sizes) * n) AS rate FROM sizes
), steps AS (
  SELECT s, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS cdf FROM rates
  UNION ALL
  SELECT s, rate, k + 1, p * rate / (k + 1), cdf + p * rate / (k + 1) FROM steps WHERE k < ceil(rate + 12 * sqrt(rate) + 30)
), tables AS (
  SELECT s, list(cdf ORDER BY k) AS cdfs FROM steps GROUP BY s
), drawn AS (
  SELECT d.*, len(list_filter(t.cdfs, lambda c:
    c < (CAST(CAST(concat('0x', substr(md5(concat('mix-1-', CAST(doc_id AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)) AS n_copies
  FROM documents d JOIN tables t ON coalesce(d.source, '') = t.s
), copies AS (
  SELECT * EXCLUDE (n_copies), CAST(unnest(range(n_copies)) AS INTEGER) AS mix_copy FROM drawn WHERE n_copies > 0
)
SELECT *, md5(concat('mix-1-order-', CAST(doc_id AS VARCHAR), '-', CAST(mix_copy AS VARCHAR))) AS mix_key FROM copies
""",
}
