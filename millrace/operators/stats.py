"""Corpus statistics: one scan and one shuffle, then levels of aggregation over the small result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import list_mean


def year_of_dump(dump: Column) -> Column:
    return F.nullif(F.regexp_extract(dump, r"CC-MAIN-(\d{4})", 1), F.lit(""))


def temporal(docs: DataFrame, high: float = 3.0) -> DataFrame:
    """By dump: documents, tokens, mean score and how many documents have a mean score of ``high`` at least."""
    score = list_mean(F.col("fw_edu_scores"))
    return docs.groupBy("dump").agg(F.count(F.lit(1)).alias("doc_count"), F.sum("token_count").alias("total_tokens"), F.avg(score).alias("avg_edu_score"), F.count_if(score >= high).alias("high_edu_count"))


def formatted(by_dump: DataFrame) -> DataFrame:
    rate = F.try_divide(F.col("high_edu_count"), F.col("doc_count"))
    return by_dump.select("dump", "doc_count", F.round("avg_edu_score", 6).alias("avg_edu_score"), F.round(rate, 6).alias("high_edu_rate"))


def overall(by_dump: DataFrame) -> DataFrame:
    """One row from the dumps' rows: means are weighted by documents."""
    docs = F.sum("doc_count")
    return by_dump.agg(
        docs.alias("total_docs"), F.sum("total_tokens").alias("total_tokens"), F.round(F.try_divide(F.sum(F.col("avg_edu_score") * F.col("doc_count")), docs), 6).alias("avg_edu_score"),
        F.round(F.try_divide(F.sum("high_edu_count"), docs), 6).alias("high_edu_rate"), F.count(F.lit(1)).alias("num_dumps"),
    )


def yearly(by_dump: DataFrame) -> DataFrame:
    """By year: documents, and the plain means of the dumps' means and rates."""
    rate = F.try_divide(F.col("high_edu_count"), F.col("doc_count"))
    out = by_dump.groupBy(year_of_dump(F.col("dump")).alias("year")).agg(F.sum("doc_count").alias("doc_count"), F.round(F.avg("avg_edu_score"), 6).alias("avg_edu_score"), F.round(F.avg(rate), 6).alias("high_edu_rate"))
    return out


def first_and_last(by_year: DataFrame) -> DataFrame:
    """One row: score and rate of the first and of the last year, and how much the score rose."""
    pick = lambda f, c: f(c, "year")
    out = by_year.where("year is not null").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), pick(F.min_by, "avg_edu_score").alias("first_score"), pick(F.max_by, "avg_edu_score").alias("last_score"))
    return out.withColumn("change", F.round(F.col("last_score") - F.col("first_score"), 6))


def ends(by_dump: DataFrame, n: int = 5) -> DataFrame:
    """The first and the last n dumps by name."""
    return by_dump.orderBy("dump").limit(n).union(by_dump.orderBy(F.col("dump").desc()).limit(n)).distinct()


def sample_plan(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("rows"), F.sum("token_count").alias("tokens"), F.count_distinct("dump").alias("dumps"))


def bar_chart(rows: DataFrame, label: str, value: str, width: int = 40) -> str:
    """ASCII bars of a small frame (dozens of rows: of years or dumps)."""
    found = rows.select(label, value).orderBy(label).limit(500).collect()
    top = max((r[1] or 0 for r in found), default=0) or 1
    return "\n".join(f"{r[0]!s:>12} {'#' * round(width * (r[1] or 0) / top)} {r[1]}" for r in found)


def long_documents(docs: DataFrame, min_tokens: int = 10_000, min_lid: float = 0.8, extractor: str | None = "docling", columns: tuple[str, ...] = ("id", "url", "text", "language", "token_count", "dump", "page_average_lid_score")) -> DataFrame:
    """Projection and conjunctive filter; both reach the scan."""
    keep = (F.col("token_count") >= min_tokens) & (F.col("page_average_lid_score") >= min_lid)
    if extractor is not None:
        keep = keep & (F.col("extractor") == extractor)
    return docs.where(keep).select(*columns)
