"""Samples that any run repeats: rows are ordered by an md5 of seed and id, not by a generator's state."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType


def seeded(column: str | Column, seed: int | str = 42) -> Column:
    """An order that looks random, the same in any SQL engine."""
    name = F.col(column) if isinstance(column, str) else column
    return F.md5(F.concat(F.lit(f"{seed}-"), name.cast("string")))


def shuffled(df: DataFrame, key: str, seed: int | str = 42) -> DataFrame:
    return df.orderBy(seeded(key, seed), key)


def take(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows by key."""
    return df.orderBy(key).limit(n)


def random_rows(df: DataFrame, key: str, n: int | None = None, fraction: float | None = None, seed: int | str = 42) -> DataFrame:
    """n rows, or a fraction of them rounded down but one at least, in the order of their keys."""
    if (n is None) == (fraction is None):
        raise ValueError("give either n or fraction")
    if fraction is not None:
        if not 0 < fraction <= 1:
            raise ValueError("fraction lies between 0 and 1")
        n = max(1, int(df.count() * fraction))
    return df.orderBy(seeded(key, seed), key).limit(n).orderBy(key)


def first_with(df: DataFrame, key: str, found: str) -> DataFrame:
    """The row of the least key whose list isn't empty."""
    return df.where(F.size(found) > 0).orderBy(key).limit(1)


def with_category(df: DataFrame, wanted: list[str], categories: str = "category") -> DataFrame:
    """Rows with any of the categories."""
    return df.where(F.arrays_overlap(F.transform(F.coalesce(categories, F.array().cast("array<string>")), lambda c: c.cast("string")), F.array(*(F.lit(w) for w in wanted))))


def allocation(df: DataFrame, n: int, key: str, categories: str = "category") -> DataFrame:
    """(category, rows, wanted): each category's share of n by the rows that have it, one at least."""
    own = df.select(F.explode(F.array_distinct(categories)).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("rows"))
    total = own.agg(F.sum("rows").alias("total"))  # one row
    return own.join(F.broadcast(total)).select("category", "rows", F.greatest(F.lit(1), F.bround(F.lit(float(n)) * F.col("rows") / F.col("total")).cast("long")).alias("wanted"))


def stratified(df: DataFrame, n: int, key: str, categories: str = "category", seed: int | str = 42) -> DataFrame:
    """n rows in which every category has its share, the rarest served first; a row counts for all its categories.

    Rows still missing are filled up in seeded order, and too many are trimmed in it. A category that wants w rows finds them
    among its first w in seeded order, whichever were chosen before, and what fills up is among the first n of all. So
    only these, n rows and one for each category beyond, meet in one task, which serves the categories in turn.
    """
    wanted = allocation(df, n, key, categories).select("category", "wanted")
    base = df.select(F.col(key).alias("__k"), F.array_distinct(F.coalesce(categories, F.array().cast("array<string>"))).alias("__c"), seeded(key, seed).alias("__o"))
    each = base.select("__k", "__o", F.explode("__c").alias("category")).join(wanted, "category")
    place = F.row_number().over(Window.partitionBy("category").orderBy("__o", "__k"))
    firsts = each.withColumn("__place", place).where(f"__place <= {n + 1} and __place <= wanted").select("category", "wanted", "__o", "__k")
    kind = df.schema[key].dataType
    everyone = base.orderBy("__o", "__k").limit(n).select(F.lit(None).cast("string").alias("category"), F.lit(0).cast("long").alias("wanted"), "__o", "__k")
    rows = firsts.unionByName(everyone).join(base.select(F.col("__k").alias("__id"), "__c"), F.col("__k") == F.col("__id")).drop("__id")

    def serve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queues: dict[tuple, list] = {}
        of: dict = {}
        order: list = []
        for batch in batches:
            for category, share, o, k, own in zip(*(batch.column(c).to_pylist() for c in ("category", "wanted", "__o", "__k", "__c")), strict=True):
                of[k] = (o, own)
                (order if category is None else queues.setdefault((share, category), [])).append((o, k))
        chosen: dict = {}
        for share, category in sorted(queues):
            needed = share - sum(category in of[k][1] for k in chosen)
            for _, k in sorted(queues[share, category]):
                if needed > 0 and k not in chosen:
                    chosen[k] = True
                    needed -= 1
        for _, k in sorted(order):
            if len(chosen) < n:
                chosen[k] = True
        first = sorted(chosen, key=lambda k: (of[k][0], k))[:n]
        yield pa.RecordBatch.from_arrays([pa.array(first, to_arrow_type(kind))], ["__k"])

    chosen = rows.coalesce(1).mapInArrow(serve, StructType([StructField("__k", kind)]))
    return df.join(chosen.withColumnRenamed("__k", key), key, "left_semi")


def coin(*parts: Column, seed: int | str = 42) -> Column:
    """0 or 1 from a hash of the parts."""
    return (F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), *parts)), 1, 8), 16, 10).cast("long") % 2).cast("int")
