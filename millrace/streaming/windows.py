"""Event-time windows and incremental runs, the same for tables and streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_time(df: DataFrame, column: str = "ts", late: str | None = None) -> DataFrame:
    """Time stamps with a zone, which watermarks need; with ``late`` a watermark that far behind."""
    df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df.withWatermark(column, late) if late else df


def tumbling(df: DataFrame, size: str, by: list[str] = (), column: str = "ts", slide: str | None = None) -> DataFrame:
    """(start, by, n, total) by windows of ``size``, each ``slide`` (tumbling without)."""
    own = F.window(column, size, slide) if slide else F.window(column, size)
    out = df.groupBy(own.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), *by, "n", "total")


def sessions(df: DataFrame, gap: str, by: str, column: str = "ts") -> DataFrame:
    """(by, start, end, n): runs of events with less than ``gap`` between them; ``end`` is the last event's time plus the gap."""
    out = df.groupBy(F.session_window(column, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_of_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key; of a stream within its watermark."""
    return df.dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and stops; the next run goes on where this one ended."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)
    query.awaitTermination()


def run_batches(df: DataFrame, write, checkpoint: str) -> None:
    """``write(frame, number)`` for each micro-batch; a repeated number replaces what it wrote before."""
    query = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def running(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, n, total, most) of a stream: for each key that a micro-batch touches its count, sum and maximum since the beginning.

    The state of a key is three numbers; batches come as Arrow data, and a null value counts as a row only.
    """
    kind = df.schema[by].dataType.simpleString()

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total, most = state.get if state.exists else (0, 0.0, float("-inf"))
        for frame in frames:
            known = frame[value].dropna()
            n, total = n + len(frame), total + float(known.sum())
            most = max([most, float(known.max())]) if len(known) else most
        state.update((n, total, most))
        yield pd.DataFrame({by: [key[0]], "n": [n], "total": [total], "most": [most]})

    made = df.select(by, F.col(value).cast("double").alias(value)).groupBy(by)
    return made.applyInPandasWithState(step, f"`{by}` {kind}, n long, total double, most double", "n long, total double, most double", "update", GroupStateTimeout.NoTimeout)


def latest(spark: SparkSession, df: DataFrame, path: str, checkpoint: str, key: str) -> DataFrame:
    """Runs a stream of updates over what is there and gives the last row of each key. Each micro-batch is a folder of its own,
    replaced if it is repeated."""

    def write(frame: DataFrame, number: int) -> None:
        frame.write.mode("overwrite").parquet(f"{path}/batch={number}")

    df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(path)
    return rows.groupBy(key).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in (key, "batch"))), "batch").alias("r")).select(key, "r.*")
