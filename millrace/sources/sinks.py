"""Writing results: whole sets, shards with resume, text files, reports."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import materialize


def replace(df: DataFrame, path: str, config: str | None = None, staging: bool = False, max_rows: int | None = None, by: list[str] | None = None) -> str:
    """Writes a whole set in place of the old one; with ``staging`` beside it, for review."""
    target = "/".join(x for x in (path.rstrip("/"), config, "_staging" if staging else None) if x)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(target)
    return target


def with_retries(write: Callable[[], object], times: int = 3, wait: float = 30.0, fallback: Callable[[], object] | None = None, sleep=time.sleep) -> object:
    """Tries again after wait, 2 * wait, ...; at last the fallback, if there is one."""
    for k in range(times):
        try:
            return write()
        except Exception:
            if k + 1 == times:
                if fallback is None:
                    raise
                return fallback()
            sleep(wait * 2**k)
    raise ValueError("times is 1 or more")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remaining(df: DataFrame, done: DataFrame | None, key: str, retry_failed: bool = False) -> DataFrame:
    """Rows whose key isn't done yet; with ``retry_failed`` those that ended in an error count as not done."""
    if done is None:
        return df
    if retry_failed and "error" in done.columns:
        done = done.where("error is null")
    return df.join(done.select(key).distinct(), key, "left_anti")


def append_shards(df: DataFrame, path: str, key: str, max_rows: int = 10_000, retry_failed: bool = False) -> None:
    """Appends the rows whose key isn't in ``path`` yet, as zstd shards of one schema; reads only the key of what is there."""
    spark = df.sparkSession
    done = None
    if exists(spark, f"{path}/_SUCCESS"):
        held = spark.read.parquet(path)
        if [(f.name, f.dataType) for f in held.schema] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"{path} has another schema: {held.schema.simpleString()}")
        done = held.select(key, *(["error"] if "error" in held.columns else []))
    remaining(df, done, key, retry_failed).write.mode("append").option("compression", "zstd").option("maxRecordsPerFile", max_rows).parquet(path)


def batch_numbers(df: DataFrame, key: str, size: int) -> DataFrame:
    """Adds ``batch``: numbers from 0 of ``size`` rows each in the order of a unique key, null first.

    Each range of keys numbers its own rows, and only one count for each range is summed up. Ranges are drawn from a sample,
    anew in each plan, so the numbered rows are written once and both sides read what was written.
    """
    ranged = df.repartitionByRange(F.col(key)).sortWithinPartitions(key).withColumn("__p", F.spark_partition_id())
    ranged = materialize(ranged.withColumn("__i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "batches")
    counts = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__before"))  # one row for each partition
    joined = ranged.join(F.broadcast(before), "__p")
    return joined.withColumn("batch", F.floor((F.col("__before") + F.col("__i")) / size).cast("long")).drop("__p", "__i", "__before")


def padded(df: DataFrame, results: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """All rows of ``df`` with their results by key; what has no result yet gets the defaults (SQL literals by column)."""
    joined = df.join(results.select(key, *defaults), key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.expr(v)) for c, v in defaults.items()})


def check_run(spark: SparkSession, path: str, metadata: dict, compared: tuple[str, ...]) -> bool:
    """Writes ``metadata`` beside the output on the first run; on later ones what is compared must be equal. True: resumed."""
    at = f"{path.rstrip('/')}/_run_metadata"
    if exists(spark, f"{at}/_SUCCESS"):
        held = json.loads(spark.read.text(at).first()[0])
        other = {k: (held.get(k), metadata.get(k)) for k in compared if held.get(k) != metadata.get(k)}
        if other:
            raise ValueError(f"the output was made by another run: {other}")
        return True
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(at)
    return False


def text_files(df: DataFrame, root: str, name: str, text: str, ending: str = ".md") -> int:
    """One file for each row, named after ``name`` (sub-folders are kept); repeated attempts write the same file. Returns their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(root)
        for batch in batches:
            n = 0
            for where, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                stem, dot, _ = where.lstrip("/").rpartition(".")
                path = f"{base}/{stem if dot else where.lstrip('/')}{ending}"
                store.create_dir(path.rpartition("/")[0], recursive=True)
                with store.open_output_stream(path) as out:
                    out.write((body or "").encode())
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return df.select(name, text).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def card(title: str, facts: dict[str, object], tags: tuple[str, ...] = ()) -> str:
    """A Markdown description with its tags."""
    head = "".join(f"- {t}\n" for t in tags)
    return f"---\ntags:\n{head}---\n\n# {title}\n\n" + "".join(f"- **{k}**: {v}\n" for k, v in facts.items())


def missing_files(ours: DataFrame, theirs: DataFrame, name: str = "name") -> DataFrame:
    """What the other side has and this one lacks."""
    return theirs.select(name).distinct().join(ours.select(name).distinct(), name, "left_anti")


def guard_superset(ours: DataFrame, theirs: DataFrame, name: str = "name") -> None:
    """Refuses to go on if something would get lost."""
    lost = missing_files(ours, theirs, name)
    if not lost.isEmpty():
        raise ValueError(f"{lost.count()} files are missing here, such as {[r[0] for r in lost.orderBy(name).limit(5).collect()]}")


def report(df: DataFrame, path: str) -> None:
    """A small result as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)
