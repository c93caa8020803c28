"""Reading sets of data."""

from __future__ import annotations

import hashlib
import io
import json
import re
import zipfile
from fnmatch import translate

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import scratch

#: Format by file name ending (fixed values).
FORMATS = {"parquet": "parquet", "json": "json", "jsonl": "json", "ndjson": "json", "csv": "csv", "orc": "orc"}


def table(spark: SparkSession, root: str, name: str, config: str | None = None, revision: str | None = None) -> DataFrame:
    """``root[/config][/revision]/name.parquet``."""
    return spark.read.parquet("/".join(x for x in (root.rstrip("/"), config, revision, f"{name}.parquet") if x))


def load(spark: SparkSession, *paths: str, fmt: str | None = None, recursive: bool = False, columns: list[str] | None = None) -> DataFrame:
    """Files or globs, their formats told from the ending (Parquet if none); several become one set, by column name. ``recursive``
    reads the files below a folder that have any ending of the format."""
    if not paths:
        raise ValueError("no path is given")
    kinds = {fmt or FORMATS.get(re.sub(r".*\.(\w+)$", r"\1", p).lower(), "parquet") for p in paths}
    if len(kinds) > 1:
        parts = [load(spark, p, recursive=recursive) for p in paths]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more, allowMissingColumns=True)
    else:
        kind = kinds.pop()
        reader = spark.read.format(kind)
        if recursive:
            reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{{{','.join(e for e, k in FORMATS.items() if k == kind)}}}")
        if kind == "csv":
            reader = reader.option("header", "true").option("inferSchema", "true").option("multiLine", "true")
        if kind == "parquet" and len(paths) > 1:
            reader = reader.option("mergeSchema", "true")
        out = reader.load(list(paths))
    return out.select(*columns) if columns else out


def listing(spark: SparkSession, root: str, pattern: str = "*", endings: tuple[str, ...] = ()) -> DataFrame:
    """(path, name, length) of the files below ``root`` whose names fit the glob and, if given, the endings."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.substring_index("path", "/", -1).alias("name"), "length")
    found = found.where(F.col("name").rlike(translate(pattern).replace(r"\Z", "$").replace(r"\z", "$")))
    return found.where(F.lower("name").rlike(rf"\.({'|'.join(endings)})$")) if endings else found


def shards(spark: SparkSession, glob: str, k: int | None = None, seed: int = 42) -> list[str]:
    """Paths that fit the glob, in order, or k of them by seeded order; none is an error."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(glob)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    paths = sorted(s.getPath().toString() for s in found or [])
    if not paths:
        raise FileNotFoundError(f"nothing fits {glob}")
    if k is not None:
        paths = sorted(sorted(paths, key=lambda p: hashlib.md5(f"{seed}-{p}".encode()).hexdigest())[:k])
    return paths


def partitions(spark: SparkSession, root: str, fallback: tuple[str, ...] = ()) -> list[str]:
    """Names of the directories below ``root``; ``fallback`` if they can't be listed."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return list(fallback)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) or list(fallback)


def snapshot(spark: SparkSession, source: str, at: str, endings: tuple[str, ...] = ()) -> DataFrame:
    """The listing of ``source`` as it was when first asked for; another source than the pinned one is listed anew."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        held = spark.read.schema("path string, name string, length long, source string").json(at)
        if held.where(F.col("source") != source).isEmpty():
            return held.drop("source")
    listing(spark, source, endings=endings).withColumn("source", F.lit(source)).write.mode("overwrite").json(at)
    return spark.read.schema("path string, name string, length long, source string").json(at).drop("source")


def zip_configs(frames: dict[str, DataFrame], key: str, column: str) -> DataFrame:
    """The first frame with one column more for each frame, named after it: its ``column`` for the same key.

    Rows are paired by key, not by place, so frames may be in any order; what a frame lacks is null.
    """
    if not frames:
        raise ValueError("no frame is given")
    out = next(iter(frames.values())).drop(column)
    for name, df in frames.items():
        out = out.join(df.select(key, F.col(column).alias(name)), key, "left")
    return out


def from_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def zipped(spark: SparkSession, content: bytes, root: str | None = None) -> DataFrame:
    """The Parquet files of an archive, unpacked into ``root``, by default a new path in the shared folder. What isn't inside it is refused."""
    root = root or scratch(spark, "zip")
    store, base = pyarrow.fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if n.endswith(".parquet")]
        if any(n.startswith("/") or ".." in n.split("/") for n in names):
            raise ValueError(f"a path outside the archive in {names}")
        for name in names:
            store.create_dir(f"{base}/{name}".rpartition("/")[0], recursive=True)
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(z.read(name))
    return load(spark, *(f"{root}/{n}" for n in names), fmt="parquet")


def template(argument: str) -> dict | list:
    """A JSON template given as such or as a path."""
    text = argument.strip()
    if text[:1] not in "{[":
        with open(text, encoding="utf-8") as f:
            text = f.read()
    try:
        return json.loads(text)
    except json.JSONDecodeError as e:
        raise ValueError(f"not a JSON template: {e}") from e


def catalog(queries: dict) -> list[tuple[str, str]]:
    """(name, first line of its description) of registered operators."""
    return sorted((k, (f.__doc__ or "").strip().split("\n")[0]) for k, f in queries.items())
