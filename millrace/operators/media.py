"""Files of pictures, pages and sound: listings, chunks, subtitles, manifests."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pictures
from ..functions.numbers import srt_time
from ..functions.texts import word_count
from .sampling import seeded

#: File name endings (fixed values).
IMAGES = ("jpg", "jpeg", "png", "tif", "tiff", "webp", "bmp", "gif", "jp2")
AUDIO = ("wav", "mp3", "flac", "m4a", "ogg", "opus", "webm", "aac")
DOCUMENTS = ("pdf",)


def files(spark: SparkSession, root: str, endings: tuple[str, ...], content: bool = True, n: int | None = None, seed: int | None = None) -> DataFrame:
    """(path, name, length, content) of the files below ``root``, all or the first n by name or by seeded order; none is an error."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    found = found.where(F.lower("path").rlike(rf"\.({'|'.join(endings)})$"))
    found = found.select("path", F.substring_index("path", "/", -1).alias("name"), "length", *(["content"] if content else []))
    if found.isEmpty():
        raise FileNotFoundError(f"no file below {root} ends in {', '.join(endings)}")
    if n is not None:
        found = found.orderBy(seeded("path", seed) if seed is not None else F.col("path")).limit(n)
    return found


def chunks(df: DataFrame, length: Column, size: int = 30, overlap: int = 2) -> DataFrame:
    """Rows with ``chunk``, ``start`` and ``end``: windows of ``size`` that overlap, the last as short as it is."""
    step = size - overlap
    if step <= 0:
        raise ValueError("the overlap is smaller than the window")
    last = F.greatest(F.ceil((length - size) / F.lit(float(step))), F.lit(0)).cast("int")
    rows = df.where(length > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))
    return rows.withColumn("start", F.col("chunk") * step).withColumn("end", F.least(F.col("start") + size, length))


def regroup(df: DataFrame, by: str, order: str, text: str) -> DataFrame:
    """(by, text, n_chunks): the pieces of each file in their order, joined by spaces."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text).alias("t"))))
    return df.groupBy(by).agg(F.array_join(F.transform(parts, lambda p: p["t"]), " ").alias(text), F.count(F.lit(1)).alias("n_chunks"))


def subtitles(df: DataFrame, number: Column, start: Column, end: Column, text: Column) -> DataFrame:
    """Adds ``srt``: a numbered block with its times."""
    return df.withColumn("srt", F.concat(number.cast("string"), F.lit("\n"), srt_time(start), F.lit(" --> "), srt_time(end), F.lit("\n"), F.trim(text), F.lit("\n")))


def srt_files(df: DataFrame, by: str, order: str) -> DataFrame:
    """(by, srt): whole subtitle files."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), F.col("srt").alias("s"))))
    return df.groupBy(by).agg(F.array_join(F.transform(parts, lambda p: p["s"]), "\n").alias("srt"))


def canvases(df: DataFrame, base: str) -> DataFrame:
    """Adds ``canvas``: the JSON of one image's place in a manifest, from name, width, height."""
    at = F.concat(F.lit(base.rstrip("/") + "/"), F.col("name"))
    service = F.array(F.struct(at.alias("id"), F.lit("ImageService3").alias("type"), F.lit("level0").alias("profile")))
    return df.withColumn("canvas", F.to_json(F.struct(F.concat(at, F.lit("/canvas")).alias("id"), F.lit("Canvas").alias("type"), F.col("name").alias("label"), "width", "height", service.alias("service"))))


def manifest(df: DataFrame, base: str, label: str) -> str:
    """One manifest of the canvases by name. A manifest is one document, so its images come together."""
    import json

    rows = canvases(df, base).orderBy("name").select("canvas").toLocalIterator()
    return json.dumps({"id": f"{base.rstrip('/')}/manifest.json", "type": "Manifest", "label": label, "items": [json.loads(r["canvas"]) for r in rows]})


def data_uri(content: Column, kind: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{kind};base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def prepared(content: bytes, longest: int | None = None, as_grey: bool = False) -> tuple[bytes, int, int]:
    """A PNG as RGB or grey, with its longer side at most ``longest``: content, width, height."""
    pixels = pictures.decode_png(content)
    pixels = pictures.grey(pixels) if as_grey else pictures.rgb(pixels)
    height, width = pixels.shape[:2]
    if longest and max(width, height) > longest:
        shrink = longest / max(width, height)
        width, height = max(1, int(width * shrink)), max(1, int(height * shrink))
        pixels = pictures.resize(pixels, width, height)
    return pictures.encode_png(pixels), width, height


def encoded(df: DataFrame, content: str = "content", longest: int | None = None, as_grey: bool = False) -> DataFrame:
    """Adds uri, width, height, error: each PNG as a data URI, RGB or grey and not larger than asked for. What can't be read
    keeps its row, with nulls and the error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for raw in batch[content]:
                try:
                    png, width, height = prepared(bytes(raw or b""), longest, as_grey)
                    made.append((f"data:image/png;base64,{base64.b64encode(png).decode()}", width, height, None))
                except Exception as e:
                    made.append((None, None, None, f"{type(e).__name__}: {e}"[:500]))
            new = pd.DataFrame(made, columns=["uri", "width", "height", "error"], index=batch.index).astype({"width": "Int32", "height": "Int32"})
            yield pd.concat([batch.drop(columns=[c for c in new.columns if c in batch.columns]), new], axis=1)

    kept = df.drop("uri", "width", "height", "error")
    return kept.mapInPandas(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), "uri string, width int, height int, error string"]))


def tiles(df: DataFrame, tile: int = 512, name: str = "name", content: str = "content") -> DataFrame:
    """(name, scale, x, y, w, h, content): the tiles of each PNG's pyramid, cut and scaled down, in the places of ``tile_plan``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own, raw in zip(batch[name], batch[content], strict=True):
                pixels = pictures.decode_png(bytes(raw))
                height, width = pixels.shape[:2]
                scale, rows = 1, []
                while True:
                    side = scale * tile
                    for y in range(0, height, side):
                        for x in range(0, width, side):
                            part = pictures.rgb(pixels[y : y + side, x : x + side])
                            h, w = part.shape[:2]
                            rows.append((own, scale, x, y, w, h, pictures.encode_png(pictures.resize(part, -(-w // scale), -(-h // scale)))))
                    if side >= max(width, height):
                        break
                    scale *= 2
                yield pd.DataFrame(rows, columns=["name", "scale", "x", "y", "w", "h", "content"])

    return df.select(name, content).mapInPandas(run, "name string, scale int, x int, y int, w int, h int, content binary")


def transcripts(df: DataFrame, by: str, order: str, text: str, seconds: Column, took: Column | None = None) -> DataFrame:
    """(by, text, segments, words, seconds, realtime): whole transcripts for text files and their summary; ``realtime`` is how
    many times faster than the sound the work was, null without its time."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), F.trim(F.col(text)).alias("t"))))
    spent = F.sum(took) if took is not None else F.lit(None).cast("double")
    out = df.where(F.col(text).isNotNull()).groupBy(by).agg(F.array_join(F.transform(parts, lambda p: p["t"]), "\n").alias("text"), F.count(F.lit(1)).alias("segments"), F.sum(seconds).alias("seconds"), spent.alias("__spent"))
    return out.select(by, "text", "segments", word_count(F.col("text")).alias("words"), F.round("seconds", 2).alias("seconds"), F.round(F.try_divide("seconds", "__spent"), 1).alias("realtime"))


def flattened(df: DataFrame, segments: str) -> DataFrame:
    """A row for each segment of a file's list, with its number from 0; files without any have none."""
    others = [c for c in df.columns if c != segments]
    return df.select(*others, F.posexplode(segments).alias("segment", "__s")).select(*others, "segment", "__s.*")


def combine_masks(masks: list[bytes], width: int, height: int) -> bytes:
    """One map of instances from their masks (a byte for each pixel): numbers from 1, later ones on top, 0 elsewhere."""
    out = np.zeros(width * height, dtype=np.uint8)
    for k, m in enumerate(masks, 1):
        out[np.frombuffer(m, np.uint8) > 0] = k
    return out.tobytes()


def segmentation_map(masks: Column, width: Column, height: Column) -> Column:
    def run(masks: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
        return pd.Series([combine_masks(list(m), w, h) for m, w, h in zip(masks, width, height, strict=True)])

    run.__annotations__ = {"masks": pd.Series, "width": pd.Series, "height": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "binary")(masks, width, height)


def pages(df: DataFrame, render, path: str = "path", content: str = "content", dpi: int = 150) -> DataFrame:
    """(path, page, content, error): a row for each page, by ``render(bytes, zoom)`` -> images; a bad file has one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, raw in zip(batch[path], batch[content], strict=True):
                try:
                    made = [(where, i, bytes(p), None) for i, p in enumerate(render(bytes(raw), dpi / 72))]
                except Exception as e:
                    made = [(where, None, None, f"{type(e).__name__}: {e}"[:500])]
                frame = pd.DataFrame(made, columns=["path", "page", "content", "error"])
                yield frame.astype({"page": "Int32"})

    return df.select(path, content).mapInPandas(run, "path string, page int, content binary, error string")


def tile_plan(df: DataFrame, tile: int = 512) -> DataFrame:
    """(name, scale, x, y, w, h): the regions of a tile pyramid over images of name, width, height."""
    levels = F.ceil(F.log2(F.greatest(F.greatest("width", "height") / F.lit(float(tile)), F.lit(1.0)))).cast("int")
    rows = df.withColumn("scale", F.explode(F.transform(F.sequence(F.lit(0), levels), lambda k: F.pow(F.lit(2.0), k).cast("int"))))
    side = F.col("scale") * tile
    rows = rows.withColumn("col", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("width") / side) - 1).cast("int"))))
    rows = rows.withColumn("row", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("height") / side) - 1).cast("int"))))
    x, y = F.col("col") * side, F.col("row") * side
    return rows.select("name", "scale", x.alias("x"), y.alias("y"), F.least(side, F.col("width") - x).alias("w"), F.least(side, F.col("height") - y).alias("h"))


def decode_data_uri(uri: str) -> bytes:
    return base64.b64decode(uri.partition(",")[2])
