"""Two versions of an annotated set: which images, categories and boxes agree."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as B
from .annotations import exploded, flat


def last_of_key(df: DataFrame, key: str, order: str, first: tuple[str, ...] = ()) -> DataFrame:
    """Of rows with one key the last one, one without an order only if there is no other; a null key is ''.

    Of rows equal in a number as order, the first by the columns ``first``, which aren't returned, is taken; without these any.
    """
    packed = F.struct(*(c for c in df.columns if c not in first))
    row = F.min_by(packed, F.struct(F.col(order).isNull(), -F.col(order), *first)) if first else F.max_by(packed, F.struct(order))
    return df.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key")).agg(row.alias("r")).select("r.*")


def images(a: DataFrame, b: DataFrame, key: str = "image_id") -> DataFrame:
    """(key, side): 'both', 'a' or 'b'."""
    left = a.select(key).distinct().withColumn("__a", F.lit(True))
    right = b.select(key).distinct().withColumn("__b", F.lit(True))
    side = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "a").otherwise("b")
    return left.join(right, key, "full").select(key, side.alias("side"))


def categories(a: DataFrame, b: DataFrame) -> DataFrame:
    """(category, side) over usable boxes."""
    names = lambda df: exploded(df).where("corners is not null").select(F.col("category").alias("image_id"))
    return images(names(a), names(b)).withColumnRenamed("image_id", "category")


def usable_boxes(df: DataFrame, fmt: str) -> DataFrame:
    """Usable boxes numbered inside their image."""
    df = flat(df)
    w, h = B.size_or_one(F.col("width")), B.size_or_one(F.col("height"))
    made = F.transform("bbox", lambda b, i: F.struct(F.when(B.usable(b), B.to_corners(b, fmt, w, h)).alias("corners"), F.coalesce(F.get("category", i).cast("string"), F.when(i < F.size("category"), F.lit("None")), F.lit("<unknown>")).alias("category")))
    return df.select("image_id", F.posexplode(F.filter(made, lambda m: m["corners"].isNotNull())).alias("i", "m")).select("image_id", "i", "m.*")


def overlapping(a: DataFrame, b: DataFrame, threshold: float = 0.5, fmt: str = "coco_xywh") -> DataFrame:
    """(image_id, i, j, iou, category_a, category_b): pairs of one image's boxes; an equi-join on the image with a filter."""
    sides = []
    for df, side, at in ((a, "p", "i"), (b, "q", "j")):
        rows = usable_boxes(df, fmt).select("image_id", F.col("i").alias(at), F.col("category").alias("category_a" if side == "p" else "category_b"), *(F.col("corners")[k].alias(f"{side}{k}") for k in range(4)))
        sides.append(rows)
    p, q = ([F.col(f"{side}{k}") for k in range(4)] for side in "pq")  # plain numbers: arrays would be unpacked for each pair
    pairs = sides[0].join(sides[1], "image_id").withColumn("iou", B.iou(p, q))
    return pairs.where(F.col("iou") >= threshold).select("image_id", "i", "category_a", "j", "category_b", "iou")


def matches(a: DataFrame, b: DataFrame, threshold: float = 0.5, fmt: str = "coco_xywh") -> DataFrame:
    """The overlapping pairs that are left after one-to-one matching inside an image, the best overlap first, of equals
    the larger numbers. Pairs come sorted, so a task takes each as it comes and remembers one image's boxes only."""
    pairs = overlapping(a, b, threshold, fmt)
    best_first = pairs.repartition("image_id").sortWithinPartitions("image_id", F.desc("iou"), F.desc("i"), F.desc("j"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        image, used_i, used_j = None, set(), set()
        for batch in batches:
            keep = []
            for k, i, j in zip(*(batch.column(c).to_pylist() for c in ("image_id", "i", "j")), strict=True):
                if k != image:
                    image, used_i, used_j = k, set(), set()
                free = i not in used_i and j not in used_j
                if free:
                    used_i.add(i)
                    used_j.add(j)
                keep.append(free)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return best_first.mapInArrow(run, pairs.schema)


def counts(a: DataFrame, b: DataFrame, threshold: float = 0.5, fmt: str = "coco_xywh") -> DataFrame:
    """One row: matched, modified, removed, added boxes of shared images, and boxes of images on one side only."""
    sides = images(a, b)
    per_side = lambda df, name: usable_boxes(df, fmt).join(sides, "image_id").agg(F.count_if(F.col("side") == "both").alias(f"shared_{name}"), F.count_if(F.col("side") == name).alias(f"only_{name}"))
    found = matches(a, b, threshold, fmt).agg(F.count(F.lit(1)).alias("matched"), F.count_if(F.col("category_a") != F.col("category_b")).alias("modified"))
    joined = found.join(F.broadcast(per_side(a, "a"))).join(F.broadcast(per_side(b, "b")))  # one row each
    return joined.select("matched", "modified", (F.col("shared_a") - F.col("matched")).alias("removed"), (F.col("shared_b") - F.col("matched")).alias("added"), "only_a", "only_b")
