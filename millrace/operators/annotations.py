"""Annotations: validate, describe and convert boxes of images.

Operators take a row for each image with parallel arrays of boxes and categories, flat or inside a struct column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions.numbers import counter

#: Codes of the validation rules: level and what is wrong (fixed values).
RULES = {
    "W001": ("warning", "no annotations"),
    "E001": ("error", "as many boxes as categories are needed"),
    "E002": ("error", "a box needs four values"),
    "E003": ("error", "a coordinate isn't finite"),
    "E004": ("error", "xmin lies behind xmax"),
    "E005": ("error", "ymin lies behind ymax"),
    "W002": ("warning", "no area"),
    "W003": ("warning", "begins before the image"),
    "W004": ("warning", "ends behind the image"),
    "W005": ("warning", "no category"),
    "W006": ("warning", "a file name that occurs more than once"),
}


def require(df: DataFrame, *names: str | None) -> None:
    missing = [n for n in names if n is not None and n.split(".")[0] not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}; there are {', '.join(df.columns)}")


def flat(df: DataFrame, bbox: str = "bbox", category: str = "category", container: str = "objects") -> DataFrame:
    """Boxes and categories as top-level arrays, empty for null, whichever way they are nested."""
    if container in df.columns:
        kind = df.schema[container].dataType
        if kind.typeName() == "array":  # a list of structs instead of a struct of lists
            df = df.withColumns({bbox: F.transform(container, lambda o: o[bbox]), category: F.transform(container, lambda o: o[category])}).drop(container)
        else:
            df = df.withColumns({bbox: F.col(container)[bbox], category: F.col(container)[category]}).drop(container)
    require(df, bbox, category)
    return df.withColumns({bbox: F.coalesce(bbox, F.array().cast(df.schema[bbox].dataType)), category: F.coalesce(category, F.array().cast(df.schema[category].dataType))})


def issue(code: str, at: Column | None = None) -> Column:
    place = F.lit(None).cast("int") if at is None else at.cast("int")
    return F.struct(F.lit(RULES[code][0]).alias("level"), F.lit(code).alias("code"), F.lit(RULES[code][1]).alias("message"), place.alias("ann_idx"))


def validate(df: DataFrame, fmt: str = "coco_xywh", image_id: str = "image_id", width: str | None = "width", height: str | None = "height", tolerance: float = 0.5) -> DataFrame:
    """(image_id, level, code, message, ann_idx): a row for each issue, found in one pass without a shuffle."""
    B.check_format(fmt)
    df = flat(df)
    require(df, image_id, width, height)
    w = F.col(width).cast("double") if width else F.lit(None).cast("double")
    h = F.col(height).cast("double") if height else F.lit(None).cast("double")

    def of_box(box: Column, at: Column) -> Column:
        corners = B.to_corners(box, fmt, B.size_or_one(w), B.size_or_one(h))
        before, behind = B.beyond(corners, w, h, tolerance)
        found = {"E004": corners[0] > corners[2], "E005": corners[1] > corners[3], "W002": B.area(corners) <= 0, "W003": before, "W004": behind}
        sound = F.filter(F.array(*(F.when(test, issue(code, at)) for code, test in found.items())), lambda x: x.isNotNull())
        short = box.isNull() | (F.size(box) < 4)
        return F.when(short, F.array(issue("E002", at))).when(~B.usable(box), F.array(issue("E003", at))).otherwise(sound)

    blank = F.transform("category", lambda c, at: F.when(c.isNull() | (F.regexp_replace(c.cast("string"), r"\s", "") == ""), issue("W005", at)))
    count = (F.when((F.size("bbox") == 0) & (F.size("category") == 0), issue("W001")).when(F.size("bbox") != F.size("category"), issue("E001")),)
    issues = F.filter(F.concat(F.array(*count), F.flatten(F.transform("bbox", of_box)), blank), lambda x: x.isNotNull())
    return df.select(F.col(image_id).alias("image_id"), F.explode(issues).alias("i")).select("image_id", "i.*")


def duplicate_names(df: DataFrame, name: Column) -> DataFrame:
    """(name, n, level, code, message) of the names that several images have."""
    found = df.groupBy(name.cast("string").alias("name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return found.select("name", "n", *(F.lit(x).alias(k) for k, x in (("level", RULES["W006"][0]), ("code", "W006"), ("message", RULES["W006"][1]))))


def summary(issues: DataFrame) -> DataFrame:
    """(level, code, n, first_image): issues by code and the least image that has one."""
    return issues.groupBy("level", "code").agg(F.count(F.lit(1)).alias("n"), F.min("image_id").alias("first_image"))


def verdict(issues: DataFrame, strict: bool = False) -> DataFrame:
    """One row: errors, warnings and whether the set is valid."""
    counts = issues.agg(F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings"))
    return counts.withColumn("valid", (F.col("errors") == 0) & ((F.col("warnings") == 0) | F.lit(not strict)))


def exploded(df: DataFrame, fmt: str = "coco_xywh", image_id: str = "image_id", width: str = "width", height: str = "height") -> DataFrame:
    """A row for each box: image_id, ann_idx, category, corners and area (null for unusable boxes), width, height.

    A box without a category, or with a null one, has '<unknown>'.
    """
    df = flat(df)
    w, h = F.nullif(F.col(width).cast("double"), F.lit(0.0)), F.nullif(F.col(height).cast("double"), F.lit(0.0))
    pairs = F.transform("bbox", lambda b, i: F.struct(i.alias("ann_idx"), b.alias("box"), F.coalesce(F.get("category", i).cast("string"), F.lit("<unknown>")).alias("category")))
    rows = df.select(F.col(image_id).alias("image_id"), w.alias("width"), h.alias("height"), F.explode(pairs).alias("p")).select("image_id", "width", "height", "p.*")
    rows = rows.withColumn("corners", F.when(B.usable(F.col("box")), B.to_corners(F.col("box"), fmt, B.size_or_one(F.col("width")), B.size_or_one(F.col("height")))))
    return rows.withColumn("area", B.area(F.col("corners"))).drop("box")


def distribution(df: DataFrame, value: str, by: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """count, min, max, mean, median, p25, p75 to two places, by groups if asked; zeros where there is no value.

    Exact quartiles hold each group's different values in one task. With ``accuracy`` they are existing values whose rank
    is off by at most 1 / accuracy of the group, from sketches of bounded size that are merged.
    """
    x = F.col(value).cast("double")
    at = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = F.percentile(x, at) if accuracy is None else F.percentile_approx(x, at, accuracy)
    out = df.groupBy(*(by or [])).agg(F.count(x).alias("count"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), quartiles.alias("q"))
    named = {"min": F.col("min"), "max": F.col("max"), "mean": F.col("mean"), "median": F.col("q")[1], "p25": F.col("q")[0], "p75": F.col("q")[2]}
    return out.select(*(by or []), "count", *(F.round(F.coalesce(c, F.lit(0.0)), 2).alias(k) for k, c in named.items()))


def box_statistics(df: DataFrame, fmt: str = "coco_xywh", accuracy: int | None = None) -> DataFrame:
    """(measure, count, min, ...): areas above 0, aspect ratios of boxes with height, boxes for each image, image sizes;
    ``accuracy`` as for ``distribution``."""
    rows = exploded(df, fmt)
    high = F.col("corners")[3] - F.col("corners")[1]
    ratio = F.when(high > 0, (F.col("corners")[2] - F.col("corners")[0]) / high)
    measures = F.array(F.struct(F.lit("area").alias("measure"), F.when(F.col("area") > 0, F.col("area")).alias("x")), F.struct(F.lit("aspect_ratio").alias("measure"), ratio.alias("x")))
    of_boxes = rows.select(F.explode(measures).alias("m")).select("m.*")
    known = F.col("width").isNotNull() & F.col("height").isNotNull()
    size = lambda c: F.when(known, F.nullif(F.col(c).cast("double"), F.lit(0.0)))
    per_image = F.array(*(F.struct(F.lit(k).alias("measure"), x.alias("x")) for k, x in (("annotations_per_image", F.size("bbox").cast("double")), ("width", size("width")), ("height", size("height")))))
    of_images = flat(df).select(F.explode(per_image).alias("m")).select("m.*")
    return distribution(of_boxes.union(of_images), "x", ["measure"], accuracy)


def box_counts(df: DataFrame, fmt: str = "coco_xywh", tolerance: float = 0.5) -> DataFrame:
    """One row: images, images without boxes, boxes, those without area, those out of bounds, categories."""
    images = flat(df).agg(F.count(F.lit(1)).alias("images"), F.count_if(F.size("bbox") == 0).alias("empty_images"), F.coalesce(F.sum(F.size("bbox")), F.lit(0)).alias("boxes"))
    before, behind = B.beyond(F.col("corners"), F.col("width"), F.col("height"), tolerance)
    rows = exploded(df, fmt).agg(F.count_if(F.col("area") <= 0).alias("zero_area"), F.count_if(before | behind).alias("out_of_bounds"), F.count_distinct("category").alias("categories"))
    return images.join(F.broadcast(rows))  # one row with one row


def label_histogram(df: DataFrame, top: int | None = None) -> DataFrame:
    """(category, n, percent), most first."""
    counts = exploded(df).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    out = counts.join(F.broadcast(total)).select("category", "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 2).alias("percent"))
    return out.orderBy(F.col("n").desc(), "category").limit(top) if top else out


def cooccurrence(df: DataFrame, top: int | None = None) -> DataFrame:
    """(category_a, category_b, n): images in which both stand, a before b; pairs come from each image's own few categories."""
    own = flat(df).select(F.array_sort(F.array_distinct(F.transform("bbox", lambda b, i: F.coalesce(F.get("category", i).cast("string"), F.lit("<unknown>"))))).alias("c"))
    pairs = F.flatten(F.transform("c", lambda a, i: F.transform(F.slice("c", i + 2, F.size("c")), lambda b: F.struct(a.alias("category_a"), b.alias("category_b")))))
    out = own.where(F.size("c") > 1).select(F.explode(pairs).alias("p")).select("p.*").groupBy("category_a", "category_b").agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.col("n").desc(), "category_a", "category_b").limit(top) if top else out


def convert_boxes(df: DataFrame, from_fmt: str, to_fmt: str, width: str = "width", height: str = "height") -> DataFrame:
    """The rows with their boxes in the other format and, unless there is one, a ``conversion`` note."""
    if from_fmt == to_fmt:
        raise ValueError("both formats are the same")
    B.check_format(from_fmt, to_fmt)
    df = flat(df).withColumn("bbox", F.transform("bbox", lambda b: B.convert(b, from_fmt, to_fmt, F.col(width), F.col(height))))
    if "conversion" in df.columns:
        return df
    return df.withColumn("conversion", F.to_json(F.struct(F.lit(from_fmt).alias("from"), F.lit(to_fmt).alias("to"))))


def against_truth(df: DataFrame, predicted: str = "detections", truth: str = "bbox", names: str = "category", image_id: str = "image_id") -> DataFrame:
    """(image_id, n_truth, n_predicted, truth_labels, predicted_labels, least, most): what a row's model found beside what it should
    have; labels are counted into maps, and the least and most coordinate tell the scale of the boxes (0 without any)."""
    boxes = F.coalesce(F.transform(predicted, lambda d: d["bbox"]), F.array().cast("array<array<double>>"))
    values = F.filter(F.flatten(boxes), lambda v: v.isNotNull())
    own = lambda c: F.coalesce(counter(c), F.create_map().cast("map<string,bigint>"))
    return df.select(
        F.col(image_id).alias("image_id"), F.size(F.coalesce(truth, F.array().cast(df.schema[truth].dataType))).cast("long").alias("n_truth"), F.size(boxes).cast("long").alias("n_predicted"),
        own(F.transform(names, lambda c: F.coalesce(c.cast("string"), F.lit("<unknown>")))).alias("truth_labels"), own(F.transform(predicted, lambda d: d["label"])).alias("predicted_labels"),
        F.coalesce(F.array_min(values), F.lit(0.0)).alias("least"), F.coalesce(F.array_max(values), F.lit(0.0)).alias("most"),
    )
