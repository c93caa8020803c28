"""Bounding boxes as column expressions. A box is an array of four numbers in one of FORMATS."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("coco_xywh", "xyxy", "voc", "yolo", "tfod", "label_studio")
#: Formats in proportion to the image, which need its size.
RELATIVE = {"yolo": 1.0, "tfod": 1.0, "label_studio": 100.0}


def check_format(*names: str) -> None:
    for name in names:
        if name not in FORMATS:
            raise ValueError(f"unknown box format {name!r}; there are {', '.join(FORMATS)}")


def to_corners(box: Column, fmt: str, width: Column, height: Column) -> Column:
    """xmin, ymin, xmax, ymax in pixels."""
    check_format(fmt)
    a, b, c, d = (box[k] for k in range(4))
    if fmt in ("xyxy", "voc"):
        return F.array(a, b, c, d)
    if fmt == "yolo":  # the centre comes first
        a, b = a - c / 2, b - d / 2
    if fmt != "tfod":
        c, d = a + c, b + d
    if fmt == "coco_xywh":
        return F.array(a, b, c, d)
    unit = F.lit(RELATIVE[fmt])
    return F.array(a / unit * width, b / unit * height, c / unit * width, d / unit * height)


def from_corners(box: Column, fmt: str, width: Column, height: Column) -> Column:
    """Of a box in pixel corners; formats in proportion fail on a size that isn't positive."""
    check_format(fmt)
    a, b, c, d = (box[k] for k in range(4))
    if fmt in ("xyxy", "voc"):
        return F.array(a, b, c, d)
    if fmt == "coco_xywh":
        return F.array(a, b, c - a, d - b)
    if fmt == "yolo":
        a, b, c, d = a + (c - a) / 2, b + (d - b) / 2, c - a, d - b
    elif fmt == "label_studio":
        c, d = c - a, d - b
    unit = F.lit(RELATIVE[fmt])
    made = F.array(a / width * unit, b / height * unit, c / width * unit, d / height * unit)
    return F.when((width > 0) & (height > 0), made).otherwise(F.raise_error(F.lit(f"{fmt} needs positive image sizes")).cast("array<double>"))


def size_or_one(size: Column) -> Column:
    """A missing or zero size counts as 1, as boxes may be in proportion already."""
    return F.coalesce(F.nullif(size.cast("double"), F.lit(0.0)), F.lit(1.0))


def convert(box: Column, from_fmt: str, to_fmt: str, width: Column, height: Column) -> Column:
    """A null box, or one of fewer than four values, stays as it is."""
    w, h = size_or_one(width), size_or_one(height)
    return F.when(box.isNull() | (F.size(box) < 4), box).otherwise(from_corners(to_corners(box, from_fmt, w, h), to_fmt, w, h))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def usable(box: Column) -> Column:
    """Four finite values."""
    return F.coalesce((F.size(box) >= 4) & finite(box[0]) & finite(box[1]) & finite(box[2]) & finite(box[3]), F.lit(False))


def area(corners: Column) -> Column:
    return (corners[2] - corners[0]) * (corners[3] - corners[1])


def iou(p: Column, q: Column) -> Column:
    """Of two boxes in corners; 0 where the union isn't positive."""
    wide = F.greatest(F.least(p[2], q[2]) - F.greatest(p[0], q[0]), F.lit(0.0))
    high = F.greatest(F.least(p[3], q[3]) - F.greatest(p[1], q[1]), F.lit(0.0))
    both = area(p) + area(q) - wide * high
    return F.when(both > 0, wide * high / both).otherwise(F.lit(0.0))


def beyond(corners: Column, width: Column, height: Column, tolerance: float = 0.5) -> tuple[Column, Column]:
    """Whether a box begins before the image and ends behind it; false where a size is unknown."""
    known = width.isNotNull() & height.isNotNull()
    before = known & ((corners[0] < -tolerance) | (corners[1] < -tolerance))
    behind = known & ((corners[2] > width + tolerance) | (corners[3] > height + tolerance))
    return F.coalesce(before, F.lit(False)), F.coalesce(behind, F.lit(False))


def denormalise(box: Column, width: Column, height: Column, scale: int = 1000, kind: str = "double") -> Column:
    """Whole pixels from values of 0 to ``scale``, kept inside the image; a box without four values becomes empty.

    Each step is rounded to ``kind``, double or float; a null value is the far edge, as least() leaves nulls out.
    """

    def pixel(k: int) -> Column:
        size = height if k % 2 else width
        share = (box[k].cast(kind) / F.lit(float(scale))).cast(kind)  # a quotient of floats is the same if rounded to double first
        return F.greatest(F.least(F.bround(share * size.cast(kind)).cast("int"), size.cast("int")), F.lit(0))

    return F.when(F.size(box) == 4, F.array(*(pixel(k) for k in range(4)))).otherwise(F.array().cast("array<int>"))


def looks_normalised(box: Column, width: Column, height: Column) -> Column:
    """Old outputs hold values of 0 to 1000 though the image is larger."""
    return (F.array_max(box) <= 1001) & (F.greatest(width, height) > 1001)
