"""Numbers, arrays and times as column expressions."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_mean(a: Column) -> Column:
    """Mean of what isn't null; null of an empty or null list."""
    have = F.filter(a, lambda x: x.isNotNull())
    return F.aggregate(have, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(have), F.lit(0))


def softmax(z: Column) -> Column:
    """Shares of the exponentials, shifted by the largest value against overflow."""
    top = F.array_max(z)
    powers = F.transform(z, lambda x: F.exp(x.cast("double") - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda s, y: s + y))


def argmax(z: Column) -> Column:
    """Place of the first largest value, from 0."""
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def srt_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm; negative times count as 0."""
    ms = F.bround(F.greatest(seconds.cast("double"), F.lit(0.0)) * 1000).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    whole = F.floor(ms / 1000)
    return F.concat(two(F.floor(whole / 3600)), F.lit(":"), two(F.floor(whole % 3600 / 60)), F.lit(":"), two(whole % 60), F.lit(","), F.lpad((ms % 1000).cast("string"), 3, "0"))


def smart_resize(height: Column, width: Column, factor: int = 28, least: int = 28 * 28 * 130, most: int = 28 * 28 * 1280) -> Column:
    """(height, width) in multiples of ``factor`` with a pixel count inside the limits, in about the old proportion."""
    low, f = F.least(height, width).cast("double"), F.lit(float(factor))
    # a side shorter than one tile grows to a tile, the other with it
    grow = lambda x: F.when(low >= f, x.cast("double")).otherwise(F.when(x == low, f).otherwise(F.bround(x * f / low)))
    h, w = grow(height), grow(width)
    near = lambda x: F.bround(x / factor) * factor
    down, up = F.sqrt(h * w / most), F.sqrt(F.lit(float(least)) / (h * w))
    lower = lambda x: F.floor(x / down / factor) * factor
    higher = lambda x: F.ceil(x * up / factor) * factor
    pixels = near(h) * near(w)
    pick = lambda x: F.when(pixels > most, lower(x)).when(pixels < least, higher(x)).otherwise(near(x)).cast("long")
    return F.struct(pick(h).alias("height"), pick(w).alias("width"))


def longest_side(width: Column, height: Column, most: int) -> Column:
    """(width, height) with the longer side at most ``most``; smaller images stay."""
    shrink = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(width, height))
    return F.struct((width * shrink).cast("int").alias("width"), (height * shrink).cast("int").alias("height"))


def pixel_budget(width: Column, height: Column, most: int) -> Column:
    """(width, height) scaled down to at most ``most`` pixels."""
    shrink = F.least(F.lit(1.0), F.sqrt(F.lit(float(most)) / (width.cast("double") * height)))
    return F.struct((width * shrink).cast("int").alias("width"), (height * shrink).cast("int").alias("height"))


def pixel_expression(text: str) -> int:
    """Whole numbers joined by ``*``; nothing is evaluated."""
    if not re.fullmatch(r"\s*\d+\s*(\*\s*\d+\s*)*", text):
        raise ValueError(f"not a product of whole numbers: {text!r}")
    return math.prod(int(x) for x in text.split("*"))


def readable_bytes(n: Column) -> Column:
    """With one decimal and the largest unit that leaves at least 1."""
    out = F.format_string("%.1f PB", n / 1024.0**5)
    for k, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        out = F.when(F.abs(n) < 1024.0 ** (k + 1), F.format_string(f"%.1f {unit}", n / 1024.0**k)).otherwise(out)
    return out


def megabits_per_second(n_bytes: Column, seconds: Column) -> Column:
    return F.try_divide(n_bytes * 8.0 / 1e6, seconds)


def elo_expected(a: Column, b: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), (b - a) / 400.0))


def counter(a: Column) -> Column:
    """A map from each different value of a list to how often it stands there; null values are left out."""
    have = F.filter(a, lambda x: x.isNotNull())
    return F.map_from_entries(F.transform(F.array_distinct(have), lambda v: F.struct(v.alias("key"), F.size(F.filter(have, lambda x: x == v)).cast("long").alias("value"))))


def text_keys(m: Column) -> Column:
    return F.transform_keys(m, lambda k, v: k.cast("string"))


def pairs_of(a: Column) -> Column:
    """All pairs of places i < j of a list, as structs of ``a`` and ``b``."""
    return F.flatten(F.transform(a, lambda x, i: F.transform(F.slice(a, i + 2, F.size(a)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
