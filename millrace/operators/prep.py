"""Preparation of stories and works for an atlas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Upper ends of the score buckets and their names; what is above, or has no score, is the last (fixed values).
SCORE_BUCKETS = ((5, "0-5"), (25, "6-25"), (100, "26-100"), (500, "101-500"))
LAST_BUCKET = "500+"
#: Category and the words that make it; the first that fits wins, case counts (fixed values).
KEYWORDS = (
    ("Fiction", ("Fiction", "Novel", "Stories")),
    ("History", ("History", "Antiquities", "Civilization")),
    ("Science", ("Science", "Physics", "Chemistry", "Biology", "Geology", "Astronomy")),
    ("Religion", ("Religion", "Theology", "Bible", "Church")),
    ("Biography", ("Biography", "Correspondence")),
    ("Literature", ("Poetry", "Drama", "Literature")),
    ("Tech & Engineering", ("Mathematics", "Computer", "Engineering", "Technol")),
    ("Music", ("Music",)),
    ("Art & Design", ("Art", "Photography", "Architecture", "Design")),
    ("Law & Politics", ("Law", "Politics", "Government", "Foreign relations")),
    ("Education", ("Education", "Teaching")),
    ("Philosophy", ("Philosophy", "Psychology")),
    ("Medicine", ("Medicine", "Health", "Disease")),
    ("Business & Economics", ("Econom", "Business", "Commerce", "Finance")),
    ("Children", ("Children", "Juvenile")),
    ("Travel", ("Travel", "Guidebook", "Description and travel")),
    ("Food & Agriculture", ("Agriculture", "Gardening", "Cook", "Food")),
    ("Society", ("Social", "Sociology", "Women", "Feminism")),
    ("Military", ("Military", "War")),
    ("Sports", ("Sport", "Games", "Baseball", "Football")),
)


def score_bucket(score: Column) -> Column:
    out = None
    for top, name in SCORE_BUCKETS:
        out = F.when(score <= top, name) if out is None else out.when(score <= top, name)
    return out.otherwise(LAST_BUCKET)


def first_category(text: Column, rules=KEYWORDS, other: str = "Other") -> Column:
    out = None
    for name, words in rules:
        fits = F.lit(False)
        for w in words:
            fits = fits | text.contains(w)
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return F.lit(other) if out is None else out.otherwise(other)


def stories(df: DataFrame, kind: int = 1) -> DataFrame:
    """Stories with a title, and their year and score bucket."""
    good = (F.col("type") == kind) & F.col("title").isNotNull() & (F.trim("title") != "")
    return df.where(good).withColumns({"year": F.year("time").cast("string"), "score_bucket": score_bucket(F.col("score"))})


def works(df: DataFrame, shortest: int = 3) -> DataFrame:
    """Works with subjects and a title of more than ``shortest`` signs, and their category and first subject."""
    good = F.col("subjects").isNotNull() & (F.col("subjects") != "[]") & (F.trim("title") != "") & (F.length("title") > shortest)
    return df.where(good).withColumns({"category": first_category(F.col("subjects")), "primary_subject": F.get_json_object("subjects", "$[0]")})


def replace_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """``old`` under the name ``new``; a column that has that name goes."""
    return df if old == new else df.drop(new).withColumnRenamed(old, new)
