"""Rows that every text operator must bear."""

LONG = "lorem ipsum dolor sit amet " * 8_000
NASTY = [
    (0, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox jumps over the lazy dog.", "en", "a"),
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n  ", "en", "b"),
    (4, LONG, "en", "b"),
    (5, "word", None, "c"),
    (0, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox jumps over the lazy dog.", "en", "a"),
    (None, "a row without an id, but with quite a few words in it", "en", None),
    (None, "a row without an id, but with quite a few words in it", "en", None),
    (7, "Größe ▁ naïve 日本語 😀 \x00 é́", "de", "c"),
    (8, "word", "en", "c"),
]
COLUMNS = "doc_id long, text string, lang string, source string"
#: Names that operators use themselves.
CLASH = ("score", "unit", "node", "n_words", "root", "part", "key", "ids", "mix_key")


def nasty(spark):
    rows = [(*r, *("x" for _ in CLASH)) for r in NASTY]
    return spark.createDataFrame(rows, COLUMNS + "".join(f", {c} string" for c in CLASH))


def none(spark):
    return spark.createDataFrame([], COLUMNS)
