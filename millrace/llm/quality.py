"""Quality rules: word statistics and compression bands.

A document passes if its zstandard compression ratio (bytes / compressed bytes) lies inside the band of its
length, over the whole text and over each fixed chunk, the rest at its end included. Text below a band is incompressible (encoded or random
data), text above it repeats itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import Words, bounded_batches, byte_table, lean, mix, slices, texts_of

#: Characters that count as symbols (fixed by the contract).
SYMBOLS = byte_table(b"#*$%&|<>")


@dataclass(frozen=True)
class Band:
    """Limits of the compression ratio for texts of fewer than ``below`` bytes (None: all longer ones)."""

    below: int | None
    low: float
    high: float


#: A frame costs some twenty bytes, so short texts get a wide band; the ceiling rises with length, as more
#: of a long text has been seen before. Base64 of random bytes stays under 4/3 at any length, so the floor of
#: longer texts lies above that.
BANDS = (
    Band(128, 0.0, 5.0),
    Band(512, 1.05, 4.0),
    Band(2_048, 1.36, 5.0),
    Band(8_192, 1.4, 6.0),
    Band(65_536, 1.4, 8.0),
    Band(None, 1.4, 10.0),
)


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    bands: tuple[Band, ...] = BANDS
    chunk_bytes: int = 4_096
    #: Share of a text's bytes that may lie in chunks outside their band.
    max_bad_chunks: float = 0.25
    level: int = 3


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long, reason string"
)


def band_of(n_bytes: int, bands: tuple[Band, ...]) -> Band:
    return next(b for b in bands if b.below is None or n_bytes < b.below)


def compression(text: bytes, rules: QualityRules, press: zstandard.ZstdCompressor) -> tuple[float, int, int, str]:
    """Ratio of the whole text, its chunks, those outside their band, and why it is rejected ('' if it isn't)."""
    if not text:
        return 0.0, 0, 0, ""
    ratio = len(text) / len(press.compress(text))
    band = band_of(len(text), rules.bands)
    chunks = bad = bad_bytes = 0
    if len(text) > rules.chunk_bytes:
        for at in range(0, len(text), rules.chunk_bytes):
            chunk = text[at : at + rules.chunk_bytes]
            # the last chunk may be short: it has the band of its own length, and weighs as much as it is long
            inner = band_of(min(len(chunk), rules.chunk_bytes - 1), rules.bands)
            chunks += 1
            if not inner.low <= len(chunk) / len(press.compress(chunk)) <= inner.high:
                bad += 1
                bad_bytes += len(chunk)
    if ratio < band.low:
        return ratio, chunks, bad, "incompressible"
    if ratio > band.high:
        return ratio, chunks, bad, "repetitive"
    return ratio, chunks, bad, "chunks" if bad_bytes > rules.max_bad_chunks * len(text) else ""


def repeated_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Per text: words that stand in a 3-word window found twice or more in the text."""
    at, value = words.windows(hashes, 3)
    value = mix(value ^ (words.doc[at].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
    order = np.argsort(value)
    ordered = value[order]
    twin = np.zeros(len(order), dtype=bool)
    if len(order):
        same = ordered[1:] == ordered[:-1]
        twin[1:] |= same
        twin[:-1] |= same
    covered = np.zeros(len(hashes), dtype=bool)
    hit = at[order[twin]]
    for j in range(3):
        covered[hit + j] = True
    return np.bincount(words.doc[covered], minlength=len(words.counts))


def measure(texts: list[bytes], rules: QualityRules, press: zstandard.ZstdCompressor) -> list[list]:
    """The columns of SCHEMA for a run of texts."""
    words = Words(texts)
    continued = (words.buf & 0xC0) == 0x80
    characters = words.per_text(~(continued | words.separator))
    symbols = words.per_text(SYMBOLS[words.buf])
    repeats = repeated_words(words, words.hashes())
    out: list[list] = [words.counts.tolist(), characters.tolist(), symbols.tolist(), [], repeats.tolist(), [], [], [], [], [], []]
    for text, n, repeat in zip(texts, out[0], out[4], strict=True):
        lines = [x for x in text.split(b"\n") if x.strip()] if b"\n" in text else []
        failed = n < rules.min_words or 100 * repeat > rules.max_repeat_percent * n
        ratio, chunks, bad, why = compression(text, rules, press)
        for k, value in ((3, len(lines) - len(set(lines))), (5, failed), (6, not failed and not why), (7, ratio), (8, chunks), (9, bad), (10, "base" if failed else why)):
            out[k].append(value)
    return out


def quality(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: QualityRules = QualityRules()) -> DataFrame:
    """Columns ``keep`` and the measures of SCHEMA for every row of ``df``.

    A null text counts as empty: no words, ``base_failed``. Rows are judged alone, so repeated rows give
    repeated results and an empty table an empty one. Other columns of ``df`` aren't read.
    """
    bounded_batches(df.sparkSession)
    kept = df.select(*(df[c] for c in keep), df[text].alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), SCHEMA])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=rules.level)
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.int64(), pa.int64(), pa.string()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            texts = texts_of(batch.column("__text"))
            for i, j in slices(texts):
                columns = measure(texts[i:j], rules, press)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in range(len(keep))), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], [*keep, *names]
                )

    return kept.mapInArrow(lean(run), schema)


def keep_good(df: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The documents that pass, with all columns of ``df``, whatever the names of extra ones.

    A null or empty text has too few words and goes. Rows are judged alone, so repeated rows stay or go together, and an
    empty table gives an empty one.
    """
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for i, j in slices(texts):
                yield batch.slice(i, j - i).filter(pa.array(measure(texts[i:j], rules, press)[6], pa.bool_()))

    return df.mapInArrow(lean(run), df.schema)
