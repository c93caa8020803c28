"""What the text operators share: shared storage, Arrow slicing and vectorised words."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from ..sources.scratch import materialize, scratch, shared_dir

__all__ = ["Table", "WordMemory", "Words", "bounded_batches", "byte_table", "crc_mod", "lean", "materialize", "mix", "scratch", "shared_dir", "slices", "smallest_hashes", "texts_of"]

#: Bytes of text that one numpy step works on; bounds a worker's memory whatever the documents' lengths.
SLICE_BYTES = 1 << 20
#: ASCII white space: what separates words.
SPACE = b"\t\n\x0b\x0c\r "


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded bytes and rows, so that very long documents don't pile up in one batch."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gives memory back to the system when a task ends: workers live on, and the next stage shares their executor."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


def crc_mod(col, n: int):
    """crc32 of an id's decimal text modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def smallest_hashes(df: DataFrame, key: str, n: int, most: int, distinct: bool = False) -> DataFrame:
    """The ``most`` rows of the smallest hashes of a key; ``n``: how many different keys there are, to a tenth.

    A threshold leaves little more than ``most`` keys before rows are put in order, so no partition sends more than its
    share. Rows are different ones, or made so by ``distinct``: all copies of a key lie on one side of the threshold.
    """
    hashed = F.xxhash64(key)
    if 1.1 * n > most:
        share = (most + 6 * most**0.5) * 1.1 / n
        df = df.where(hashed <= F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64))))
    return (df.distinct() if distinct else df).orderBy(hashed, key).limit(most)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(texts: list[bytes], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes together; a longer text is a run of its own."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def byte_table(separators: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(separators)] = True
    return table


IS_SPACE = byte_table(SPACE)


@lru_cache(maxsize=1)
def _byte_numbers() -> np.ndarray:
    """A fixed random number for each byte."""
    return np.random.Generator(np.random.PCG64(20240607)).integers(0, 2**64, 256, dtype=np.uint64)


_PLACES = [np.empty(0, np.uint64)]


def _place_numbers(n: int) -> np.ndarray:
    """A fixed random number for each of the first n places in a word, none a multiple of another."""
    if len(_PLACES[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        _PLACES[0] = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _PLACES[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: neighbouring keys become unrelated ones."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of a run of texts as arrays: start, end (bytes in ``buf``), doc (index in the run).

    ``first`` has, for each text and one past the last, the index of its first word.
    """

    def __init__(self, texts: list[bytes], is_separator: np.ndarray = IS_SPACE, glue: bytes = b"\n"):
        self.buf = np.frombuffer(glue.join(texts) + glue, dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.lengths = lengths
        self.separator = is_separator[self.buf]
        inside = np.empty(len(self.buf) + 1, dtype=np.int8)
        inside[0] = 0
        np.subtract(1, self.separator.view(np.int8), out=inside[1:])
        steps = np.diff(inside)
        self.start = np.flatnonzero(steps == 1)
        self.end = np.flatnonzero(steps == -1)
        self.first = np.searchsorted(self.start, self.text_start)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same in every process: the sum over its bytes of the byte's number times its
        place's. The places' numbers have nothing to do with one another, so that no words agree by construction, as
        they do where the numbers are powers."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        inside = np.flatnonzero(~self.separator)
        length = self.end - self.start
        first = np.concatenate(([0], np.cumsum(length)[:-1]))
        place = np.arange(len(inside)) - np.repeat(first, length)
        parts = _byte_numbers()[self.buf[inside]] * _place_numbers(int(length.max()))[place]
        return mix(np.add.reduceat(parts, first) + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (first word) and hashes of all runs of k words inside one text."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        value = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            value = value * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, mix(value[at])

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """Sums of a per-byte array over each text."""
        sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return sums[self.text_start[1:] - 1] - sums[self.text_start[:-1]]


class Table:
    """Open-addressing look-up of 64-bit keys, vectorised: gives each key's value (0 or more), or -1."""

    def __init__(self, keys: np.ndarray, values: np.ndarray | None = None, room: int = 0):
        self.bits = max(4, int(max(len(keys), room) * 2.5).bit_length())
        self.shift = np.uint64(64 - self.bits)
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.values = np.full(1 << self.bits, -1, dtype=np.int32)
        self.insert(keys, np.arange(len(keys)) if values is None else values)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Different keys, none of which is there yet."""
        slot, last = self.slot(keys), len(self.values) - 1
        while len(keys):
            free = np.flatnonzero(self.values[slot] < 0)
            taken, index = np.unique(slot[free], return_index=True)
            put = free[index]
            self.keys[taken] = keys[put]
            self.values[taken] = values[put]
            left = np.ones(len(keys), dtype=bool)
            left[put] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & last

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot, last = self.slot(keys), len(self.values) - 1
        out = self.values[slot].astype(np.int64)
        left = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        out[left] = -1
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & last
            value = self.values[slot]
            hit = (value >= 0) & (self.keys[slot] == keys[left])
            out[left[hit]] = value[hit]
            going = ~hit & (value >= 0)
            left, slot = left[going], slot[going]
        return out


class WordMemory:
    """What is made of each different word, remembered by a worker and laid out for whole runs of texts at once.

    ``make`` gets new words and gives, for each word, the bytes of its items in each store. The memory starts anew when
    it is full: that changes speed, never results. Words are known by a 64-bit hash whose numbers have no structure: of
    1.5 million words remembered at once two agree with a probability below 1e-7.
    """

    def __init__(self, make, kinds: tuple, words: int = 1_500_000, items: int = 20_000_000):
        self.make, self.kinds, self.words, self.items = make, kinds, words, items
        self.clear()

    def clear(self) -> None:
        self.table = Table(np.empty(0, np.uint64), room=self.words)
        self.count = 0
        self.flat = [np.empty(1 << 16, dtype=k) for k in self.kinds]
        self.ends = [np.zeros(1 << 16, dtype=np.int64) for _ in self.kinds]

    def places(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        """The place of each word of a run; valid until the next call."""
        if self.count > 0.8 * self.words or any(self.ends[k][self.count] > self.items for k in range(len(self.kinds))):
            self.clear()
        found = self.table.find(hashes)
        new = np.flatnonzero(found < 0)
        if not len(new):
            return found
        keys, first = np.unique(hashes[new], return_index=True)
        raw = words.buf.tobytes()
        at = new[first]
        made = self.make([raw[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)])
        top = self.count + len(keys)
        for k in range(len(self.kinds)):
            parts = [m[k] for m in made]
            if top + 1 > len(self.ends[k]):
                self.ends[k] = np.concatenate((self.ends[k], np.zeros(max(top, len(self.ends[k])), np.int64)))
            items = np.frombuffer(b"".join(parts), dtype=self.kinds[k])
            ends = self.ends[k][self.count] + np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // items.itemsize)
            self.ends[k][self.count + 1 : top + 1] = ends
            if ends[-1] > len(self.flat[k]):
                self.flat[k] = np.concatenate((self.flat[k], np.empty(max(int(ends[-1]), len(self.flat[k])), self.kinds[k])))
            self.flat[k][self.ends[k][self.count] : ends[-1]] = items
        if top <= self.words:
            self.table.insert(keys, np.arange(self.count, top))
        else:  # a single run with more new words than fit: they are known to this run alone
            self.table = Table(np.empty(0, np.uint64), room=self.words)
        self.count = top
        found[new] = np.searchsorted(keys, hashes[new]) + (top - len(keys))
        return found

    def lay_out(self, k: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Store k's items of all words one after another, and how many each word has."""
        starts = self.ends[k][places]
        counts = self.ends[k][places + 1] - starts
        before = np.cumsum(counts) - counts
        return self.flat[k][np.repeat(starts - before, counts) + np.arange(int(counts.sum()))], counts
