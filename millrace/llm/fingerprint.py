"""Improbable-feature digests.

Every window of 64 bytes gets a rank by how rare its entropy is; windows that are the rarest of many neighbourhoods
in a row are a text's features. Their hashes go into Bloom filters, the next filter beginning when one is full, and
two texts are as alike as the bits of their filters overlap beyond chance.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean, mix

WINDOW = 64
#: Texts too short to choose among windows of 64 bytes have all their windows of this size as features.
SHORT_WINDOW = 16
SCALE = 1 << 20
#: Neighbourhoods that are gone through at once; places are numbered in 24 bits.
PIECE = 1 << 23


@dataclass(frozen=True)
class DigestParams:
    #: Windows in a neighbourhood, and in how many of them a feature must be the rarest.
    neighbourhood: int = 64
    popularity: int = 16
    #: Bits of a filter, bits set by a feature, features that fill a filter.
    bits: int = 2048
    hashes: int = 5
    features: int = 160
    #: Entropy (bits per byte) that most windows of prose have, and how far they stray: far from it is rare.
    usual: float = 4.05
    spread: float = 0.25
    #: Windows below this entropy repeat themselves and are never features.
    least: float = 1.0


@lru_cache(maxsize=4)
def tables(params: DigestParams) -> tuple[np.ndarray, np.ndarray]:
    """Change of sum(c * log2(c)) when a count grows to c, in units of 1 / SCALE; rank by entropy in units of 1 / 256 bit."""
    c = np.arange(1, WINDOW + 1, dtype=np.float64)
    whole = np.concatenate(([0], np.rint(c * np.log2(c) * SCALE)))
    steps = np.concatenate(([0], np.diff(whole))).astype(np.int64)
    entropy = np.arange(6 * 256 + 1) / 256
    away = np.abs(entropy - params.usual) / params.spread
    rank = np.rint(1e6 * np.exp(-0.5 * np.minimum(away, 6) ** 2)).astype(np.int64)
    rank[entropy < params.least] = np.iinfo(np.int32).max
    return steps, rank


def window_ranks(buf: np.ndarray, params: DigestParams) -> np.ndarray:
    """Rank of the window that begins at each byte; the smaller, the rarer."""
    n = len(buf)
    steps, rank = tables(params)
    ahead, behind = np.ones(n, dtype=np.uint8), np.ones(n, dtype=np.uint8)  # of a byte's value, in the window that begins or ends at it
    for k in range(1, min(WINDOW, n)):
        same = (buf[k:] == buf[:-k]).view(np.uint8)
        ahead[:-k] += same
        behind[k:] += same
    # what the window loses at its first byte and wins at the byte behind it
    gain = steps[behind]
    total = np.empty(n - WINDOW + 1, dtype=np.int64)
    total[0] = gain_of_first(buf[:WINDOW], steps)
    np.cumsum(gain[WINDOW:] - steps[ahead[: n - WINDOW]], out=total[1:])
    total[1:] += total[0]
    entropy = 6.0 - total / (WINDOW * SCALE)
    return rank[np.clip(np.rint(entropy * 256), 0, 6 * 256).astype(np.int64)]


def gain_of_first(window: np.ndarray, steps: np.ndarray) -> int:
    return int(sum(steps[1 : c + 1].sum() for c in np.bincount(window, minlength=256) if c))


def votes(ranks: np.ndarray, allowed: np.ndarray, params: DigestParams) -> np.ndarray:
    """In how many neighbourhoods each window is the rarest (of equals the first).

    ``allowed``: whether the neighbourhood that begins at a window lies inside one text.
    """
    n, wide = len(ranks), params.neighbourhood
    if n < wide:
        return np.zeros(n, dtype=np.int64)
    key = (ranks << np.int64(24)) | np.arange(n, dtype=np.int64)
    have = 1
    best = key
    while have < wide:  # minimum over ``wide`` neighbours by doubling
        step = min(have, wide - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    winners = best[allowed[: len(best)]]
    winners = winners[(winners >> np.int64(24)) < np.iinfo(np.int32).max] & np.int64((1 << 24) - 1)
    return np.bincount(winners, minlength=n)


def feature_bits(buf: np.ndarray, places: np.ndarray, params: DigestParams) -> np.ndarray:
    """Bit numbers (a row for each feature) from a hash of the window."""
    words = np.lib.stride_tricks.sliding_window_view(buf, WINDOW)[places].copy().view(np.uint64)
    h = np.full(len(places), 0x243F6A8885A308D3, dtype=np.uint64)
    for k in range(words.shape[1]):
        h = mix(h ^ words[:, k]) + np.uint64(k)
    return bits_of_hash(h, params)


def bits_of_hash(h: np.ndarray, params: DigestParams) -> np.ndarray:
    second = mix(h ^ np.uint64(0x13198A2E03707344)) | np.uint64(1)
    return np.stack([(mix(h + np.uint64(k) * second) % np.uint64(params.bits)).astype(np.int64) for k in range(params.hashes)], axis=1)


def filters(bits: np.ndarray, params: DigestParams) -> np.ndarray:
    """Chained filters (a row of bytes each) of a text's features in their order."""
    chain = max(1, -(-len(bits) // params.features)) if len(bits) else 0
    out = np.zeros((chain, params.bits), dtype=bool)
    out[np.repeat(np.arange(len(bits)) // params.features, params.hashes), bits.reshape(-1)] = True
    return np.packbits(out, axis=1)


def digests(texts: list[bytes], params: DigestParams = DigestParams(), most: int = 1 << 20) -> list[np.ndarray]:
    """Filters of each text. An empty text has none; one without any chosen window has all its short windows."""
    out: list[np.ndarray] = [np.zeros((0, params.bits // 8), np.uint8)] * len(texts)
    long = WINDOW + params.neighbourhood - 1
    run: list[int] = []
    size = 0

    def flush() -> None:
        buf = np.frombuffer(b"".join([texts[i] for i in run]), dtype=np.uint8)
        starts = np.cumsum([0, *(len(texts[i]) for i in run)])
        ranks = window_ranks(buf, params)
        allowed = np.ones(len(ranks), dtype=bool)
        for end in starts[1:-1]:  # no neighbourhood reaches into the next text
            allowed[max(0, end - long + 1) : end] = False
        places = np.flatnonzero(votes(ranks, allowed, params) >= params.popularity)
        bits = feature_bits(buf, places, params) if len(places) else np.empty((0, params.hashes), np.int64)
        cuts = np.searchsorted(places, starts)
        for k, i in enumerate(run):
            own = bits[cuts[k] : cuts[k + 1]]
            out[i] = filters(own, params) if len(own) else whole(texts[i])
        run.clear()

    def whole(text: bytes) -> np.ndarray:
        wide = min(SHORT_WINDOW, len(text))
        parts = dict.fromkeys(text[k : k + wide] for k in range(len(text) - wide + 1))
        h = np.array([int.from_bytes(hashlib.sha256(x).digest()[:8], "little") for x in parts], dtype=np.uint64)
        return filters(bits_of_hash(h, params), params)

    for i, t in enumerate(texts):
        if len(t) < long:
            if t:
                out[i] = whole(t)
            continue
        if len(t) > PIECE:
            found = digest_bits(t, params)
            out[i] = filters(found, params) if len(found) else whole(t)
            continue
        if size + len(t) > most and run:
            flush()
            size = 0
        run.append(i)
        size += len(t)
    if run:
        flush()
    return out


def digest_bits(text: bytes, params: DigestParams, piece: int = PIECE) -> np.ndarray:
    """Bits of a long text's features: neighbourhoods are gone through piece by piece, and a window at a seam has the
    votes of the neighbourhoods of both its pieces, so that the seams change nothing."""
    long = WINDOW + params.neighbourhood - 1
    found, carried = [], np.zeros(0, dtype=np.int64)
    last = (len(text) - long) // piece * piece
    for a in range(0, last + 1, piece):
        buf = np.frombuffer(text, dtype=np.uint8, count=min(piece + long - 1, len(text) - a), offset=a)
        ranks = window_ranks(buf, params)
        count = votes(ranks, np.ones(len(ranks), dtype=bool), params)
        count[: len(carried)] += carried
        own = len(count) if a == last else piece
        carried = count[own:]
        places = np.flatnonzero(count[:own] >= params.popularity)
        if len(places):
            found.append(feature_bits(buf, places, params))
    return np.concatenate(found) if found else np.empty((0, params.hashes), np.int64)


_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)


def likeness(a: np.ndarray, b: np.ndarray, params: DigestParams = DigestParams()) -> float:
    """0 to 1: for each filter of the shorter chain the best overlap with one of the other, less what chance gives, weighted by its bits."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b) or len(a) == len(b) and a.tobytes() > b.tobytes():
        a, b = b, a
    na, nb = _ONES[a].sum(1), _ONES[b].sum(1)
    total = 0.0
    for row, n in zip(a, na, strict=True):
        common = _ONES[b & row].sum(1)
        least = np.minimum(n, nb)
        chance = n * nb / params.bits
        part = np.where(least > chance, (common - chance) / np.maximum(least - chance, 1e-9), (common == least).astype(float))
        # a filter with few bits says little about a full one: overlap counts in proportion to the larger
        total += n * float(np.clip(part * np.minimum(n, nb) / np.maximum(n, nb), 0, 1).max())
    return total / float(na.sum())


def text_of(digest: np.ndarray) -> str:
    return base64.b64encode(digest.tobytes()).decode()


def of_text(fingerprint: str, params: DigestParams = DigestParams()) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, params.bits // 8)


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), params: DigestParams = DigestParams()) -> DataFrame:
    """Columns ``keep`` and the fingerprint of every row; a null text counts as empty ('')."""
    bounded_batches(docs.sparkSession)
    kept = docs.select(*(docs[c] for c in keep), docs[text].alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), "fingerprint string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = digests([(t or "").encode() for t in batch.column("__text").to_pylist()], params)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array([text_of(d) for d in made], pa.string())], [*keep, "fingerprint"])

    return kept.mapInArrow(lean(run), schema)


def in_order(docs: DataFrame, text: str = "text") -> DataFrame:
    """(part, doc_id, text, guest) in ascending order of doc_id inside each part, whole parts in one task.

    Each part ends with a guest, the first document of the next part (of the last part: the first of all). One pass
    over the texts is shuffled; only part borders, one id for each part, come to the driver.
    """
    spark = docs.sparkSession
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    parts = max(1, 2 * kept.rdd.getNumPartitions())
    cuts = kept.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else []
    edges = np.unique(np.array(cuts or [], dtype=np.float64))

    def place(ids: pa.Array) -> np.ndarray:
        own = np.array([np.nan if d is None else d for d in ids.to_pylist()], dtype=np.float64)
        return np.where(np.isnan(own), 0, np.searchsorted(edges, own, side="right")).astype(np.int32)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(place(batch.column(0))), batch.column(0)], ["part", "doc_id"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(lean(least), "part int, doc_id long")
    firsts = ids.groupBy("part").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("has_null")).orderBy("part").collect()
    used = [r["part"] for r in firsts]
    before = {p: used[i - 1] for i, p in enumerate(used)}
    first_id = {r["part"]: None if r["has_null"] else r["first"] for r in firsts}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = place(batch.column("doc_id"))
            flags = pa.array(np.zeros(len(own), dtype=bool))
            yield pa.RecordBatch.from_arrays([pa.array(own), batch.column("doc_id"), batch.column("__text"), flags], ["part", "doc_id", "__text", "guest"])
            guests = [i for i, (p, d) in enumerate(zip(own.tolist(), batch.column("doc_id").to_pylist(), strict=True)) if first_id[p] == d]
            if guests:
                picked = batch.take(pa.array(guests))
                to = pa.array([before[int(own[i])] for i in guests], pa.int32())
                yield pa.RecordBatch.from_arrays([to, picked.column("doc_id"), picked.column("__text"), pa.array([True] * len(guests))], ["part", "doc_id", "__text", "guest"])

    dealt = kept.mapInArrow(lean(deal), "part int, doc_id long, __text string, guest boolean")
    return dealt.repartitionById(len(edges) + 1, "part").sortWithinPartitions("part", "guest", F.col("doc_id").asc_nulls_first(), "__text")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_neighbours(docs: DataFrame, text: str = "text", params: DigestParams = DigestParams()) -> DataFrame:
    """Each document against its edited text (the last quarter replaced by the head of the next) and against the next.

    Order is by doc_id, null first, equal ids by text; the last is followed by the first, and a single document by
    itself. A null text counts as empty; the likeness of two empty texts is 1, of an empty and another 0. An empty
    table gives an empty one.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row still waits for its next

        def answer(rows: list[tuple]) -> pa.RecordBatch | None:
            own = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if a[0] == b[0] and not a[3]]
            if not own:
                return None
            edited = []
            for a, b in own:
                k = len(a[2]) // 4
                edited.append(a[2][: len(a[2]) - k] + b[2][:k])
            made = digests([*(r[2].encode() for r in rows), *(e.encode() for e in edited)], params)
            at = {id(r): d for r, d in zip(rows, made, strict=False)}
            changed = made[len(rows) :]
            columns = [
                [a[1] for a, _ in own], [len(a[2]) for a, _ in own], [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                [text_of(at[id(a)]) for a, _ in own], [text_of(d) for d in changed],
                [likeness(at[id(a)], d, params) for (a, _), d in zip(own, changed, strict=True)], [likeness(at[id(a)], at[id(b)], params) for a, b in own],
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "__text", "guest")), strict=True):
                # equal first ids make several guests; the first of them is the next one
                if row[3] and held and held[-1][3] and held[-1][0] == row[0]:
                    continue
                held.append(row)
                size += len(row[2])
                if size > 2 << 20 and len(held) > 1:
                    if (out := answer(held)) is not None:
                        yield out
                    held, size = held[-1:], len(row[2])
        if (out := answer(held)) is not None:
            yield out

    return in_order(docs, text).mapInArrow(lean(run), SCHEMA)
