"""Toxicity by a weighted lexicon.

Texts are folded (case, look-alike letters, digits and signs that stand for letters), matched in one pass by an
Aho-Corasick automaton of word beginnings and words, freed of what stands inside an exception phrase, and the sum of
the weights, also in proportion to length, goes through a logistic function. Lexicon, weights, exceptions and the
logistic function are learned from labelled rows; entries can be given as well.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, crc_mod, lean, materialize, slices, smallest_hashes, texts_of

# Letters of other scripts and signs that look like a Latin letter.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "з": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɩ": "i", "ɡ": "g", "ℓ": "l",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
}
FOLD = {c: " " for c in range(128) if not chr(c).isalnum()}
FOLD |= {ord(k): v for k, v in LOOKALIKES.items()}
FOLD |= {c: " " for c in range(0x2000, 0x2070) if c not in (0x200B, 0x200C, 0x200D, 0x2060)}
FOLD |= {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
FOLD |= {0xFF01 + k: FOLD.get(0x21 + k, chr(0x21 + k).lower()) for k in range(94)}


def fold(text: str) -> str:
    """Lower case, look-alikes and digits as letters, punctuation as spaces, a space at both ends."""
    # signs at the end of a word ("stop!") close it; inside or before it they stand for letters
    return f" {text.lower().translate(FOLD)} "


@dataclass(frozen=True)
class ToxicityParams:
    #: The classifier is fitted on at most this many labelled ids, those of the smallest hashes.
    fit_rows: int = 30_000
    shortest: int = 4
    longest: int = 9
    #: An entry is in so many different toxic texts, and either in this share of them or in more than chance explains:
    #: texts labelled at random would have it in toxic ones only with a probability below exp(-min_evidence).
    min_rows: int = 4
    min_share: float = 0.02
    min_evidence: float = 14.0
    #: Least log odds ratio of an entry.
    min_weight: float = 2.5
    #: Bounds of the lexicon: learned entries, those of the greatest weight and number; learned exceptions, the most frequent.
    max_entries: int = 5_000
    max_exceptions: int = 5_000
    threshold: float = 0.7
    #: Entries and exceptions besides the learned ones.
    entries: tuple[tuple[str, float], ...] = ()
    exceptions: tuple[str, ...] = ("clown fish", "trash can", "trash bin")


@dataclass
class Lexicon:
    """weights: by pattern, which begins with a space and ends with one if it is a whole word."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    #: Of the logistic function: for 1, log(1 + sum), sum / sqrt(words), entries found.
    logistic: tuple[float, ...] = (-4.0, 2.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        built = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            built.add_word(pattern, (len(pattern), weight, pattern))
        for phrase in self.exceptions:
            built.add_word(phrase, (len(phrase), None, phrase))
        if len(built):
            built.make_automaton()
        return built


def matches(folded: str, built: ahocorasick.Automaton) -> list[tuple[int, int, float, str]]:
    """(start, end, weight, entry) of the entries found outside exception phrases; of those that begin at one place, the longest."""
    if not len(built):
        return []
    found: dict[int, tuple[int, int, float, str]] = {}
    spared: list[tuple[int, int]] = []
    for end, (n, weight, pattern) in built.iter(folded):
        start = end + 1 - n
        if weight is None:
            spared.append((start, end))
        elif start not in found or found[start][1] < end:
            found[start] = (start, end, weight, pattern)
    if not spared:
        return list(found.values())
    spared.sort()
    starts, furthest = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))

    def inside(m: tuple[int, int, float, str]) -> bool:
        before = bisect_right(starts, m[0])
        return before > 0 and furthest[before - 1] >= m[0] + len(m[3].rstrip()) - 1

    return [m for m in found.values() if not inside(m)]


def features(text: str, built: ahocorasick.Automaton) -> tuple[float, float, float, float]:
    folded = fold(text)
    return measures(matches(folded, built), folded)


def measures(found: list[tuple[int, int, float, str]], folded: str) -> tuple[float, float, float, float]:
    """1, log(1 + sum), sum / sqrt(words) and the number of entries; an entry's further places add less and less."""
    weights = {m[3]: m[2] for m in found}
    counts = Counter(m[3] for m in found)
    total = sum(w * (1 + math.log(counts[e])) for e, w in weights.items())
    return 1.0, math.log1p(max(total, 0.0)), total / math.sqrt(1 + folded.count(" ")), float(len(weights))


def squash(weights: tuple[float, ...], x: tuple[float, ...]) -> float:
    z = sum(w * v for w, v in zip(weights, x, strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def terms(text: str, params: ToxicityParams) -> set[str]:
    """Candidate entries of a text: the beginnings of its words, and its words."""
    found = set()
    for word in set(fold(text).split()):
        for n in range(params.shortest, min(params.longest, len(word)) + 1):
            found.add(f" {word[:n]}")
        if 3 <= len(word) <= 24:
            found.add(f" {word} ")
    return found


def evidence(toxic: int, clean: int, rate: float) -> float:
    """-log of Chernoff's bound of the chance that so many of toxic + clean texts are toxic, where ``rate`` of all are."""
    n = toxic + clean
    if not 0 < rate < 1 or toxic <= rate * n:
        return 0.0
    return toxic * math.log(toxic / n / rate) + (clean * math.log(clean / n / (1 - rate)) if clean else 0.0)


def choose(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int, params: ToxicityParams) -> Lexicon:
    """counts: (term, toxic texts, clean texts). A longer entry is taken only where no shorter one says as much."""
    odds = {t: math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1)) for t, a, b in counts}
    rows = {t: (a, b) for t, a, b in counts}
    common, rate = math.ceil(params.min_share * n_toxic), n_toxic / max(n_toxic + n_clean, 1)
    sure = [t for t, (a, b) in rows.items() if a >= params.min_rows and (a >= common or evidence(a, b, rate) >= params.min_evidence)]
    strong = [t for t in sure if odds[t] >= params.min_weight and rows[t][0] > 2 * rows[t][1]]
    strong.sort(key=lambda t: (len(t), t))
    taken: dict[str, float] = {}
    for t in strong:
        stem = next((t[:n] for n in range(params.shortest + 1, len(t)) if t[:n] in taken), None)
        if stem is None or odds[t] > taken[stem] + 1.0 and rows[t][0] > 0.5 * rows[stem][0]:
            taken[t] = odds[t]
    taken = dict(sorted(taken.items(), key=lambda x: (-x[1] * math.sqrt(rows[x[0]][0]), x[0]))[: params.max_entries])
    stems = tuple(t for t in taken if not t.endswith(" "))
    spared = sorted(t for t in odds if t.endswith(" ") and t.startswith(stems) and rows[t][1] >= 3 and odds[t] < 0) if stems else []
    for word, weight in params.entries:
        taken[f" {fold(word).strip()} "] = weight
    return Lexicon(taken, [*spared, *(fold(p) for p in params.exceptions)])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """The greatest likelihood less a ridge, which keeps separable data finite. Newton's steps are halved until they gain, so
    that they can't run away where the data are nearly separable."""
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[0] = 1e-3

    def value(w: np.ndarray) -> float:
        z = x @ w
        return float(y @ z - np.logaddexp(0.0, z).sum() - 0.5 * pull @ (w * w))

    now = value(w)
    for _ in range(200):
        p = 0.5 * (1.0 + np.tanh(0.5 * (x @ w)))
        gradient = x.T @ (y - p) - pull * w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(pull), gradient)
        part = 1.0
        while part > 1e-12 and value(w + part * step) < now + 1e-4 * part * float(gradient @ step):
            part /= 2
        if part <= 1e-12 or np.abs(part * step).max() < 1e-9:
            break
        w = w + part * step
        now = value(w)
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> Lexicon:
    """From rows of ``labels`` (doc_id, toxic) whose crc32(doc_id) mod 3 isn't 1. Without any, a lexicon of the given entries."""
    spark = docs.sparkSession
    bounded_batches(spark)
    train = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), 3) != 1))
    train = train.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__y"))
    train = smallest_hashes(train, "doc_id", train.count(), params.fit_rows)
    sample = docs.select("doc_id", F.col("text").alias("__text")).join(F.broadcast(train), "doc_id").select("__y", "__text")
    sample = materialize(sample, "toxicity")
    # copies of one text count once, so they don't make an entry
    same = F.md5(F.trim(F.regexp_replace(F.lower(F.coalesce("__text", F.lit(""))), r"\s+", " ")))
    once = sample.withColumn("__same", same).dropDuplicates(["__y", "__same"]).drop("__same")
    sizes = {bool(r["__y"]): r["n"] for r in once.groupBy((F.col("__y") == 1).alias("__y")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())
        for batch in batches:
            for y, text in zip(batch.column("__y").to_pylist(), texts_of(batch.column("__text")), strict=True):
                held[y == 1].update(terms(text.decode(), params))
                if len(held[0]) + len(held[1]) > 500_000:
                    yield pack(held)
        yield pack(held)

    def pack(held: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(held[0].keys() | held[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([held[1][t] for t in names], pa.int64()), pa.array([held[0][t] for t in names], pa.int64())], ["term", "toxic", "clean"]
        )
        held[0].clear()
        held[1].clear()
        return out

    counts = once.mapInArrow(lean(count), "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    strong = (F.col("toxic") >= params.min_rows) & (F.col("toxic") > 2 * F.col("clean")) & (F.col("odds") >= params.min_weight - 1e-6)
    weak = (F.col("clean") >= 3) & F.col("term").endswith(" ") & (F.col("odds") < 0)
    counts = materialize(counts.withColumn("odds", odds).where(strong | weak), "toxicity-terms")
    # what comes to the driver is bounded by the fitted rows, and by the bounds of the lexicon
    order = F.col("toxic").desc(), "term"
    lexicon = choose([tuple(r) for r in counts.where(strong).orderBy(*order).select("term", "toxic", "clean").limit(20 * params.max_entries).collect()], n_toxic, n_clean, params)
    stems: dict[int, list[str]] = {}
    for t in sorted(t for t in lexicon.weights if not t.endswith(" ")):
        stems.setdefault(len(t), []).append(t)
    if stems:
        begins = F.lit(False)
        for n, some in stems.items():
            begins |= F.substring("term", 1, n).isin(some)
        near = counts.where(weak & begins).orderBy(F.col("clean").desc(), "term").select("term").limit(params.max_exceptions)
        lexicon.exceptions += sorted(r["term"] for r in near.collect())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = lexicon.automaton()
        for batch in batches:
            rows = np.array([features(t.decode(), built) for t in texts_of(batch.column("__text"))]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("__y"), pa.int32()), *(pa.array(rows[:, k]) for k in range(4))], ["y", "a", "b", "c", "d"])

    rows = np.array(sample.mapInArrow(lean(measure), "y int, a double, b double, c double, d double").collect(), dtype=float).reshape(-1, 5)
    if len(rows) and 0 < rows[:, 0].sum() < len(rows):
        lexicon.logistic = fit_logistic(rows[:, 1:], rows[:, 0])
    return lexicon


SCHEMA = "score double, predicted int, n_matches long, entries array<string>"


def score(docs: DataFrame, lexicon: Lexicon, keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.7, text: str = "text") -> DataFrame:
    """Columns ``keep``, score, predicted, n_matches and the entries found, for every row. A null text counts as empty."""
    bounded_batches(docs.sparkSession)
    kept = docs.select(*(docs[c] for c in keep), docs[text].alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), SCHEMA])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = lexicon.automaton()
        for batch in batches:
            texts = texts_of(batch.column("__text"))
            for i, j in slices(texts):
                scores, numbers, entries = [], [], []
                for t in texts[i:j]:
                    found = matches(folded := fold(t.decode()), built)
                    scores.append(squash(lexicon.logistic, measures(found, folded)))
                    numbers.append(len(found))
                    entries.append(sorted({m[3].strip() for m in found}))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(numbers, pa.int64()), pa.array(entries, pa.list_(pa.string()))],
                    [*keep, "score", "predicted", "n_matches", "entries"],
                )

    return kept.mapInArrow(lean(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """doc_id, held_out, score, predicted, n_matches, entries for every row of ``docs``; learns from ``labels``.

    Repeated rows get equal scores, a null or empty text the score of a text without matches, an empty table an empty
    result. Of repeated labels of one id the toxic one counts; labels without a value are left out.
    """
    out = score(docs, learn(docs, labels, params), threshold=params.threshold)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted", "n_matches", "entries")


def drop_toxic(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns, whatever the names of extra ones.

    A null or empty text counts as one without matches; repeated rows stay or go together; an empty table gives an empty
    one. Without labels of both kinds the lexicon has the given entries only.
    """
    lexicon = learn(docs, labels, params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = lexicon.automaton()
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for i, j in slices(texts):
                good = [squash(lexicon.logistic, features(t.decode(), built)) < params.threshold for t in texts[i:j]]
                yield batch.slice(i, j - i).filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)
