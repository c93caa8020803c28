"""Language-model scores by prediction by partial matching, beside a unigram base.

The model is a trie of byte contexts with the counts of the bytes that follow. A byte is coded in the longest context
known; where it never followed, an escape (estimated from the number of different bytes that did follow, method C) leads
to the next shorter context, whose counts leave out the bytes just excluded; the last resort is an even share of what no
context has excluded.

Counts are taken over all training texts and all of them are used, so the model grows with the corpus. A byte's probability
depends only on the group of it and the bytes before it, so each group of the corpus is scored once, in a table dealt by
group. The scores of frequent groups (``least`` of all training bytes, so at most 1 / least) are sent to every task, the
others are joined to the texts.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Table, Words, bounded_batches, crc_mod, lean, materialize, slices, texts_of

#: Bytes that UTF-8 never has: the end of a text (coded like a byte) and what stands before its beginning.
END, BEGIN = 0xFF, 0xFE


@dataclass(frozen=True)
class PpmParams:
    #: Bytes of the longest context.
    order: int = 5
    #: Share of all training bytes from which a group's score is sent to every task; others are joined.
    least: float = 2.0**-22
    #: Share of all training words from which a word's count is sent to every task; others are joined.
    common_word: float = 2.0**-20
    #: Entries that a counting task holds before it hands them on.
    held: int = 3_000_000


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(order + 1)-byte groups that end at each byte of each text and at its end, the byte coded lowest; and the text of each."""
    if not texts:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    joined = np.frombuffer(b"".join([x for t in texts for x in (t, b"\xff", b"\xfe" * order)]), dtype=np.uint8)
    joined = np.concatenate((np.full(order, BEGIN, np.uint8), joined)).astype(np.uint64)
    n = len(joined) - 2 * order
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    starts = np.concatenate(([0], np.cumsum(lengths + order)[:-1]))
    at = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
    key = np.zeros(n + order, dtype=np.uint64)
    for k in range(order + 1):
        key[:n + order] = (key << np.uint64(8)) | joined[k : k + n + order] if k <= order else key
    return key[at], np.repeat(np.arange(len(texts)), lengths)


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


class Held:
    """Counts by 64-bit key, summed up now and then."""

    def __init__(self, most: int):
        self.most, self.keys, self.counts, self.size = most, [], [], 0

    def add(self, values: np.ndarray) -> bool:
        """Whether it is full."""
        key, count = np.unique(values, return_counts=True)
        self.keys.append(key)
        self.counts.append(count.astype(np.int64))
        self.size += len(key)
        if self.size > self.most:
            key, count = merge_counts(self.keys, self.counts)
            self.keys, self.counts, self.size = [key], [count], len(key)
        return self.size > self.most // 2

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = merge_counts(self.keys, self.counts) if self.keys else (np.empty(0, np.uint64), np.empty(0, np.int64))
        self.keys, self.counts, self.size = [], [], 0
        return out


def count_corpus(docs: DataFrame, text: str, train: str, params: PpmParams) -> DataFrame:
    """(kind, key, n): of kind 0 byte groups of the longest order, of kind 1 words by hash, over all rows where ``train``
    is true. Groups that only other rows have are there with a count of 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # groups and words of training texts, groups of others
        held = (Held(params.held), Held(params.held), Held(params.held))

        def out(which: int) -> Iterator[pa.RecordBatch]:
            key, count = held[which].take()
            kind, count = (0, np.zeros_like(count)) if which == 2 else (which, count)
            for i in range(0, len(key), 100_000):
                k = key[i : i + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(count[i : i + 100_000])], ["kind", "key", "n"])

        for batch in batches:
            texts = [t.lower() for t in texts_of(batch.column("__text"))]
            learned = batch.column("__train").to_pylist()
            for i, j in slices(texts):
                own = [t for t, y in zip(texts[i:j], learned[i:j], strict=True) if y]
                if held[0].add(grams(own, params.order)[0]):
                    yield from out(0)
                if own and held[1].add(Words(own).hashes()):
                    yield from out(1)
                if held[2].add(grams([t for t, y in zip(texts[i:j], learned[i:j], strict=True) if not y], params.order)[0]):
                    yield from out(2)
        for which in range(3):
            yield from out(which)

    counted = docs.select(F.col(text).alias("__text"), F.col(train).alias("__train")).mapInArrow(lean(run), "kind int, key long, n long")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def cut(key: str, length: str) -> F.Column:
    """The last ``length`` bytes."""
    return F.expr(f"CASE WHEN {length} = 8 THEN {key} ELSE {key} & (shiftleft(1L, 8 * ({length})) - 1L) END")


def score_groups(counted: DataFrame, params: PpmParams) -> DataFrame:
    """(key, n, score): log10 of the probability of the last byte of every group of the longest order, given the others."""
    whole = counted.where("kind = 0").select("key", "n")
    same = Window.partitionBy(F.shiftrightunsigned("key", 8))  # at most 256 groups
    known = whole.where("n > 0").select("key", "n", (F.log10("n") - F.log10(F.sum("n").over(same) + F.count(F.lit(1)).over(same))).alias("score"))
    lengths = F.explode(F.sequence(F.lit(1), F.lit(params.order + 1))).alias("length")
    by_length = whole.where("n > 0").select("key", "n", lengths).select("length", cut("key", "length").alias("key"), "n")
    by_length = by_length.groupBy("length", "key").agg(F.sum("n").alias("n")).withColumn("context", F.shiftrightunsigned("key", 8))
    by_length = materialize(by_length, "ppm-groups")
    asked = whole.where("n = 0").select(F.col("key").alias("whole"), lengths).withColumn("key", cut("whole", "length"))
    asked = materialize(asked.withColumn("context", F.shiftrightunsigned("key", 8)), "ppm-asked")
    # of each context that a new group has: what followed, its kinds, and what of these the shorter context knows
    needed = by_length.join(asked.select("length", "context").distinct(), ["length", "context"], "left_semi")
    shorter = by_length.select((F.col("length") + 1).alias("length"), F.col("key").alias("suffix"), F.col("n").alias("seen"))
    needed = needed.withColumn("suffix", F.when(F.col("length") > 1, cut("key", "length - 1"))).join(shorter, ["length", "suffix"], "left")
    contexts = needed.groupBy("length", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum("seen").alias("seen"))
    contexts = materialize(contexts, "ppm-contexts")

    def look_up(rows: DataFrame, table: DataFrame, on: str, most: int) -> DataFrame:
        # of few bytes there are few keys (65,792 of up to two), each with many rows: these go to every task
        short, long = F.col("length") <= most, F.col("length") > most
        sent = rows.where(short).join(F.broadcast(table.where(short)), ["length", on], "left")
        return sent.unionByName(rows.where(long).join(table.where(long), ["length", on], "left"))

    found = look_up(look_up(asked, by_length.drop("context"), "key", 2), contexts, "context", 3)
    names = [(c, k) for k in range(1, params.order + 2) for c in ("n", "total", "kinds", "seen")]
    rows = found.groupBy("whole").agg(*(F.coalesce(F.max(F.when(F.col("length") == k, F.col(c))), F.lit(0)).alias(f"{c}{k}") for c, k in names))
    n_bytes = by_length.where("length = 1").count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = {k: [batch.column(f"{c}{k}").to_numpy().astype(np.float64) for c in ("n", "total", "kinds", "seen")] for k in range(1, params.order + 2)}
            score = fall_back(of, params.order, n_bytes)
            yield pa.RecordBatch.from_arrays([batch.column("whole"), pa.array(np.zeros(len(score), np.int64)), pa.array(score)], ["key", "n", "score"])

    return known.unionByName(rows.mapInArrow(lean(run), "key long, n long, score double"))


def fall_back(of: dict[int, list[np.ndarray]], order: int, n_bytes: int) -> np.ndarray:
    """log10 of the probabilities of groups by their (n, total, kinds, seen) of each length, 0 where a context is unknown."""
    size = len(of[1][0])
    spent, done, start = np.zeros(size), np.zeros(size, bool), np.ones(size, bool)
    seen_before, kinds_before = np.zeros(size), np.zeros(size)
    for k in range(order + 1, 0, -1):
        n, total, kinds, seen = of[k]
        # without what the longer context offered
        bottom = np.maximum(total - seen_before + kinds - kinds_before, 1e-300)
        escaped = np.where(start, kinds, kinds - kinds_before)
        hit, go = ~done & (n > 0), ~done & (n == 0) & (total > 0)
        spent[hit] += np.log10(n[hit]) - np.log10(bottom[hit])
        # with nothing left the escape is certain
        more = go & (escaped > 0)
        spent[more] += np.log10(escaped[more]) - np.log10(bottom[more])
        done |= hit
        start &= total == 0
        seen_before, kinds_before = seen, kinds
    return np.where(done, spent, spent - math.log10(max(256 - n_bytes, 1)))


@dataclass(frozen=True)
class Level:
    """What the model knows of one length: frequent groups (sorted) with counts, and the contexts of these (sorted, without
    the last byte) with the counts and kinds of all bytes that followed, frequent or not."""

    groups: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray


def level_of(groups: np.ndarray, counts: np.ndarray, least: int) -> Level:
    """From all groups of one length, sorted."""
    context = groups >> np.uint64(8)
    first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(groups) else np.empty(0, np.int64)
    totals = np.add.reduceat(counts, first) if len(first) else np.empty(0, np.int64)
    top = np.maximum.reduceat(counts, first) if len(first) else np.empty(0, np.int64)
    kinds = np.diff(np.concatenate((first, [len(groups)])))
    keep = top >= least
    return Level(groups[counts >= least], counts[counts >= least], context[first][keep], totals[keep], kinds[keep])


class PpmModel:
    """The same model in one process, for texts that fit there; with levels cut to frequent groups the rest is escapes.

    ``levels``: of groups of 1, 2, ... bytes.

    For a context c: own[c] = log10(all that followed + kinds of it), escape[c] = log10(what followed rarely + kinds) -
    own[c]. After an escape from c the shorter context leaves out the bytes that c offered: rest[c] and rest_escape[c]
    are the same two numbers of what is left there.
    """

    def __init__(self, levels: list[Level]):
        self.order = len(levels) - 1
        self.groups = [Table(v.groups) for v in levels]
        self.logs = [np.log10(v.counts.astype(np.float64)) for v in levels]
        self.contexts = [Table(v.contexts) for v in levels]
        self.own, self.escape, self.rest, self.rest_escape = [], [], [], []
        tiny = 1e-300
        for k, v in enumerate(levels):
            context = v.groups >> np.uint64(8)
            first = np.searchsorted(context, v.contexts)
            offered = np.diff(np.concatenate((first, [len(v.groups)])))
            sums = np.add.reduceat(v.counts, first) if len(first) else np.empty(0, np.int64)
            self.own.append(np.log10((v.totals + v.kinds).astype(np.float64)))
            rare = v.totals - sums
            self.escape.append(np.log10((rare + v.kinds).astype(np.float64)) - self.own[-1])
            if k:
                above, mask = levels[k - 1], np.uint64((1 << (8 * k)) - 1)
                # a group as frequent as this is as frequent without its first byte
                at = np.searchsorted(above.groups, v.groups & mask)
                seen = np.add.reduceat(above.counts[at], first) if len(first) else np.empty(0, np.int64)
                parent = self.contexts[k - 1].find(v.contexts & np.uint64((1 << (8 * (k - 1))) - 1))
                kinds = above.kinds[parent] - offered
                rest = (above.totals[parent] - seen + kinds).astype(np.float64)
                out = (rare_above[parent] + kinds).astype(np.float64)
                self.rest.append(np.log10(np.maximum(rest, tiny)))
                # with nothing left the escape is certain
                self.rest_escape.append(np.where(out > 0, np.log10(np.maximum(out, tiny)) - np.log10(np.maximum(rest, tiny)), 0.0))
            else:
                self.rest.append(np.zeros(len(v.contexts)))
                self.rest_escape.append(np.zeros(len(v.contexts)))
                self.even = math.log10(256 - len(v.groups))
            rare_above = rare

    def log10_probabilities(self, key: np.ndarray) -> np.ndarray:
        """Of the lowest byte of each key, given the others above it."""
        out = np.empty(len(key))
        todo = np.arange(len(key))
        spent = np.zeros(len(key))  # log10 of the escapes so far
        below = np.full(len(key), -1)  # the context just left, -1: none
        for k in range(self.order, -1, -1):
            now = key[todo] & np.uint64((1 << (8 * (k + 1))) - 1)
            place = self.groups[k].find(now)
            hit = place >= 0
            # a group that is known has a context that is known
            context = self.contexts[k].find(now >> np.uint64(8)) if k else np.full(len(now), 0 if len(self.own[0]) else -1)
            start = below < 0
            bottom = np.where(start, self._at(self.own[k], context), self._at(self.rest[k + 1], below) if k < self.order else 0.0)
            out[todo[hit]] = spent[hit] + self.logs[k][place[hit]] - bottom[hit]
            go = ~hit
            todo, context, start, below, spent = todo[go], context[go], start[go], below[go], spent[go]
            lost = np.where(start, self._at(self.escape[k], context), self._at(self.rest_escape[k + 1], below) if k < self.order else 0.0)
            spent = spent + np.where(context >= 0, lost, 0.0)
            below = np.where(context >= 0, context, -1)
            if not len(todo):
                return out
        out[todo] = spent - self.even
        return out

    @staticmethod
    def _at(values: np.ndarray, index: np.ndarray) -> np.ndarray:
        return values[index] if len(values) else np.zeros(len(index))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 of the probability of each text with its end."""
        key, owner = grams(texts, self.order)
        return np.bincount(owner, self.log10_probabilities(key), minlength=len(texts))


_BUILT: dict[str, tuple] = {}


def built(name: str, sent) -> tuple[Table, np.ndarray, Table, np.ndarray]:
    """The tables of a broadcast model, built once in each worker process."""
    if name not in _BUILT:
        groups, scores, keys, logs = sent.value
        _BUILT.clear()
        _BUILT[name] = Table(groups), scores, Table(keys), logs
    return _BUILT[name]


def look_up(table: Table, values: np.ndarray, keys: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """For each text: the sum of the values of the keys found, their number, and the other keys."""
    place = table.find(keys)
    known = place >= 0
    # of no keys at all bincount gives whole numbers
    sums = np.bincount(owner[known], values[place[known]], minlength=size).astype(np.float64) if len(values) else np.zeros(size)
    cuts = np.searchsorted(owner[~known], np.arange(size + 1)).astype(np.int32)
    return sums, np.bincount(owner[known], minlength=size), pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys[~known].view(np.int64)))


def held_out_column(part: int, of: int) -> F.Column:
    return crc_mod(F.col("doc_id"), of) == part


def score_documents(docs: DataFrame, params: PpmParams = PpmParams(), text: str = "text", part: int = 2, of: int = 7) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Learns from the rows whose crc32(doc_id) mod ``of`` isn't ``part``; A-Z is lower-cased for both models. The base is
    a unigram model of words and an end of text with add-one smoothing. A null text counts as empty: one token, its
    end. Repeated rows count each time, in training too. Without training rows every probability is the even share.
    Words are known by a 64-bit hash.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = docs.select(F.col("doc_id"), F.col(text).alias("__text"))
    train = kept.where(~held_out_column(part, of))
    marked = kept.withColumn("__train", ~held_out_column(part, of))
    counted = materialize(count_corpus(marked, "__text", "__train", params), "ppm-counts")
    sums = counted.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
    by_kind = {r["kind"]: r for r in sums}
    n_bytes = by_kind[0]["n"] if 0 in by_kind else 0
    n_docs = train.count()
    n_tokens = (by_kind[1]["n"] if 1 in by_kind else 0) + n_docs
    n_kinds = (by_kind[1]["kinds"] if 1 in by_kind else 0) + (n_docs > 0)
    base = math.log10(n_tokens + n_kinds + 1)
    groups = materialize(score_groups(counted, params), "ppm-scored")
    least = max(1, math.ceil(n_bytes * params.least))
    # at most 1 / least groups have this share: a proven bound of what comes to the driver
    frequent = groups.where(F.col("n") >= least).select("key", "score").toArrow()
    group_keys, group_scores = frequent.column("key").to_numpy().astype(np.int64).view(np.uint64), frequent.column("score").to_numpy()
    by_key = np.argsort(group_keys)
    words = counted.where("kind = 1").select("key", "n")
    floor = max(2, math.ceil(n_tokens * params.common_word))
    # at most 1 / common_word words have this share: a proven bound
    common = words.where(F.col("n") >= floor).toArrow()
    common_keys, common_counts = common.column("key").to_numpy().astype(np.int64).view(np.uint64), common.column("n").to_numpy()
    order = np.argsort(common_keys)
    sent = spark.sparkContext.broadcast((group_keys[by_key], group_scores[by_key], common_keys[order], np.log10(common_counts[order] + 1.0) - base))
    name = uuid.uuid4().hex
    end_score = math.log10((n_docs or 0) + 1) - base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, scores, table, logs = built(name, sent)
        for batch in batches:
            texts = [t.lower() for t in texts_of(batch.column("__text"))]
            for i, j in slices(texts, SLICE_BYTES // 2):
                words = Words(texts[i:j])
                sums, n_known, rare = look_up(table, logs, words.hashes(), words.doc, j - i)
                scored, _, rare_groups = look_up(groups, scores, *grams(texts[i:j], params.order), j - i)
                out = [pa.array(words.counts + 1), pa.array(n_known), pa.array(sums), pa.array(scored), rare, rare_groups]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *out], ["doc_id", "n_tokens", "n_known", "part_score", "group_score", "rare", "rare_groups"])

    id_type = kept.schema["doc_id"].dataType.simpleString()
    scored = kept.mapInArrow(lean(run), f"doc_id {id_type}, n_tokens long, n_known long, part_score double, group_score double, rare array<long>, rare_groups array<long>")
    scored = materialize(scored.withColumn("row_id", F.monotonically_increasing_id()), "ppm-scores")
    # no key here is frequent; the table of a partition is small, so the many rows needn't be sorted
    others = groups.where(F.col("n") < least).select("key", "score").hint("shuffle_hash")
    rest = scored.select("row_id", F.explode("rare_groups").alias("key")).join(others, "key")
    rest = rest.groupBy("row_id").agg(F.sum("score").alias("rest"))
    rare = scored.select("row_id", F.explode("rare").alias("key")).join(words.where(F.col("n") < floor), "key", "left")
    found = rare.groupBy("row_id").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1) - F.lit(base)).alias("more"), F.count("n").alias("known"))
    joined = scored.drop("rare", "rare_groups").join(found, "row_id", "left").join(rest, "row_id", "left")
    return joined.select(
        "doc_id", held_out_column(part, of).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0)) + F.lit(int(n_docs > 0))).alias("n_known"), F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("part_score") + F.coalesce("more", F.lit(0.0)) + F.lit(end_score)).alias("base_score"),
        (F.col("group_score") + F.coalesce("rest", F.lit(0.0))).alias("score"),
    )
