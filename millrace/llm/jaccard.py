"""N-gram Jaccard join by chosen paths.

Texts are sets of word 5-grams, embedded as MinHash tokens (two sets share a token with the probability of their
Jaccard similarity). A run starts with all sets in one node; each node picks some of the token places at random and
sends its sets to one child for each value found there. Buckets of one set end, small ones are compared by brute
force, large ones first lose whole groups of mutually similar sets and split further. Runs have random places of their
own; their number follows from the recall asked for. What shared a bucket and looks alike by its tokens forms
candidate groups, inside which every pair is verified on the exact sets.

A bucket larger than a task is dealt in blocks, each with the same pivot set. If nearly all of its sets are in the
pivot's group, the rest is compared with every block, and the bucket is done; otherwise all its sets go on to the
children. On the last level what is still larger is compared block with block. No bucket is ever cut.

Exact copies are one set throughout, and neither pairs nor copies are ever written out: a group of n texts costs n
rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, bounded_batches, lean, materialize, mix, slices, texts_of


@dataclass(frozen=True)
class JoinParams:
    words: int = 5
    threshold: float = 0.8
    #: Chance that a pair at the threshold is found by some run.
    recall: float = 0.999_999
    #: MinHash tokens of a set, how many of their places a run picks at its start, and how many each node below; sets
    #: that share a third of their members then don't multiply from node to node.
    tokens: int = 128
    picks: int = 5
    picks_below: int = 3
    #: Buckets up to this size are compared as they are; larger ones split, at most so many times.
    small: int = 1_024
    depth: int = 4
    #: Least share of equal tokens (by one byte of each) of a candidate pair: a pair at the threshold of 0.8 has less
    #: than that once in two million times.
    alike: float = 0.62
    #: Larger buckets are dealt in blocks: of half as many sets, of a 512th of the bucket if that is more (but ``widest`` at most).
    held: int = 2_048
    widest: int = 16_384
    #: A bucket is done if its sets outside the pivot's group are at most so many blocks' worth.
    rest_blocks: int = 4
    #: Sets of a block where the last level compares block with block.
    last_block: int = 8_192
    #: Texts and characters of a block in which pairs are verified.
    block: int = 1_024
    block_chars: int = 32 << 20
    #: Candidates (rows of a few numbers) up to this number are sent to every task, more are joined by a shuffle.
    broadcast_rows: int = 200_000
    #: Such small tables are written by tasks of this many rows instead of one for each partition.
    task_rows: int = 10_000

    @property
    def runs(self) -> int:
        """Runs until the chance that all of them lose a pair, on paths of any length, is below 1 - recall."""
        lost = 0.0
        for _ in range(100):  # a pair gets lost below a node if in each picked place it parts, or gets lost below that child
            lost = (1 - self.threshold * (1 - lost)) ** self.picks_below
        lost = (1 - self.threshold * (1 - lost)) ** self.picks
        return math.ceil(math.log(1 - self.recall) / math.log(lost))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all word k-grams; a text of fewer words, but some, has one of all its words."""
    hashes = words.hashes()
    at, value = words.windows(hashes, k)
    owner = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        own = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            have = words.counts[short] > j
            own[have] = own[have] * np.uint64(0xD6E8FEB86659FD93) + hashes[words.first[short[have]] + j]
        owner, value = np.concatenate((owner, short)), np.concatenate((value, mix(own + np.uint64(k))))
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], value[order]
    return owner, value


def minhash(owner: np.ndarray, value: np.ndarray, n: int, tokens: int) -> np.ndarray:
    """Tokens (uint32) of n sets given as (set, hash) in the order of sets; a set without members has ones only."""
    out = np.full((n, tokens), 0xFFFFFFFF, dtype=np.uint32)
    if not len(owner):
        return out
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    sets = owner[first]
    low, high = value.astype(np.uint32), (value >> np.uint64(32)).astype(np.uint32)
    seeds = mix(np.arange(1, 2 * tokens + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)
    for t in range(tokens):
        h = (low ^ seeds[2 * t]) * (seeds[2 * t + 1] | np.uint32(1)) + high
        out[sets, t] = np.minimum.reduceat(h, first)
    return out


def children(node: np.ndarray, tokens: np.ndarray, picks: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) for sets in nodes: one child for each different place that a node picks, by the set's token there."""
    n, rows, out = len(node), [], []
    taken = np.zeros(tokens.shape, dtype=bool)
    every = np.arange(n)
    for t in range(picks):
        place = (mix(node + np.uint64((t + 1) * 0xA24BAED4963EE407 % 2**64)) % np.uint64(tokens.shape[1])).astype(np.int64)
        while (again := taken[every, place]).any():
            place = np.where(again, (place + 1) % tokens.shape[1], place)
        taken[every, place] = True
        rows.append(every)
        out.append(mix(mix(node ^ place.astype(np.uint64)) ^ (tokens[every, place].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))))
    return np.concatenate(rows), np.concatenate(out)


def alike_groups(sketch: np.ndarray, params: JoinParams, budget: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
    """Connected groups of sets whose sketches agree enough: (root of each set or -1, whether its group is complete).

    Each set found is compared only with sets not found yet, so a group of similar sets costs little. With a budget
    (comparisons), sets not reached stay at -1.
    """
    n = len(sketch)
    least = params.alike * sketch.shape[1]
    root = np.full(n, -1)
    free = np.arange(n)
    while len(free) and budget > 0:
        seed, free = free[0], free[1:]
        root[seed] = seed
        front = [seed]
        while front and len(free):
            x = front.pop()
            budget -= len(free)
            near = (sketch[free] == sketch[x]).sum(1) >= least
            if near.any():
                hit = free[near]
                root[hit] = seed
                front.extend(hit.tolist())
                free = free[~near]
    return root, root >= 0


def group_of(sketch: np.ndarray, seed: int, params: JoinParams, budget: float) -> np.ndarray:
    """Which sets are connected with the seed; some may be left out when the budget (comparisons) is spent."""
    least = params.alike * sketch.shape[1]
    inside = np.zeros(len(sketch), dtype=bool)
    inside[seed] = True
    free = np.flatnonzero(~inside)
    front = [seed]
    while front and len(free) and budget > 0:
        budget -= len(free)
        near = (sketch[free] == sketch[front.pop()]).sum(1) >= least
        inside[free[near]] = True
        front.extend(free[near].tolist())
        free = free[~near]
    return inside


def runs_of(batches: Iterator[pa.RecordBatch], key: str, names: list[str]) -> Iterator[tuple[int, list]]:
    """Rows of equal key that follow one another, as lists of the named columns."""
    last, held = None, None
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        columns = [batch.column(c).to_pylist() for c in names]
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else [0]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held is not None and keys[a] != last:
                yield last, held
                held = None
            last = keys[a]
            part = [c[a:b] for c in columns]
            if held is None:
                held = part
            else:
                for x, y in zip(held, part, strict=True):
                    x.extend(y)
    if held is not None:
        yield last, held


def gathered(df: DataFrame, rows: int, params: JoinParams) -> DataFrame:
    """A table of about so many small rows in few partitions if it is small: each file of a written table has its price."""
    return df.coalesce(-(-rows // params.task_rows) or 1) if rows <= params.broadcast_rows else df


def connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, root) of all ends of the links (a, b) of a task."""
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if not held:
        return
    ends = np.concatenate([x for x, _ in held] + [y for _, y in held])
    names, place = np.unique(ends, return_inverse=True)
    a, b = place[: len(place) // 2], place[len(place) // 2 :]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[a], root[b])
        was = root.copy()
        np.minimum.at(root, was[a], least)
        np.minimum.at(root, was[b], least)
        root = root[root]
        if (root == was).all():
            break
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[root])], ["a", "root"])


def components(edges: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """(a, root) for every end of ``edges`` (a, b): the least number that it is connected with.

    Up to broadcast_rows links are joined up in one task. Of more, labels go to neighbours and jump to their own label's
    label; rounds grow with the logarithm of a path's length.
    """
    links = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if links.count() <= params.broadcast_rows:
        return materialize(links.coalesce(1).mapInArrow(lean(connected), "a long, root long"), "labels")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(near, "a").select("a", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        jump = step.select(F.col("a").alias("root"), F.col("root").alias("further"))
        step = step.join(jump, "root", "left").select("a", F.least("root", F.coalesce("further", "root")).alias("root"), "was")
        step = materialize(step, "labels")
        labels = step.select("a", "root")
        if step.where("root <> was").isEmpty():
            return labels


def with_key(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text")).withColumn("text_key", F.unhex(F.md5("__text")))


def embed(docs: DataFrame, params: JoinParams) -> DataFrame:
    """(doc_id, text_key, chars, tokens) of every row; tokens is null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("__text"))
            for i, j in slices(texts):
                words = Words(texts[i:j])
                owner, value = shingles(words, params.words)
                made = minhash(owner, value, j - i, params.tokens)
                tokens = pa.array([made[k].tobytes() if words.counts[k] else None for k in range(j - i)], pa.binary())
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(words.lengths), tokens], ["doc_id", "text_key", "chars", "tokens"])

    return docs.mapInArrow(lean(run), "doc_id long, text_key binary, chars long, tokens binary")


def tokens_array(column: pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, n)


def buckets(rows: DataFrame) -> DataFrame:
    """(node, n, sign, low): size and members' checksum of every node with at least two sets, from (unit, node)."""
    return rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("unit")).alias("sign"), F.min("unit").alias("low")).where("n > 1")


def candidate_edges(units: DataFrame, params: JoinParams) -> DataFrame:
    """(a, b): stars of sets that shared a bucket and look alike, from ``units`` (unit, tokens)."""
    spark = units.sparkSession
    roots = mix(np.arange(1, params.runs + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, unit = tokens_array(batch.column("tokens"), params.tokens), batch.column("unit").to_numpy()
            for root in roots:
                row, child = children(np.full(len(unit), root), tokens, params.picks)
                yield pa.RecordBatch.from_arrays([pa.array(unit[row]), pa.array(child.view(np.int64))], ["unit", "node"])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, unit = tokens_array(batch.column("tokens"), params.tokens), batch.column("unit").to_numpy()
            node = batch.column("node").to_numpy().view(np.uint64)
            row, child = children(node, tokens, params.picks_below)
            yield pa.RecordBatch.from_arrays([pa.array(unit[row]), pa.array(child.view(np.int64))], ["unit", "node"])

    def compare(whole: bool):
        """Buckets (whole: without a budget), and blocks of split ones, as rows (a, b, kind): links, or sets and nodes."""

        def answer(unit: np.ndarray, own: np.ndarray, node: int, split: bool, pivot: list[bool]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
            if split:
                at = pivot.index(True)
                inside = group_of(own, at, params, 32.0 * len(unit))
                others = np.arange(len(unit)) != at
                for kind, chosen in ((LINK, inside & others), (WITH_PIVOT, inside & others), (REST, ~inside)):
                    yield unit[chosen], np.full(int(chosen.sum()), unit[at] if kind == LINK else node), kind
                return
            all_pairs = whole or len(unit) <= params.small
            root, reached = alike_groups(own, params, math.inf if all_pairs else 32.0 * len(unit))
            joined = np.flatnonzero(reached & (root != np.arange(len(unit))))
            yield unit[joined], unit[root[joined]], LINK
            if not all_pairs:
                yield unit[~reached], np.full(int((~reached).sum()), node), OPEN

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[list[np.ndarray]] = [[], [], []]
            size = 0

            def out() -> pa.RecordBatch:
                columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in held]
                for x in held:
                    x.clear()
                return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], pa.int32())], ["a", "b", "kind"])

            for _, (unit, sketch, node, split, pivot) in runs_of(batches, "deal", ["unit", "sketch", "node", "split", "pivot"]):
                if len(unit) < 2 and not split[0]:
                    continue
                unit = np.array(unit, dtype=np.int64)
                own = np.frombuffer(b"".join(sketch), dtype=np.uint8).reshape(len(unit), -1)
                for x, y, kind in answer(unit, own, node[0], split[0], pivot):
                    held[0].append(x)
                    held[1].append(y)
                    held[2].append(np.full(len(x), kind))
                    size += len(x)
                if size > 50_000:
                    yield out()
                    size = 0
            yield out()

        return run

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = tokens_array(batch.column("tokens"), params.tokens)
            made = np.ascontiguousarray((tokens >> np.uint32(24)) ^ (tokens >> np.uint32(9)), dtype=np.uint32).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("unit"), pa.array([r.tobytes() for r in made], pa.binary())], ["unit", "sketch"])

    sketched = units.mapInArrow(lean(sketches), "unit long, sketch binary")
    plain = (F.lit(False).alias("split"), F.lit(False).alias("pivot"))

    def compared(dealt: DataFrame, n: int, whole: bool) -> DataFrame:
        few = n <= params.broadcast_rows
        ready = (F.broadcast(dealt) if few else dealt).join(sketched, "unit").repartition("deal").sortWithinPartitions("deal", "unit")
        return materialize(gathered(ready.mapInArrow(lean(compare(whole)), "a long, b long, kind int"), n, params), "compared")

    rows = units.mapInArrow(lean(start), "unit long, node long")
    found = []
    n_left = None
    for level in range(params.depth + 1):
        if n_left is None:
            rows = materialize(rows, "nodes")
            n_rows = rows.count()
        else:
            n_rows = params.picks_below * n_left
            rows = materialize(gathered(rows, n_rows, params), "nodes")
        sizes = materialize(gathered(buckets(rows), n_rows, params), "buckets")
        # buckets of the same sets count once
        kept = sizes.groupBy("n", "sign", "low").agg(F.min("node").alias("node"))
        kept = kept.select("node", "n", "low", blocks_of(F.col("n"), params).alias("blocks"))
        dealt = rows.join(kept, "node")
        if level == params.depth:
            n_pairs = kept.agg(F.coalesce(F.sum(F.col("n") * F.ceil(F.col("n") / params.last_block)), F.lit(0))).first()[0]
            found.append(compared(block_pairs(dealt, params).select("unit", "deal", "node", *plain), n_pairs, True).where(F.col("kind") == LINK).select("a", "b"))
            break
        totals = kept.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("blocks") > 1).alias("split")).first()
        own = F.when(F.col("blocks") == 1, F.col("node")).otherwise(block_key(F.col("node"), own_block(F.col("unit"), F.col("blocks"))))
        split = F.col("blocks") > 1
        dealt = dealt.where(~split | (F.col("unit") != F.col("low"))).select("unit", own.alias("deal"), "node", split.alias("split"), F.lit(False).alias("pivot"))
        if totals["split"]:
            every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
            pivots = kept.where(split).select(F.col("low").alias("unit"), "node", every)
            dealt = dealt.union(pivots.select("unit", block_key(F.col("node"), F.col("block")), "node", F.lit(True), F.lit(True)))
        edges = compared(dealt, totals["n"], False)
        found.append(edges.where(F.col("kind") == LINK).select("a", "b"))
        left = edges.where(F.col("kind") == OPEN).select(F.col("a").alias("unit"), F.col("b").alias("node"))
        if totals["split"]:
            member = edges.where(F.col("kind").isin(WITH_PIVOT, REST)).select(F.col("a").alias("unit"), F.col("b").alias("node"), (F.col("kind") == REST).alias("rest"))
            rest = member.groupBy("node").agg(F.count_if("rest").alias("n_rest"))
            ended = kept.join(rest, "node").withColumn("done", F.col("n_rest") * F.col("blocks") <= params.rest_blocks * F.col("n"))
            ended = materialize(gathered(ended.select("node", "low", "blocks", "done"), totals["split"], params), "ended")
            member = member.join(ended, "node")
            # a bucket that is done: its pivot's group block by block, each with all of the rest
            block = F.explode(F.when(F.col("rest"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own_block(F.col("unit"), F.col("blocks")))))
            last = member.where("done").select("unit", "node", block.alias("block"))
            last = last.select("unit", block_key(F.col("node"), F.col("block")).alias("deal"), "node", *plain)
            # the rest is at most rest_blocks blocks of each bucket, in every block of it
            found.append(compared(last, (1 + params.rest_blocks) * totals["n"], True).where(F.col("kind") == LINK).select("a", "b"))
            going = ended.where("not done")
            left = left.union(member.where("not done").select("unit", "node")).union(going.select(F.col("low").alias("unit"), "node"))
        n_left = left.count()
        if not n_left:
            break
        rows = (F.broadcast(left) if n_left <= params.broadcast_rows else left).join(units, "unit").select("unit", "node", "tokens").mapInArrow(lean(descend), "unit long, node long")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


#: What a row of a comparison says: two linked sets, a set that goes on, one of the pivot's group, one outside it.
LINK, OPEN, WITH_PIVOT, REST = range(4)


def blocks_of(n: F.Column, params: JoinParams) -> F.Column:
    """Blocks in which a bucket of n sets is dealt; 1 if it isn't."""
    block = F.least(F.greatest(F.lit(params.held // 2), F.ceil(n / 512)), F.lit(params.widest))
    return F.when(n > params.held, F.ceil(n / block)).otherwise(F.lit(1)).cast("int")


def own_block(unit: F.Column, blocks: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(unit), blocks).cast("int")


def block_key(node: F.Column, *blocks: F.Column) -> F.Column:
    return F.xxhash64(node, *blocks)


def block_pairs(dealt: DataFrame, params: JoinParams) -> DataFrame:
    """(unit, node, deal): each set with those of every block of its bucket, its own included."""
    blocks = F.ceil(F.col("n") / params.last_block).cast("int")
    pairs = dealt.select("unit", "node", blocks.alias("blocks"))
    pairs = pairs.withColumn("own", own_block(F.col("unit"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = block_key(F.col("node"), F.least("own", "other"), F.greatest("own", "other"))
    return pairs.select("unit", "node", F.when(F.col("blocks") == 1, F.col("node")).otherwise(key).alias("deal"))


def set_of(text: bytes, k: int) -> np.ndarray:
    return np.unique(shingles(Words([text]), k)[1])


def sets_of(texts: list[bytes], k: int) -> list[np.ndarray]:
    out = []
    for i, j in slices(texts):
        owner, value = shingles(Words(texts[i:j]), k)
        cuts = np.searchsorted(owner, np.arange(j - i + 1))
        out += [np.unique(value[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return out


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Matrix of the pairs whose exact Jaccard similarity reaches the threshold (no set with itself)."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    names, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes.astype(np.int64))
    often = count[place] > 1
    column = (np.cumsum(count > 1) - 1)[place[often]]
    owner = owner[often]
    common = np.zeros((n, n), dtype=np.float32)
    wide = max(1, min(int((count > 1).sum()), (8 << 20) // n))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    edges = np.searchsorted(column, np.arange(0, int((count > 1).sum()) + wide, wide))
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        dense = np.zeros((n, wide), dtype=np.float32)
        dense[owner[a:b], column[a:b] - k * wide] = 1
        common += dense @ dense.T
    out = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-6
    out &= (sizes[:, None] > 0) & (sizes[None, :] > 0)
    np.fill_diagonal(out, False)
    return out


def least_of_group(links: np.ndarray) -> np.ndarray:
    """Least place of each place's connected group."""
    n = len(links)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] < 0:
            root[i] = i
            front = [i]
            while front:
                near = np.flatnonzero(links[front.pop()] & (root < 0))
                root[near] = i
                front.extend(near.tolist())
    return root


def verify(texts: DataFrame, params: JoinParams) -> DataFrame:
    """(unit, n_links, root, final) from (task, blocks, own, unit, __text), sorted by task: exact links by pairs inside a
    task; of a task on two blocks, those between the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (unit, own, two, blocks, text) in runs_of(batches, "task", ["unit", "own", "two", "blocks", "__text"]):
            unit = np.array(unit, dtype=np.int64)
            first = np.unique(unit, return_index=True)[1]  # repeated rows of one id and text
            sets = sets_of([(text[i] or "").encode() for i in first], params.words)
            links = linked(sets, params.threshold)
            side = np.array(own)[first]
            if two[0]:
                links &= side[:, None] != side[None, :]
            root = unit[first][least_of_group(links)]
            final = np.full(len(first), blocks[0] == 1)
            yield pa.RecordBatch.from_arrays([pa.array(unit[first]), pa.array(links.sum(1).astype(np.int64)), pa.array(root), pa.array(final)], ["unit", "n_links", "root", "final"])

    return texts.mapInArrow(lean(run), "unit long, n_links long, root long, final boolean")


def classes(docs: DataFrame, params: JoinParams = JoinParams(), text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, texts): doc_id and text_key of every row; class_id, n_links and n_copies of every text_key, and the id and
    text that stay if one row of its class is to (the least id, of equals the least text; null last)."""
    bounded_batches(docs.sparkSession)
    keyed = with_key(docs, text)
    rows = materialize(embed(keyed, params), "sets")
    grouped = rows.groupBy("text_key").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n_copies"), F.first("chars").alias("chars"), F.first("tokens").alias("tokens"))
    units = materialize(grouped.withColumn("unit", F.monotonically_increasing_id()), "units")
    named = units.select("unit", "text_key", "first_doc", "chars")
    edges = candidate_edges(units.where("tokens is not null").select("unit", "tokens"), params)
    groups = components(edges, params)
    sizes = groups.join(named.select(F.col("unit").alias("a"), "chars"), "a").groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    sizes = sizes.select("root", F.greatest(F.lit(1), F.ceil(F.greatest(F.col("n") / params.block, F.col("chars") / params.block_chars))).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int")
    wanted = groups.select(F.col("a").alias("unit"), "root").join(sizes, "root").join(named.drop("chars"), "unit").withColumn("own", own)
    n_wanted = groups.count()
    wanted = wanted.select("unit", "root", "blocks", "own", F.col("text_key").alias("key"), F.col("first_doc").alias("doc"))
    wanted = materialize(gathered(wanted, n_wanted, params), "wanted")
    chosen = F.broadcast(wanted) if n_wanted <= params.broadcast_rows else wanted
    texts = keyed.join(chosen, (keyed["text_key"] == F.col("key")) & keyed["doc_id"].eqNullSafe(F.col("doc")))
    other = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = (F.least("own", "other"), F.greatest("own", "other"))
    dealt = other.select(F.xxhash64("root", *pair).alias("task"), "unit", "own", (F.col("own") != F.col("other")).alias("__two"), "blocks", "__text", pair[0].alias("__p"), pair[1].alias("__q"))
    dealt = dealt.select("task", "unit", "own", (F.col("__p") != F.col("__q")).alias("two"), "blocks", "__text").repartition("task").sortWithinPartitions("task", "unit")
    checked = materialize(verify(dealt, params), "links")
    links = checked.groupBy("unit").agg(F.sum("n_links").alias("n_links"))
    final = checked.where("final").select("unit", "root")
    apart = checked.where("not final and root <> unit").select(F.col("unit").alias("a"), F.col("root").alias("b"))
    if not apart.isEmpty():
        final = final.union(components(apart, params).select(F.col("a").alias("unit"), "root"))
    member = final.join(named.select("unit", "first_doc", "text_key"), "unit")
    one = F.struct(F.col("first_doc").isNull().alias("none"), "first_doc", "text_key")
    least = member.groupBy("root").agg(F.min("first_doc").alias("class_id"), F.min(one).alias("stays"))
    found = final.join(least, "root").select("unit", "class_id", "stays")
    joined = units.select("unit", "text_key", "first_doc", "n_copies").join(found, "unit", "left").join(links, "unit", "left")
    alone = F.col("stays").isNull()
    texts = joined.select(
        "text_key", F.when(alone, F.col("first_doc")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies",
        F.when(alone, F.col("first_doc")).otherwise(F.col("stays.first_doc")).alias("stays_id"), F.when(alone, F.col("text_key")).otherwise(F.col("stays.text_key")).alias("stays_key"),
    )
    return rows.select("doc_id", "text_key"), texts


def near_duplicates(docs: DataFrame, params: JoinParams = JoinParams(), text: str = "text") -> DataFrame:
    """doc_id, class_id, n_links, n_copies for every row of ``docs`` (doc_id, text).

    class_id is the least doc_id of all rows connected by links or equal texts, n_links the number of other different
    texts whose sets of word 5-grams have a Jaccard similarity of at least the threshold, n_copies the rows of the
    same text. A null text counts as empty; texts without words link to none, but equal ones are one class. A text of
    fewer words than five has one set member, all of it. Rows with null ids take part; a class of only such rows has a
    null class_id. Repeated rows are copies. An empty table gives an empty one.
    """
    rows, texts = classes(docs, params, text)
    return rows.join(texts, "text_key").select("doc_id", "class_id", "n_links", "n_copies")


def drop_near_duplicates(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """One row of each class, with all columns of ``docs``: that of the least doc_id, a null one only if there is no other;
    of different texts of one id the text of the least md5.

    A null text counts as empty, and all rows without words but equal texts are one class. Of rows that share both id and
    text any one stays. Extra columns are kept whatever their names. An empty table gives an empty one.
    """
    rows, texts = classes(docs, params)
    joined = rows.join(texts, "text_key")
    stays = F.col("doc_id").eqNullSafe(F.col("stays_id")) & (F.col("text_key") == F.col("stays_key"))
    leaving = joined.where(~stays).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__k")).distinct()
    leaving = materialize(leaving, "leaving")
    small = leaving.count() <= 5 * params.broadcast_rows
    keyed = docs.withColumn("__own", F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))))
    fits = keyed["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (keyed["__own"] == F.col("__k"))
    left = keyed.join(F.broadcast(leaving) if small else leaving, fits, "left_anti")
    # rows of one id and one text can't be told apart by the join: all but one of them go
    again = joined.where(stays).groupBy("doc_id", "text_key").count().where("count > 1")
    again = materialize(again.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__k")), "again")
    if again.isEmpty():
        return left.select(*docs.columns)
    fits = left["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (left["__own"] == F.col("__k"))
    return left.join(again, fits, "left_anti").union(left.join(again, fits, "left_semi").dropDuplicates(["doc_id", "__own"])).select(*docs.columns)
