import random

import numpy as np
import pytest

from millrace.llm import jaccard
from millrace.llm.jaccard import JoinParams, alike_groups, components, drop_near_duplicates, group_of, linked, near_duplicates, sets_of

from .helpers import NASTY, nasty, none


def brute(rows, params=JoinParams()):
    """Class and number of links of each row by comparing all texts."""
    texts = sorted({t or "" for _, t in rows})
    def grams(t):
        words = t.encode().split()
        return frozenset(tuple(words[i : i + params.words]) for i in range(max(1, len(words) - params.words + 1))) if words else frozenset()
    sets = [grams(t) for t in texts]
    near = [[j for j in range(len(texts)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= params.threshold * len(sets[i] | sets[j])] for i in range(len(texts))]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        seen, front = {i}, [i]
        while front:
            for j in near[front.pop()]:
                if j not in seen:
                    seen.add(j)
                    front.append(j)
        root[i] = min(seen)
    place = {t: i for i, t in enumerate(texts)}
    least = {}
    for d, t in rows:
        r = root[place[t or ""]]
        if d is not None:
            least[r] = min(least.get(r, d), d)
    copies = [sum((t or "") == x for _, t in rows) for x in texts]
    return [(d, least.get(root[place[t or ""]]), len(near[place[t or ""]]), copies[place[t or ""]]) for d, t in rows]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def corpus(seed, groups=12, size=9):
    """Near copies of several lengths and degrees, a passage many share, exact copies, ordinary texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3_000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 30, 120, 400]))]
        texts += [edited(rng, base, rng.randint(0, max(1, len(base) // 40))) for _ in range(size)]
    texts += [" ".join([rng.choice(vocabulary) for _ in range(150)] + passage) for _ in range(90)]
    texts += [rng.choice(texts) for _ in range(40)] + ["short text", "short text", "two words", "", ""]
    rng.shuffle(texts)
    return list(enumerate(texts))


def run(spark, rows, params=JoinParams()):
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), params).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[3])
    return sorted(map(tuple, got), key=order), sorted(brute(rows), key=order)


def test_matches_brute_force(spark):
    got, wanted = run(spark, corpus(1))
    assert got == wanted
    assert sum(r[2] > 0 for r in wanted) > 50


def test_small_buckets_blocks_and_depth(spark):
    # everything is a large bucket, compared in blocks, verified in blocks, and joined without a broadcast
    params = JoinParams(small=3, held=8, widest=8, last_block=4, block=4, depth=1, broadcast_rows=0)
    got, wanted = run(spark, corpus(2, groups=5, size=14), params)
    assert got == wanted


def test_one_hot_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    rows = [(i, edited(rng, base, 1)) for i in range(400)] + [(400 + i, " ".join(base)) for i in range(100)] + [(500 + i, f"text of its own number {i} with words") for i in range(200)]
    got, wanted = run(spark, rows)
    assert got == wanted
    assert max(r[2] for r in wanted) >= 399


def tiny_batches(spark, monkeypatch, rows=8):
    """Buckets come in many Arrow batches."""

    def set_rows(session):
        session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))

    monkeypatch.setattr(jaccard, "bounded_batches", set_rows)


@pytest.mark.parametrize("depth", [0, 1, 4])
def test_large_buckets_over_many_batches_lose_no_link(spark, monkeypatch, depth):
    # all share a passage, so they stand in the same buckets; each has one twin of nearly the same words, somewhere
    tiny_batches(spark, monkeypatch)
    rng = random.Random(depth)
    passage = [f"p{k}" for k in range(60)]
    texts = []
    for i in range(150):
        own = [f"o{i}x{k}" for k in range(50)]
        texts += [" ".join(own + passage), " ".join(own[:-1] + passage) + "  "]
    rng.shuffle(texts)
    params = JoinParams(small=4, held=64, widest=64, last_block=32, depth=depth, broadcast_rows=depth)
    got, wanted = run(spark, list(enumerate(texts)), params)
    assert got == wanted
    assert all(r[2] == 1 for r in wanted)


@pytest.mark.parametrize("strangers", [0, 30, 200])
def test_a_bucket_of_near_copies_and_others(spark, monkeypatch, strangers):
    # the pivot's group is nearly all of a bucket, or only a part of it
    tiny_batches(spark, monkeypatch)
    rng = random.Random(strangers)
    base = [f"w{k}" for k in range(120)]
    texts = [edited(rng, base, 1) for _ in range(200)]
    for i in range(strangers // 2):
        own = [f"s{i}x{k}" for k in range(100)]
        texts += [" ".join(own + base), " ".join(own + base[1:])]
    rng.shuffle(texts)
    got, wanted = run(spark, list(enumerate(texts)), JoinParams(small=4, held=32, widest=32, last_block=32))
    assert got == wanted


def test_group_of_the_pivot():
    sketch = np.repeat(np.arange(4, dtype=np.uint8)[:, None], 16, axis=1)[[0, 1, 0, 2, 0]]
    assert group_of(sketch, 2, JoinParams(), 1e9).tolist() == [True, False, True, False, True]
    assert group_of(sketch, 2, JoinParams(), 0).tolist() == [False, False, True, False, False]


def test_nasty_rows(spark):
    order = lambda r: (r[0] is None, r[0] or 0, r[3])
    got = sorted(map(tuple, near_duplicates(nasty(spark)).collect()), key=order)
    assert got == sorted(brute([r[:2] for r in NASTY]), key=order)
    assert near_duplicates(none(spark)).collect() == []


def test_one_row_of_each_class_stays(spark):
    df = nasty(spark)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    rows = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert rows == sorted({(d, t) for (d, t, *_), b in zip(NASTY, brute([r[:2] for r in NASTY]), strict=True) if b[0] == b[1]} - {(2, "")}, key=str)
    assert drop_near_duplicates(none(spark)).collect() == []


def test_one_row_stays_where_ids_are_repeated_or_null(spark):
    base = [f"w{k}" for k in range(100)]
    a, b, c = " ".join(base), " ".join(base[1:]), " ".join(base[2:])
    # one class of two rows of id 5, one class without any id, one with an id beside null, one of equal rows
    rows = [(5, a), (5, b), (None, "x " + a.replace("w", "v")), (None, a.replace("w", "v")), (None, a.replace("w", "u")), (9, b.replace("w", "u")), (3, c.replace("w", "t")), (3, c.replace("w", "t"))]
    kept = [(r["doc_id"], r["text"]) for r in drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(kept) == 4
    assert sorted(d is None for d, _ in kept) == [False, False, False, True]
    assert {d for d, _ in kept} == {5, None, 9, 3}


@pytest.mark.parametrize("seed", range(3))
def test_exact_links(seed):
    rng = random.Random(seed)
    texts = [t.encode() for _, t in corpus(seed, 4, 5)[:60]]
    links = linked(sets_of(texts, 5), 0.8)
    sets = [set(s.tolist()) for s in sets_of(texts, 5)]
    for _ in range(500):
        i, j = rng.randrange(60), rng.randrange(60)
        want = i != j and bool(sets[i]) and bool(sets[j]) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
        assert links[i, j] == want


def test_groups_are_complete():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (4, 128), dtype=np.uint8)
    sketch = np.concatenate([np.where(rng.random((20, 128)) < 0.1, rng.integers(0, 256, (20, 128)), b) for b in base]).astype(np.uint8)
    root, reached = alike_groups(sketch, JoinParams())
    assert reached.all() and len(set(root.tolist())) == 4


@pytest.mark.parametrize("rows", [0, 200_000])
def test_components_of_long_paths(spark, rows):
    params = JoinParams(broadcast_rows=rows)
    rng = random.Random(rows)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (205, 203), (203, 201), (7, 7), (101, 100)]
    edges += [(rng.randrange(1_000, 1_400), rng.randrange(1_000, 1_400)) for _ in range(180)]
    rng.shuffle(edges)
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(edges)):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r["a"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), params).collect()}
    assert got == root
    assert all(got[i] == 0 for i in range(61)) and got[101] == 100 and got[205] == 201
    assert components(spark.createDataFrame([], "a long, b long"), params).collect() == []


def test_runs_reach_the_recall():
    assert JoinParams(recall=0.5).runs < JoinParams().runs < JoinParams(recall=1 - 1e-12).runs
