import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm.fingerprint import DigestParams, compare_neighbours, digest_bits, digests, fingerprints, likeness, of_text, tables, text_of, votes, window_ranks

from .helpers import NASTY, nasty, none

P = DigestParams()


def prose(seed, n=300):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("etaoinshrdlucmfwyp") for _ in range(rng.randint(2, 9))) for _ in range(n))


def brute_places(text):
    """Features by their definition, window by window."""
    steps, rank = tables(P)
    ranks = []
    for i in range(len(text) - 63):
        counts = Counter(text[i : i + 64])
        total = sum(round(c * math.log2(c) * (1 << 20)) for c in counts.values())
        ranks.append(int(rank[min(1536, max(0, round((6.0 - total / (64 << 20)) * 256)))]))
    votes = Counter()
    for i in range(len(ranks) - P.neighbourhood + 1):
        part = ranks[i : i + P.neighbourhood]
        least = min(part)
        if least < 2**31 - 1:
            votes[i + part.index(least)] += 1
    return sorted(k for k, v in votes.items() if v >= P.popularity)


@pytest.mark.parametrize("seed", range(4))
def test_features_match_brute_force(seed):
    text = (prose(seed, 60) + "a" * (seed * 40) + prose(seed + 9, 20)).encode()
    ranks = window_ranks(np.frombuffer(text, np.uint8), P)
    got = np.flatnonzero(votes(ranks, np.ones(len(ranks), bool), P) >= P.popularity)
    assert got.tolist() == brute_places(text)


@pytest.mark.parametrize("piece", [64, 100, 257, 1_000])
def test_seams_change_nothing(piece):
    for seed in range(3):
        text = (prose(seed, 200) + "ab" * 90 + prose(seed + 5, 300)).encode()
        whole = digest_bits(text, P, 1 << 23)
        assert np.array_equal(digest_bits(text, P, piece), whole)
        assert len(whole) == len(brute_places(text))


M = (1 << 64) - 1


def brute_mix(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & M
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & M
    return x ^ x >> 33


def brute_filters(text):
    """Sets of bit numbers, one for each filter of the chain, by whole numbers and one feature at a time."""
    places = brute_places(text) if len(text) >= 127 else []
    hashes = []
    for at in places:
        h = 0x243F6A8885A308D3
        for k in range(8):
            h = (brute_mix(h ^ int.from_bytes(text[at + 8 * k : at + 8 * k + 8], "little")) + k) & M
        hashes.append(h)
    if not places:
        wide = min(16, len(text))
        windows = dict.fromkeys(text[i : i + wide] for i in range(len(text) - wide + 1)) if text else {}
        hashes = [int.from_bytes(hashlib.sha256(w).digest()[:8], "little") for w in windows]
    chain = []
    for k, h in enumerate(hashes):
        if k % 160 == 0:
            chain.append(set())
        second = brute_mix(h ^ 0x13198A2E03707344) | 1
        chain[-1] |= {brute_mix((h + j * second) & M) % 2048 for j in range(5)}
    return chain


def brute_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    total = 0.0
    for f in a:
        best = 0.0
        for g in b:
            chance, least = len(f) * len(g) / 2048, min(len(f), len(g))
            part = (len(f & g) - chance) / max(least - chance, 1e-9) if least > chance else float(len(f & g) == least)
            best = max(best, min(1.0, max(0.0, part * least / max(len(f), len(g)))))
        total += len(f) * best
    return total / sum(map(len, a))


def test_filters_and_overlap_match_brute_force():
    texts = [prose(k, n).encode() for k, n in enumerate((1, 8, 40, 160, 400, 5_000))] + [b"", b"x", b"a" * 300]
    texts += [texts[4][: len(texts[4]) * 3 // 4] + texts[3][:200], texts[5][2_000:]]
    own, wanted = digests(texts), [brute_filters(t) for t in texts]
    for d, w in zip(own, wanted, strict=True):
        bits = [set(np.flatnonzero(np.unpackbits(row)).tolist()) for row in d]
        assert bits == w
    assert max(map(len, wanted)) > 1
    for i, a in enumerate(wanted):
        for j, b in enumerate(wanted):
            both = {round(brute_likeness(x, y), 9) for x, y in ((a, b), (b, a))}  # of chains of one length either may come first
            assert round(likeness(own[i], own[j]), 9) in both


def test_a_text_has_one_digest_wherever_it_stands():
    texts = [prose(k, k * 7).encode() for k in range(40)] + [b"", b"x", b"short text", bytes(range(256)), b"a" * 5_000]
    together = digests(texts, most=3_000)
    for t, d in zip(texts, together, strict=True):
        assert np.array_equal(digests([t])[0], d)
    assert all(np.array_equal(of_text(text_of(d)), d) for d in together)


def test_very_long_text_is_chained():
    d = digests([("abc def " + prose(1, 30_000)).encode()])[0]
    assert len(d) > 10 and likeness(d, d) == 1.0


def test_likeness_tells_edits_from_other_texts():
    a, b = prose(1), prose(2)
    da, de, db = digests([a.encode(), (a[: len(a) * 3 // 4] + b[: len(a) // 4]).encode(), b.encode()])
    assert likeness(da, da) == 1.0
    assert 0.5 < likeness(da, de) < 0.95
    assert likeness(da, db) < 0.1
    assert likeness(da, de) == likeness(de, da)
    empty = digests([b""])[0]
    assert likeness(empty, empty) == 1.0 and likeness(empty, da) == 0.0


def brute_rows(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for k, (d, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        x, y, z = digests([t.encode(), edited.encode(), after.encode()])
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), text_of(x), text_of(y), round(likeness(x, y), 9), round(likeness(x, z), 9)))
    return out


def check(spark, df, rows):
    got = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, compare_neighbours(df).collect())]
    assert sorted(got, key=repr) == sorted(brute_rows(rows), key=repr)


def test_query_matches_brute_force(spark):
    rows = [(i * 3 % 101, prose(i, i % 40)) for i in range(101)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_nasty_rows(spark):
    check(spark, nasty(spark).repartition(3), [r[:2] for r in NASTY])
    assert compare_neighbours(none(spark)).collect() == []
    one = spark.createDataFrame([(1, "alone in the world")], "doc_id long, text string")
    check(spark, one, [(1, "alone in the world")])
    assert len(fingerprints(nasty(spark)).collect()) == len(NASTY)
