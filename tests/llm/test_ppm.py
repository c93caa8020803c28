import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import ppm
from millrace.llm.common import Table
from millrace.llm.ppm import PpmModel, PpmParams, grams, score_documents

from .helpers import nasty


def levels_of(texts, order, least=1):
    key, _ = grams(texts, order)
    out = []
    for k in range(1, order + 2):
        keys, counts = np.unique(key & np.uint64((1 << (8 * k)) - 1), return_counts=True)
        out.append(ppm.level_of(keys, counts.astype(np.int64), least))
    return out


def brute_score(train, text, order, least=1):
    """PPM with method C and exclusion, by dictionaries and one byte at a time."""
    trie = {}
    for t in train:
        padded = bytes([ppm.BEGIN]) * order + t + bytes([ppm.END])
        for i in range(order, len(padded)):
            for k in range(order + 1):
                trie.setdefault(padded[i - k : i], Counter())[padded[i]] += 1
    offers = {c: {s for s, n in held.items() if n >= least} for c, held in trie.items()}
    padded = bytes([ppm.BEGIN]) * order + text + bytes([ppm.END])
    total = 0.0
    for i in range(order, len(padded)):
        excluded = set()
        p = 1.0
        for k in range(order, -2, -1):
            if k == -1:
                p /= 256 - len(excluded)
                break
            context = padded[i - k : i]
            if not offers.get(context):
                continue
            left = {s: n for s, n in trie[context].items() if s not in excluded}
            whole = sum(left.values()) + len(left)
            if padded[i] in left and padded[i] in offers[context]:
                p *= left[padded[i]] / whole
                break
            if left:
                p *= (len(left) + sum(n for s, n in left.items() if s not in offers[context])) / whole
            excluded |= offers[context]
        total += math.log10(p)
    return total


@pytest.mark.parametrize("least", [1, 3])
@pytest.mark.parametrize("order", [1, 2, 4])
def test_model_matches_brute_force(order, least):
    rng = random.Random(order)
    make = lambda n: "".join(rng.choice("ab cé") for _ in range(n)).encode()
    train = [make(rng.randint(0, 60)) for _ in range(12)]
    texts = [*train[:3], *(make(rng.randint(0, 40)) for _ in range(12)), b"", b"zzz a", bytes(range(32, 90))]
    got = PpmModel(levels_of(train, order, least)).score(texts)
    assert np.allclose(got, [brute_score(train, t, order, least) for t in texts])


def test_probabilities_of_a_context_add_up_to_one():
    model = PpmModel(levels_of([b"abracadabra", b"banana"], 2))
    for context in (b"ab", b"an", b"zz", b"ba"):
        keys = np.array([(context[0] << 16) | (context[1] << 8) | s for s in range(256)], dtype=np.uint64)
        assert math.isclose(float((10 ** model.log10_probabilities(keys)).sum()), 1.0, rel_tol=1e-9)


def test_untrained_model_gives_the_even_share():
    assert np.allclose(PpmModel(levels_of([], 2)).score([b"ab"]), 3 * -math.log10(256))


def test_table_finds_all_and_nothing_else():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**40, 5000, dtype=np.uint64))
    table = Table(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(2**41)) == -1).all()


def rows_of(spark, data):
    return score_documents(spark.createDataFrame(data, "doc_id long, text string, rare string"), PpmParams(order=3, common_word=0.05))


def test_query_matches_brute_force(spark):
    rng = random.Random(5)
    words = ["the", "of", "Été", "x1", "zebra", "rare"]
    data = [(i, " ".join(rng.choices(words, [9, 8, 3, 2, 1, 1], k=rng.randint(0, 30))), "clash") for i in range(40)]
    data += [(40, None, None), (41, "", None), (42, "unseen Words\tonly", None), (3, data[3][1], "again"), (None, "the of", None)]
    got = rows_of(spark, data).collect()
    assert len(got) == len(data)
    name = lambda d: b"" if d is None else str(d).encode()
    low = lambda t: (t or "").encode().lower()
    train = [low(t) for d, t, _ in data if zlib.crc32(name(d)) % 7 != 2]
    counts = Counter(w for t in train for w in t.split())
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    wanted = []
    for d, t, _ in data:
        own = [counts[w] for w in low(t).split()] + [len(train)]
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in own)
        wanted.append((d, zlib.crc32(name(d)) % 7 == 2, len(own), sum(c > 0 for c in own), n, base, brute_score(train, low(t), 3)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(wanted, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:])


def test_empty_table(spark):
    assert rows_of(spark, []).collect() == []


@pytest.mark.parametrize("order", [1, 3, 5])
def test_rare_groups_count_whatever_their_share(spark, order):
    rng = random.Random(order)
    data = [(i, "".join(rng.choice("aab cdé") for _ in range(rng.randint(0, 40))), "") for i in range(60)]
    data += [(60 + i, f"the name {i}{i} zyx{chr(0x430 + i)}", "") for i in range(20)] + [(90, "", ""), (91, "QQ\x01~", "")]
    # a group is sent to every task from 5 % of the bytes: nearly all are joined
    got = score_documents(spark.createDataFrame(data, "doc_id long, text string, rare string"), PpmParams(order=order, least=0.05, common_word=0.05)).collect()
    low = {d: t.encode().lower() for d, t, _ in data}
    train = [t for d, t in low.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    assert len(train) < len(data) == len(got)
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx({d: brute_score(train, t, order) for d, t in low.items()})


def test_nasty_and_very_long_rows(spark):
    df = nasty(spark).union(nasty(spark).limit(1).selectExpr("8888L AS doc_id", "repeat(concat('lorem ipsum ', uuid()), 9) AS text", *[f"'{c}' AS {c}" for c in nasty(spark).columns[2:]]))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = score_documents(df, PpmParams(order=2, least=0.01, common_word=0.01)).collect()
    name = lambda d: b"" if d is None else str(d).encode()
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode()
    train = [low(t) for d, t in rows if zlib.crc32(name(d)) % 7 != 2]
    # the long text is one phrase 8,000 times: its score is that of a few contexts, so a shorter brute force would do as well
    wanted = {(d, t): brute_score(train, low(t), 2) for d, t in set(rows)}
    assert len(got) == len(rows)
    for (d, t), score in wanted.items():
        assert any(r["doc_id"] == d and r["score"] == pytest.approx(score) for r in got), d
    assert max(len(t or "") for _, t in rows) > 200_000


def test_every_count_matters(spark):
    """What the model gathers grows with the corpus: a phrase of two training texts lowers its cost by far."""
    rng = random.Random(3)
    plain = lambda: " ".join("".join(rng.choice("etaoinshr") for _ in range(5)) for _ in range(40))
    rows = [(i, plain()) for i in range(400)]
    phrase = "quixotic zephyrs jab my vow"
    free = [d for d in range(400, 440) if zlib.crc32(str(d).encode()) % 7 != 2]
    asked = next(d for d in range(9_000, 9_100) if zlib.crc32(str(d).encode()) % 7 == 2)
    seen = rows + [(d, phrase) for d in free[:2]] + [(asked, phrase)]
    new = rows + [(d, plain()) for d in free[:2]] + [(asked, phrase)]
    cost = {}
    for name, data in (("seen", seen), ("new", new)):
        got = score_documents(spark.createDataFrame(data, "doc_id long, text string")).where(f"doc_id = {asked}").first()
        cost[name] = got["score"]
    assert cost["seen"] > cost["new"] + 15
