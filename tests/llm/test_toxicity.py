import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import toxicity as T
from millrace.llm.toxicity import Lexicon, ToxicityParams, drop_toxic, fold, matches, toxicity

from .helpers import NASTY, nasty, none


def found(text, weights, exceptions=()):
    return sorted(m[3].strip() for m in matches(fold(text), Lexicon(dict(weights), [fold(e) for e in exceptions]).automaton()))


def test_folding_sees_through_disguise():
    lexicon = {" idiot": 3.0}
    for text in ("Idiot!", "1d10t", "іdіоt", "IDIOTS", "an id​iot", "ｉｄｉｏｔ", "(idiot)"):
        assert found(text, lexicon) == ["idiot"], text
    for text in ("", "an i diot", "anidiot", "idio"):
        assert found(text, lexicon) == [], text


def test_exceptions_spare_their_words_only():
    lexicon = {" trash": 2.0, " clown ": 2.0}
    assert found("the trash can", lexicon, ["trash can"]) == []
    assert found("the trash can is trash", lexicon, ["trash can"]) == ["trash"]
    assert found("clowns and a clown", lexicon) == ["clown"]


def brute_matches(text, weights):
    """Entries at each word's beginning, the longest of those that fit."""
    folded = fold(text)
    out = []
    for i in range(len(folded)):
        fits = [w for w in weights if folded.startswith(w, i)]
        if fits:
            out.append(max(fits, key=len))
    return sorted(out)


def test_automaton_matches_brute_force():
    rng = random.Random(1)
    weights = {f" {a}{b}": 1.0 for a in "abc" for b in ("", "a", "bc")} | {" cab ": 1.0}
    for _ in range(300):
        text = "".join(rng.choice("abc  ") for _ in range(30))
        got = sorted(m[3] for m in matches(fold(text), Lexicon(weights).automaton()))
        assert got == brute_matches(text, weights)


def labelled(n=900, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice("etaoinshrdl") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    bad = ["snargle", "blorpface", "vexworm"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", "s", "ish"]))
        docs.append((i, " ".join(text), "en", "s"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_learns_what_labels_mark(spark):
    docs, labels = labelled()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    out = toxicity(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(out) == len(docs)
    truth = {d: t for d, _, t in labels}
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in out)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = labelled(400)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    turned = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 3 == 1 else t) for d, q, t in labels]
    run = lambda rows: sorted((r["doc_id"], r["score"]) for r in toxicity(df, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect())
    assert run(labels) == run(turned)


def test_nasty_rows(spark):
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (4, None, None), (None, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    out = toxicity(nasty(spark), labels).collect()
    assert len(out) == len(NASTY)
    assert toxicity(none(spark), labels).collect() == []
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["predicted"] for r in toxicity(nasty(spark), nothing).collect()} == {0}


def test_drop_toxic_keeps_clean_rows_and_columns(spark):
    docs, labels = labelled(600)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumnRenamed("lang", "score")
    kept = drop_toxic(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == df.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {d for d, _, t in labels if not t} <= ids
    assert len(ids) < 520


def test_given_entries_and_empty_text():
    lexicon = T.choose([], 0, 0, ToxicityParams(entries=(("Blorp", 4.0),)))
    assert " blorp " in lexicon.weights
    assert T.features("", lexicon.automaton())[1:] == (0.0, 0.0, 0.0)


def test_terms_of_a_small_group_are_entries():
    from millrace.llm.toxicity import ToxicityParams, choose, evidence

    # 60 of 3,300 toxic texts and no clean one: under 2 %, but not by chance; five are too few to tell
    lexicon = choose([(" zaffre", 60, 0), (" common", 900, 3), (" fivefold", 5, 0), (" evenly", 60, 480)], 3_300, 26_700, ToxicityParams())
    assert set(lexicon.weights) == {" zaffre", " common"}
    assert evidence(60, 480, 0.11) < 1 and evidence(0, 0, 0.5) == evidence(3, 0, 1.0) == 0.0


def test_copies_of_a_text_make_no_entry(spark):
    from millrace.llm.toxicity import learn

    rng = random.Random(8)
    plain = lambda: " ".join("".join(rng.choice("bcdfglmnrst") + rng.choice("aeiou") for _ in range(3)) for _ in range(20))
    rows = [(i, plain() + " quabbernaut", 1) if i % 10 == 0 else (i, plain(), 0) for i in range(900)]
    rows += [(1_000 + i, "Zyxomorph  copied words" if i % 2 else "zyxomorph copied\twords", 1) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic")).weights
    assert any(t.startswith(" quab") for t in found) and not any(t.startswith(" zyxo") for t in found)


def test_exceptions_cost_no_more_than_their_number():
    import time

    built = Lexicon({" trash": 2.0, " can": 1.0}, [fold("trash can")]).automaton()
    began = time.perf_counter()
    assert matches(fold("trash can " * 200_000), built) == []
    assert len(matches(fold("trash can trash bag " * 50_000), built)) == 50_000
    assert time.perf_counter() - began < 20


def test_exceptions_match_brute_force():
    rng = random.Random(6)
    weights = {" a": 1.0, " ab": 1.0, " b ": 1.0, " c": 1.0}
    spared = [" a b ", " b c c ", " ab "]
    built = Lexicon(weights, spared).automaton()
    for _ in range(300):
        text = fold(" ".join(rng.choice(["a", "b", "c", "ab", "ca"]) for _ in range(rng.randint(0, 14))))
        spans = [(i, i + len(p) - 1) for p in spared for i in range(len(text)) if text.startswith(p, i)]
        want = []
        for i in range(len(text)):
            fits = [w for w in weights if text.startswith(w, i)]
            if fits:
                w = max(fits, key=len)
                if not any(a <= i and i + len(w.rstrip()) - 1 <= b for a, b in spans):
                    want.append((i, w))
        assert sorted((m[0], m[3]) for m in matches(text, built)) == want


def brute_scores(docs, labels, params):
    """Entries, logistic function and scores by plain loops over all texts."""
    y = {d: t for d, _, t in labels}
    folded = {d: fold(t) for d, t, *_ in docs}
    train = [d for d, *_ in docs if zlib.crc32(str(d).encode()) % 3 != 1]
    candidates = set()
    for d in train:
        for w in folded[d].split():
            candidates |= {" " + w[:n] for n in range(params.shortest, min(params.longest, len(w)) + 1)} | ({f" {w} "} if 3 <= len(w) <= 24 else set())
    n = [sum(y[d] == k for d in train) for k in (0, 1)]
    rows, odds = {}, {}
    held = {k: [folded[d] for d in train if y[d] == k] for k in (0, 1)}
    for t in candidates:
        toxic = sum(t in f for f in held[1])
        if toxic < params.min_rows:
            continue
        clean = sum(t in f for f in held[0])
        weight = math.log((toxic + 0.5) / (n[1] + 1)) - math.log((clean + 0.5) / (n[0] + 1))
        rate = n[1] / (n[0] + n[1])
        of = toxic + clean
        chance = toxic * math.log(toxic / of / rate) + (clean * math.log(clean / of / (1 - rate)) if clean else 0) if toxic > rate * of else 0
        if toxic > 2 * clean and weight >= params.min_weight and (toxic >= params.min_share * n[1] or chance >= params.min_evidence):
            rows[t], odds[t] = (toxic, clean), weight
    entries = {}
    for t in sorted(odds, key=lambda t: (len(t), t)):
        stems = [t[:k] for k in range(params.shortest + 1, len(t)) if t[:k] in entries]
        if not stems or odds[t] > entries[stems[0]] + 1 and 2 * rows[t][0] > rows[stems[0]][0]:
            entries[t] = odds[t]

    def measured(text):
        found = brute_matches_of(text, entries)
        total = sum(entries[e] * (1 + math.log(found.count(e))) for e in set(found))
        return [1.0, math.log(1 + total), total / math.sqrt(1 + text.count(" ")), len(set(found))]

    x, truth = np.array([measured(folded[d]) for d in train]), np.array([y[d] for d in train])
    pull = np.array([1e-3, 0.1, 0.1, 0.1])
    w = np.zeros(4)
    for _ in range(200_000):
        step = x.T @ (truth - 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))) - pull * w
        w += 2e-4 * step
        if np.abs(step).max() < 1e-6:
            break
    return entries, {d: 1 / (1 + math.exp(-max(-30, min(30, float(np.dot(w, measured(f))))))) for d, f in folded.items()}


def brute_matches_of(folded, weights):
    out = []
    for i in [k for k, c in enumerate(folded) if c == " "]:
        fits = [w for w in weights if folded.startswith(w, i)]
        if fits:
            out.append(max(fits, key=len))
    return out


def test_lexicon_and_scores_match_brute_force(spark):
    docs, labels = labelled(420, seed=9)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    params = ToxicityParams(exceptions=())
    lexicon = T.learn(df, marked, params)
    entries, scores = brute_scores(docs, labels, params)
    assert lexicon.exceptions == []
    assert lexicon.weights.keys() == entries.keys() and len(entries) > 2
    assert all(math.isclose(lexicon.weights[t], w, rel_tol=1e-9) for t, w in entries.items())
    got = {r["doc_id"]: r["score"] for r in toxicity(df, marked, params).collect()}
    assert all(abs(got[d] - s) < 0.01 for d, s in scores.items())


def test_only_the_smallest_hashes_are_fitted(spark):
    from millrace.llm.common import smallest_hashes

    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    few = smallest_hashes(df, "doc_id", 20_000, 500)
    assert few.count() == 500
    assert {r[0] for r in few.collect()} == {r[0] for r in df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(500).collect()}
    assert smallest_hashes(df, "doc_id", 20_000, 50_000).count() == 20_000


def test_nearly_separable_data_have_a_finite_fit():
    # many rows without any match, some with several: undamped steps run away here and call every text toxic
    rng = np.random.default_rng(1)
    clean, toxic = np.zeros((11_000, 3)), np.abs(rng.normal(size=(1_400, 3))) * [0.3, 0.2, 2] + [2.7, 1.5, 3]
    clean[:5] = [1.2, 0.2, 1]
    x = np.concatenate((np.concatenate((clean, toxic)), np.ones((12_400, 1))), axis=1)[:, [3, 0, 1, 2]]
    y = np.concatenate((np.zeros(11_000), np.ones(1_400)))
    w = np.array(T.fit_logistic(x, y))
    p = 1 / (1 + np.exp(-x @ w))
    assert np.abs(w).max() < 50
    assert ((p >= 0.7) == (y == 1)).all()
    assert np.abs(x.T @ (y - p) - np.array([1e-3, 0.1, 0.1, 0.1]) * w).max() < 1e-4
