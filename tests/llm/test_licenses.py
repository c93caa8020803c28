import math
import random
import re
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from millrace.llm.licenses import BASE_PHRASES, TEMPLATES, load_templates, scan_licenses, verify, votes

from .helpers import NASTY, nasty, none

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    found = [(i, label) for label, p in BASE_PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


CASES = [
    "Released under the MIT License.",
    "mit license MIT\nLICENSE apache, license; general public license",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0.",
    "nothing to see here but the license plate of a car and the general public",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this fine software and associated documentation files (the Software), to deal in the Software without restriction",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: " + "filler " * 50,
    "licensed under cc",
    "übermit license MITÉ license",
    "mit " * 2_000 + "license",
]


def test_base_matches_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for r in scan_licenses(df).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(CASES[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_labels_of_the_method(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in scan_licenses(df).collect()}
    assert got[0]["labels"] == "mit" and got[2]["labels"] == "gpl" and got[3]["labels"] == "cc-by-nc"
    assert got[5]["labels"] == "" and got[8]["labels"] == "" and got[5]["score"] < 1
    assert got[6]["labels"] == "mit" and got[6]["n_base"] == 0
    assert got[7]["labels"] == "bsd" and got[7]["spans"][0]["first"] == 0 and got[7]["spans"][0]["last"] == 20


def test_diagonals_merge_across_a_gap(spark):
    hits = spark.createDataFrame([(1, 10, 7), (1, 11, 8), (1, 14, 9), (1, 90, 7), (2, 3, 7)], "row_id long, pos long, hash long")
    for needed, wanted in ((1, {(1, 10, 14, 3), (1, 90, 90, 1), (2, 3, 3, 1)}), (2, {(1, 10, 14, 3)}), (4, set())):
        table = spark.createDataFrame([(7, 0, 0, needed), (8, 0, 1, needed), (9, 0, 2, needed)], "hash long, template int, tpos long, needed int")
        assert {(r["row_id"], r["low"], r["high"], r["votes"]) for r in votes(hits, table).collect()} == wanted


def test_every_template_finds_itself(spark):
    df = spark.createDataFrame([(i, f"before it {t} and after") for i, (_, t) in enumerate(TEMPLATES)], "doc_id long, text string")
    for r in scan_licenses(df).collect():
        assert TEMPLATES[r["doc_id"]][0] in r["labels"].split(",")


def test_verify_counts_words_in_order():
    assert verify([b"a", b"b", b"x", b"c"], [b"a", b"b", b"c"]) == (3, 0, 3)
    assert verify([b"q"], [b"a"]) == (0, 0, -1)


def test_nasty_rows(spark):
    got = scan_licenses(nasty(spark)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    wanted = [(d, *brute(t)) for d, t, *_ in NASTY]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    assert scan_licenses(none(spark)).where(F.lit(True)).collect() == []


def brute_spans(text, templates):
    """Labels and spans by comparing every triple of words with every triple of every template."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, spans = WORD.findall(low), []
    telling = set("mit apache gpl lesser affero general mozilla creative attribution sharealike noncommercial noderivatives cc nc sa nd eclipse boost".split())
    for label, t in templates:
        template = t.split()
        grams = len(template) - 2
        hits = [(i - j, i) for i in range(len(words) - 2) for j in range(grams) if words[i : i + 3] == template[j : j + 3]]
        runs, last = [], None
        for d, i in sorted(hits):
            if last is None or d - last > 4:
                runs.append([])
            runs[-1].append(i)
            last = d
        for run in runs:
            if len(run) < max(1, min(math.ceil(0.4 * grams), 10)):
                continue
            start = max(0, min(run) - 4)
            piece = words[start : max(run) + 7]
            blocks = [b for b in SequenceMatcher(None, piece, template, autojunk=False).get_matching_blocks() if b.size]
            n, a, b = sum(x.size for x in blocks), blocks[0].a, blocks[-1].a + blocks[-1].size - 1
            same = telling & set(piece[a : b + 1]) == telling & set(template)
            if same and b - a + 1 <= 1.5 * n + 4 and (n / len(template) >= 0.8 or n >= 12):
                spans.append((label, start + a, start + b, round(n / len(template), 9), n))
    held = lambda s: set(range(s[1], s[2] + 1))
    return sorted(s[:4] for s in spans if not any(t[0] != s[0] and t[4] > s[4] and len(held(s) & held(t)) > len(held(s)) / 2 for t in spans))


def test_spans_match_brute_force(spark):
    rng = random.Random(11)
    plain = "the of a software work license under this terms copy public notice rights".split()
    rows = []
    for i in range(150):
        words = rng.choices(plain, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(t))
                t[k : k + rng.randint(0, 1)] = rng.choices(plain, k=rng.randint(0, 2))
            at = rng.randint(0, len(words))
            words[at:at] = t
        rows.append((i, " ".join(words)))
    for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        want = brute_spans(rows[r["doc_id"]][1], TEMPLATES)
        assert sorted((s["label"], s["first"], s["last"], round(s["coverage"], 9)) for s in r["spans"]) == want
        base = brute(rows[r["doc_id"]][1])
        assert r["labels"] == ",".join(sorted({w[0] for w in want} | set(filter(None, base[4].split(",")))))
        assert math.isclose(r["score"], 1.0 if base[1] else max((w[3] for w in want), default=0.0), abs_tol=1e-8)


def test_a_few_words_of_a_long_template_have_too_few_votes(spark):
    df = spark.createDataFrame([(0, "any person obtaining a copy of it"), (1, "All rights reserved. Thank you."), (2, "all rights are reserved")], "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in scan_licenses(df).collect()} == {0: "", 1: "proprietary", 2: ""}


def test_templates_of_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.txt").write_text("You may do with these files, as you like; but (always) name us.")
    (tmp_path / "other").write_text("Nobody may ever use any of this")
    templates = load_templates(spark, str(tmp_path))
    assert [t[0] for t in templates] == ["own-1", "other"]
    df = spark.createDataFrame([(0, "note: you may do with these files as you like but always name us."), (1, "nothing")], "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in scan_licenses(df, templates=templates).collect()} == {0: "own-1", 1: ""}
