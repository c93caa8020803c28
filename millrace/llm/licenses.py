"""License scans by diagonal voting.

All rolling word 3-gram hashes of the texts are joined with the positions of the same hashes in license templates.
A hit lies on the diagonal (text position - template position); hits of one diagonal vote together, neighbouring
diagonals (words inserted or left out) are merged, and a run with enough votes for its template is verified word by word.

The built-in templates are the sentences by which common licenses are declared and the telling paragraphs of some short
ones, not a collection of whole licenses; ``load_templates`` reads such a collection.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, bounded_batches, byte_table, lean, materialize, mix, slices, texts_of

#: What separates words: all ASCII but digits and lower-case letters (texts are lower-cased first).
SEPARATORS = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
K = 3
#: Templates: sentences by which licenses are declared and paragraphs of their texts, with the label of each (fixed values).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "licensed under the gnu affero general public license version 3"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-nc-sa", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-nd", "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("odc", "made available under the open database license"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "no part of this publication may be reproduced distributed or transmitted in any form or by any means"),
)
#: Phrases of the base labels (fixed by the contract).
BASE_PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
#: Diagonals at most this far apart belong to one span.
DRIFT = 4
#: A template as long as this many words need not be there as a whole: so many words in place are enough.
ENOUGH_WORDS = 12
MIN_COVERAGE = 0.8
#: Votes that a run of diagonals needs: this share of its template's k-grams, at most those of ENOUGH_WORDS words.
MIN_VOTES = 0.4
#: Templates and k-grams of theirs that are sent to every task at most.
MOST_TEMPLATES, MOST_GRAMS = 10_000, 2_000_000


def votes_needed(n_words: int) -> int:
    return max(1, min(math.ceil(MIN_VOTES * (n_words - K + 1)), ENOUGH_WORDS - K + 1))


def plain_hash(words: list[bytes]) -> np.ndarray:
    return Words([b" ".join(words)], SEPARATORS).hashes()


def template_words(text: str) -> list[bytes]:
    words = Words([text.encode().lower()], SEPARATORS)
    raw = words.buf.tobytes()
    return [raw[a:b] for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True)]


def template_table(templates=TEMPLATES) -> list[tuple[int, int, int, int]]:
    """(hash, template, position, votes needed) of every k-gram of the templates; a template of fewer words is refused."""
    rows = []
    for t, (_, text) in enumerate(templates):
        words = Words([text.encode().lower()], SEPARATORS)
        at, value = words.windows(words.hashes(), K)
        if not len(at):
            raise ValueError(f"template {t} has fewer than {K} words")
        needed = votes_needed(len(words.start))
        rows += [(int(v), t, int(p), needed) for p, v in zip(at, value.view(np.int64), strict=True)]
    return rows


def lowered(texts: list[bytes]) -> list[bytes]:
    return [x.lower() for x in texts]


def verify(found: list[bytes], template: list[bytes]) -> tuple[int, int, int]:
    """Words of the template that stand in order in ``found``, and the first and last word of ``found`` among them."""
    blocks = [b for b in SequenceMatcher(None, found, template, autojunk=False).get_matching_blocks() if b.size]
    if not blocks:
        return 0, 0, -1
    return sum(b.size for b in blocks), blocks[0].a, blocks[-1].a + blocks[-1].size - 1


def outdone(span: dict, other: dict) -> bool:
    """Whether a span of another label has more words in place and holds more than half of this one."""
    shared = min(span["last"], other["last"]) - max(span["first"], other["first"]) + 1
    return other["label"] != span["label"] and other["n"] > span["n"] and 2 * shared > span["last"] - span["first"] + 1


#: Words that tell one license from another: a span must have those of its template and no other.
TELLING = frozenset(b"mit apache gpl lesser affero general mozilla creative attribution sharealike noncommercial noderivatives cc nc sa nd eclipse boost".split())


def same_license(found: list[bytes], template: list[bytes]) -> bool:
    return TELLING.intersection(found) == TELLING.intersection(template)


def votes(row: DataFrame, table: DataFrame) -> DataFrame:
    """(row_id, template, low, high, votes): runs of neighbouring diagonals with enough votes, from (row_id, pos, hash) and
    (hash, template, tpos, needed).

    The join's right side is the k-grams of the templates: bounded by MOST_GRAMS, whatever the corpus is.
    """
    hits = row.join(F.broadcast(table), "hash")
    diagonals = hits.groupBy("row_id", "template", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"), F.first("needed").alias("needed")
    )
    order = Window.partitionBy("row_id", "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT).cast("int"), F.lit(1))
    runs = diagonals.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("row_id", "template", "run").agg(F.sum("n").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"), F.first("needed").alias("needed"))
    return merged.where("votes >= needed").drop("needed")


def load_templates(spark: SparkSession, path: str) -> tuple[tuple[str, str], ...]:
    """A template for each text file of a folder, labelled by its name without ending; '' for folders without any."""
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path).select("_metadata.file_name", "value")
    rows = sorted(tuple(r) for r in files.limit(MOST_TEMPLATES + 1).collect())
    return tuple((name.rpartition(".")[0].lower() or name.lower(), text) for name, text in rows)


def scan_licenses(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), templates: tuple[tuple[str, str], ...] = TEMPLATES
) -> DataFrame:
    """Columns ``keep`` and, for each row: n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. ``base_*`` come from BASE_PHRASES; ``labels``
    adds those of verified template spans, but of similar spans in one place only that of the most words; ``spans`` lists them as (label, first, last, coverage); ``score`` is the best
    coverage, and 1 where a base phrase stands. A null text counts as empty: no words, no labels (''), score 0.
    Repeated rows give repeated results; other columns aren't read. ``templates``: (label, text), sentences or whole texts.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"templates are sent to every task; give at most {MOST_TEMPLATES}")
    words_of = [template_words(text) for _, text in templates]
    rows = template_table(templates)
    if len(rows) > MOST_GRAMS:
        raise ValueError(f"templates of {len(rows)} k-grams; give at most {MOST_GRAMS}")
    known = np.unique(np.array([r[0] for r in rows], dtype=np.int64))
    names = [t[0] for t in templates]
    phrases = [(label, [int(h) for h in plain_hash(p.encode().split())]) for label, p in BASE_PHRASES]
    kept = df.select(*(df[c] for c in keep), df[text].alias("__text"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    word = "n_words long, n_base long, first_word long, last_word long, base_labels string, grams array<struct<pos:long,hash:long>>, words array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = pa.list_(pa.struct([("pos", pa.int64()), ("hash", pa.int64())]))
        kinds = [pa.int64()] * 4 + [pa.string(), gram, pa.list_(pa.string())]
        for batch in batches:
            texts = lowered(texts_of(batch.column("__text")))
            for i, j in slices(texts):
                words = Words(texts[i:j], SEPARATORS)
                hashes = words.hashes()
                base: list[list[tuple[int, str]]] = [[] for _ in range(i, j)]
                for label, phrase in phrases:
                    n = len(hashes) - len(phrase) + 1
                    same = np.ones(max(n, 0), dtype=bool)
                    for k, h in enumerate(phrase):
                        same &= hashes[k : k + n] == np.uint64(h) if n > 0 else same
                    for p in np.flatnonzero(same):
                        if words.doc[p] == words.doc[p + len(phrase) - 1]:
                            base[words.doc[p]].append((int(p - words.first[words.doc[p]]), label))
                at, value = words.windows(hashes, K)
                value = value.view(np.int64)
                place = np.minimum(np.searchsorted(known, value), len(known) - 1)
                hit = np.flatnonzero(known[place] == value)  # a k-gram that no template has joins nothing
                grams: list[list[dict]] = [[] for _ in range(i, j)]
                for p, h in zip(at[hit].tolist(), value[hit].tolist(), strict=True):
                    d = words.doc[p]
                    grams[d].append({"pos": p - int(words.first[d]), "hash": h})
                view = words.buf.tobytes()
                own = [
                    [view[s:e].decode() for s, e in zip(words.start[words.first[d] : words.first[d + 1]].tolist(), words.end[words.first[d] : words.first[d + 1]].tolist(), strict=True)]
                    if grams[d] else None
                    for d in range(j - i)
                ]
                out = [
                    words.counts.tolist(),
                    [len(b) for b in base],
                    [min(b)[0] if b else None for b in base],
                    [max(b)[0] if b else None for b in base],
                    [",".join(sorted({x for _, x in b})) for b in base],
                    grams,
                    own,
                ]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in range(len(keep))), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))],
                    [*keep, "n_words", "n_base", "first_word", "last_word", "base_labels", "grams", "words"],
                )

    measured = materialize(kept.mapInArrow(lean(run), f"{columns}, {word}").withColumn("row_id", F.monotonically_increasing_id()), "licenses")
    table = spark.createDataFrame(rows, "hash long, template int, tpos long, needed int")
    hits = measured.where(F.size("grams") > 0).select("row_id", F.explode("grams").alias("g")).select("row_id", "g.pos", "g.hash")
    runs = votes(hits, table).groupBy("row_id").agg(F.collect_list(F.struct("template", "low", "high", "votes")).alias("runs"))
    span = "row_id long, labels array<string>, spans array<struct<label:string,first:long,last:long,coverage:double>>, best double"

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())]))
        for batch in batches:
            labels, spans, best = [], [], []
            for own, runs_ in zip(batch.column("words").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                own = [w.encode() for w in own]
                good = []
                for r in sorted(runs_, key=lambda r: (r["low"], r["template"])):
                    template = words_of[r["template"]]
                    start = max(0, r["low"] - DRIFT)
                    n, a, b = verify(own[start : r["high"] + K + DRIFT], template)
                    coverage = n / len(template)
                    if not same_license(own[start + a : start + b + 1], template):
                        continue
                    if b - a + 1 <= 1.5 * n + DRIFT and (coverage >= MIN_COVERAGE or n >= ENOUGH_WORDS):
                        good.append({"label": names[r["template"]], "first": start + a, "last": start + b, "coverage": coverage, "n": n})
                good = [g for g in good if not any(outdone(g, k) for k in good)]
                labels.append(sorted({g["label"] for g in good}))
                spans.append([{c: g[c] for c in ("label", "first", "last", "coverage")} for g in good])
                best.append(max((g["coverage"] for g in good), default=0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array(labels, pa.list_(pa.string())), pa.array(spans, kind), pa.array(best, pa.float64())], ["row_id", "labels", "spans", "best"]
            )

    spans = measured.where(F.size("grams") > 0).select("row_id", "words").join(runs, "row_id").mapInArrow(lean(check), span)
    joined = measured.drop("grams", "words").join(spans, "row_id", "left")
    base = F.filter(F.split("base_labels", ","), lambda x: x != "")
    return joined.select(
        *keep, "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, F.coalesce("labels", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<label:string,first:long,last:long,coverage:double>>")).alias("spans"),
    )
