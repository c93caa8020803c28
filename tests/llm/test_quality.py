import random
import re
import zlib
from collections import Counter

import zstandard

from millrace.llm.quality import QualityRules, band_of, keep_good, quality

from .helpers import NASTY, nasty, none

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def compressed_well(text):
    raw = (text or "").encode()
    rules = QualityRules()
    size = lambda b: len(zstandard.ZstdCompressor(level=rules.level).compress(b))
    band = band_of(len(raw), rules.bands)
    if raw and not band.low <= len(raw) / size(raw) <= band.high:
        return False
    if len(raw) <= rules.chunk_bytes:
        return True
    bad, rest = 0, raw
    while rest:  # the last chunk is as short as it is, and has the band of its length
        chunk, rest = rest[: rules.chunk_bytes], rest[rules.chunk_bytes :]
        inner = band_of(min(len(chunk), rules.chunk_bytes - 1), rules.bands)
        if not inner.low <= len(chunk) / size(chunk) <= inner.high:
            bad += len(chunk)
    return bad <= rules.max_bad_chunks * len(raw)


def check(rows, texts):
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts, strict=True):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(t), t
        assert r["kept"] == (not r["base_failed"] and compressed_well(t))


def test_nasty_rows(spark):
    check(quality(nasty(spark).coalesce(1)).collect(), [r[1] for r in NASTY])
    assert quality(none(spark)).collect() == []


def test_random_texts_match_brute_force(spark):
    rng = random.Random(1)
    texts = []
    for k in range(60):
        words = [rng.choice(["a", "b#", "ça", "d<e", "long-word", "x y", "z"] if k % 2 else [str(rng.random()) for _ in range(500)]) for _ in range(rng.randint(0, 400))]
        texts.append("".join(w + rng.choice(" \n\t") for w in words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    check(quality(df).collect(), texts)


def test_bands_reject_noise_and_repetition(spark):
    rng = random.Random(2)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(600))
    import base64

    noise = " ".join(base64.b64encode(rng.randbytes(60)).decode() for _ in range(80))
    loops = " ".join(f"{a} of the same old thing again and again forever more" for a in range(60))
    got = {r["doc_id"]: r for r in quality(spark.createDataFrame([(0, prose), (1, noise), (2, loops)], "doc_id long, text string")).collect()}
    assert got[0]["kept"]
    assert not got[1]["kept"] and got[1]["reason"] == "incompressible"
    assert not got[2]["kept"]


def test_keep_good_keeps_all_columns(spark):
    df = nasty(spark)
    kept = keep_good(df)
    assert kept.columns == df.columns
    wanted = [t for _, t, *_ in NASTY if not brute(t)[-1] and compressed_well(t)]
    assert Counter(r["text"] for r in kept.collect()) == Counter(wanted)
    assert zlib.crc32(b"") == 0


def test_the_end_of_a_text_is_judged(spark):
    import base64

    rng = random.Random(4)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(2_000))
    noise = " ".join(base64.b64encode(rng.randbytes(9)).decode() for _ in range(400))
    loops = "the same old line once more\n" * 200
    texts = [
        prose[:8_000],
        prose[:4_096] + noise[:4_000],
        prose[:4_096] + loops[:4_000],
        prose[:4_096] + "-" * 130,  # a short end weighs little
        prose[:8_192] + noise[:4_000],
        prose[:8_192],
        noise[:4_096] + prose[:8_192],
    ]
    got = {r["doc_id"]: r for r in quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    measured = [(got[k]["n_chunks"], got[k]["n_bad_chunks"], got[k]["reason"] == "chunks") for k in range(len(texts))]
    # by hand: bytes of bad chunks over bytes of the text against 0.25; the last is 4,096 of 12,288
    assert [m[:2] for m in measured] == [(2, 0), (2, 1), (2, 1), (2, 1), (3, 1), (2, 0), (3, 1)]
    rejected = {k for k in range(len(texts)) if not got[k]["base_failed"] and got[k]["reason"]}
    assert rejected == {k for k in (1, 4, 6)} | ({2} if not got[2]["base_failed"] else set())
    assert not got[1]["base_failed"] and measured[1][2] and got[3]["kept"] and not got[2]["kept"]
