"""Words that agree under hashes made of powers must not agree here."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
import sentencepiece
import tokenizers

from millrace.llm.common import Words, byte_table
from millrace.llm.ppm import PpmParams, score_documents
from millrace.llm.quality import quality
from millrace.llm.rans import default_tokenizer, tokens_of
from millrace.llm.sentencepieces import default_model, encode_pieces


def twins(n: int) -> tuple[str, str]:
    """The Thue-Morse word of n letters and its complement: their polynomial sums modulo 2 ** 64 are equal from some 1,024 letters."""
    word = "".join("ab"[k.bit_count() % 2] for k in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


PAIRS = [twins(1_024), twins(2_048)]


@pytest.mark.parametrize("n", [64, 1_024, 2_048, 1 << 16])
def test_twins_differ(n):
    a, b = Words([" ".join(twins(n)).encode()]).hashes()
    assert a != b


def test_equal_words_agree_wherever_they_stand():
    rng = random.Random(4)
    words = ["".join(rng.choice("abé日x") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=50)).encode() for _ in range(30)]
    seen = {}
    for chosen in (texts, texts[::-1], [b"", *texts, b" "]):
        run = Words(chosen)
        raw = run.buf.tobytes()
        for h, a, b in zip(run.hashes().tolist(), run.start.tolist(), run.end.tolist(), strict=True):
            assert seen.setdefault(raw[a:b], h) == h
    assert len(set(seen.values())) == len(seen)


def test_short_words_of_two_bytes_differ():
    words = ["".join(p) for n in range(1, 13) for p in itertools.product("ab", repeat=n)]
    found = Words([" ".join(words).encode()], byte_table(b" "), b" ").hashes()
    assert len(np.unique(found)) == len(words)


def texts():
    rows = [f"{a} {b} {a} {b} middle {b} {a}" for a, b in PAIRS]
    return [*rows, *(f"{a} x y {b} x y" for a, b in PAIRS), *(w for p in PAIRS for w in p)]


def test_quality_counts_no_repeats_of_twins(spark):
    a, b = PAIRS[0]
    rows = [(0, f"{a} x y {b} x y"), (1, f"{a} x y {a} x y")]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 6}


def test_pieces_of_twins(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: r["ids_sha256"] for r in encode_pieces(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: hashlib.sha256(",".join(map(str, library.encode(t))).encode()).hexdigest() for d, t in rows}


def test_tokens_of_twins():
    library = tokenizers.Tokenizer.from_file(default_tokenizer())
    raw = [t.encode() for t in texts()]
    got = [ids[a:b].tolist() for ids, n in tokens_of(None).encode(raw) for a, b in zip(np.cumsum(n) - n, np.cumsum(n), strict=True)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts()]


def test_base_counts_of_twins(spark):
    rows = [(k, t) for k, t in enumerate(texts())]
    got = score_documents(spark.createDataFrame(rows, "doc_id long, text string"), PpmParams(order=2)).collect()
    train = [t for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    known = {w for t in train for w in t.split()}
    assert {r["doc_id"]: r["n_known"] for r in got} == {d: 1 + sum(w in known for w in t.split()) for d, t in rows}
