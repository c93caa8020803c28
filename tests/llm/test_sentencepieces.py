import hashlib
import random

import pytest

from millrace.llm.sentencepieces import PieceEncoder, default_model, encode_pieces, encode_run, memory_of

from .helpers import LONG, NASTY, nasty, none

ALPHABET = " ab▁\n\téß日本😀theing<>0x1234.,ﬁ́\x00"


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder()


def texts(n, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        s = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 25)))
        out.append(s.replace("a", "   ").replace("b", "the") if rng.random() < 0.3 else s)
    return out


HARD = ["", " ", "   ", "▁", "▁▁ ▁", " lead", "trail ", "two  gaps", "<s></s><unk><0x0A>", "\x00", "a" * 3_000, "日本語" * 500, " " * 2_000, "the" * 1_000, "x́̂", LONG]


def test_equals_the_library(encoder):
    for t in HARD + texts(4_000):
        assert encoder.ids_of(t) == encoder.library.encode(t), t[:60]


def test_runs_of_texts_equal_the_library(encoder):
    cases = HARD[:-1] + texts(2_000, 2)
    got = list(encode_run([t.encode() for t in cases], encoder, memory_of(None)))
    for t, (ids, decimal) in zip(cases, got, strict=True):
        wanted = encoder.library.encode(t)
        assert ids.tolist() == wanted and decimal.decode() == "".join(f"{i}," for i in wanted)


def test_pair_checks_equal_merging(encoder):
    rng = random.Random(3)
    pieces = [p for p in encoder.ids if "▁▁" not in p]
    for k in range(6_000):
        a, b = rng.choice(pieces), rng.choice(pieces)
        if k % 2 and len(a) > 2:
            cut = rng.randint(1, len(a) - 1)
            a, b = a[:cut], a[cut:]
        assert encoder.merged_apart(a, b) == (encoder.merge(a + b) == [a, b])
        assert encoder.merged_apart("", a) == (encoder.merge(a) == [a])


def test_decoding_gives_the_text_back(encoder):
    for t in texts(500, 4):
        assert encoder.library.decode(encoder.ids_of(t)) == encoder.library.decode(encoder.library.encode(t))


def test_query(spark, encoder):
    got = sorted(map(tuple, encode_pieces(nasty(spark)).collect()), key=repr)
    wanted = []
    for d, t, *_ in NASTY:
        ids = encoder.library.encode(t or "")
        hashed = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), encoder.library.decode(ids) if ids else "")]
        wanted.append((d, len(ids), *hashed))
    assert got == sorted(wanted, key=repr)
    assert encode_pieces(none(spark)).collect() == []
    given = encode_pieces(nasty(spark), model=default_model(), ids=True).where("doc_id = 5").first()
    assert given["ids"] == encoder.library.encode("word")
