import random
import zlib

import numpy as np
import pytest
import tokenizers

from millrace.llm import rans
from millrace.llm.common import scratch
from millrace.llm.rans import BLOCK, decode_blocks, decode_documents, default_tokenizer, encode_documents, encode_ids, frequencies, pack_file, parts_of, read_file, round_trip, tokens_of

from .helpers import NASTY, nasty, none


@pytest.mark.parametrize("n", [0, 1, 2, BLOCK - 1, BLOCK, 3 * BLOCK + 17])
@pytest.mark.parametrize("kinds", [1, 2, 300, 49_410])
def test_ids_come_back(n, kinds):
    rng = np.random.default_rng(n + kinds)
    ids = np.minimum(rng.zipf(1.3, n) - 1, kinds - 1).astype(np.uint32)
    assert np.array_equal(decode_blocks(encode_ids(ids), n), ids)


def test_any_blocks_alone():
    ids = np.random.default_rng(1).integers(0, 999, 5 * BLOCK + 9).astype(np.uint32)
    parts = encode_ids(ids)
    assert np.array_equal(decode_blocks(parts, len(ids), 2, 4), ids[2 * BLOCK : 4 * BLOCK])
    assert np.array_equal(decode_blocks(parts, len(ids), 5), ids[5 * BLOCK :])


def test_large_ids_and_size():
    ids = np.array([2**32 - 1, 5, 2**31, 5] * 10_000, dtype=np.uint32)
    assert np.array_equal(decode_blocks(encode_ids(ids), len(ids)), ids)
    skewed = np.minimum(np.random.default_rng(2).zipf(1.5, 400_000) - 1, 5_000).astype(np.uint32)
    counts = np.bincount(skewed)
    p = counts[counts > 0] / len(skewed)
    entropy = -(p * np.log2(p)).sum() * len(skewed) / 8
    parts = encode_ids(skewed)
    assert parts["words"].nbytes < 1.01 * entropy + 64


def test_frequencies_fill_the_table():
    for counts in (np.array([1]), np.array([1, 10**12]), np.ones(49_410, dtype=np.int64), np.array([10**9] + [1] * 49_000)):
        f = frequencies(counts)
        assert f.sum() == 1 << rans.PRECISION and f.min() >= 1


def test_damage_is_noticed():
    ids = np.arange(BLOCK, dtype=np.uint32) % 77
    content = pack_file([1], [BLOCK], ids)
    head, parts = read_file(content)
    assert np.array_equal(decode_blocks(parts, head["ids"]), ids)
    broken = dict(parts)
    broken["words"] = parts["words"].copy()
    broken["words"][5] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        decode_blocks(broken, head["ids"])
    with pytest.raises(ValueError, match="header"):
        read_file(content[:20] + b"#" + content[21:])
    with pytest.raises(ValueError, match="format"):
        read_file(b"x" * 40)
    for at in (head["begin"], (head["begin"] + head["words"]) // 2, head["words"] - 1):  # any section of the index
        with pytest.raises(ValueError, match="index"):
            read_file(content[:at] + bytes([content[at] ^ 1]) + content[at + 1 :])


@pytest.mark.parametrize("first", [0, 1, 7, 29])
@pytest.mark.parametrize("n", [1, 5])
def test_a_segment_reads_its_documents_alone(tmp_path, first, n):
    import pyarrow.fs

    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 3 * BLOCK // 2, 34).tolist()
    ids = rng.integers(0, 900, sum(lengths)).astype(np.uint32)
    (tmp_path / "a").write_bytes(pack_file(list(range(34)), lengths, ids))
    parts, got = rans.read_segment(pyarrow.fs.LocalFileSystem(), str(tmp_path / "a"), first, n)
    start = sum(lengths[:first])
    assert np.array_equal(got, ids[start : start + sum(lengths[first : first + n])])
    assert parts["doc_ids"].tolist() == list(range(34))


def test_hot_ids_take_their_share_of_the_ranges():
    rng = np.random.default_rng(4)
    ids = [7] * 4_000 + [None] * 4_000 + rng.integers(-500, 500, 4_000).tolist()
    ties = rng.integers(0, 1 << 32, len(ids))
    own = np.array([rans.NULL_ID if d is None else d for d in ids], dtype=np.float64)
    cuts = np.sort(own)[np.arange(1, 12) * len(own) // 12]
    part = parts_of(ids, ties, cuts)
    assert np.bincount(part, minlength=12).max() < 2_200
    order = sorted(range(len(ids)), key=lambda i: (part[i], own[i], ties[i]))
    assert order == sorted(range(len(ids)), key=lambda i: (own[i], ties[i]))


def library():
    return tokenizers.Tokenizer.from_file(default_tokenizer())


def test_tokens_equal_the_library():
    rng = random.Random(2)
    alphabet = " abÀ\n\té́ßΣσς日本😀the's'll<|endoftext|>1²Ⅷ½4.,ﬁİ\x1f\xa0 _-$$"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(4_000)]
    texts += ["", "<|endoftext|> <|startoftext|>x", "a" * 5_000, "don't I'll WE'RE", "naïve Ångström"]
    got = [x.tolist() for ids, counts in tokens_of(None).encode([t.encode() for t in texts]) for x in np.split(ids, np.cumsum(counts)[:-1])]
    lib = library()
    for t, ids in zip(texts, got, strict=True):
        assert ids == lib.encode(t, add_special_tokens=False).ids, repr(t)


def brute(rows):
    lib, start, out = library(), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_matches_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(-50, 10_000), " ".join(rng.choice(["word", "Größe", "x1", "don't"]) for _ in range(rng.randint(0, 50)))) for _ in range(300)]
    got = round_trip(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).drop("file").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute(rows)


def test_several_files_and_segments_for_a_part(spark, monkeypatch):
    rows = [(i, "some words in a text") for i in range(50)]
    path = scratch(spark, "rans-test")
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(rans, "FILE_IDS", 40)
    monkeypatch.setattr(rans, "SEGMENT_IDS", 12)
    segments = encode_documents(df, path)
    assert segments.agg({"n_docs": "sum", "n_tokens": "sum"}).first()[0] > 0
    assert segments.count() > segments.select("file").distinct().count() >= 1
    assert sorted(map(tuple, decode_documents(segments, path).drop("file").collect()), key=lambda r: r[1]) == brute(rows)


def test_a_path_used_before(spark):
    path = scratch(spark, "rans-again")
    make = lambda n: [(i, f"text number {i} of {n}") for i in range(n)]
    for n in (50, 5):
        got = round_trip(spark.createDataFrame(make(n), "doc_id long, text string").repartition(4), path=path)
        assert sorted(map(tuple, got.drop("file").collect()), key=lambda r: r[1]) == brute(make(n))


def test_rows_of_one_id(spark):
    rows = [(3, f"text {i}") for i in range(200)] + [(None, f"text {i}") for i in range(200)] + [(i, "x") for i in range(40)]
    got = round_trip(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).drop("file").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute(rows)


def test_nasty_rows(spark):
    got = round_trip(nasty(spark).repartition(3)).drop("file").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute([r[:2] for r in NASTY])
    assert round_trip(none(spark)).collect() == []
