"""Functions and operators beside the registered queries."""

import io
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import pictures
from millrace.functions import texts as T
from millrace.operators import annotations, dedup, inference, media, sampling
from millrace.sources import readers, sinks
from millrace.sources.scratch import scratch


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_batch_numbers_of_wide_rows(spark, adaptive):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        rows = spark.range(150_000).select(((F.col("id") * 7919) % 150_001).alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 8).alias("t"))
        got = sinks.batch_numbers(rows, "k", 64)
        wanted = rows.select("k", F.floor((F.row_number().over(Window.orderBy("k")) - 1) / 64).alias("w"))
        assert got.count() == 150_000
        assert got.join(wanted, "k").where("batch = w").count() == 150_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def test_hashed_pairs_reach_their_recall(spark):
    rng = np.random.default_rng(2)
    # one cluster that fills more than a block, many pairs near the threshold, and strangers
    centre = rng.normal(size=32)
    rows = [centre + 0.1 * rng.normal(size=32) for _ in range(300)]
    for _ in range(250):
        a = rng.normal(size=32)
        b = rng.normal(size=32)
        b -= a * (a @ b) / (a @ a)
        b *= np.linalg.norm(a) / np.linalg.norm(b)
        c = rng.uniform(0.9, 0.97)
        rows += [a, c * a + np.sqrt(1 - c * c) * b]
    rows += list(rng.normal(size=(500, 32)))
    m = np.array(rows, dtype=np.float32).astype(np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    sure = {(i, j) for i, j in zip(*np.nonzero(np.triu(m @ m.T >= 0.9 + 1e-6, 1)), strict=True)}
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "k long, v array<float>")
    got = {(r["a"], r["b"]) for r in dedup.hashed_pairs(df, "k", "v", 0.9, bits=8, block=64).collect()}
    assert len(got & sure) >= 0.999 * len(sure) and len(sure) > 10_000
    assert all(m[a] @ m[b] >= 0.9 - 1e-6 for a, b in got)
    assert dedup.tables_for(0.9, 12, 0.9995) == 45
    assert dedup.hashed_pairs(df.limit(0), "k", "v").collect() == []


def filtered(pixels: np.ndarray, kinds: list[int]) -> bytes:
    """A PNG whose rows have the filters given, by the format's definition."""
    height, width, step = pixels.shape
    rows = []
    for y in range(height):
        kind = kinds[y % len(kinds)]
        line = pixels[y].reshape(-1).astype(int)
        above = pixels[y - 1].reshape(-1).astype(int) if y else np.zeros(width * step, int)
        out = []
        for i, x in enumerate(line):
            left = line[i - step] if i >= step else 0
            corner = above[i - step] if i >= step else 0
            p = left + above[i] - corner
            paeth = min((left, above[i], corner), key=lambda v: (abs(p - v), [left, above[i], corner].index(v)))
            out.append((x - (0, left, above[i], (left + above[i]) // 2, paeth)[kind]) % 256)
        rows.append(bytes([kind, *out]))

    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 2: 4, 3: 2, 4: 6}[step], 0, 0, 0)
    body = zlib.compress(b"".join(rows))
    return pictures.SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", body[:20]) + chunk(b"IDAT", body[20:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("step", [1, 2, 3, 4])
@pytest.mark.parametrize("kinds", [[0], [1], [2], [3], [4], [4, 3, 2, 1, 0]])
def test_pictures_come_back(step, kinds):
    pixels = np.random.default_rng(step).integers(0, 256, (7, 9, step)).astype(np.uint8)
    assert np.array_equal(pictures.decode_png(filtered(pixels, kinds)), pixels)
    if step in (1, 3):
        assert np.array_equal(pictures.decode_png(pictures.encode_png(pixels)), pixels)


def test_pictures_that_cannot_be_read():
    good = pictures.encode_png(np.zeros((4, 4, 3), np.uint8))
    for bad in (b"", b"x", good[:30], good[:41] + b"\0" + good[42:], good.replace(b"\x08\x02\0\0\0", b"\x10\x02\0\0\0")):
        with pytest.raises(ValueError):
            pictures.decode_png(bad)


def test_grey_and_resize():
    pixels = np.arange(6 * 8 * 3, dtype=np.uint8).reshape(6, 8, 3)
    r, g, b = (pixels[:, :, k].astype(int) for k in range(3))
    assert np.array_equal(pictures.grey(pixels)[:, :, 0], (r * 19_595 + g * 38_470 + b * 7_471 + 32_768) // 65_536)
    assert np.array_equal(pictures.resize(pixels, 8, 6), pixels)
    half = pictures.resize(pixels, 4, 3)
    want = np.floor(pixels.reshape(3, 2, 4, 2, 3).mean(axis=(1, 3)) + 0.5)
    assert np.array_equal(half, want)
    assert pictures.resize(pixels, 20, 1).shape == (1, 20, 3)
    png, width, height = media.prepared(pictures.encode_png(pixels), longest=4)
    assert (width, height) == (4, 3) and np.array_equal(pictures.decode_png(png), half)


def test_tiles_hold_their_pixels(spark):
    pixels = np.random.default_rng(1).integers(0, 256, (10, 13, 3)).astype(np.uint8)
    df = spark.createDataFrame([("a", bytearray(pictures.encode_png(pixels)))], "name string, content binary")
    got = media.tiles(df, 8).collect()
    plan = media.tile_plan(spark.createDataFrame([("a", 13, 10)], "name string, width int, height int"), 8)
    assert {tuple(r[k] for k in ("scale", "x", "y", "w", "h")) for r in got} == {tuple(r[k] for k in ("scale", "x", "y", "w", "h")) for r in plan.collect()}
    for r in got:
        part = pixels[r["y"] : r["y"] + r["h"], r["x"] : r["x"] + r["w"]]
        shown = pictures.decode_png(bytes(r["content"]))
        assert shown.shape[:2] == (-(-r["h"] // r["scale"]), -(-r["w"] // r["scale"]))
        if r["scale"] == 1:
            assert np.array_equal(shown, part)


def test_batches_fail_whole_or_alone_or_get_a_stand_in(spark):
    class Picky:
        columns = "y long"

        def predict(self, rows):
            if any(r["x"] == 3 for r in rows):
                raise ValueError("three")
            return [{"y": r["x"] * 2} for r in rows]

    df = spark.range(6).select(F.col("id").alias("x")).coalesce(1)
    run = lambda **k: {r["x"]: (r["y"], r["error"]) for r in inference.infer(df, Picky(), ["x"], batch_size=2, **k).collect()}
    bad = "ValueError: three"
    assert run() == {0: (0, None), 1: (2, None), 2: (4, None), 3: (None, bad), 4: (8, None), 5: (10, None)}
    assert run(alone=False) == {0: (0, None), 1: (2, None), 2: (None, bad), 3: (None, bad), 4: (8, None), 5: (10, None)}
    assert run(stand_in={"x": 100})[3] == (200, bad)


def test_json_of_any_ending_is_read(spark, tmp_path):
    for k, name in enumerate(("a.json", "sub/b.jsonl", "sub/deep/c.ndjson", "sub/d.txt")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f'{{"k": {k}}}\n')
    assert sorted(r["k"] for r in readers.load(spark, str(tmp_path), fmt="json", recursive=True).collect()) == [0, 1, 2]


def test_archives_go_through_the_shared_folder(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "x"))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for p in (tmp_path / "x").glob("*.parquet"):
            z.write(p, "in/side.parquet")
    assert readers.zipped(spark, held.getvalue()).count() == 5
    bad = io.BytesIO()
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("../out.parquet", b"x")
    with pytest.raises(ValueError, match="outside"):
        readers.zipped(spark, bad.getvalue())


def test_listings_without_files_are_an_error(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        media.files(spark, str(tmp_path), ("png",))


def test_samples_come_in_the_order_of_their_keys(spark):
    got = [r["id"] for r in sampling.random_rows(spark.range(500), "id", n=40).collect()]
    assert got == sorted(got) and len(set(got)) == 40


def test_null_and_empty_texts_are_equal(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (4, None)], "k long, t string")
    assert sorted(map(tuple, dedup.equal_texts(df, "k", F.col("t")).collect())) == [(1, 3), (3, 1)]


def test_approximate_quartiles(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    r = annotations.distribution(df, "v", accuracy=1_000).first()
    assert abs(r["median"] - 5_000) <= 10 and abs(r["p25"] - 2_500) <= 10 and r["count"] == 10_001


def test_prompts_need_a_default(spark):
    with pytest.raises(ValueError, match="no prompt"):
        inference.task_prompt(F.lit("a"), {"b": "x"}, "c")


def test_projection_is_that_of_the_singular_vectors(spark):
    from millrace.operators import atlas

    rng = np.random.default_rng(3)
    m = rng.normal(size=(200, 6)) * np.array([5, 3, 1, 1, 0.5, 0.2])
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "k long, v array<double>")
    got = np.array([(r["x"], r["y"]) for r in atlas.projection(df, "k", "v").orderBy("k").collect()])
    _, vectors = np.linalg.eigh(np.cov(m.T))
    want = m @ vectors[:, ::-1][:, :2]
    for k in range(2):
        assert np.allclose(got[:, k], want[:, k], atol=1e-6) or np.allclose(got[:, k], -want[:, k], atol=1e-6)


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from millrace.sources import scratch as module

    class Far:
        class sparkContext:  # noqa: N801
            master = "spark://far:7077"

        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return None

    with pytest.raises(ValueError, match="checkpoint"):
        module.shared_dir(Far())
    assert scratch(spark, "x").count("millrace-x") == 1


def test_class_lists_and_addresses(spark):
    df = spark.createDataFrame([(" a, b ,,c\n",), (None,)], "t string")
    assert [r[0] for r in df.select(T.class_list(F.col("t"))).collect()] == [["a", "b", "c"], []]
    assert spark.range(1).select(T.url_of("https://h/", "/a/", F.lit(None).cast("string"), "b/c")).first()[0] == "https://h/a/b/c"


def test_operators_as_commands(spark, tmp_path, capsys):
    from millrace import __main__ as command

    spark.range(40).withColumn("t", F.concat(F.lit("t"), (F.col("id") % 4).cast("string"))).write.parquet(str(tmp_path / "in"))
    frames = [spark.read.parquet(str(tmp_path / "in"))]
    assert command.apply("sampling.random_rows", frames, ["key=id", "n=7"]).count() == 7
    assert command.apply("dedup.equal_texts", frames, ["key=id", "text=upper(t)"]).count() == 4
    assert "p" in command.apply("inference.with_provenance", frames, ["column=p", "model_id=m"]).columns
    assert command.apply("diff.images", [frames[0], frames[0].limit(0)], ["key=id"]).where("side = 'a'").count() == 40
    for name, given, flags in (("no.such", 1, []), ("sampling.take", 1, ["key=id"]), ("sampling.take", 1, ["x=1"]), ("diff.images", 1, [])):
        with pytest.raises(SystemExit):
            command.apply(name, frames[:given], flags)
    assert command.main(["list", "--operators"]) == 0
    shown = capsys.readouterr().out
    assert "annotations.convert_boxes" in shown and "dedup.similarities" not in shown
