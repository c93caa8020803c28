import itertools
import json
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import boxes as B
from millrace.functions import numbers as N
from millrace.functions import texts as T
from millrace.operators import annotations as A
from millrace.operators import atlas, dedup, diff, inference, judging, media, sampling

IMAGES = "image_id long, file_name string, bbox array<array<double>>, category array<string>, width double, height double"


def images(spark, rows):
    return spark.createDataFrame(rows, IMAGES)


# Boxes


@pytest.mark.parametrize(("source", "target"), [p for p in itertools.permutations(B.FORMATS, 2)])
def test_conversion_there_and_back(spark, source, target):
    rng = random.Random(1)
    boxes = [[rng.uniform(1, 50) for _ in range(2)] + [rng.uniform(51, 90) for _ in range(2)] for _ in range(5)]
    df = images(spark, [(1, "a", boxes, ["x"] * 5, 640.0, 480.0)])
    back = A.convert_boxes(A.convert_boxes(df, source, target), target, source).first()
    assert np.allclose(back["bbox"], boxes)
    assert json.loads(back["conversion"]) == {"from": source, "to": target}


def test_conversion_leaves_broken_boxes(spark):
    df = images(spark, [(1, "a", [None, [1.0], [1.0, 2.0, 3.0, 4.0]], ["x"], 0.0, None)])
    assert A.convert_boxes(df, "coco_xywh", "xyxy").first()["bbox"] == [None, [1.0], [1.0, 2.0, 4.0, 6.0]]
    with pytest.raises(ValueError, match="unknown"):
        A.convert_boxes(df, "coco", "xyxy")
    with pytest.raises(ValueError, match="same"):
        A.convert_boxes(df, "voc", "voc")


def brute_iou(p, q):
    wide = max(0.0, min(p[2], q[2]) - max(p[0], q[0]))
    high = max(0.0, min(p[3], q[3]) - max(p[1], q[1]))
    union = (p[2] - p[0]) * (p[3] - p[1]) + (q[2] - q[0]) * (q[3] - q[1]) - wide * high
    return wide * high / union if union > 0 else 0.0


def test_iou_is_symmetric_and_bounded(spark):
    rng = random.Random(2)
    box = lambda: [*(a := [rng.uniform(0, 9), rng.uniform(0, 9)]), a[0] + rng.uniform(0, 9), a[1] + rng.uniform(0, 9)]
    pairs = [(i, box(), box()) for i in range(60)] + [(60, [0.0] * 4, [0.0] * 4)]
    df = spark.createDataFrame(pairs, "i int, p array<double>, q array<double>")
    for r in df.select("p", "q", B.iou(F.col("p"), F.col("q")).alias("a"), B.iou(F.col("q"), F.col("p")).alias("b")).collect():
        assert math.isclose(r["a"], r["b"]) and 0 <= r["a"] <= 1 and math.isclose(r["a"], brute_iou(r["p"], r["q"]))


def test_every_rule_of_validation(spark):
    nan = float("nan")
    df = images(
        spark,
        [
            (1, "a", [], [], 10.0, 10.0),
            (2, "b", [[1.0, 1.0, 2.0, 2.0]], [], 10.0, 10.0),
            (3, "c", [None, [1.0]], ["x", "y"], 10.0, 10.0),
            (4, "d", [[1.0, nan, 2.0, 2.0], [1.0, float("inf"), 2.0, 2.0]], ["x", "y"], 10.0, 10.0),
            (5, "e", [[5.0, 5.0, -2.0, -3.0]], [" \t"], 10.0, 10.0),
            (6, "f", [[-3.0, 1.0, 2.0, 2.0], [9.0, 9.0, 5.0, 5.0], [0.0, 0.0, 10.4, 10.4]], ["x", None, "z"], 10.0, 10.0),
            (7, "g", [[-3.0, 1.0, 99.0, 2.0]], ["x"], None, 10.0),
            (8, "h", None, None, 1.0, 1.0),
        ],
    )
    got = {(r["image_id"], r["code"], r["ann_idx"]) for r in A.validate(df).collect()}
    assert got == {
        (1, "W001", None), (2, "E001", None), (3, "E002", 0), (3, "E002", 1), (4, "E003", 0), (4, "E003", 1), (5, "E004", 0), (5, "E005", 0), (5, "W005", 0),
        (6, "W003", 0), (6, "W004", 1), (6, "W005", 1), (8, "W001", None),
    }
    verdict = A.verdict(A.validate(df)).first()
    assert verdict["errors"] == 7 and not verdict["valid"]
    clean = A.validate(df.where("image_id = 7"))
    assert A.verdict(clean).first()["valid"] and A.verdict(clean, strict=True).first()["valid"]
    names = images(spark, [(i, n, [], [], 1.0, 1.0) for i, n in enumerate("aab")])
    assert [(r["name"], r["n"]) for r in A.duplicate_names(names, F.col("file_name")).collect()] == [("a", 2)]


def test_nested_layouts_are_the_same(spark):
    flat = images(spark, [(1, "a", [[1.0, 2.0, 3.0, 4.0], [0.0, 0.0, 9.0, 9.0]], ["x"], 10.0, 10.0)])
    struct = flat.select("image_id", "width", "height", F.struct("bbox", "category").alias("objects"))
    listed = flat.select("image_id", "width", "height", F.transform(F.arrays_zip("bbox", "category"), lambda z: F.struct(z["bbox"].alias("bbox"), z["category"].alias("category"))).alias("objects"))
    rows = lambda df: sorted(map(str, A.exploded(df).drop("corners").collect()))
    assert rows(flat) == rows(struct) == rows(listed)
    with pytest.raises(ValueError, match="no column"):
        A.validate(flat.drop("bbox"))


def test_distribution_of_nothing_is_zero(spark):
    assert tuple(A.distribution(spark.createDataFrame([], "x double"), "x").first()) == (0, 0, 0, 0, 0, 0, 0)


# Differences


def brute_greedy(pairs):
    used_i, used_j, out = set(), set(), []
    for iou, i, j in sorted(pairs, reverse=True):
        if i not in used_i and j not in used_j:
            out.append((i, j))
            used_i.add(i)
            used_j.add(j)
    return out


def test_greedy_matching(spark):
    rng = random.Random(4)
    make = lambda: [(k, f"f{k}", [[rng.randint(0, 6) * 1.0, rng.randint(0, 6) * 1.0, 5.0, 5.0] for _ in range(6)], [rng.choice("xy") for _ in range(6)], 20.0, 20.0) for k in range(12)]
    left, right = make(), make()[:9]
    got = diff.matches(images(spark, left), images(spark, right), 0.3).collect()
    wanted = set()
    corners = lambda b: [b[0], b[1], b[0] + b[2], b[1] + b[3]]
    for k in range(9):
        pairs = [(brute_iou(corners(p), corners(q)), i, j) for i, p in enumerate(left[k][2]) for j, q in enumerate(right[k][2])]
        wanted |= {(k, *m) for m in brute_greedy([p for p in pairs if p[0] >= 0.3])}
    assert {(r["image_id"], r["i"], r["j"]) for r in got} == wanted
    c = diff.counts(images(spark, left), images(spark, right), 0.3).first()
    assert c["matched"] == len(wanted) and c["removed"] == 54 - len(wanted) == c["added"] and c["only_a"] == 18 and c["only_b"] == 0
    same = diff.counts(images(spark, left), images(spark, left)).first()
    assert same["removed"] == same["added"] == same["modified"] == 0


def test_last_row_of_a_key_wins(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), (None, 3, 2), ("", 4, 3)], "k string, v int, o int")
    assert sorted(r["v"] for r in diff.last_of_key(df, "k", "o").collect()) == [2, 4]


# Samples


def test_samples_repeat_and_have_their_size(spark):
    df = spark.range(1_000).withColumn("category", F.array((F.col("id") % 10).cast("string"), F.when(F.col("id") % 97 == 0, "rare").otherwise("x")))
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(sampling.random_rows(df, "id", 50)) == ids(sampling.random_rows(df.repartition(7), "id", 50))
    assert len(ids(sampling.random_rows(df, "id", fraction=0.0005))) == 1
    assert len(ids(sampling.random_rows(df, "id", 5_000))) == 1_000
    assert ids(sampling.random_rows(df, "id", 50, seed=1)) != ids(sampling.random_rows(df, "id", 50))
    chosen = sampling.stratified(df, 60, "id")
    assert chosen.count() == 60
    assert chosen.where(F.array_contains("category", "rare")).count() >= 1
    assert ids(chosen) == ids(sampling.stratified(df.repartition(3), 60, "id"))
    with pytest.raises(ValueError, match="either"):
        sampling.random_rows(df, "id")


# Duplicates


def vectors(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 16))
    v[n // 2 :] = v[: n - n // 2] + rng.normal(size=(n - n // 2, 16)) * rng.uniform(0, 0.4, (n - n // 2, 1))
    return v, spark.createDataFrame([(i, x.tolist(), int(i % 5)) for i, x in enumerate(v)], "id long, v array<float>, c int")


def test_similar_pairs_in_blocks_and_hashed(spark, monkeypatch):
    v, df = vectors(spark)
    u = v.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    c = u @ u.T
    wanted = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if c[i, j] >= 0.9}
    exact = {(r["a"], r["b"]) for r in dedup.similar_pairs(df, "id", "v").collect()}
    assert exact == wanted and len(wanted) > 50
    monkeypatch.setattr(dedup.similarities, "__defaults__", (64,))
    assert {(r["a"], r["b"]) for r in dedup.similar_pairs(df, "id", "v").collect()} == wanted
    hashed = {(r["a"], r["b"]) for r in dedup.hashed_pairs(df, "id", "v").collect()}
    assert hashed <= wanted and len(hashed) >= 0.97 * len(wanted)
    assert {r["id"] for r in dedup.semantic_duplicates(df, "id", "v").collect()} == {j for _, j in wanted}


def test_normalised_texts(spark):
    df = spark.createDataFrame([(1, " A  b\n"), (2, "a b"), (3, None), (4, ""), (5, "a  c")], "id long, t string")
    assert sorted(tuple(r) for r in dedup.equal_texts(df, "id", dedup.normalised(F.col("t"))).collect()) == [(1, 2), (3, 2), (5, 1)]


# Texts


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "value", "ok"),
    [('```json\n{"a": 1}\n```', '{"a": 1}', True), ("{broken", "{broken", False), ("[1]", "[1]", True), ("", "", False), ("``` \n[]\n```  ", "[]", True)],
)
def test_fences(spark, text, value, ok):
    assert tuple(one(spark, text, T.json_or_raw(F.col("t")))) == (value, ok)


def test_thinking_answers_and_front_matter(spark):
    assert tuple(one(spark, "<think> a </think> b ", T.split_thinking(F.col("t")))) == ("a", "b")
    assert tuple(one(spark, "<think> never closed", T.split_thinking(F.col("t")))) == (None, "<think> never closed")
    assert one(spark, "<think>x</think> <answer> y\nz </answer> w", T.answer_of(F.col("t"))) == "y\nz"
    assert one(spark, "plain", T.answer_of(F.col("t"))) == "plain"
    got = one(spark, "---\nlang: en\ntable: false\n---\nbody", T.front_matter(F.col("t")))
    assert json.loads(got["metadata"]) == {"lang": "en", "table": "false"} and got["body"] == "body"
    assert tuple(one(spark, "no block", T.front_matter(F.col("t")))) == (None, "no block")


def test_detections_forgive_mistakes(spark):
    find = lambda t: [(d["bbox"], d["label"]) for d in one(spark, t, T.detections(F.col("t")))]
    assert find('[{"bbox_2d": [1, 2, 3, 4], "label": "cat", }, # a note\n {"bbox": [5,6,7,8]}]') == [([1, 2, 3, 4], "cat"), ([5, 6, 7, 8], "")]
    assert find("boxes [1, 2, 3, 4] and [ 5,6,7,8.5 ] then [1,2]") == [([1, 2, 3, 4], "object_1"), ([5, 6, 7, 8.5], "object_2")]
    assert find("none") == [] and find('{"bbox": [1, 2]}') == []


def test_provenance_is_always_a_list(spark):
    for held, n in ((None, 1), ("", 1), ("{bad", 1), ('[{"model_id": "a"}]', 2)):
        df = inference.with_provenance(spark.createDataFrame([(held,)], "info string"), "info", model_id="m")
        got = json.loads(df.first()["info"])
        assert len(got) == n and got[-1] == {"model_id": "m"}


def brute_loop(text, least=8_000):
    n = len(text)
    if n < least:
        return text
    for p in range(2, n // 10 + 1):
        count = 0
        while (count + 1) * p <= n and text[n - (count + 1) * p : n - count * p] == text[-p:]:
            count += 1
        if count >= 10:
            return text[: n - p * (count - 1)]
    return text


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=60), st.text("abc", min_size=1, max_size=9), st.integers(0, 30))
def test_loops_match_brute_force(head, unit, times):
    text = head + unit * times
    assert T.trim_loop(text, least=20) == brute_loop(text, 20)


def test_trimming_of_long_texts():
    assert T.trim_loop("x" * 9_000) == "xx" and T.trim_loop(None) is None
    body = "".join(chr(97 + i % 26) + str(i) for i in range(2_000))
    assert T.trim_pattern(body + "0123456789" * 400).endswith("0123456789") and len(T.trim_pattern(body + "0123456789" * 400)) < len(body) + 20
    assert T.trim_pattern("short " * 5) == "short " * 5


# Numbers


def test_softmax_and_times(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([1000.0, 0.0, 0.0],)], "z array<double>")
    for r in df.select(N.softmax(F.col("z")).alias("p"), N.argmax(F.col("z")).alias("k"), "z").collect():
        assert math.isclose(sum(r["p"]), 1) and r["k"] == r["z"].index(max(r["z"]))
    times = spark.createDataFrame([(-1.0,), (0.0005,), (3_725.25,), (359_999.999,)], "s double").select(N.srt_time(F.col("s"))).collect()
    assert [r[0] for r in times] == ["00:00:00,000", "00:00:00,000", "01:02:05,250", "99:59:59,999"]
    assert one(spark, "x", N.list_mean(F.array().cast("array<double>"))) is None


def brute_resize(h, w, f=28, low=28 * 28 * 130, top=28 * 28 * 1280):
    if h < f:
        h, w = f, round(w * f / h)
    if w < f:
        h, w = round(h * f / w), f
    a, b = round(h / f) * f, round(w / f) * f
    if a * b > top:
        k = math.sqrt(h * w / top)
        return math.floor(h / k / f) * f, math.floor(w / k / f) * f
    if a * b < low:
        k = math.sqrt(low / (h * w))
        return math.ceil(h * k / f) * f, math.ceil(w * k / f) * f
    return a, b


def test_sizes(spark):
    rng = random.Random(5)
    sizes = [(rng.randint(5, 4_000), rng.randint(5, 4_000)) for _ in range(150)]
    df = spark.createDataFrame(sizes, "h int, w int")
    for r in df.select("h", "w", N.smart_resize(F.col("h"), F.col("w")).alias("s"), N.longest_side(F.col("w"), F.col("h"), 500).alias("l"), N.pixel_budget(F.col("w"), F.col("h"), 90_000).alias("p")).collect():
        if min(r["h"], r["w"]) >= 28:
            assert tuple(r["s"]) == brute_resize(r["h"], r["w"])
        assert max(r["l"]) <= max(500, 0) or max(r["l"]) == max(r["h"], r["w"])
        assert r["p"]["width"] * r["p"]["height"] <= 90_000
    assert N.pixel_expression(" 512 * 28*28") == 512 * 784
    with pytest.raises(ValueError):
        N.pixel_expression("__import__('os')")
    shown = spark.createDataFrame([(0,), (1_536,), (5 * 1024**3,)], "n long").select(N.readable_bytes(F.col("n"))).collect()
    assert [r[0] for r in shown] == ["0.0 B", "1.5 KB", "5.0 GB"]


# Judging


def test_ratings_keep_their_sum_and_order(spark):
    rng = random.Random(6)
    rows = [(k, a, b, rng.choice(["A", "B", "TIE"])) for k in range(80) for a, b in (("m0", "m1"), ("m0", "m2"), ("m1", "m2"))]
    df = spark.createDataFrame(rows, "sample_idx int, model_a string, model_b string, winner string").repartition(5)
    got = {r["model"]: r["elo"] for r in judging.elo(df).collect()}
    rating = dict.fromkeys(("m0", "m1", "m2"), 1500.0)
    for _, a, b, w in sorted(rows):
        e = 1 / (1 + 10 ** ((rating[b] - rating[a]) / 400))
        d = 32 * ({"A": 1, "B": 0}.get(w, 0.5) - e)
        rating[a] += d
        rating[b] -= d
    assert got == pytest.approx(rating, abs=1e-5) and math.isclose(sum(got.values()), 4_500, abs_tol=1e-4)


def test_jury_ties_go_to_the_first_vote(spark):
    rows = [(1, "a", "b", False, "j0", "B"), (1, "a", "b", False, "j1", "A"), (2, "a", "b", True, "j0", "TIE"), (2, "a", "b", True, "j1", "A"), (2, "a", "b", True, "j2", "A")]
    votes = spark.createDataFrame(rows, "sample_idx int, model_a string, model_b string, swapped boolean, judge string, vote string")
    got = {r["sample_idx"]: r for r in judging.unswapped(judging.jury(votes)).collect()}
    assert (got[1]["winner"], got[1]["agreement"]) == ("B", "1/2") and (got[2]["winner"], got[2]["agreement"]) == ("B", "2/3")


# Inference


class Shaky:
    columns = "label string, prob double"

    def predict(self, rows):
        if any(r["x"] is None for r in rows):
            raise RuntimeError("bad row")
        return [{"label": str(r["x"]), "prob": 0.5} for r in rows]


def test_a_bad_row_fails_alone(spark):
    df = spark.createDataFrame([(i, None if i == 7 else i) for i in range(20)], "id int, x int")
    got = inference.infer(df, Shaky(), ["x"], batch_size=8).collect()
    assert [(r["id"], r["label"]) for r in got] == [(i, None if i == 7 else str(i)) for i in range(20)]
    assert [r["id"] for r in got if r["error"]] == [7] and "bad row" in got[7]["error"]
    with pytest.raises(ValueError, match="no column"):
        inference.infer(df, Shaky(), ["y"])


def test_output_columns(spark):
    df = spark.createDataFrame([(None, "a", "b", "c")], "inference_info string, text string, ocr_x string, other string")
    assert inference.output_columns(df) == ["text", "ocr_x"]
    named = spark.createDataFrame([('[{"column_name": "other"}]', "a", "b", "c")], df.schema)
    assert inference.output_columns(named) == ["other"]


# Media


def brute_chunks(n, size=30, overlap=2):
    out, start = [], 0
    while n > 0:
        out.append((start, min(start + size, n)))
        if start + size >= n:
            break
        start += size - overlap
    return out


def test_chunks(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 29, 30, 31, 58, 59, 86, 500)], "n int")
    got = {}
    for r in media.chunks(df, F.col("n")).collect():
        got.setdefault(r["n"], []).append((r["start"], r["end"]))
    assert got == {n: brute_chunks(n) for n in (1, 29, 30, 31, 58, 59, 86, 500)}


def test_masks_pages_and_manifest(spark):
    assert media.combine_masks([b"\x01\x01\x00", b"\x00\x01\x00"], 3, 1) == b"\x01\x02\x00"
    masks = spark.createDataFrame([([bytearray(b"\x01\x00"), bytearray(b"\x01\x01")], 2, 1)], "m array<binary>, w int, h int")
    assert bytes(masks.select(media.segmentation_map(F.col("m"), F.col("w"), F.col("h")).alias("s")).first()["s"]) == b"\x02\x02"
    files = spark.createDataFrame([("a", bytearray(b"2")), ("b", bytearray(b"x"))], "path string, content binary")
    got = media.pages(files, lambda raw, zoom: [b"p"] * int(raw)).collect()
    assert [(r["path"], r["page"]) for r in got] == [("a", 0), ("a", 1), ("b", None)] and got[2]["error"]
    rows = spark.createDataFrame([("b.png", 5, 6), ("a.png", 3, 4)], "name string, width int, height int")
    made = json.loads(media.manifest(rows, "https://x.test/i/", "set"))
    assert [c["label"] for c in made["items"]] == ["a.png", "b.png"] and made["items"][0]["width"] == 3
    assert media.decode_data_uri(spark.createDataFrame([(bytearray(b"abc" * 50),)], "c binary").select(media.data_uri(F.col("c"))).first()[0]) == b"abc" * 50


def test_projection_keeps_what_differs_most(spark):
    rng = np.random.default_rng(1)
    x = np.outer(rng.normal(size=200), [3.0, 0, 0, 0]) + np.outer(rng.normal(size=200), [0, 2.0, 0, 0]) + rng.normal(size=(200, 4)) * 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = np.array([[r["x"], r["y"]] for r in atlas.projection(df, "id", "v").orderBy("id").collect()])
    assert abs(np.corrcoef(got[:, 0], x[:, 0])[0, 1]) > 0.99 and abs(np.corrcoef(got[:, 1], x[:, 1])[0, 1]) > 0.99


def test_neighbours_across_blocks(spark, monkeypatch):
    v, df = vectors(spark, 150)
    u = v.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    c = u @ u.T
    np.fill_diagonal(c, -3)
    monkeypatch.setattr(dedup.similarities, "__defaults__", (40,))
    got = {}
    for r in atlas.neighbours(df, "id", "v", 4).collect():
        got.setdefault(r["id"], [None] * 4)[r["rank"] - 1] = r["neighbour"]
    assert got == {i: np.argsort(-c[i], kind="stable")[:4].tolist() for i in range(150)}


def test_plan_facts(spark):
    from millrace.plans.explain import facts, plan

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars > 5").groupBy("lang").count()
    found = facts(df)
    assert not found["cartesian"] and not found["python"] and "GreaterThan(n_chars,5)" in found["pushed_filters"][0] and "text" not in found["read_schemas"][0]
    assert "HashAggregate" in plan(df)
    assert one(spark, "x", T.prompt("a {t} {t}", t=F.col("t"))) == "a x x"
    with pytest.raises(ValueError, match="names"):
        T.prompt("{nope}", t=F.col("t"))


def test_maps_pairs_and_entities(spark):
    df = spark.createDataFrame([([3, 1, 3, None],), ([],)], "a array<int>")
    assert [r[0] for r in df.select(N.text_keys(N.counter(F.col("a")))).collect()] == [{"3": 2, "1": 1}, {}]
    assert [[tuple(p) for p in r[0]] for r in df.select(N.pairs_of(F.slice("a", 1, 3))).collect()] == [[(3, 1), (3, 3), (1, 3)], []]
    found = spark.createDataFrame([([(1, 4, "abc", "x", None), (5, 6, "d", "y", 0.9)],)], "e array<struct<start:long,end:long,text:string,label:string,score:float>>")
    made = T.entities(F.col("e"))
    row = found.select(made.alias("all"), T.above(made, 0.5).alias("some"), T.above(made, 0).alias("every")).first()
    assert row["all"][0]["score"] == 0.0 and len(row["some"]) == 1 and len(row["every"]) == 2


def test_configs_side_by_side(spark):
    from millrace.sources.readers import zip_configs

    a = spark.createDataFrame([(1, "a1", "k"), (2, "a2", "l")], "id long, text string, extra string")
    b = spark.createDataFrame([(2, "b2")], "id long, text string")
    got = {r["id"]: r for r in zip_configs({"m0": a, "m1": b}, "id", "text").collect()}
    assert (got[1]["m0"], got[1]["m1"], got[1]["extra"]) == ("a1", None, "k") and got[2]["m1"] == "b2"


def test_command_line(spark, tmp_path, capsys):
    from millrace.__main__ import main

    assert main(["list"]) == 0 and "temporal_stats" in capsys.readouterr().out
    assert main(["run", "nothing", "x"]) == 2
    assert main(["run", "label_top", "/root/testdata/sf0.001", "--out", str(tmp_path / "o")]) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3
    assert main(["run", "label_top", "/root/testdata/sf0.001", "--explain"]) == 0
    assert "Exchange" in capsys.readouterr().out
