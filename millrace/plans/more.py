"""Registered queries of sources, sinks, functions and model operators: what is written is read back and compared in SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions import numbers as N
from ..functions import pictures
from ..functions import texts as T
from ..operators import annotations as A
from ..operators import dedup, inference, media, prep, sampling
from ..sources import readers, sinks
from ..sources.scratch import scratch
from ..streaming import windows
from .fixtures import images, read, view
from .registry import query

STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"

# Sources


@query("SELECT r_regionkey, r_name FROM region")
def source_load(spark, sf_dir):
    """A table by root, configuration and name."""
    root, _, config = sf_dir.rstrip("/").rpartition("/")
    return readers.table(spark, root, "region", config=config).select("r_regionkey", "r_name")


def written(df, name, fmt="parquet"):
    path = scratch(df.sparkSession, name)
    df.write.format(fmt).save(path)
    return path


@query("SELECT n_nationkey, n_name FROM nation")
def recursive_scan(spark, sf_dir):
    """All files of a format below a folder, however deep."""
    rows = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    root = scratch(spark, "tree")
    rows.where("n_nationkey % 2 = 0").write.parquet(f"{root}/a")
    rows.where("n_nationkey % 2 = 1").write.parquet(f"{root}/b/c")
    return readers.load(spark, root, fmt="parquet", recursive=True)


@query("SELECT n_nationkey, n_name FROM nation")
def shard_list(spark, sf_dir):
    """The shards that fit a glob, as one set."""
    root = scratch(spark, "shards")
    rows = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    for k in range(3):
        rows.where(F.col("n_nationkey") % 3 == k).write.json(f"{root}/part{k}")
    return readers.load(spark, *readers.shards(spark, f"{root}/part*"), fmt="json").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")


@query("SELECT r_name AS region FROM region")
def partition_list(spark, sf_dir):
    """Names of the partitions of a written set."""
    root = scratch(spark, "partitions")
    sinks.replace(read(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region")), root, by=["region"])
    names = [n.removeprefix("region=") for n in readers.partitions(spark, root) if n.startswith("region=")]
    return readers.from_rows(spark, [(n,) for n in names], "region string")


def region_files(spark, sf_dir):
    root = scratch(spark, "files")
    sinks.text_files(read(spark, sf_dir, "region").select(F.concat(F.col("r_name"), F.lit(".png")).alias("name"), F.concat(F.lit("# "), F.col("r_name")).alias("text")), root, "name", "text")
    return root


@query("SELECT concat(r_name, '.md') AS name, length(r_name) + 2 AS length FROM region")
def text_files(spark, sf_dir):
    """One text file for each row, as a listing finds them."""
    return media.files(spark, region_files(spark, sf_dir), ("md",), content=False).select("name", "length")


@query("SELECT concat(r_name, '.md') AS name FROM region WHERE r_name LIKE 'A%' AND r_name <> 'ASIA' ORDER BY 1 LIMIT 2")
def archive_listing(spark, sf_dir):
    """Files that fit a glob and an ending, without those that are there already, the first two by name."""
    found = readers.listing(spark, region_files(spark, sf_dir), "A*", ("md", "txt")).select("name")
    done = readers.from_rows(spark, [("ASIA.md",)], "name string")
    return sampling.take(sinks.remaining(found, done, "name"), "name", 2)


@query("SELECT concat(r_name, '.md') AS name FROM region")
def snapshot_listing(spark, sf_dir):
    """A pinned listing, unmoved by files that come later."""
    root, pin = region_files(spark, sf_dir), scratch(spark, "pin")
    readers.snapshot(spark, root, pin, ("md",))
    sinks.text_files(readers.from_rows(spark, [("later.x", "t")], "name string, text string"), root, "name", "text")
    return readers.snapshot(spark, root, pin, ("md",)).select("name")


@query("SELECT vec_id AS k, CAST(label AS BIGINT) AS a, CASE WHEN vec_id % 2 = 0 THEN CAST(label + 1 AS BIGINT) ELSE -1 END AS b FROM embeddings")
def zip_configs(spark, sf_dir):
    """Two configurations side by side by key, the first as base."""
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("k"), F.col("label").cast("long").alias("x"))
    return readers.zip_configs({"a": rows, "b": rows.where("k % 2 = 0").withColumn("x", F.col("x") + 1)}, "k", "x").fillna(-1, ["b"])


# Sinks


@query("SELECT doc_id, lang FROM documents")
def append_shards(spark, sf_dir):
    """Shards of two runs; the second skips what the first has done."""
    path = scratch(spark, "shards")
    rows = read(spark, sf_dir, "documents").select("doc_id", "lang")
    sinks.append_shards(rows.where("doc_id % 3 <> 0"), path, "doc_id", 100)
    sinks.append_shards(rows, path, "doc_id", 100)
    return spark.read.parquet(path)


@query("SELECT false AS first, true AS again, true AS refused")
def run_metadata(spark, sf_dir):
    """A run notes its settings, goes on under the same ones and refuses others."""
    path = scratch(spark, "run")
    notes = {"rows": read(spark, sf_dir, "region").count(), "model": "m"}
    first, again = (sinks.check_run(spark, path, notes, ("rows", "model")) for _ in range(2))
    try:
        sinks.check_run(spark, path, notes | {"model": "n"}, ("rows", "model"))
        refused = False
    except ValueError:
        refused = True
    return readers.from_rows(spark, [(first, again, refused)], "first boolean, again boolean, refused boolean")


@query("SELECT d.doc_id, coalesce(CAST(l.toxic AS BIGINT), -1) AS toxic, coalesce(CASE WHEN l.quality = 1 THEN 'good' END, '[]') AS layout FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def padded_results(spark, sf_dir):
    """All rows with their results, and defaults where there is none yet."""
    results = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("long").alias("toxic"), F.when(F.col("quality") == 1, "good").alias("layout"))
    return sinks.padded(read(spark, sf_dir, "documents").select("doc_id"), results, "doc_id", {"toxic": "-1L", "layout": "'[]'"})


@query("SELECT count(*) AS documents, count(DISTINCT lang) AS languages FROM documents")
def report_file(spark, sf_dir):
    """A report of one row, written as JSON and read back."""
    path = scratch(spark, "report")
    sinks.report(read(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("lang").alias("languages")), path)
    return spark.read.json(path)


@query("SELECT concat('---', chr(10), 'tags:', chr(10), '- made', chr(10), '---', chr(10), chr(10), '# Regions', chr(10), chr(10), '- **rows**: ', CAST(count(*) AS VARCHAR), chr(10)) AS card FROM region")
def dataset_card(spark, sf_dir):
    """The description of a set."""
    return readers.from_rows(spark, [(sinks.card("Regions", {"rows": read(spark, sf_dir, "region").count()}, ("made",)),)], "card string")


@query(
    """WITH f AS (SELECT conv_id, turn, trim(text) AS t, length(text) / 10.0 AS s, length(text) / 30.0 AS took FROM conversations WHERE text IS NOT NULL),
    g AS (SELECT conv_id, string_agg(t, chr(10) ORDER BY turn, t) AS text, count(*) AS segments, sum(s) AS s, sum(took) AS took FROM f GROUP BY 1)
    SELECT conv_id, text, segments, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS words, round(s, 2) AS seconds, round(s / nullif(took, 0), 1) AS realtime FROM g""".replace("\\\\", "\\")
)
def transcript_files(spark, sf_dir):
    """Whole transcripts with their words, length and how much faster than real time they were made."""
    return media.transcripts(read(spark, sf_dir, "conversations"), "conv_id", "turn", "text", F.length("text") / 10.0, F.length("text") / 30.0)


@query("SELECT conv_id, string_agg(concat(CAST(turn + 1 AS VARCHAR), chr(10), '00:00:0', CAST(turn AS VARCHAR), ',000 --> 00:00:0', CAST(turn + 1 AS VARCHAR), ',500', chr(10), trim(text), chr(10)), chr(10) ORDER BY turn, text) AS srt FROM conversations WHERE turn < 8 AND text IS NOT NULL GROUP BY 1")
def srt_files(spark, sf_dir):
    """Whole subtitle files."""
    turns = read(spark, sf_dir, "conversations").where("turn < 8 and text is not null")
    return media.srt_files(media.subtitles(turns, F.col("turn") + 1, F.col("turn"), F.col("turn") + 1.5, F.col("text")), "conv_id", "turn")


@query("SELECT conv_id, CAST(unnest(range(3)) AS INTEGER) AS segment, unnest(range(3)) * 10 AS start FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 2 = 0)")
def flatten_segments(spark, sf_dir):
    """A row for each segment of a list; files without any have none."""
    part = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.struct((k * 10).cast("long").alias("start")))
    rows = read(spark, sf_dir, "conversations").select("conv_id").distinct()
    return media.flattened(rows.withColumn("segments", F.when(F.col("conv_id") % 2 == 0, part)), "segments")


# Columns and texts


@query("SELECT doc_id, upper(lang) AS text FROM documents")
def replace_column(spark, sf_dir):
    """A result takes the place of the column of its name."""
    rows = read(spark, sf_dir, "documents").select("doc_id", "text", F.upper("lang").alias("result"))
    return prep.replace_column(rows, "result", "text")


SCORED = "list_transform(CAST(embedding[1:6] AS DOUBLE[]), lambda x, i: {'label': concat('L', CAST(i % 3 AS VARCHAR)), 'score': x})"


def scored(spark, sf_dir):
    one = F.transform(F.slice("embedding", 1, 6), lambda x, i: F.struct(F.concat(F.lit("L"), ((i + 1) % 3).cast("string")).alias("label"), x.cast("double").alias("score")))
    return read(spark, sf_dir, "embeddings").select("vec_id", one.alias("found"))


@query(f"SELECT vec_id, len(list_filter({SCORED}, lambda d: d.score >= 0.05)) AS n, len({SCORED}) AS n_all FROM embeddings")
def score_threshold(spark, sf_dir):
    """Detections above a threshold; none given leaves all."""
    return scored(spark, sf_dir).select("vec_id", F.size(T.above(F.col("found"), 0.05)).cast("long").alias("n"), F.size(T.above(F.col("found"), None)).cast("long").alias("n_all"))


@query(f"SELECT vec_id, len(list_filter({SCORED}, lambda d: d.score >= 0 AND d.label IN ('L1', 'L2'))) AS n FROM embeddings")
def detect_classes(spark, sf_dir):
    """Detections of wanted classes, case apart."""
    return scored(spark, sf_dir).select("vec_id", F.size(inference.of_class(F.col("found"), ["l1", "L2"])).cast("long").alias("n"))


@query(f"WITH n AS (SELECT len(list_filter({SCORED}, lambda d: d.score >= 0.1)) AS n FROM embeddings) SELECT count(*) AS rows, CAST(sum(n) AS BIGINT) AS detections, count(*) FILTER (WHERE n > 0) AS rows_with_any, max(n) AS most FROM n")
def detection_totals(spark, sf_dir):
    """Detections over all rows, and rows that have any."""
    rows = scored(spark, sf_dir).select(T.above(F.col("found"), 0.1).alias("detections"))
    return inference.detection_totals(rows).withColumns({c: F.col(c).cast("long") for c in ("detections", "most")})


@query(f"SELECT vec_id FROM embeddings WHERE len(list_filter({SCORED}, lambda d: d.score >= 0.2)) > 0 ORDER BY vec_id LIMIT 1")
def first_detected(spark, sf_dir):
    """The first row with any detection."""
    rows = scored(spark, sf_dir).withColumn("found", T.above(F.col("found"), 0.2))
    return sampling.first_with(rows, "vec_id", "found").select("vec_id")


@query("SELECT doc_id, left(coalesce(text, ''), 250) AS text FROM documents")
def clip_text(spark, sf_dir):
    """Texts of at most 250 signs, null as empty."""
    return read(spark, sf_dir, "documents").select("doc_id", T.clipped(F.col("text"), 250).alias("text"))


@query(f"SELECT doc_id, array_to_string(list_filter(list_transform(str_split(coalesce(text, ''), ','), lambda x: {STRIP.format('x')}), lambda x: x <> ''), '|') AS names FROM documents")
def class_list(spark, sf_dir):
    """Names between commas."""
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(T.class_list(F.col("text")), "|").alias("names"))


BEHIND = STRIP.format("substr(raw, strpos(raw, '</think>') + 8)")


@query(f"SELECT doc_id, CASE WHEN contains(raw, '</think>') THEN {BEHIND} ELSE {STRIP.format('raw')} END AS text FROM llm_text", "llm_text")
def after_thinking(spark, sf_dir):
    """What follows the thought; an unclosed one leaves all."""
    return view(spark, sf_dir, "llm_text").select("doc_id", T.after_thinking(F.col("raw")).alias("text"))


@query("SELECT doc_id, CAST(n_chars / 2 AS INTEGER) AS start, CAST(n_chars AS INTEGER) AS \"end\", left(coalesce(source, ''), 9) AS text, coalesce(lang, '') AS label, CASE WHEN doc_id % 2 = 0 THEN CAST(0.5 AS DOUBLE) ELSE 0 END AS score FROM documents WHERE n_chars % 2 = 0")
def entity_normalise(spark, sf_dir):
    """Entities of one shape; a missing score is 0."""
    one = F.struct((F.col("n_chars") / 2).alias("start"), F.col("n_chars").cast("string").alias("end"), F.left(F.coalesce("source", F.lit("")), F.lit(9)).alias("text"), F.coalesce("lang", F.lit("")).alias("label"), F.when(F.col("doc_id") % 2 == 0, "0.5").alias("score"))
    rows = read(spark, sf_dir, "documents").where("n_chars % 2 = 0").select("doc_id", T.entities(F.array(one)).alias("e"))
    return rows.select("doc_id", F.inline("e"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS n, CASE doc_id % 5 WHEN 2 THEN 'm0' WHEN 3 THEN 'm9' END AS first_model FROM documents")
def provenance_variants(spark, sf_dir):
    """Provenance as a list, a bare object, or nothing that can be read."""
    k = F.col("doc_id") % 5
    info = F.when(k == 1, "").when(k == 2, '[{"model_id":"m0"},{"model_id":"m1"}]').when(k == 3, ' {"model_id":"m9","image_size":"9x9"}').when(k == 4, "{bad")
    rows = read(spark, sf_dir, "documents").select("doc_id", T.provenance(info).alias("p"))
    return rows.select("doc_id", F.size("p").alias("n"), F.get("p", F.lit(0))["model_id"].alias("first_model"))


@query("SELECT unnest(['markdown', 'other']) AS column_name, unnest(['m (markdown)', 'm (other)']) AS model")
def model_names(spark, sf_dir):
    """Output columns and their models; a model of two columns is told apart."""
    rows = read(spark, sf_dir, "region").select(F.col("r_name").alias("markdown"), F.col("r_name").alias("other"))
    for c in rows.columns:
        rows = inference.with_provenance(rows, "inference_info", model_id="org/m", column_name=c)
    return readers.from_rows(spark, list(inference.model_names(rows).items()), "column_name string, model string")


@query("SELECT page_id, split_part(url, '/', -1) AS base, CASE WHEN url IS NULL THEN 'files' ELSE concat_ws('/', 'files', nullif(split_part(url, '/', -1), '')) END AS path FROM pages")
def base_names(spark, sf_dir):
    """The last part of a path, and a path put together from parts."""
    base = T.base_name(F.col("url"))
    return read(spark, sf_dir, "pages").select("page_id", base.alias("base"), T.url_of("files/", base, "").alias("path"))


@query("SELECT page_id, concat('https://h/', array_to_string(list_filter(str_split(regexp_extract(url, '://[^/]+/(.*)$', 1), '/')[1:2], lambda x: x <> ''), '/')) AS address FROM pages")
def url_parts(spark, sf_dir):
    """An address from a host and the first parts of a path."""
    parts = F.slice(F.split(F.regexp_extract("url", r"://[^/]+/(.*)$", 1), "/"), 1, 2)
    return read(spark, sf_dir, "pages").select("page_id", T.url_of("https://h/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))).alias("address"))


@query("SELECT p_partkey, array_to_string(list_transform(str_split(replace(replace(lower(p_name), '-', '_'), '_', ' '), ' '), lambda w: concat(upper(left(w, 1)), substr(w, 2))), ' ') AS title FROM part")
def titles_of_slugs(spark, sf_dir):
    """Titles from names with dashes."""
    return read(spark, sf_dir, "part").select("p_partkey", T.title_of_slug(F.regexp_replace(F.lower("p_name"), " ", "-")).alias("title"))


@query("SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN lang END AS allowed, CASE WHEN regexp_matches(source, '^src[0-3]$') THEN source END AS fits FROM documents")
def allowed_values(spark, sf_dir):
    """Values of a closed set, and values that fit a pattern."""
    return read(spark, sf_dir, "documents").select("doc_id", T.one_of(F.concat(F.lit(" "), F.col("lang")), ["en", "de"]).alias("allowed"), T.fits(F.concat(F.col("source"), F.lit("\n")), "src[0-3]").alias("fits"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '[FAILED]' ELSE lang END AS text, CASE WHEN doc_id % 3 = 0 THEN 'ValueError: no' END AS error FROM documents")
def placeholders(spark, sf_dir):
    """Rows that failed keep their error and get a marker at the end."""

    def of_row(r):
        if r["doc_id"] % 3 == 0:
            raise ValueError("no")
        return {"out": r["lang"]}

    done = inference.infer(read(spark, sf_dir, "documents").select("doc_id", "lang"), inference.FunctionPredictor("out string", of_row), ["doc_id", "lang"])
    return done.select("doc_id", T.placeholder(F.col("out")).alias("text"), "error")


TASKS = {"ocr": "Read all text.", "table": "Read the table.", "formula": "Read the formula."}


@query("SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN 'Read the table.' WHEN 2 THEN 'Read the formula.' ELSE 'Read all text.' END AS prompt FROM documents")
def task_prompts(spark, sf_dir):
    """Prompts by task; an unknown one has the default's."""
    task = F.element_at(F.array(F.lit("ocr"), F.lit("table"), F.lit("formula"), F.lit("song")), (F.col("doc_id") % 4 + 1).cast("int"))
    return read(spark, sf_dir, "documents").select("doc_id", inference.task_prompt(task, TASKS, "ocr").alias("prompt"))


@query("""WITH z AS (SELECT vec_id, list_transform(CAST(embedding[1:4] AS DOUBLE[]), lambda x: exp(x * 5)) AS e FROM embeddings), t AS (SELECT *, list_position(e, list_max(e)) - 1 AS k FROM z)
SELECT vec_id, CASE WHEN k < 3 THEN ['bad', 'fair', 'good'][k + 1] ELSE '#3' END AS label, round(list_max(e) / list_sum(e), 6) AS prob, CAST(k AS INTEGER) AS label_id FROM t""")
def classify_stub(spark, sf_dir):
    """Labels by a deterministic classifier through the inference operator."""
    model = inference.Classifier(lambda r: [x * 5 for x in r["v"]], {0: "bad", 1: "fair", 2: "good"})
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, 4).cast("array<double>").alias("v"))
    return inference.infer(rows, model, ["v"]).select("vec_id", "label", F.round("prob", 6).alias("prob"), "label_id")


# Boxes, numbers, maps


@query("SELECT DISTINCT image_id, '{\"from\":\"coco_xywh\",\"to\":\"xyxy\"}' AS conversion, 'kept' AS own FROM boxes_a", "boxes_a")
def conversion_note(spark, sf_dir):
    """Converted rows say so, unless they have a note of their own."""
    rows = images(spark, sf_dir)
    made = A.convert_boxes(rows, "coco_xywh", "xyxy").select("image_id", "conversion")
    kept = A.convert_boxes(rows.withColumn("conversion", F.lit("kept")), "coco_xywh", "xyxy").select("image_id", F.col("conversion").alias("own"))
    return made.join(kept, "image_id")


@query("SELECT p_partkey, p_partkey % 1500 <= 1001 AND greatest(p_partkey % 3000, 600) > 1001 AS legacy FROM part")
def legacy_boxes(spark, sf_dir):
    """Boxes of values up to 1000 in larger images."""
    box = F.array(*(F.lit(float(k)) for k in (1, 2, 3)), (F.col("p_partkey") % 1500).cast("double"))
    return read(spark, sf_dir, "part").select("p_partkey", B.looks_normalised(box, F.col("p_partkey") % 3000, F.lit(600)).alias("legacy"))


MASK = "CASE WHEN x > 0.2 THEN 3 WHEN x > 0.1 THEN 2 WHEN x > 0 THEN 1 ELSE 0 END"


@query(f"SELECT vec_id, array_to_string(list_transform(CAST(embedding AS DOUBLE[]), lambda x: {MASK}), '') AS map FROM embeddings")
def mask_combine(spark, sf_dir):
    """One map of instances from their masks, later ones on top."""
    mask = lambda least: F.unhex(F.array_join(F.transform("embedding", lambda x: F.when(x.cast("double") > least, "01").otherwise("00")), ""))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", media.segmentation_map(F.array(mask(0.0), mask(0.1), mask(0.2)), F.lit(8), F.lit(8)).alias("m"))
    return rows.select("vec_id", F.regexp_replace(F.hex("m"), "0(.)", "$1").alias("map"))


TRUTH = "b AS (SELECT image_id, coalesce(category, '<unknown>') AS c, b0, b1, b2, b3 FROM boxes_a WHERE NOT isnan(b0))"


@query(
    f"""WITH {TRUTH}, t AS (SELECT image_id, count(*) AS n_truth, count(*) FILTER (WHERE c = 'RF') AS truth_rf FROM b GROUP BY 1),
    p AS (SELECT image_id, count(*) AS n_predicted, count(*) FILTER (WHERE c = 'RF') AS predicted_rf, min(least(b0, b1, b2, b3)) AS least, max(greatest(b0, b1, b2, b3)) AS most FROM b WHERE b3 > 40 GROUP BY 1)
    SELECT t.image_id, n_truth, coalesce(n_predicted, 0) AS n_predicted, truth_rf, coalesce(predicted_rf, 0) AS predicted_rf, coalesce(least, 0) AS least, coalesce(most, 0) AS most FROM t LEFT JOIN p ON p.image_id = t.image_id""",
    "boxes_a",
)
def against_truth(spark, sf_dir):
    """What a model found beside what it should have, in one row."""
    sound = images(spark, sf_dir).select("image_id", F.filter(F.arrays_zip("bbox", "category"), lambda z: ~F.isnan(z["bbox"][0])).alias("z")).where(F.size("z") > 0)
    found = F.transform(F.filter("z", lambda z: z["bbox"][3] > 40), lambda z: F.struct(z["bbox"].alias("bbox"), F.coalesce(z["category"], F.lit("<unknown>")).alias("label")))
    rows = sound.select("image_id", F.col("z.bbox").alias("bbox"), F.col("z.category").alias("category"), found.alias("detections"))
    out = A.against_truth(rows)
    number = lambda c: F.coalesce(F.try_element_at(c, F.lit("RF")), F.lit(0)).cast("long")
    return out.select("image_id", "n_truth", "n_predicted", number("truth_labels").alias("truth_rf"), number("predicted_labels").alias("predicted_rf"), "least", "most")


SIDES = "SELECT p_partkey, 40 + p_partkey % 3000 AS w, 40 + p_partkey * 7 % 2500 AS h FROM part"


@query(f"WITH d AS ({SIDES}), s AS (SELECT *, least(1.0::DOUBLE, 1540.0 / greatest(w, h)) AS f, least(1.0::DOUBLE, sqrt(1000000 / (CAST(w AS DOUBLE) * h))) AS g FROM d) SELECT p_partkey, CAST(floor(w * f) AS INTEGER) AS width, CAST(floor(h * f) AS INTEGER) AS height, CAST(floor(w * g) AS INTEGER) AS budget_width, CAST(floor(h * g) AS INTEGER) AS budget_height FROM s")
def resize_sides(spark, sf_dir):
    """Sizes with a bounded longer side, and inside a pixel budget."""
    w, h = F.col("p_partkey") % 3000 + 40, F.col("p_partkey") * 7 % 2500 + 40
    rows = read(spark, sf_dir, "part").select("p_partkey", N.longest_side(w, h, 1540).alias("s"), N.pixel_budget(w, h, 1_000_000).alias("b"))
    return rows.select("p_partkey", "s.width", "s.height", F.col("b.width").alias("budget_width"), F.col("b.height").alias("budget_height"))


@query("SELECT 28 * 28 * 1280 AS pixels, count(*) AS refused FROM (SELECT unnest(['2+3', '__import__', '2**3', '']))")
def pixel_expression(spark, sf_dir):
    """Products of whole numbers; anything else is refused, nothing is evaluated."""
    refused = 0
    for text in ("2+3", "__import__", "2**3", ""):
        try:
            N.pixel_expression(text)
        except ValueError:
            refused += 1
    return readers.from_rows(spark, [(N.pixel_expression("28 * 28 * 1280"), refused)], "pixels int, refused long")


@query("""WITH n AS (SELECT o_orderkey, 2 * CAST(floor(o_totalprice) AS BIGINT) * (1 + o_orderkey % 5000) + 1 AS n FROM orders)
SELECT o_orderkey, CASE WHEN n < 1024 THEN printf('%.1f B', CAST(n AS DOUBLE)) WHEN n < 1048576 THEN printf('%.1f KB', n / 1024.0::DOUBLE) WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576.0::DOUBLE) ELSE printf('%.1f GB', n / 1073741824.0::DOUBLE) END AS size, round(n * 8 / 1e6 / 2.5, 4) AS mbps FROM n""")
def readable_bytes(spark, sf_dir):
    """Sizes as people read them, and rates."""
    n = 2 * F.floor("o_totalprice").cast("long") * (F.col("o_orderkey") % 5000 + 1) + 1
    return read(spark, sf_dir, "orders").select("o_orderkey", N.readable_bytes(n).alias("size"), F.round(N.megabits_per_second(n, F.lit(2.5)), 4).alias("mbps"))


@query("SELECT image_id, coalesce(category, '<none>') AS category, count(*) AS n FROM boxes_a WHERE category IS NOT NULL GROUP BY ALL", "boxes_a")
def counter_map(spark, sf_dir):
    """How often each label stands in a row, as a map."""
    return images(spark, sf_dir).select("image_id", F.explode(N.counter(F.col("category"))).alias("category", "n"))


@query("SELECT vec_id, CAST(label AS VARCHAR) AS k, concat('class-', CAST(label AS VARCHAR)) AS name FROM embeddings")
def text_keys(spark, sf_dir):
    """Maps with whole numbers as keys get texts as keys."""
    rows = read(spark, sf_dir, "embeddings")
    named = N.text_keys(F.create_map(F.col("label"), F.concat(F.lit("class-"), F.col("label").cast("string"))))
    return rows.select("vec_id", F.explode(named).alias("k", "name"))


@query("SELECT p_partkey, coalesce(nullif(CAST(p_partkey % 3 AS DOUBLE), 0), 1) AS width, coalesce(CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) END, 1) AS height FROM part")
def size_fallback(spark, sf_dir):
    """Missing or zero sizes count as 1."""
    return read(spark, sf_dir, "part").select("p_partkey", B.size_or_one(F.col("p_partkey") % 3).alias("width"), B.size_or_one(F.when(F.col("p_partkey") % 2 == 0, F.col("p_size"))).alias("height"))


CHECKED = "SELECT l_orderkey AS image_id, l_linenumber AS n, l_partkey AS p FROM lineitem WHERE l_linenumber <= 4"


@query(
    f"""WITH r AS (SELECT DISTINCT image_id, n FROM ({CHECKED}))
    SELECT image_id, n, 'error' AS level, 'E001' AS code, -1 AS ann_idx FROM r WHERE n = 1 UNION ALL SELECT image_id, n, 'error', 'E002', 0 FROM r WHERE n IN (1, 2)
    UNION ALL SELECT image_id, n, 'warning', 'W001', -1 FROM r WHERE n = 3"""
)
def bbox_validate_shapes(spark, sf_dir):
    """Issues of rows without boxes, with short boxes, or with fewer categories than boxes."""
    rows = read(spark, sf_dir, "lineitem").where("l_linenumber <= 4").select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("n")).distinct()
    box = lambda *v: F.array(*(F.lit(float(x)) for x in v))
    empty = F.array().cast("array<array<double>>")
    boxes = F.when(F.col("n") == 1, F.array(box(1, 2), box(1, 2, 3, 4))).when(F.col("n") == 2, F.array(box(1, 2, 3))).when(F.col("n") == 4, F.array(box(1, 2, 3, 4))).otherwise(empty)
    names = F.when(F.col("n") == 3, F.array().cast("array<string>")).otherwise(F.array(F.lit("a")))
    keyed = rows.select(F.struct("image_id", "n").alias("image_id"), boxes.alias("bbox"), names.alias("category"), F.lit(99.0).alias("width"), F.lit(99.0).alias("height"))
    return A.validate(keyed).select("image_id.image_id", "image_id.n", "level", "code", F.coalesce("ann_idx", F.lit(-1)).alias("ann_idx"))


# Vectors and pictures

COSINE = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


@query(f"SELECT a.vec_id AS a, b.vec_id AS b, round({COSINE}, 6) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {COSINE} >= 0.4")
def similar_hashed(spark, sf_dir):
    """Pairs of similar vectors by random hyperplanes."""
    found = dedup.hashed_pairs(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.4, bits=4, recall=0.999_999)
    return found.withColumn("cosine", F.round("cosine", 6))


def small_pictures(spark, sf_dir):
    """A PNG of 12 x 8 RGB pixels for each region, of one colour that its key gives."""

    def make(batches):
        for batch in batches:
            batch["content"] = [pictures.encode_png(np.full((8, 12, 3), (k * 10, k * 20, k * 30), np.uint8)) for k in batch["r_regionkey"]]
            yield batch

    return read(spark, sf_dir, "region").select("r_regionkey", "r_name").mapInPandas(make, "r_regionkey int, r_name string, content binary")


@query("SELECT r_regionkey, r_name, 6 AS width, 4 AS height, CAST(floor((r_regionkey * (10 * 19595 + 20 * 38470 + 30 * 7471) + 32768) / 65536) AS INTEGER) AS grey, CAST(NULL AS VARCHAR) AS error FROM region WHERE r_regionkey > 0 UNION ALL SELECT r_regionkey, r_name, -1, -1, -1, 'ValueError: not a PNG' FROM region WHERE r_regionkey = 0")
def encode_images(spark, sf_dir):
    """Pictures in grey, half as large, as data URIs; what can't be read keeps its row."""
    rows = small_pictures(spark, sf_dir).withColumn("content", F.when(F.col("r_regionkey") == 0, F.lit(b"no picture")).otherwise(F.col("content")))
    made = media.encoded(rows, longest=6, as_grey=True).drop("content")

    def look(batches):
        for batch in batches:
            batch["grey"] = [-1 if u is None else int(pictures.decode_png(media.decode_data_uri(u))[0, 0, 0]) for u in batch["uri"]]
            yield batch[["r_regionkey", "r_name", "width", "height", "grey", "error"]].fillna({"width": -1, "height": -1})

    return made.mapInPandas(look, "r_regionkey int, r_name string, width int, height int, grey int, error string")


@query("SELECT r_name AS name, s.scale, s.x, s.y, s.w, s.h FROM region, (VALUES (1,0,0,8,8),(1,8,0,4,8),(2,0,0,12,8)) s(scale, x, y, w, h)")
def image_tiles(spark, sf_dir):
    """Tiles of a pyramid, cut from pictures."""
    return media.tiles(small_pictures(spark, sf_dir).withColumnRenamed("r_name", "name"), 8).drop("content")


# Streams


def event_shards(spark, sf_dir):
    """The events as four files, which a stream reads two at a time, in a folder of their own."""
    root = scratch(spark, "events")
    read(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("double").alias("value")).repartition(4, "event_id").write.parquet(root)
    return root, spark.read.parquet(root).schema


@query("SELECT user_id, count(*) AS n, round(coalesce(sum(value), 0), 4) AS total, round(max(value), 4) AS most FROM events GROUP BY 1")
def stream_running(spark, sf_dir):
    """Counts, sums and maxima by user, kept as state over the micro-batches of a stream."""
    root, schema = event_shards(spark, sf_dir)
    updates = windows.running(windows.read_stream(spark, root, schema, 2), "user_id", "value")
    out = windows.latest(spark, updates, scratch(spark, "running"), scratch(spark, "running-checkpoint"), "user_id")
    return out.withColumns({"total": F.round("total", 4), "most": F.round("most", 4)})


@query("SELECT DISTINCT event_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Each event once, though the stream brings some twice, within a watermark."""
    root, schema = event_shards(spark, sf_dir)
    spark.read.parquet(root).where("event_id % 2 = 0").write.mode("append").parquet(root)
    stream = windows.event_time(windows.read_stream(spark, root, schema, 2), late="3650 days")
    path = scratch(spark, "once")
    windows.run_available(windows.first_of_key(stream, ["event_id"]).select("event_id", "event_type"), path, scratch(spark, "once-checkpoint"))
    return spark.read.parquet(path)


@query("SELECT event_id, value FROM events")
def stream_incremental(spark, sf_dir):
    """A second run of a stream goes on where the first one ended."""
    root, schema = event_shards(spark, sf_dir)
    later = spark.read.parquet(root).where("event_id % 10 = 0")
    path, first, checkpoint = scratch(spark, "out"), scratch(spark, "in"), scratch(spark, "out-checkpoint")
    for rows in (spark.read.parquet(root).where("event_id % 10 <> 0"), later):
        rows.write.mode("append").parquet(first)
        windows.run_available(windows.read_stream(spark, first, schema).select("event_id", "value"), path, checkpoint)
    return spark.read.parquet(path)
