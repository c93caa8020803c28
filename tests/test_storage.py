import io
import json
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import readers, sinks
from millrace.streaming import windows


def test_readers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, t string")
    df.write.parquet(str(tmp_path / "x.parquet"))
    df.write.json(str(tmp_path / "x.jsonl"))
    df.write.option("header", True).csv(str(tmp_path / "x.csv"))
    for name in ("x.parquet", "x.jsonl", "x.csv"):
        assert sorted(tuple(r) for r in readers.load(spark, str(tmp_path / name)).select("id", "t").collect()) == [(1, "a"), (2, "b")]
    both = readers.load(spark, str(tmp_path / "x.parquet"), str(tmp_path / "x.jsonl"))
    assert both.count() == 4
    assert readers.load(spark, str(tmp_path / "x.parquet"), columns=["id"]).columns == ["id"]
    assert readers.load(spark, str(tmp_path / "x.parquet"), recursive=True, fmt="parquet").count() == 2
    with pytest.raises(ValueError, match="no path"):
        readers.load(spark)


def test_shards_partitions_and_listing(spark, tmp_path):
    for k in range(5):
        (tmp_path / "d").mkdir(exist_ok=True)
        (tmp_path / "d" / f"s{k}.PNG").write_bytes(b"x" * (k + 1))
    (tmp_path / "d" / "note.txt").write_text("x")
    glob = str(tmp_path / "d" / "*.PNG")
    assert len(readers.shards(spark, glob)) == 5
    assert readers.shards(spark, glob, 2) == readers.shards(spark, glob, 2) and len(readers.shards(spark, glob, 2)) == 2
    with pytest.raises(FileNotFoundError):
        readers.shards(spark, str(tmp_path / "none*"))
    assert readers.partitions(spark, str(tmp_path)) == ["d"]
    assert readers.partitions(spark, str(tmp_path / "no"), ("en",)) == ["en"]
    assert readers.listing(spark, str(tmp_path / "d"), "s[12]*", ("png",)).count() == 2
    pinned = readers.snapshot(spark, str(tmp_path / "d"), str(tmp_path / "pin"), ("png",))
    (tmp_path / "d" / "s9.png").write_bytes(b"y")
    assert pinned.count() == 5 and readers.snapshot(spark, str(tmp_path / "d"), str(tmp_path / "pin"), ("png",)).count() == 5


def test_zip_and_template(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "z.parquet"))
    part = next((tmp_path / "z.parquet").glob("part-*"))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.write(part, "data/a.parquet")
        z.writestr("readme.txt", "x")
    assert readers.zipped(spark, held.getvalue(), str(tmp_path / "out")).count() == 3
    (tmp_path / "t.json").write_text('{"a": "string"}')
    assert readers.template(str(tmp_path / "t.json")) == readers.template('{"a": "string"}') == {"a": "string"}
    with pytest.raises(ValueError, match="template"):
        readers.template("{nope")


def test_resume_adds_each_row_once(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") % 10 == 0, "failed").alias("error"))
    sinks.append_shards(df.where("id < 40"), path, "id", max_rows=7)
    sinks.append_shards(df, path, "id")
    sinks.append_shards(df, path, "id")
    assert spark.read.parquet(path).count() == 100
    sinks.append_shards(df, path, "id", retry_failed=True)
    assert spark.read.parquet(path).count() == 110
    with pytest.raises(ValueError, match="schema"):
        sinks.append_shards(df.withColumn("more", F.lit(1)), path, "id")


def test_run_metadata(spark, tmp_path):
    path = str(tmp_path / "run")
    assert not sinks.check_run(spark, path, {"model": "a", "time": 1}, ("model",))
    assert sinks.check_run(spark, path, {"model": "a", "time": 2}, ("model",))
    with pytest.raises(ValueError, match="another run"):
        sinks.check_run(spark, path, {"model": "b", "time": 2}, ("model",))


def test_batches_files_and_guard(spark, tmp_path):
    got = {r["id"]: r["batch"] for r in sinks.batch_numbers(spark.range(100).repartition(6), "id", 16).collect()}
    assert got == {i: i // 16 for i in range(100)}
    pages = spark.createDataFrame([("a/p1.png", "# one"), ("p2", None)], "name string, md string")
    assert sinks.text_files(pages, f"file://{tmp_path}/md", "name", "md") == 2
    assert (tmp_path / "md/a/p1.md").read_text() == "# one" and (tmp_path / "md/p2.md").read_text() == ""
    ours, theirs = spark.createDataFrame([("a",)], "name string"), spark.createDataFrame([("a",), ("b",)], "name string")
    sinks.guard_superset(theirs, ours)
    with pytest.raises(ValueError, match="missing"):
        sinks.guard_superset(ours, theirs)


def test_retries_and_reports(spark, tmp_path):
    waits, calls = [], []

    def write():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("down")
        return "done"

    assert sinks.with_retries(write, sleep=waits.append) == "done" and waits == [30.0, 60.0]
    assert sinks.with_retries(lambda: 1 / 0, fallback=lambda: "local", sleep=waits.append) == "local"
    assert sinks.replace(spark.range(3), str(tmp_path), config="m1", staging=True).endswith("/m1/_staging")
    sinks.report(spark.range(1), str(tmp_path / "r"))
    assert "tags:" in sinks.card("Set", {"rows": 3}, ("ocr",))


def test_stream_equals_table(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.orderBy("ts").coalesce(1).write.parquet(source)
    stream = windows.event_time(windows.read_stream(spark, source, events.schema), late="1 hour")
    windows.run_available(windows.first_of_key(stream, ["user_id", "event_type"]), out, str(tmp_path / "c1"))
    assert spark.read.parquet(out).count() == events.select("user_id", "event_type").distinct().count()
    windows.run_available(windows.tumbling(stream, "1 day", ["event_type"]), str(tmp_path / "w"), str(tmp_path / "c2"))
    closed = spark.read.parquet(str(tmp_path / "w"))
    whole = windows.tumbling(windows.event_time(events), "1 day", ["event_type"])
    assert closed.count() > 0 and closed.select("start", "event_type", "n").exceptAll(whole.select("start", "event_type", "n")).isEmpty()
    seen = []
    windows.run_batches(windows.read_stream(spark, source, events.schema), lambda frame, number: seen.append((number, frame.count())), str(tmp_path / "c3"))
    assert sum(n for _, n in seen) == events.count()


def test_entry_point_without_the_text_operators():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "millrace.llm") or name.startswith("millrace.llm."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert e.queries() and set(e.oracle_sql()) <= set(e.queries()) and not any(k.startswith("op1") for k in e.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True)
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_plans_push_down(spark):
    from millrace.operators.stats import long_documents

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = long_documents(docs.withColumnsRenamed({"n_chars": "token_count", "source": "extractor"}).withColumn("page_average_lid_score", F.lit(1.0)), extractor="src0", columns=("doc_id",))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n_chars" in plan and "text" not in plan.split("ReadSchema")[1]
    assert json.loads('{"ok": true}')["ok"]
