"""Derived views over the driver's tables that give every operator an input, in SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "corpus_docs": """
SELECT o.o_orderkey AS id,
       concat('CC-MAIN-', CAST(year(o.o_orderdate) AS STRING), '-', lpad(CAST(month(o.o_orderdate) AS STRING), 2, '0')) AS dump,
       CAST(floor(o.o_totalprice) AS BIGINT) AS token_count,
       array_agg(CAST(floor(l.l_quantity / 10) AS DOUBLE)) FILTER (WHERE l.l_quantity IS NOT NULL) AS fw_edu_scores
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderkey, o.o_orderdate, o.o_totalprice""",
    "boxes_a": """
SELECT l_orderkey AS image_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS ann_idx,
       CASE WHEN l_partkey % 211 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(l_partkey % 640 AS DOUBLE) END AS b0,
       CAST(l_suppkey % 480 AS DOUBLE) AS b1,
       CASE WHEN l_partkey % 193 = 0 THEN -1.0 * l_quantity ELSE l_quantity * 4 END AS b2,
       CAST(l_partkey % 97 AS DOUBLE) AS b3,
       CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN ' ' ELSE concat(l_returnflag, l_linestatus) END AS category,
       CAST(640 AS DOUBLE) AS width, CAST(480 AS DOUBLE) AS height
FROM lineitem""",
    "boxes_b": """
SELECT image_id, ann_idx, b0 + (ann_idx % 3) * 2 AS b0, b1, b2, b3,
       CASE WHEN ann_idx % 5 = 4 THEN 'CHANGED' ELSE category END AS category, width, height
FROM boxes_a WHERE image_id % 11 <> 0
UNION ALL
SELECT image_id + 10000000 AS image_id, ann_idx, b0, b1, b2, b3, category, width, height
FROM boxes_a WHERE image_id % 13 = 0""",
    "provenance": """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '[{"model_id":"m0","column_name":"text"}]' ELSE '{bad' END AS inference_info
FROM documents""",
    "llm_text": """
SELECT doc_id,
       CASE doc_id % 8
         WHEN 0 THEN concat(repeat(chr(96), 3), 'json', chr(10), '{"winner": "a", "n": ', CAST(doc_id AS STRING), '}', chr(10), repeat(chr(96), 3))
         WHEN 1 THEN concat('<think>plan ', lang, '</think>  ', text)
         WHEN 2 THEN concat('<think>x</think><answer>', text, '</answer>')
         WHEN 3 THEN concat('---', chr(10), 'primary_language: ', lang, chr(10), 'is_table: false', chr(10), '---', chr(10), text)
         WHEN 4 THEN concat('[{"bbox_2d": [10, 20, 500, ', CAST(doc_id % 1000 AS STRING), '], "label": "', source, '"}]')
         WHEN 5 THEN concat('{"bbox_2d": [1,2,3,4], "label": "t", }', ' tail')
         WHEN 6 THEN '{broken'
         ELSE text END AS raw
FROM documents""",
    "votes": """
SELECT d.doc_id AS sample_idx, a.m AS model_a, b.m AS model_b, j.j AS judge,
       CASE ascii(substr(md5(concat('42-', CAST(d.doc_id AS STRING), a.m, b.m, j.j)), 1, 1)) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'TIE' END AS vote,
       ascii(substr(md5(concat('swap-', CAST(d.doc_id AS STRING), a.m, b.m)), 1, 1)) % 2 = 1 AS swapped
FROM documents d
CROSS JOIN (SELECT 'm0' AS m UNION ALL SELECT 'm1' UNION ALL SELECT 'm2' UNION ALL SELECT 'm3') a
CROSS JOIN (SELECT 'm0' AS m UNION ALL SELECT 'm1' UNION ALL SELECT 'm2' UNION ALL SELECT 'm3') b
CROSS JOIN (SELECT 'j0' AS j UNION ALL SELECT 'j1' UNION ALL SELECT 'j2') j
WHERE a.m < b.m""",
    "stories": """
SELECT event_id AS id, props AS title, CASE WHEN event_id % 29 = 0 THEN NULL ELSE value END AS score, ts AS time,
       CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS type, user_id AS by_user
FROM events""",
    "works": """
SELECT p_partkey, p_name AS title,
       CASE WHEN p_partkey % 23 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN '[]' ELSE concat('["', p_type, '","', p_brand, '"]') END AS subjects
FROM part""",
}
#: Views that others stand on.
NEEDS = {"boxes_b": ("boxes_a",)}


def oracle(sql: str, *views: str) -> str:
    """SQL with the views it names in front."""
    names: list[str] = []
    for v in views:
        names += [x for x in (*NEEDS.get(v, ()), v) if x not in names]
    if not names:
        return sql
    head = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in names)
    body = sql.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(start):
            return f"{start}{head},\n{body[len(start):]}"
    return f"WITH {head}\n{body}"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view. Tables are registered under names of their own, so sessions can mix directories."""
    import re
    import zlib

    suffix = f"_{zlib.crc32(sf_dir.encode()):08x}"
    for needed in NEEDS.get(name, ()):
        view(spark, sf_dir, needed).createOrReplaceTempView(needed + suffix)
    sql = VIEWS[name]
    if name == "llm_text":
        sql = sql.replace("concat(", "concat_ws('', ")  # DuckDB's concat leaves nulls out, Spark's is null with one
    for t in (*TABLES, *NEEDS.get(name, ())):
        if re.search(rf"\b(FROM|JOIN) {t}\b", sql):
            if t in TABLES:
                read(spark, sf_dir, t).createOrReplaceTempView(t + suffix)
            sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {t}{suffix}", sql)
    return spark.sql(sql)


def nested_boxes(rows: DataFrame) -> DataFrame:
    """A row for each image, with arrays of boxes and categories in the order of ann_idx."""
    box = F.struct("ann_idx", F.array("b0", "b1", "b2", "b3").alias("bbox"), "category")
    one = rows.groupBy("image_id").agg(F.array_sort(F.collect_list(box), lambda x, y: (x["ann_idx"] - y["ann_idx"]).cast("int")).alias("o"), F.max("width").alias("width"), F.max("height").alias("height"))
    return one.select("image_id", F.transform("o", lambda o: o["bbox"]).alias("bbox"), F.transform("o", lambda o: o["category"]).alias("category"), "width", "height")


def images(spark: SparkSession, sf_dir: str, version: str = "a") -> DataFrame:
    return nested_boxes(view(spark, sf_dir, f"boxes_{version}"))
