"""Batched inference: a pluggable predictor adds columns, failures keep their row, provenance is recorded.

A predictor is anything with ``columns`` (a DDL string of what it adds) and ``predict(rows)``, which takes a list of
row dictionaries and gives a list of dictionaries of the same length. It may have ``open()``, called once in each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.texts import append_provenance, provenance


class Predictor(Protocol):
    columns: str

    def predict(self, rows: list[dict[str, Any]]) -> list[dict[str, Any]]: ...


@dataclass
class FunctionPredictor:
    """A predictor from a plain function of one row."""

    columns: str
    of_row: Callable[[dict[str, Any]], dict[str, Any]]

    def predict(self, rows: list[dict[str, Any]]) -> list[dict[str, Any]]:
        return [self.of_row(r) for r in rows]


def infer(df: DataFrame, predictor: Predictor, inputs: list[str], batch_size: int = 32, error: str = "error", alone: bool = True, stand_in: dict[str, Any] | None = None) -> DataFrame:
    """``df`` with the predictor's columns and ``error`` (null where it worked).

    Only ``inputs`` are handed to the predictor. A batch that fails is tried again row by row, so a bad row fails
    alone: its new columns are null and ``error`` says why; without ``alone`` the whole batch fails. With ``stand_in`` a row
    that failed is tried once more with these inputs in place of its own. Order and all columns of ``df`` are kept.
    """
    missing = [c for c in inputs if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}; there are {', '.join(df.columns)}")
    added = StructType.fromDDL(predictor.columns)
    clash = [n for n in [*added.names, error] if n in df.columns]
    df = df.drop(*clash)
    schema = StructType([*df.schema.fields, *added.fields, *StructType.fromDDL(f"{error} string").fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    new = to_arrow_schema(StructType([*added.fields, *StructType.fromDDL(f"{error} string").fields]))

    def attempt(rows: list[dict]) -> list[dict]:
        try:
            made = predictor.predict(rows)
            if len(made) != len(rows):
                raise ValueError(f"{len(made)} results for {len(rows)} rows")
            return [m | {error: None} for m in made]
        except Exception as e:
            if len(rows) > 1 and alone:
                return [out for r in rows for out in attempt([r])]
            said = f"{type(e).__name__}: {e}"[:500]
            return [replaced(r, said) if stand_in else {error: said} for r in rows]

    def replaced(row: dict, said: str) -> dict:
        try:
            return predictor.predict([row | (stand_in or {})])[0] | {error: said}
        except Exception:
            return {error: said}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if hasattr(predictor, "open"):
            predictor.open()
        for batch in batches:
            rows = batch.select(inputs).to_pylist()
            made = [m for i in range(0, len(rows), batch_size) for m in attempt(rows[i : i + batch_size])]
            columns = [pa.array([m.get(f.name) for m in made], f.type) for f in new]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *new.names])

    return df.mapInArrow(run, schema)


def with_provenance(df: DataFrame, column: str, **entry: str) -> DataFrame:
    """One entry more in the JSON list of ``column``, which is made if it isn't there."""
    held = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumn(column, append_provenance(held, F.struct(*(F.lit(v).alias(k) for k, v in sorted(entry.items())))))


def output_columns(df: DataFrame, info: str = "inference_info") -> list[str]:
    """Text columns made by models: those that the first row's provenance names, else those with a telling name."""
    if info in df.columns:
        first = df.where(F.col(info).isNotNull()).select(F.expr(f"transform(from_json({info}, 'array<map<string,string>>'), m -> m['column_name'])").alias("c")).limit(1).collect()
        named = [c for c in (first[0]["c"] or [] if first else []) if c in df.columns]
        if named:
            return list(dict.fromkeys(named))
    return [c for c, t in df.dtypes if t == "string" and (c == "text" or "markdown" in c.lower() or "ocr" in c.lower())]


def model_names(df: DataFrame, info: str = "inference_info") -> dict[str, str]:
    """The model of each output column by the first row's provenance; a model of several columns is told apart by its short name and
    the column. A column without provenance is its own model."""
    columns = output_columns(df, info)
    models: dict[str, str] = {}
    if info in df.columns:
        for r in df.where(F.col(info).isNotNull()).select(provenance(F.col(info)).alias("p")).limit(1).collect():
            for m in r["p"]:
                if m.get("column_name") in columns:
                    models[m["column_name"]] = m.get("model_id") or m.get("model_name") or "unknown"
    named = {c: models.get(c, c) for c in columns}
    often = [m for m in named.values()]
    return {c: f"{m.rpartition('/')[2]} ({c})" if often.count(m) > 1 else m for c, m in named.items()}


class Classifier:
    """Class scores from a function of a row, as label, its probability and its number: softmax and the first largest."""

    columns = "label string, prob double, label_id int"

    def __init__(self, scores: Callable[[dict[str, Any]], list[float]], names: dict[int, str]):
        self.scores, self.names = scores, names

    def predict(self, rows: list[dict[str, Any]]) -> list[dict[str, Any]]:
        import math

        out = []
        for r in rows:
            z = self.scores(r)
            top = max(range(len(z)), key=lambda k: (z[k], -k))
            prob = 1.0 / sum(math.exp(v - z[top]) for v in z)
            out.append({"label": self.names.get(top, f"#{top}"), "prob": prob, "label_id": top})
        return out


def task_prompt(task: Column, prompts: dict[str, str], default: str) -> Column:
    """The prompt of each row's task; an unknown or null task has the default's."""
    if default not in prompts:
        raise ValueError(f"no prompt for {default!r}; there are {', '.join(prompts)}")
    table = F.create_map(*(F.lit(x) for k, v in prompts.items() for x in (k, v)))
    return F.coalesce(table[task], F.lit(prompts[default]))


def detection_totals(df: DataFrame, detections: str = "detections", label: str = "label") -> DataFrame:
    """One row: rows, detections, rows with any, the most in a row."""
    n = F.greatest(F.size(F.coalesce(detections, F.array().cast(df.schema[detections].dataType))), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(n), F.lit(0)).alias("detections"), F.count_if(n > 0).alias("rows_with_any"), F.coalesce(F.max(n), F.lit(0)).alias("most"))


def of_class(detections: Column, classes: list[str], threshold: float = 0.0) -> Column:
    """Detections of the wanted classes (case apart) with a score of the threshold at least."""
    wanted = F.array(*(F.lit(c.lower()) for c in classes))
    return F.filter(detections, lambda d: F.array_contains(wanted, F.lower(d["label"])) & (F.coalesce(d["score"], F.lit(0.0)) >= threshold))


def label_of(index: Column, names: dict[int, str]) -> Column:
    """The name of a class number, or #number."""
    if not names:
        return F.concat(F.lit("#"), index.cast("string"))
    table = F.create_map(*(F.lit(x) for k, v in sorted(names.items()) for x in (k, v)))
    return F.coalesce(table[index], F.concat(F.lit("#"), index.cast("string")))


def render_chat(turns: DataFrame, by: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(by, prompt): each conversation as tagged turns in their order, ready for an answer."""
    one = F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn), one.alias("s"))))
    return turns.groupBy(by).agg(F.concat(F.array_join(F.transform(ordered, lambda s: s["s"]), ""), F.lit("<|assistant|>\n")).alias("prompt"))


def answer_short_prompts(df: DataFrame, n_tokens: Column, most: int, answer: Column) -> DataFrame:
    """All rows; those with a prompt of more than ``most`` tokens have '' as their response."""
    return df.withColumn("response", F.when(n_tokens <= most, answer).otherwise(F.lit("")))


class EntityRules:
    """Named entities by patterns: a deterministic stand-in for a model, with the same output."""

    columns = "entities array<struct<start:int,end:int,text:string,label:string,score:double>>"

    def __init__(self, patterns: dict[str, str], text: str = "text", longest: int | None = None, threshold: float = 0.0):
        self.patterns, self.text, self.longest, self.threshold = patterns, text, longest, threshold

    def predict(self, rows: list[dict]) -> list[dict]:
        import re

        out = []
        for r in rows:
            t = (r[self.text] or "")[: self.longest]
            found = [(m.start(), m.end(), m.group(), label) for label, p in self.patterns.items() for m in re.finditer(p, t)]
            out.append({"entities": [{"start": a, "end": b, "text": s, "label": x, "score": 1.0} for a, b, s, x in sorted(found) if self.threshold <= 1.0]})
        return out
