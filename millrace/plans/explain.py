"""What a plan does, for people and for tests."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan(df: DataFrame, mode: str = "formatted") -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def facts(df: DataFrame) -> dict[str, object]:
    """Exchanges, joins that multiply rows, Python steps, filters and columns that reach the scans."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return {
        "exchanges": len(re.findall(r"\bExchange\b", text)),
        "cartesian": bool(re.search("CartesianProduct", text)),
        "python": bool(re.search("Python|Pandas|InArrow", text)),
        "pushed_filters": re.findall(r"PushedFilters: \[([^\]]*)\]", text),
        "read_schemas": re.findall(r"ReadSchema: struct<([^\n]*)>", text),
    }
