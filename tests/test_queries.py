"""Every registered query with an oracle against DuckDB, on the smallest tables."""

import glob
import math
import os

import duckdb
import numpy as np
import pytest

from millrace.plans.fixtures import TABLES
from millrace.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(x):
    if isinstance(x, np.ndarray):
        return [plain(y) for y in x.tolist()]
    if isinstance(x, (float, np.floating)):
        return None if math.isnan(x) else round(float(x), 6) + 0.0
    return int(x) if isinstance(x, (np.integer, bool, np.bool_)) else x


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(plain(x) for x in r)) for r in frame.where(frame.notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, duck, name):
    got, wanted = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_others_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_all_tables_are_there():
    assert all(os.path.exists(f"{SF}/{t}.parquet") for t in TABLES)
