"""Every registered query runs on sf0.001 and its SQL oracle agrees (DuckDB)."""
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tabloom.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"
FAST = os.environ.get("TABLOOM_FULL_TESTS") is None
SLOW = {"ml_top_coef", "em_train", "ml_oof", "ml_importance_table",
        "agg_importance", "ml_param_search", "fs_model_loop", "io_write_csv"}


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert "up_order_rate" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, con, name):
    if FAST and name in SLOW:
        pytest.skip("slow; set TABLOOM_FULL_TESTS=1")
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dk)
    assert c1 == c2
    assert r1 == r2


def test_every_query_has_callable():
    q = E.queries()
    assert len(q) >= 180
    assert set(E.oracle_sql()) <= set(q)
