"""Registered queries: name → (Spark builder, SQL oracle or None).

Every builder takes ``(spark, sf_dir)``, reads the test tables (or data
Spark derives from them) and returns a DataFrame whose column names equal
those of its SQL oracle.  Importing the sub-modules fills ``REGISTRY``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.semantics import SQL_ROUND_SIG, round_outputs
from ..session import apply_defaults

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None, rounded: bool = True):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            df = fn(spark, sf_dir)
            return round_outputs(df) if rounded else df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = (run, sql.strip() if sql else None)
        return run
    return deco


def _schemas() -> dict:
    import json
    import os
    p = os.path.join(os.path.dirname(__file__), "schemas.json")
    return json.load(open(p)) if os.path.exists(p) else {}


def _quote(c: str) -> str:
    return '"' + c.replace('"', '""') + '"'


def normalized_sql(name: str, sql: str, schema: list | None) -> str:
    """Wrap an oracle so its output follows the Spark result's declared types:
    doubles rounded to 8 significant digits, integers as BIGINT (as ``round_outputs``)."""
    if not schema:
        return sql
    cols = []
    for c, t in schema:
        q = _quote(c)
        if t in ("double", "float") or t.startswith("decimal"):
            x = f"CAST({q} AS DOUBLE)"
            cols.append(SQL_ROUND_SIG.format(x=x, k=7) + f" AS {q}")
        elif t in ("bigint", "int", "smallint", "tinyint"):
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        else:
            cols.append(q)
    return "SELECT " + ", ".join(cols) + " FROM (\n" + sql + "\n) AS oracle_q"


def oracle_sqls() -> dict:
    reg = load_all()
    sch = _schemas()
    return {n: normalized_sql(n, sql, sch.get(n)) for n, (_f, sql) in reg.items() if sql}


def load_all() -> dict:
    from . import (aggregation, basket, embedding, encoding, io, modeling, relational,  # noqa: F401
                   screening, text, timeseries, vocabulary)
    return REGISTRY
