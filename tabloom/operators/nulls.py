"""Filters, missing values and outliers."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .project import NUMERIC


def where(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(cond)


def drop_where(df: DataFrame, cond: Column) -> DataFrame:
    """Remove rows where ``cond`` is true; rows where it is NULL stay."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def _rule(c: Column, rule) -> Column:
    op, v = rule
    if op == ">":
        return c > F.lit(v)
    if op == ">=":
        return c >= F.lit(v)
    if op == "<":
        return c < F.lit(v)
    if op == "<=":
        return c <= F.lit(v)
    if op == "==":
        return c == F.lit(v)
    if op == "outside":
        lo, hi = v
        return (c < F.lit(lo)) | (c > F.lit(hi))
    raise ValueError(op)


def null_outliers(df: DataFrame, rules: Mapping[str, tuple]) -> DataFrame:
    """Value matching its rule → NULL, e.g. {"DAYS": (">", 0), "AMT": ("outside", (0, 1e6))}."""
    return df.withColumns({c: F.when(_rule(F.col(c), r), F.lit(None)).otherwise(F.col(c))
                           for c, r in rules.items()})


def null_sentinel(df: DataFrame, cols: Sequence[str], value=365243) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(value)) for c in cols})


def fill_by_type(df: DataFrame, numeric=None, text=None, cols: Sequence[str] | None = None) -> DataFrame:
    """``fillna`` with one value for numeric and one for string columns."""
    fill = {}
    for f in df.schema.fields:
        if cols is not None and f.name not in cols:
            continue
        if numeric is not None and isinstance(f.dataType, NUMERIC):
            fill[f.name] = numeric
        elif text is not None and isinstance(f.dataType, T.StringType):
            fill[f.name] = text
    return df.fillna(fill) if fill else df


def count_nulls_expr(cols: Sequence[str]) -> Column:
    e = F.lit(0)
    for c in cols:
        e = e + F.col(c).isNull().cast("int")
    return e


def count_nulls(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, count_nulls_expr(cols))


def null_flags(df: DataFrame, cols: Sequence[str], prefix: str = "no_na_") -> DataFrame:
    return df.withColumns({f"{prefix}{c}": F.col(c).isNull().cast("int") for c in cols})


def split_on_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(train, test): train has the target, test does not."""
    return df.where(F.col(target).isNotNull()), df.where(F.col(target).isNull())
