"""Projection and derived columns."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import col_

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def cols_of(df: DataFrame, kind: str) -> list[str]:
    """Column names by kind: 'numeric', 'text', 'timestamp'."""
    if kind == "numeric":
        return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    if kind == "text":
        return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if kind == "timestamp":
        return [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
    raise ValueError(kind)


def select_by_type(df: DataFrame, kind: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[c for c in cols_of(df, kind) if c not in keep])


def agg_name(prefix: str, col: str, stat: str) -> str:
    """Flattened two-level name ``PREFIX + col + '_' + STAT``."""
    return f"{prefix}{col}_{stat.upper()}"


def flatten_names(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def derive(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add derived columns (differences, ratios, products) in one projection."""
    return df.withColumns(dict(exprs))


def _present(cols):
    return F.filter(F.array(*[col_(c).cast("double") for c in cols]), lambda x: x.isNotNull())


def row_mean(cols) -> Column:
    """Row-wise mean over the non-NULL values of ``cols`` (NULL if none)."""
    a = _present(cols)
    return F.try_divide(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x), F.size(a).cast("double"))


def row_std(cols) -> Column:
    """Row-wise sample standard deviation (ddof=1) over non-NULL values."""
    a = _present(cols)
    n = F.size(a).cast("double")
    m = F.try_divide(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x), n)
    ss = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m))
    return F.when(n > 1, F.sqrt(ss / (n - 1)))


def row_stats(df: DataFrame, cols: Sequence[str], stats=("mean", "std"), prefix: str = "row") -> DataFrame:
    out = {}
    for s in stats:
        out[f"{prefix}_{s}"] = row_mean(cols) if s == "mean" else row_std(cols)
    return df.withColumns(out)


def row_sum(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Row-wise sum with NULL counted as 0."""
    e = F.lit(0)
    for c in cols:
        e = e + F.coalesce(col_(c), F.lit(0))
    return df.withColumn(out, e)


def indicator_expr(cond: Column) -> Column:
    """Comparison → 0/1 where NULL compares as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def indicator(df: DataFrame, cond: Column, out: str) -> DataFrame:
    return df.withColumn(out, indicator_expr(cond))


def line_indicator(df: DataFrame, x: str, y: str, a: float, b: float, out: str) -> DataFrame:
    """1 if x > a*y + b."""
    return indicator(df, F.col(x) > F.lit(a) * F.col(y) + F.lit(b), out)


def isin_flag(df: DataFrame, col: str, values: Sequence, out: str) -> DataFrame:
    return df.withColumn(out, indicator_expr(F.col(col).isin(list(values))))


def abs_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.abs(F.col(c)) for c in cols})


def log1p_cap(c, cap: float = 17.5) -> Column:
    """min(log1p(x), cap), NULL → 0."""
    return F.least(F.log1p(F.coalesce(col_(c).cast("double"), F.lit(0.0))), F.lit(float(cap)))


def tail_flag(c, cap: float = 17.5) -> Column:
    """1 if log1p(x) >= cap."""
    return indicator_expr(F.log1p(col_(c).cast("double")) >= F.lit(float(cap)))


def clip(c, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.least(col_(c), F.lit(hi)), F.lit(lo))


def classify(df: DataFrame, p: str, t: float, out: str) -> DataFrame:
    """Probability → class: 1 if p > t."""
    return df.withColumn(out, F.when(F.col(p) > F.lit(t), 1).otherwise(0))


def cast_cols(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


_INT_STEPS = [("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647), ("bigint", -2**63, 2**63 - 1)]


def narrow_plan(df: DataFrame, tolerance: float = 1e-6) -> dict[str, str]:
    """Smallest type per numeric column from one min/max pass.

    Integral columns get the narrowest integer type holding [min, max].
    Doubles become float when every value survives the cast within
    ``tolerance`` (relative); there is no 16-bit float in Spark.
    Only one row (two numbers per column) reaches the driver.
    """
    exprs = []
    num = [f for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    for f in num:
        c = F.col(f"`{f.name}`")
        exprs += [F.min(c).alias(f"{f.name}__min"), F.max(c).alias(f"{f.name}__max")]
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            err = F.abs(c.cast("double") - c.cast("float").cast("double")) / F.greatest(F.abs(c.cast("double")), F.lit(1e-30))
            exprs.append(F.max(err).alias(f"{f.name}__err"))
    if not exprs:
        return {}
    r = df.agg(*exprs).first().asDict()
    plan = {}
    for f in num:
        lo, hi = r[f"{f.name}__min"], r[f"{f.name}__max"]
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            if lo is None:
                plan[f.name] = "tinyint"
                continue
            for name, a, b in _INT_STEPS:
                if lo >= a and hi <= b:
                    plan[f.name] = name
                    break
        elif isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            e = r[f"{f.name}__err"]
            plan[f.name] = "float" if (e is None or e <= tolerance) else "double"
        else:
            plan[f.name] = f.dataType.simpleString()
    return plan


def narrow_schema(df: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Cast every numeric column to the type chosen by ``narrow_plan``."""
    return cast_cols(df, narrow_plan(df, tolerance))


def narrow_plan_table(df: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """``narrow_plan`` as a (column_name, narrow_type) DataFrame, computed in Spark."""
    num = [f for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    exprs = []
    for f in num:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType, T.FloatType)):
            err = F.abs(c.cast("double") - c.cast("float").cast("double")) / F.greatest(F.abs(c.cast("double")), F.lit(1e-30))
            t = F.when(F.max(err).isNull() | (F.max(err) <= tolerance), "float").otherwise("double")
        else:
            lo, hi = F.min(c), F.max(c)
            t = F.lit("bigint")
            for name, a, b in reversed(_INT_STEPS[:-1]):
                t = F.when(lo.isNull() | ((lo >= a) & (hi <= b)), name).otherwise(t)
        exprs.append(F.struct(F.lit(f.name).alias("column_name"), t.alias("narrow_type")))
    return df.agg(F.array(*exprs).alias("_p")).select(F.inline("_p"))
