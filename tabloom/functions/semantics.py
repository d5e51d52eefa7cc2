"""One place for the numeric and string semantics the operators share.

pandas and Spark disagree on a handful of points (division by zero, skew
bias, NULL group keys, word splitting).  Each rule is settled here once so
that every operator and every SQL oracle follows the same definition.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: a lambda variable is bound once,
    where the optimiser would inline a column into every lambda that reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def safe_div(a, b) -> Column:
    """a / b as double; NULL when b is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(col_(a).cast("double"), col_(b).cast("double"))


def sample_skew(c) -> Column:
    """Bias-corrected sample skewness G1 (pandas ``skew``); NULL for n < 3.

    Spark's ``skewness`` is the population g1; G1 = g1 * sqrt(n(n-1)) / (n-2).
    """
    x = col_(c).cast("double")
    n = F.count(x).cast("double")
    return F.when(n >= 3, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def sem(c) -> Column:
    """Standard error of the mean, ddof=1 (pandas ``sem``)."""
    x = col_(c).cast("double")
    return F.stddev_samp(x) / F.sqrt(F.count(x).cast("double"))


def stat_expr(stat: str, c) -> Column:
    """Aggregate expression for a pandas-style statistic name."""
    x = col_(c)
    s = stat.lower()
    if s == "mean":
        return F.avg(x)
    if s == "sum":
        return F.sum(x)
    if s == "min":
        return F.min(x)
    if s == "max":
        return F.max(x)
    if s == "count":
        return F.count(x)
    if s == "size":
        return F.count(F.lit(1))
    if s == "median":
        return F.median(x)
    if s in ("std", "stddev"):
        return F.stddev_samp(x)
    if s == "var":
        return F.var_samp(x)
    if s == "skew":
        return sample_skew(x)
    if s == "sem":
        return sem(x)
    if s == "nunique":
        return F.count_distinct(x)
    if s == "first":
        raise ValueError("'first' needs an order column: use operators.aggregate.first_last")
    raise ValueError(f"unknown statistic {stat!r}")


def portable_hash(c) -> Column:
    """Deterministic non-negative 32-bit hash: first 8 hex digits of md5(string).

    The same value is computed by SQL engines that have ``md5``
    (``('0x'||substr(md5(x),1,8))::BIGINT``), so folds, samples and hash
    buckets can be checked against an oracle.
    """
    return F.conv(F.substring(F.md5(col_(c).cast("string")), 1, 8), 16, 10).cast("bigint")


def tokens(c, lower: bool = False) -> Column:
    """``str.split()``: split on runs of whitespace, no empty tokens."""
    x = col_(c)
    if lower:
        x = F.lower(x)
    return F.filter(F.split(F.trim(x), r"\s+"), lambda t: t != "")


_CUT = 0.5001234567


def round_sig(c, digits: int = 10) -> Column:
    """Round half-up to ``digits`` significant digits in plain IEEE arithmetic.

    Written out (instead of ``round``) so that a SQL engine evaluating the
    same expression gets bit-identical results: the power of ten is always
    an exact double (10^0..10^22) and is applied by one multiply or divide.
    Float sums differ between engines in the last bits only; rounding to
    significant digits hides that at every magnitude.  The cut-off sits at
    an odd fraction (``_CUT``) rather than at .5: means of decimal data often
    land exactly on a half, where last-bit noise would decide the direction.
    """
    x = col_(c).cast("double")
    e = F.floor(F.log10(F.abs(x)))
    k = digits - 1
    big = F.floor(x / F.pow(F.lit(10.0), e - k) + _CUT) * F.pow(F.lit(10.0), e - k)
    small = F.floor(x * F.pow(F.lit(10.0), k - e) + _CUT) / F.pow(F.lit(10.0), k - e)
    bad = x.isNull() | F.isnan(x) | (x == 0) | (F.abs(x) == float("inf"))
    return F.when(bad, x).when(e >= k, big).otherwise(small)


SQL_ROUND_SIG = ("CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 OR isinf({x}) THEN {x} "
                 "WHEN floor(log10(abs({x}))) >= {k} THEN floor({x} / pow(10.0, floor(log10(abs({x}))) - {k}) + 0.5001234567) * pow(10.0, floor(log10(abs({x}))) - {k}) "
                 "ELSE floor({x} * pow(10.0, {k} - floor(log10(abs({x})))) + 0.5001234567) / pow(10.0, {k} - floor(log10(abs({x})))) END")


def _round_sql(x: str, digits: int) -> str:
    """``round_sig`` as SQL text: a wide result needs one parse instead of thousands of calls into the JVM."""
    k, e, cut = digits - 1, f"floor(log10(abs({x})))", f"{_CUT}D"
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 OR abs({x}) = double('Infinity') THEN {x} "
            f"WHEN {e} >= {k} THEN floor({x} / pow(10D, {e} - {k}) + {cut}) * pow(10D, {e} - {k}) "
            f"ELSE floor({x} * pow(10D, {k} - {e}) + {cut}) / pow(10D, {k} - {e}) END")


def round_outputs(df: DataFrame, digits: int = 8) -> DataFrame:
    """Round doubles/floats to significant digits and widen integral columns to bigint.

    Used by the registered queries so results compare exactly against a SQL
    oracle (float sums are order dependent in every engine).
    """
    out = []
    for f in df.schema.fields:
        name = "`" + f.name.replace("`", "``") + "`"
        c = name
        if isinstance(f.dataType, T.DoubleType):
            c = _round_sql(name, digits)
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            c = _round_sql(f"CAST({name} AS DOUBLE)", digits)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            c = f"CAST({name} AS BIGINT)"
        out.append(f"{c} AS {name}")
    return df.selectExpr(*out)
