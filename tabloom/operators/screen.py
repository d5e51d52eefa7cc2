"""Feature screening as Spark jobs.

Features are unpivoted to a long (id, feature, value, group…) table so a
thousand features cost one shuffle, not a thousand scans; medians and rank
statistics come from (feature, value) counts and one running sum.
Only the per-feature result (one row per feature) is small.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ranking import running_totals

# Abramowitz & Stegun 7.1.26 coefficients for erfc.
ERFC_P = 0.3275911
ERFC_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erfc(x: Column) -> Column:
    """erfc(x) for x ≥ 0 (absolute error < 1.5e-7); Spark SQL has no erf."""
    t = 1 / (1 + F.lit(ERFC_P) * x)
    poly = F.lit(0.0)
    for a in reversed(ERFC_A):
        poly = (poly + F.lit(a)) * t
    return poly * F.exp(-x * x)


def to_long(df: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(ids…, feature, value double) — one row per non-NULL feature value."""
    x = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in features])
    return x.unpivot(list(ids), list(features), "feature", "value").where(F.col("value").isNotNull())


def constant_columns(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, is_constant): ≤ 1 distinct non-NULL value, from one min/max pass."""
    aggs = [F.struct(F.lit(c).alias("feature"),
                     F.coalesce(F.min(c) == F.max(c), F.lit(True)).cast("int").alias("is_constant"))
            for c in features]
    return df.agg(F.array(*aggs).alias("_a")).select(F.inline("_a"))


def group_statistics(long: DataFrame, pairs: dict[str, tuple[Column, Column, Column | None]]) -> DataFrame:
    """All two-group statistics of every feature from one sorted table of value counts.

    ``pairs``: name → (group 0, group 1, the rows it looks at or None for all).
    Columns per name: ``_mean`` (of the rows looked at), ``_diff``
    (|median₀ − median₁|, or |mean₀ − mean₁| for 0/1 features), ``_n0``,
    ``_n1`` and ``_w`` (rank sum of group 1, average ranks for ties).

    Equal values are counted once per group, before any shuffle of values;
    one running sum along the sorted values of a feature then holds every
    median and every rank.  A feature is a whole column, so its values are
    dealt by range (``running_totals``).
    """
    weights = {}
    for name, (g0, g1, rows) in pairs.items():
        weights |= {f"{name}_0": g0, f"{name}_1": g1, f"{name}_a": rows if rows is not None else F.lit(True)}
    c = long.groupBy("feature", "value").agg(*[F.count_if(F.coalesce(e, F.lit(False))).alias(w) for w, e in weights.items()])
    ensure_checkpoint_dir(long.sparkSession)
    t = running_totals(c.checkpoint(), "feature", "value", list(weights))
    aggs = []
    for name in pairs:
        a, g = f"{name}_a", [f"{name}_0", f"{name}_1"]
        mean = [f"sum(value * {x}) / nullif(sum({x}), 0)" for x in g]
        hit = "max(value) FILTER (WHERE {x}_upto - {x} < {p} AND {p} <= {x}_upto)"
        median = [f"({hit.format(x=x, p=f'({x}_all + 1) div 2')} + {hit.format(x=x, p=f'({x}_all div 2 + 1)')}) / 2" for x in g]
        rank = f"({g[0]}_upto + {g[1]}_upto - {g[0]} - {g[1]} + ({g[0]} + {g[1]} + 1) / 2D)"
        aggs += [f"sum(value * {a}) / nullif(sum({a}), 0) AS {name}_mean",
                 f"if(min(value IN (0D, 1D)) FILTER (WHERE {a} > 0), abs({mean[0]} - {mean[1]}), abs({median[0]} - {median[1]})) AS {name}_diff",
                 f"sum({g[0]}) AS {name}_n0", f"sum({g[1]}) AS {name}_n1", f"sum({g[1]} * {rank}) AS {name}_w"]
    return t.groupBy("feature").agg(*[F.expr(e) for e in aggs])


def _halves(group: str, rows: Column | None = None) -> tuple[Column, Column, Column | None]:
    side = lambda v: F.col(group) == v if rows is None else (F.col(group) == v) & rows
    return side(0), side(1), rows


def _rank_test(name: str, min_n: int = 20) -> tuple[Column, Column]:
    """(z, p) of the Wilcoxon rank sum; no tie correction, p = 2 when a group has fewer than ``min_n`` values."""
    n0, n1 = F.col(f"{name}_n0").cast("double"), F.col(f"{name}_n1").cast("double")
    z = F.try_divide(F.col(f"{name}_w") - n1 * (n0 + n1 + 1) / 2, F.sqrt(n0 * n1 * (n0 + n1 + 1) / 12))
    return z, F.when((n0 < min_n) | (n1 < min_n), F.lit(2.0)).otherwise(erfc(F.abs(z) / math.sqrt(2.0)))


def class_diff(long: DataFrame, group: str) -> DataFrame:
    """(feature, class_diff, mean): |median₀ − median₁|, or |mean₀ − mean₁| for 0/1 features."""
    return group_statistics(long, {"g": _halves(group)}).select("feature", F.col("g_diff").alias("class_diff"), F.col("g_mean").alias("mean"))


def rank_sum(long: DataFrame, group: str, min_n: int = 20) -> DataFrame:
    """Wilcoxon rank-sum per feature: (feature, n0, n1, z, p) with x = group 1."""
    z, p = _rank_test("g", min_n)
    return group_statistics(long, {"g": _halves(group)}).select("feature", F.col("g_n0").alias("n0"), F.col("g_n1").alias("n1"), z.alias("z"), p.alias("p"))


def same_distribution(long: DataFrame, target: str, id_exempt: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """(feature, diff_norm, p, drop): drop if (diff = 0 or diff_norm < .5) and p > alpha."""
    j = group_statistics(long, {"g": _halves(target)}).withColumn("p", _rank_test("g")[1])
    dn = F.abs(F.try_divide(F.col("g_diff"), F.col("g_mean")))
    drop = ((F.col("g_diff") == 0) & (F.col("p") > alpha)) | ((dn < 0.5) & (F.col("p") > alpha))
    drop = F.coalesce(drop, F.lit(False)) & ~F.col("feature").isin(list(id_exempt) or [""])
    return j.select("feature", dn.alias("diff_norm"), "p", drop.cast("int").alias("drop"))


def train_test_drift(long: DataFrame, is_train: str, target: str, alpha: float = 0.05) -> DataFrame:
    """(feature, drift_norm, p, drop): drop if p < alpha, drift_norm > 1 and the class diff is 0."""
    j = group_statistics(long, {"d": _halves(is_train), "c": _halves(target, F.col(is_train) == 1)}).withColumn("p", _rank_test("d")[1])
    dn = F.abs(F.try_divide(F.col("d_diff"), F.col("d_mean")))
    cn = F.abs(F.try_divide(F.col("c_diff"), F.col("c_mean")))
    drop = F.coalesce((F.col("p") < alpha) & (dn > 1) & (cn == 0), F.lit(False))
    return j.select("feature", dn.alias("drift_norm"), "p", drop.cast("int").alias("drop"))
