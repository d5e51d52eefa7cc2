"""Aggregation builders.

All builders emit a single ``groupBy().agg()`` per key wherever the
reference scanned a table several times: conditional variants are
``agg(f(when(cond, x)))`` in the same pass, status counts are a pivot with
explicit values.  Every aggregate here is partially aggregated map-side,
so a hot key costs one partial row per task before the shuffle.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import col_, safe_div, stat_expr
from .project import NUMERIC, agg_name

# Aggregate lists wider than this are split into chunks joined on the key
# (whole-stage codegen and the 64 KB method limit break on thousands of
# expressions).  The chunks share the key's hash partitioning.
MAX_AGGS_PER_PASS = 200


def known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a NULL or NaN key: such keys form no group, in any aggregate of this module."""
    return df.dropna(subset=list(keys)) if keys else df


def _agg_chunked(df: DataFrame, keys: Sequence[str], exprs: list[Column]) -> DataFrame:
    df = known_keys(df, keys)
    if len(exprs) <= MAX_AGGS_PER_PASS:
        return df.groupBy(*keys).agg(*exprs)
    parts = [df.groupBy(*keys).agg(*exprs[i:i + MAX_AGGS_PER_PASS])
             for i in range(0, len(exprs), MAX_AGGS_PER_PASS)]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, list(keys), "inner")
    return out


def stat_exprs(spec: Mapping[str, Sequence[str]], prefix: str = "",
               cond: Column | None = None) -> list[Column]:
    """[stat(col) AS PREFIXcol_STAT] for {col: [stats]}; ``size`` counts rows."""
    out = []
    for c, stats in spec.items():
        for s in stats:
            if s == "size":
                e = F.count_if(cond) if cond is not None else F.count(F.lit(1))
            else:
                x = F.col(c) if cond is None else F.when(cond, F.col(c))
                e = stat_expr(s, x)
            out.append(e.alias(agg_name(prefix, c, s)))
    return out


def _with_medians(df: DataFrame, keys: list, spec: Mapping[str, Sequence[str]], prefix: str,
                  median: str) -> tuple[dict, list]:
    """Split out the median statistics when they are not computed by Spark's ``median``."""
    if median == "exact":
        return dict(spec), []
    rest = {c: [s for s in st if s != "median"] for c, st in spec.items()}
    meds = [c for c, st in spec.items() if "median" in st]
    return rest, meds


def _attach_medians(out: DataFrame, df: DataFrame, keys: list, meds: list, prefix: str, median: str) -> DataFrame:
    if not meds:
        return out
    df = known_keys(df, keys)
    names = {c: agg_name(prefix, c, "median") for c in meds}
    if median == "approx":
        m = df.groupBy(*keys).agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 10000).alias(n)
                                    for c, n in names.items()])
        return out.join(m, keys, "left")
    # all median columns in one distributed pass: unpivot → median per (keys, column) → pivot
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in meds]) \
        .unpivot(keys, meds, "_col", "_val")
    m = exact_median(long, [*keys, "_col"], "_val", "_med")
    wide = m.groupBy(*keys).pivot("_col", meds).agg(F.first("_med")).withColumnsRenamed(names)
    return out.join(wide, keys, "left")


def profile(df: DataFrame, keys, spec: Mapping[str, Sequence[str]], prefix: str = "",
            median: str = "exact") -> DataFrame:
    """``groupby(keys).agg({col: [stats]})`` with flattened names.

    ``median``: "exact" (Spark's median: one buffer per group), "distributed"
    (exact, range-partitioned: use when a key may hold a large share of the
    rows) or "approx".
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest, meds = _with_medians(df, keys, spec, prefix, median)
    out = _agg_chunked(df, keys, stat_exprs(rest, prefix))
    return _attach_medians(out, df, keys, meds, prefix, median)


def numeric_cols(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


STATS4 = ("mean", "count", "median", "max")
STATS6 = ("min", "max", "mean", "var", "sum")


def profile_all(df: DataFrame, keys, stats: Sequence[str] = STATS4, prefix: str = "",
                onehot_cols: Sequence[str] = (), size: bool = False, median: str = "exact") -> DataFrame:
    """Every numeric non-key column × stats; one-hot columns × mean.

    The row count (``size``) is computed once per key, not per column.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [c for c in numeric_cols(df, keys) if c not in onehot_cols]
    rest, meds = _with_medians(df, keys, {c: list(stats) for c in cols}, prefix, median)
    exprs = stat_exprs(rest, prefix)
    exprs += [F.avg(F.col(c)).alias(agg_name(prefix, c, "mean")) for c in onehot_cols]
    if size:
        exprs.append(F.count(F.lit(1)).alias(f"{prefix}COUNT"))
    out = _agg_chunked(df, keys, exprs)
    out = _attach_medians(out, df, keys, meds, prefix, median)
    order = list(keys) + [agg_name(prefix, c, s) for c in cols for s in stats] + \
        [agg_name(prefix, c, "mean") for c in onehot_cols] + ([f"{prefix}COUNT"] if size else [])
    return out.select(*order)


def profile_two_level(df: DataFrame, inner, outer, spec: Mapping[str, Sequence[str]],
                      prefix: str = "") -> DataFrame:
    """Stats per (outer, inner) group, then the mean of each stat per outer key."""
    inner = [inner] if isinstance(inner, str) else list(inner)
    outer = [outer] if isinstance(outer, str) else list(outer)
    first = df.groupBy(*outer, *inner).agg(*stat_exprs(spec, prefix))
    names = [c for c in first.columns if c not in outer + inner]
    return first.groupBy(*outer).agg(*[F.avg(c).alias(c) for c in names])


def profile_children(child: DataFrame, parent: DataFrame, pid: str, cid: str,
                     child_spec: Mapping[str, Sequence[str]],
                     parent_stats: Sequence[str] = ("mean",), child_prefix: str = "",
                     prefix: str = "", parent_cols: Sequence[str] = (), parent_onehot: Sequence[str] = ()) -> DataFrame:
    """child → per parent id → left join parent → per customer id.

    The parent's own numeric columns (``parent_cols``) get the same statistics
    as the children's; its categories (``parent_onehot``) one mean per value.
    """
    from .encode import one_hot
    c = profile(child, pid, child_spec, child_prefix)
    p = parent.select(pid, cid, *parent_cols, *parent_onehot)
    flags: list[str] = []
    if parent_onehot:
        p, flags = one_hot(p, parent_onehot)
    p = p.join(c, pid, "left").drop(pid)
    cols = [x for x in p.columns if x != cid and x not in flags]
    return profile(p, cid, {x: list(parent_stats) for x in cols} | {x: ["mean"] for x in flags}, prefix)


def profile_subsets(df: DataFrame, key, subsets: Mapping[str, Column],
                    spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """Same stats restricted to each subset, side by side, in **one** pass.

    ``subsets`` maps a name prefix to a condition; '' with ``None`` means all rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    exprs = []
    for pre, cond in subsets.items():
        exprs += stat_exprs(spec, pre, cond)
    return _agg_chunked(df, keys, exprs)


def count_when(df: DataFrame, key, conds: Mapping[str, Column]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return known_keys(df, keys).groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conds.items()])


def status_counts(df: DataFrame, key: str, col: str, values: Sequence, prefix: str = "STATUS_",
                  months: str | None = None) -> DataFrame:
    """Count of each status value per key; absent statuses are NULL (as a left
    join of per-value counts).  ``months`` names a column of month offsets
    (0, -1, ... back to the oldest): its greatest distance is returned as
    ``MONTHS`` and divides each count, in the same aggregation."""
    n = lambda v: F.count_if(F.col(col) == F.lit(v))
    exprs = [F.when(n(v) > 0, n(v)).alias(f"{prefix}{v}") for v in values]
    if months:
        exprs.append(F.abs(F.min(months)).alias("MONTHS"))
    p = known_keys(df, [key]).groupBy(key).agg(*exprs)
    return p.withColumns({f"{prefix}{v}_RATIO": safe_div(f"{prefix}{v}", "MONTHS") for v in values}) if months else p


def first_last(df: DataFrame, key, order: str, col: str, first: str = "FIRST", last: str = "LAST") -> DataFrame:
    """Value at the earliest and latest ``order`` per key, skipping NULL values."""
    keys = [key] if isinstance(key, str) else list(key)
    ok = F.col(col).isNotNull()
    return df.groupBy(*keys).agg(
        F.min_by(F.when(ok, F.col(col)), F.when(ok, F.col(order))).alias(f"{col}_{first}"),
        F.max_by(F.when(ok, F.col(col)), F.when(ok, F.col(order))).alias(f"{col}_{last}"))


def last_when(df: DataFrame, key, order: str, cond: Column, out: str) -> DataFrame:
    """abs of the smallest ``order`` value among rows meeting ``cond`` (the
    oldest month in a newest-first file)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.abs(F.min(F.when(cond, F.col(order)))).alias(out))


def group_size(df: DataFrame, keys, out: str = "size") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def distinct_count(df: DataFrame, keys, col: str, out: str | None = None, approx: bool = False,
                   rsd: float = 0.01) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    e = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    return df.groupBy(*keys).agg(e.alias(out or f"{col}_nunique"))


def user_profile(df: DataFrame, key, spec: Mapping[str, Sequence[str]], fill=0, prefix: str = "") -> DataFrame:
    """Several statistics of several columns for one key, NULL → fill."""
    p = profile(df, key, spec, prefix)
    return p.fillna(fill) if fill is not None else p


def concat_ids(df: DataFrame, key, col: str, sep: str = " ", out: str | None = None) -> DataFrame:
    """Values of ``col`` per key joined with ``sep`` in ascending order."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.col(col))), lambda x: x.cast("string")), sep)
        .alias(out or f"{col}_list"))


def with_group_max(df: DataFrame, keys, ts: str, out: str) -> DataFrame:
    """Attach max(ts) of the row's group: aggregate then join (partial
    aggregation keeps hot groups cheap)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    m = df.groupBy(*keys).agg(F.max(ts).alias(out))
    return df.join(m, keys, "inner")


def mean_importance(imp: DataFrame, feature: str = "feature", value: str = "importance", n: int = 50) -> DataFrame:
    return (imp.groupBy(feature).agg(F.avg(value).alias(value))
            .orderBy(F.col(value).desc(), F.col(feature)).limit(n))


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols) of a stage as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Exact (interpolated) median per key without gathering a group in one task.

    Equal values of a key are counted first (aggregated before the shuffle,
    so a value that fills most of a group is one row); a running sum of the
    counts along the range-partitioned distinct values finds the one or two
    values in the middle.  NULL and NaN keys form no group.
    """
    from .ranking import cumulative_sum_by
    keys = list(keys)
    x = known_keys(df, keys).select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    counted = x.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    r = cumulative_sum_by(counted, keys, ["_x"], "_c", out="_upto")
    n = r.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    lo = F.floor((F.col("_n") - 1) / 2) + 1
    hi = F.ceil((F.col("_n") - 1) / 2) + 1
    inside = lambda k: (F.col("_upto") - F.col("_c") < k) & (k <= F.col("_upto"))
    mid = r.join(n, keys, "inner").where(inside(lo) | inside(hi))
    return mid.groupBy(*keys).agg(F.avg("_x").alias(out))
