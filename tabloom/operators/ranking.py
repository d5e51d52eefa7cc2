"""Row numbering, ordering, top-k, sampling.

``row_number_by`` is the scale-safe numbering used everywhere a plain
``row_number()`` window would put a whole table (no partition key) or a hot
key into one task.  Rows are range-partitioned on (keys, order), so a key
holding a third of the table is spread over many tasks; each task numbers
its rows locally and a small (partition, key) table of counts supplies the
offsets.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import col_, portable_hash
from ..session import ensure_checkpoint_dir


def _names(cols) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def row_number_by(df: DataFrame, keys: Sequence[str] | str | None, order: Sequence,
                  out: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """1-based ``row_number() over (partition by keys order by order)``.

    Rows are range-partitioned on (keys, order) and numbered locally; the
    numbered table is checkpointed to the shared checkpoint folder so the
    partition assignment (range bounds come from sampling) is fixed before
    the offsets are computed from it, and survives executor loss.  A key
    spanning several range partitions gets per-partition offsets from the
    small (partition, key) count table.  ``order`` must make rows unique
    within a key.
    """
    keys = _names(keys)
    order = _names(order)
    n = _num_partitions(df, num_partitions)
    sort_cols = [col_(k) for k in keys] + [col_(o) for o in order]
    t = (df.repartitionByRange(n, *sort_cols)
           .sortWithinPartitions(*sort_cols)
           .withColumn("__rn_pid", F.spark_partition_id())
           .withColumn("__rn_li", F.monotonically_increasing_id()
                       - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    ensure_checkpoint_dir(df.sparkSession)
    t = t.checkpoint(eager=True)
    stats = t.groupBy("__rn_pid", *keys).agg(F.min("__rn_li").alias("__rn_first"),
                                         F.count(F.lit(1)).alias("__rn_cnt"))
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("__rn_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("__rn_before", F.coalesce(F.sum("__rn_cnt").over(w), F.lit(0))).drop("__rn_cnt")
    ren = {k: f"__rn_k{i}" for i, k in enumerate(keys)}
    stats = stats.withColumnsRenamed(ren).withColumnRenamed("__rn_pid", "__rn_spid")
    cond = [F.col("__rn_pid") == F.col("__rn_spid")] + [F.col(k).eqNullSafe(F.col(v)) for k, v in ren.items()]
    if not keys:  # at most one row per partition: never shuffle the table for it
        stats = F.broadcast(stats)
    res = t.join(stats, on=cond, how="inner").drop("__rn_spid", *ren.values())
    return (res.withColumn(out, (F.col("__rn_li") - F.col("__rn_first") + F.col("__rn_before") + 1).cast("long"))
               .drop("__rn_pid", "__rn_li", "__rn_first", "__rn_before"))


def dense_ids(df: DataFrame, cols: Sequence[str] | str, out: str = "id", start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Distinct values of ``cols`` numbered start.. in sorted order (global dense rank)."""
    cols = _names(cols)
    d = df.select(*cols).where(F.greatest(*[F.col(c).isNotNull() for c in cols]) if len(cols) > 1
                               else F.col(cols[0]).isNotNull()).distinct()
    r = row_number_by(d, None, cols, out=out, num_partitions=num_partitions)
    return r.withColumn(out, F.col(out) + (start - 1))


def running_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """``groupby(keys).cumcount() + 1`` in ``order`` (win_cumcount)."""
    return row_number_by(df, keys, order, out=out)


def order(df: DataFrame, cols: Sequence, ascending=True) -> DataFrame:
    """Sort by several keys (srt_multi).  A global sort range-partitions."""
    return df.orderBy(*_names(cols), ascending=ascending)


def top_k(df: DataFrame, col: str, n: int, ascending: bool = False,
          tie_breaker: Sequence[str] = ()) -> DataFrame:
    """n rows with the largest (or smallest) ``col``: TakeOrderedAndProject."""
    c = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return df.orderBy(c, *[F.col(t) for t in tie_breaker]).limit(n)


def top_k_both(df: DataFrame, col: str, n: int, tie_breaker: Sequence[str] = ()) -> DataFrame:
    """n smallest ∪ n largest rows by ``col`` (duplicates removed)."""
    lo = top_k(df, col, n, ascending=True, tie_breaker=tie_breaker)
    hi = top_k(df, col, n, ascending=False, tie_breaker=tie_breaker)
    return lo.unionByName(hi).dropDuplicates()


def top_k_per_group(df: DataFrame, keys: Sequence[str], col: str, n: int,
                    tie_breaker: Sequence[str] = ()) -> DataFrame:
    """n largest rows of ``col`` within each key."""
    w = Window.partitionBy(*keys).orderBy(F.col(col).desc(), *tie_breaker)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def hash_sample(df: DataFrame, id_col: str, fraction: float, seed: int = 0) -> DataFrame:
    """Repeatable sample: keep rows whose md5 bucket of (seed, id) is below fraction."""
    h = portable_hash(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return df.where(h < F.lit(int(fraction * 4294967296)))


def sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample (smp_frac); use ``hash_sample`` when it must be repeatable."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def cumulative_sum_by(df: DataFrame, keys: Sequence[str] | str | None, order: Sequence, weight: str,
                      out: str = "cum", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` within ``keys`` along ``order``.

    Range-partitioned like ``row_number_by`` so one key never lands in a
    single task: each (partition, key) slice is summed locally and shifted by
    the totals of the earlier partitions of the same key.  Rows tied on
    ``order`` get distinct running values; pre-aggregate ties first when a
    value per distinct order is wanted.
    """
    keys = _names(keys)
    order = _names(order)
    n = _num_partitions(df, num_partitions)
    sort_cols = [col_(k) for k in keys] + [col_(o) for o in order]
    t = (df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
           .withColumn("__cs_pid", F.spark_partition_id()))
    ensure_checkpoint_dir(df.sparkSession)
    t = t.checkpoint(eager=True)
    lw = Window.partitionBy("__cs_pid", *keys).orderBy(*[col_(o) for o in order]) \
        .rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("__cs_local", F.sum(weight).over(lw))
    tot = t.groupBy("__cs_pid", *keys).agg(F.sum(weight).alias("__cs_tot"))
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("__cs_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.withColumn("__cs_before", F.coalesce(F.sum("__cs_tot").over(w), F.lit(0))).drop("__cs_tot")
    ren = {k: f"__cs_k{i}" for i, k in enumerate(keys)}
    tot = tot.withColumnsRenamed(ren).withColumnRenamed("__cs_pid", "__cs_spid")
    cond = [F.col("__cs_pid") == F.col("__cs_spid")] + [F.col(k).eqNullSafe(F.col(v)) for k, v in ren.items()]
    if not keys:  # at most one row per partition
        tot = F.broadcast(tot)
    res = t.join(tot, on=cond, how="inner").drop("__cs_spid", *ren.values())
    return res.withColumn(out, F.col("__cs_local") + F.col("__cs_before")).drop("__cs_pid", "__cs_local", "__cs_before")


def value_cuts(df: DataFrame, value: str, slices: int | None = None) -> list[float]:
    """Borders of ``slices`` ranges of a numeric column that hold about equally many rows (one pass, Spark's quantile sketch)."""
    n = slices or min(256, max(16, _num_partitions(df, None)))
    cuts = df.select(F.col(value).cast("double").alias("x")).approxQuantile("x", [i / n for i in range(1, n)], 0.002)
    return sorted({c for c in cuts if c == c and abs(c) != float("inf")})


def _sliced(df: DataFrame, value: str, cuts: Sequence[float], out: str) -> DataFrame:
    """Number of the range each value lies in; NULL and NaN count as beyond the last."""
    if not cuts:
        return df.withColumn(out, F.lit(0))
    from pyspark.ml.feature import Bucketizer
    x = df.withColumn("__vs", F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))))
    b = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__vs", outputCol=out, handleInvalid="keep")
    return b.transform(x).withColumn(out, F.col(out).cast("int")).drop("__vs")


def running_totals(df: DataFrame, keys: Sequence[str] | str, value: str, weights: Sequence[str], cuts: Sequence[float] | None = None) -> DataFrame:
    """Adds ``{w}_upto`` (sum of w within ``keys`` up to and with this ``value``) and ``{w}_all`` (over the key).

    ``df`` has one row per (keys, value), keys not NULL.  Rows are dealt by
    (keys, value range), so a key that holds most rows is split over many
    tasks; ranges are summed locally and shifted by the totals of the earlier
    ranges of their key, a small table.  ``cuts`` (``value_cuts``) are numbers
    fixed beforehand, so every reader of the result sees the same ranges; if
    they are not given, ``df`` should be a written table, which is read once more.
    """
    keys = _names(keys)
    d = _sliced(df, value, value_cuts(df, value) if cuts is None else cuts, "__slice")
    w = Window.partitionBy(*keys, "__slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = d.withColumns({f"{x}_upto": F.sum(x).over(w) for x in weights})
    tot = d.groupBy(*keys, "__slice").agg(*[F.sum(x).alias(f"__t_{x}") for x in weights])
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*keys)
    tot = tot.select(*keys, "__slice", *[F.coalesce(F.sum(f"__t_{x}").over(before), F.lit(0)).alias(f"__b_{x}") for x in weights],
                     *[F.sum(f"__t_{x}").over(every).alias(f"{x}_all") for x in weights])
    out = local.join(tot, [*keys, "__slice"])
    return out.withColumns({f"{x}_upto": F.col(f"{x}_upto") + F.col(f"__b_{x}") for x in weights}) \
              .drop("__slice", *[f"__b_{x}" for x in weights])


def ordered_pass(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str], lag: Sequence[str] = (), cuts: Sequence[float] | None = None) -> DataFrame:
    """One ordered pass per key: adds ``rn`` (1-based), ``n`` (rows of the key) and ``prev_{c}`` (c of the row before) for ``lag``.

    Rows are dealt by (keys, range of the first ``order`` column, a number,
    date or timestamp) and numbered within their range; the small table of
    (keys, range) passes on how many rows came before and what the last of
    them held.  ``order`` must make rows unique within a key; keys not NULL.
    """
    keys = _names(keys)
    x = df.withColumn("__x", F.unix_micros(F.col(order[0]).cast("timestamp")) if dict(df.dtypes)[order[0]] in ("date", "timestamp") else F.col(order[0]).cast("double"))
    x = _sliced(x, "__x", value_cuts(x, "__x") if cuts is None else cuts, "__slice").drop("__x")
    w = Window.partitionBy(*keys, "__slice").orderBy(*order)
    local = x.withColumn("rn", F.row_number().over(w)).withColumns({f"prev_{c}": F.lag(c).over(w) for c in lag})
    edge = F.max_by(F.struct(*[F.col(c) for c in lag]), F.struct(*order)) if lag else F.lit(None)
    t = x.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__c"), edge.alias("__edge"))
    by = Window.partitionBy(*keys).orderBy("__slice")
    t = t.select(*keys, "__slice", F.coalesce(F.sum("__c").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
                 F.sum("__c").over(Window.partitionBy(*keys)).alias("n"), F.lag("__edge").over(by).alias("__prev"))
    out = local.join(t, [*keys, "__slice"])
    first = F.col("rn") == 1
    return (out.withColumns({f"prev_{c}": F.when(first, F.col("__prev")[c]).otherwise(F.col(f"prev_{c}")) for c in lag})
               .withColumn("rn", (F.col("rn") + F.col("__before")).cast("long")).drop("__slice", "__before", "__prev"))


#: Up to this many rows a top-k is sorted and numbered in one place; beyond, by a cut-off count and by range.
SMALL_TOP = 10_000
#: Cells of one histogram of counts.
CELLS = 4096


def count_cut(df: DataFrame, count: str, k: int) -> int | None:
    """Largest c such that at least ``k`` rows of the written table ``df`` have ``count`` >= c; None if it has fewer rows.

    A histogram of the counts of ``CELLS`` cells at most is read, then one of
    the cell in which the k-th row lies, and so on: two or three passes.
    """
    low, high = df.agg(F.min(count), F.max(count)).first()
    above = 0
    while low is not None:
        step = -(-(high - low + 1) // CELLS)
        cell = F.floor((F.col(count) - low) / step)
        hist = dict(map(tuple, df.where(F.col(count).between(low, high)).groupBy(cell.alias("c")).count().collect()))
        for c in sorted(hist, reverse=True):
            if above + hist[c] >= k:
                break
            above += hist[c]
        else:
            return None
        low, high = low + c * step, min(high, low + c * step + step - 1)
        if low == high:
            return low
    return None


def top_by_count(df: DataFrame, count: str, ties: Sequence[str], k: int, out: str = "rank") -> DataFrame:
    """The ``k`` rows with the largest ``count`` (an integer; ties by ``ties`` ascending), numbered from 1 in that order."""
    order = [F.col(count).desc(), *[F.col(t) for t in ties]]
    if k <= SMALL_TOP:
        return numbered_small(df.orderBy(*order).limit(k), [-F.col(count), *ties], out)
    ensure_checkpoint_dir(df.sparkSession)
    t = df.checkpoint()
    cut = count_cut(t, count, k)
    if cut is not None:
        t = t.where(F.col(count) >= cut)
    return row_number_by(t, None, order, out=out).where(F.col(out) <= k)


def numbered_small(df: DataFrame, order: Sequence, out: str, start: int = 1) -> DataFrame:
    """Rows of a table known to be small (``SMALL_TOP``), numbered in ``order`` by sorting one array of them."""
    rows = F.array_sort(F.collect_list(F.struct(*[col_(o).alias(f"__o{i}") for i, o in enumerate(order)], F.struct(*df.columns).alias("__r"))))
    x = df.agg(rows.alias("__a")).select(F.posexplode("__a").alias("__p", "__x"))
    return x.select(*[F.col(f"__x.__r.{c}").alias(c) for c in df.columns], (F.col("__p") + start).cast("long").alias(out))
