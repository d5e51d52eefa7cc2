"""Trailing-window and exponential-decay time features.

For step ``k`` and a row whose (group_keys) group ends at ``M`` (max ts):

* base rows:    M-(k+1)·m <= ts < M-k·m       (the rows that get features)
* history rows: ts < M-(k+1)·m
* horizon n:    history rows with ts >= M-(k+n)·m

``M`` is always the row's own group maximum, also when features are grouped
by coarser keys.  Horizons are nested, so each history row belongs to
exactly one *ring* between two neighbouring horizons.  One aggregation per
(key set, keys, ring) gives mergeable parts (count, mean, centred moments,
extremes, decayed sums); a horizon is the merge of its rings.  Medians come
from value counts per ring along one running sum (``running_totals``), so no
group is gathered in a task.  All key sets go through the same pass as
grouping sets.  Base rows without history under a key get 0.
"""
from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import stage
from .ranking import running_totals, value_cuts

STATS7 = ("min", "mean", "median", "max", "count", "std", "skew")
MINUTES = 60 * 1_000_000


def micros(ts: str) -> Column:
    """Microseconds since the epoch of a timestamp column (wall clock, UTC)."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def split_base_history(df: DataFrame, ts: str, group_keys: Sequence[str], moment_us: int, k: int = 0,
                       materialize: bool = True, longest: int | None = None):
    """(base, history) with helper columns _t, _M (group max), _L1, _L2.

    ``longest`` is the longest horizon that will be asked for: older history
    cannot reach any feature and is left out.  ``materialize`` writes the
    prepared table (shared checkpoint folder), which every feature block reads
    several times.
    """
    t = df.withColumn("_t", micros(ts))
    m = t.groupBy(*group_keys).agg(F.max("_t").alias("_M"))
    t = (t.join(m, list(group_keys), "inner")
          .withColumn("_L1", F.col("_M") - F.lit((k + 1) * moment_us))
          .withColumn("_L2", F.col("_M") - F.lit(k * moment_us)))
    t = t.where(F.col("_t") < F.col("_L2"))
    if longest is not None:
        t = t.where((F.col("_t") >= F.col("_L1")) | _in_horizon(longest, moment_us, k))
    if materialize:
        t = stage(t, "history")
    base = t.where(F.col("_t") >= F.col("_L1"))
    hist = t.where(F.col("_t") < F.col("_L1"))
    return base, hist


def _in_horizon(n: int, moment_us: int, k: int) -> Column:
    return F.col("_t") >= F.col("_M") - F.lit((k + n) * moment_us)


def _rings(horizons: Sequence[int], moment_us: int, k: int) -> Column:
    """Number of the ring a history row lies in: between two neighbouring horizons; NULL beyond the last."""
    ring = F.when(_in_horizon(horizons[0], moment_us, k), F.lit(0))
    for i, n in enumerate(horizons[1:], 1):
        ring = ring.when(_in_horizon(n, moment_us, k), F.lit(i))
    return ring


def _mark(number: Column, cols: Sequence[str], within: Sequence[str] | None = None) -> list[Column]:
    """Two 64-bit hashes that stand for (number of the key set, its keys); columns outside the set count as NULL."""
    parts = [F.struct(number, *[F.col(c) if within is None or c in within else F.when(F.lit(False), F.col(c)) for c in cols])]
    return [F.xxhash64(*parts).alias("_g1"), F.xxhash64(F.lit("2"), *parts).alias("_g2")]


def _grouped(df: DataFrame, sets: Sequence[Sequence[str]], cols: Sequence[str], inner: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per (key set, its keys, inner), every key set in one pass (grouping sets): _g1, _g2, inner, aggregates.

    NULL keys form no group.
    """
    every = [*cols, *inner]
    g = df.groupingSets([[*s, *inner] for s in sets], *every).agg(F.grouping_id().alias("_gid"), *aggs)
    # a column outside the grouping set is a bit, the first column's the highest
    gid = [sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in s and c not in inner) for s in sets]
    number, known = F.lit(None).cast("int"), F.lit(False)
    for i, s in enumerate(sets):
        hit = F.col("_gid") == gid[i]
        number = F.when(hit, i).otherwise(number)
        known = F.when(hit, reduce(and_, [F.col(c).isNotNull() for c in s])).otherwise(known)
    rest = [c for c in g.columns if c not in cols and c != "_gid"]
    return g.where(known).select(*_mark(number, cols), *rest)


#: Statistics of a horizon from the running sums of its rings.  d is a ring's mean less the mean of the key's first ring,
#: s1..s3 the sums of n, n d^2, n d^3 in that order, t1 the sum of d m2; from them the centred moments M2 and M3 of all rings.
_STATS = {
    "count": "n", "sum": "if(n > 0, n * (a + s1 / n), NULL)", "mean": "if(n > 0, a + s1 / n, NULL)", "min": "low", "max": "high",
    "var": "if(n > 1, greatest(m2, 0D) / (n - 1), NULL)", "std": "if(n > 1, sqrt(greatest(m2, 0D) / (n - 1)), NULL)",
    "sem": "if(n > 1, sqrt(greatest(m2, 0D) / (n - 1) / n), NULL)",
    "skew": "if(n > 2 and m2 > 0, sqrt(n) * m3 / pow(m2, 1.5D) * sqrt(n * (n - 1)) / (n - 2), NULL)", "exp_mean": "try_divide(vw, w)"}


def _ring_stats(hist: DataFrame, sets, cols, rings: int, stats: Sequence[str], moments: bool, weights: bool) -> DataFrame:
    """Per (key set, keys): the statistics of each horizon j, rings 0..j taken together, as arrays ``h{j}``."""
    x = F.col("_v")
    aggs = {"rn": F.count(x).cast("double"), "mean": F.avg(x)}
    if moments:
        aggs |= {"var": F.var_pop(x), "skew": F.skewness(x), "rlow": F.min(x), "rhigh": F.max(x)}
    if weights:
        aggs |= {"rvw": F.sum(x * F.col("_w")), "rw": F.sum("_w")}
    part = _grouped(hist, sets, cols, ["_ring"], [e.alias(c) for c, e in aggs.items()])
    upto = "OVER (PARTITION BY _g1, _g2 ORDER BY _ring ROWS UNBOUNDED PRECEDING)"
    run = {"n": "sum(rn)"}
    if moments:
        part = part.selectExpr("*", f"first_value(mean, true) {upto} AS a", "coalesce(var * rn, 0D) AS rm2")
        part = part.selectExpr("*", "coalesce(mean - a, 0D) AS d", "coalesce(skew * pow(rm2, 1.5D) / sqrt(rn), 0D) AS rm3")
        run |= {"s1": "sum(rn * d)", "s2": "sum(rn * d * d)", "s3": "sum(rn * d * d * d)", "t0": "sum(rm2)", "t1": "sum(d * rm2)", "u": "sum(rm3)",
                "low": "min(rlow)", "high": "max(rhigh)"}
    if weights:
        run |= {"vw": "sum(rvw)", "w": "sum(rw)"}
    part = part.selectExpr("_g1", "_g2", "_ring", *(["a"] if moments else []), *[f"{e} {upto} AS {c}" for c, e in run.items()])
    if moments:
        part = part.selectExpr("*", "if(n > 0, s1 / n, 0D) AS mu").selectExpr(
            "*", "t0 + s2 - n * mu * mu AS m2", "u + 3 * (t1 - mu * t0) + s3 - 3 * mu * s2 + 3 * mu * mu * s1 - n * mu * mu * mu AS m3")
    part = part.selectExpr("_g1", "_g2", "_ring", f"array({', '.join(f'coalesce({_STATS[s]}, 0D)' for s in stats)}) AS h")
    # rings without rows: a horizon ends at the last ring below it
    return part.groupBy("_g1", "_g2").agg(*[F.expr(f"max_by(h, _ring) FILTER (WHERE _ring <= {j})").alias(f"h{j}") for j in range(rings)])


def _ring_medians(hist: DataFrame, sets, cols, rings: int) -> DataFrame:
    """Per (key set, keys): exact medians of the horizons, as array ``medians``.

    Equal values are counted first; one running sum per horizon along the
    sorted values then finds the one or two values in the middle.
    """
    hist = hist.where("_v is not null")
    c = [f"c{j}" for j in range(rings)]
    v = _grouped(hist, sets, cols, ["_v"], [F.count_if(F.col("_ring") <= j).alias(x) for j, x in enumerate(c)])
    t = running_totals(v, ["_g1", "_g2"], "_v", c, cuts=value_cuts(hist, "_v"))
    at = lambda x, p: f"max(_v) FILTER (WHERE {x}_upto - {x} < {p} AND {p} <= {x}_upto)"
    mid = [f"({at(x, f'({x}_all + 1) div 2')} + {at(x, f'({x}_all div 2 + 1)')}) / 2" for x in c]
    return t.groupBy("_g1", "_g2").agg(F.expr(f"array({', '.join(f'coalesce({m}, 0D)' for m in mid)})").alias("medians"))


def _features(hist: DataFrame, sets: Sequence[tuple], blocks: Sequence[Sequence[dict]], value: str, moment_us: int, k: int,
              stats: Sequence[str], decay_base: float, unit_us: int) -> tuple[DataFrame, list[list[tuple[str, str, str]]]]:
    """(_g1, _g2, h) for all key sets, and for each set its features: name, place in ``h``, type."""
    cols = list(dict.fromkeys(c for s in sets for c in s))
    trail = {n for bl in blocks for b in bl for n in b.get("horizons", ())}
    decay = {n for bl in blocks for b in bl for n in b.get("decay_horizons", ())}
    horizons = sorted(trail | decay)
    unknown = [s for s in stats if s not in _STATS and s != "median"]
    if unknown:
        raise ValueError(f"unknown statistics {unknown}")
    w = F.pow(F.lit(decay_base), (F.col("_L2") - F.col("_t")).cast("double") / F.lit(float(unit_us)))
    h = hist.select(*cols, F.col(value).cast("double").alias("_v"), w.alias("_w"), _rings(horizons, moment_us, k).alias("_ring")).where("_ring is not null")
    own = [s for s in stats if s != "median"] if trail else []
    own += ["exp_mean"] if decay else []
    out = _ring_stats(h, sets, cols, len(horizons), own, bool(trail), bool(decay))
    with_median = trail and "median" in stats
    if with_median:
        out = out.join(_ring_medians(h, sets, cols, len(horizons)), ["_g1", "_g2"], "left")
    place = {n: i for i, n in enumerate(horizons)}
    at = {s: i for i, s in enumerate(own)}
    where = lambda n, s: f"medians[{place[n]}]" if s == "median" else f"h{place[n]}[{at[s]}]"
    picks = [[x for b in bl for x in [
        *[(f"{b['name']}_{s}{n}", where(n, s), "BIGINT" if s == "count" else "DOUBLE") for n in b.get("horizons", ()) for s in stats],
        *[(f"{b['name']}_exp_mean{n}", where(n, "exp_mean"), "DOUBLE") for n in b.get("decay_horizons", ())]]] for bl in blocks]
    return out.selectExpr("_g1", "_g2", f"struct({', '.join([f'h{j}' for j in range(len(horizons))] + (['medians'] if with_median else []))}) AS h"), picks


def _named(h: str, picks: Sequence[tuple[str, str, str]]) -> list[str]:
    """Features by name, 0 where there is none; counts as integers."""
    return [f"CAST(coalesce({h}.{place}, 0D) AS {kind}) AS `{c}`" for c, place, kind in picks]


def keyset_features(base: DataFrame, hist: DataFrame, obs_id: str, sets: Sequence[Sequence[str]], value: str,
                    blocks: Sequence[Sequence[dict]], moment_us: int, k: int = 0, stats: Sequence[str] = STATS7,
                    decay_base: float = 0.985, unit_us: int = 15 * MINUTES) -> DataFrame:
    """(obs_id, features) of the base rows; ``blocks[i]`` are the blocks of key set ``sets[i]``."""
    sets = [tuple(s) for s in sets]
    cols = list(dict.fromkeys(c for s in sets for c in s))
    feats, picks = _features(hist, sets, blocks, value, moment_us, k, stats, decay_base, unit_us)
    on = ["_g1", "_g2"]
    if len(sets) == 1:
        return base.select(obs_id, *_mark(F.lit(0), cols)).join(feats, on, "left").selectExpr(f"`{obs_id}`", *_named("h", picks[0]))
    # one row per (base row, key set), one join for all sets, and back to one row
    b = base.select(obs_id, F.explode(F.array(*[F.struct(F.lit(i).alias("set"), *_mark(F.lit(i), cols, s)) for i, s in enumerate(sets)])).alias("x"))
    j = b.select(obs_id, "x.*").join(feats, on, "left").groupBy(obs_id).agg(*[F.expr(f"first(h, true) FILTER (WHERE set = {i})").alias(f"_v{i}") for i in range(len(sets))])
    return j.selectExpr(f"`{obs_id}`", *[c for i in range(len(sets)) for c in _named(f"_v{i}", picks[i])])


def feature_block(base: DataFrame, hist: DataFrame, obs_id: str, keys: Sequence[str], value: str,
                  name: str, horizons: Sequence[int] = (), decay_horizons: Sequence[int] = (),
                  moment_us: int = 16 * 15 * MINUTES, k: int = 0, stats: Sequence[str] = STATS7,
                  decay_base: float = 0.985, unit_us: int = 15 * MINUTES) -> DataFrame:
    """(obs_id, features…) for the base rows: trailing stats and decay means by ``keys``."""
    return keyset_features(base, hist, obs_id, [list(keys)], value, [[{"name": name, "horizons": horizons, "decay_horizons": decay_horizons}]],
                           moment_us, k, stats, decay_base, unit_us)


def trailing_stats(df: DataFrame, obs_id: str, ts: str, group_keys: Sequence[str], keys: Sequence[str],
                   value: str, horizons: Sequence[int], name: str, moment_us: int = 16 * 15 * MINUTES,
                   k: int = 0, stats: Sequence[str] = STATS7) -> DataFrame:
    base, hist = split_base_history(df, ts, group_keys, moment_us, k, longest=max(horizons, default=None))
    return feature_block(base, hist, obs_id, keys, value, name, horizons, (), moment_us, k, stats)


def decayed_mean(df: DataFrame, obs_id: str, ts: str, group_keys: Sequence[str], keys: Sequence[str],
                 value: str, horizons: Sequence[int], name: str, moment_us: int = 16 * 15 * MINUTES,
                 k: int = 0, base: float = 0.985, unit_us: int = 15 * MINUTES) -> DataFrame:
    b, hist = split_base_history(df, ts, group_keys, moment_us, k, longest=max(horizons, default=None))
    return feature_block(b, hist, obs_id, keys, value, name, (), horizons, moment_us, k,
                         decay_base=base, unit_us=unit_us)


def assemble(df: DataFrame, obs_id: str, ts: str, group_keys: Sequence[str], value: str,
             blocks: Sequence[dict], moment_us: int, k: int = 0, decay_base: float = 0.985,
             unit_us: int = 15 * MINUTES) -> DataFrame:
    """All blocks → one wide row per base obs_id (which identifies a row).

    ``blocks``: dicts with ``keys``, ``name``, ``horizons`` and/or
    ``decay_horizons``.  All key sets share one pass over the history, one
    sorted table of value counts and one join.
    """
    reach = [n for b in blocks for n in (*b.get("horizons", ()), *b.get("decay_horizons", ()))]
    base, hist = split_base_history(df, ts, group_keys, moment_us, k, longest=max(reach, default=0))
    by_keys: dict[tuple, list[dict]] = {}
    for b in blocks:
        by_keys.setdefault(tuple(b["keys"]), []).append(b)
    return keyset_features(base, hist, obs_id, list(by_keys), value, list(by_keys.values()), moment_us, k,
                           decay_base=decay_base, unit_us=unit_us)


def calendar(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """month, day, ISO week, weekday (Monday=0), hour, minute."""
    t = F.col(ts)
    return df.withColumns({f"{prefix}month": F.month(t), f"{prefix}day": F.dayofmonth(t),
                           f"{prefix}week": F.weekofyear(t), f"{prefix}weekday": F.weekday(t),
                           f"{prefix}hour": F.hour(t), f"{prefix}minute": F.minute(t)})
