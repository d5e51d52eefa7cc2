"""Trailing-window / decay time-series queries — SURVEY §2.6.

Fixture mapping: site = user_id, forecast = event_type, value = value on
the ``events`` table.  The data is sparse (≈13 rows per pair over 30
days), so one moment is one day and the decay unit is six hours (the API
defaults stay 4 h / 15 min).  k = 0.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trailing as TR
from ..sources.fixtures import ENERGY_SQL, energy
from . import query

DAY_US = 86_400_000_000
UNIT_US = 6 * 3_600_000_000
K = 0
GROUP = ["site", "forecast"]

# name, keys, trailing horizons, decay horizons
BLOCKS = {
    "ts_trail_site": ("Site", ["site"], [2, 6, 12, 14, 17], []),
    "ts_trail_forecast": ("Forecast", ["forecast"], [2, 6, 12, 14, 17], []),
    "ts_trail_site_forecast": ("Site_Forecast", ["site", "forecast"], [3, 6, 14, 17], []),
    "ts_trail_site_minute": ("Site_Minute", ["site", "minute"], [3, 6, 14, 17], []),
    "ts_trail_site_hour": ("Site_Hour", ["site", "hour"], [3, 6, 14, 17], []),
    "ts_trail_site_day": ("Site_Day", ["site", "day"], [6, 17], []),
    "ts_trail_site_dow": ("Site_DayofWeek", ["site", "dow"], [6, 17], []),
    "ts_trail_sf_minute": ("Site_Forecast_Minute", ["site", "forecast", "minute"], [3, 6, 14, 17], []),
    "ts_trail_sf_hour": ("Site_Forecast_Hour", ["site", "forecast", "hour"], [6, 14], []),
    "ts_trail_sf_day": ("Site_Forecast_Day", ["site", "forecast", "day"], [6, 17], []),
    "ts_trail_sf_dow": ("Site_Forecast_DayofWeek", ["site", "forecast", "dow"], [6, 17], []),
    "ts_decay_site": ("Site", ["site"], [], [3, 6, 14, 17]),
    "ts_decay_sf": ("Site_Forecast", ["site", "forecast"], [], [3, 6, 14, 17]),
    "ts_decay_sf_minute": ("Site_Forecast_Minute", ["site", "forecast", "minute"], [], [3, 6, 14, 17]),
    "ts_decay_sf_hour": ("Site_Forecast_Hour", ["site", "forecast", "hour"], [], [6, 17]),
    "ts_decay_sf_day": ("Site_Forecast_Day", ["site", "forecast", "day"], [], [6, 17]),
}
_SQL_STAT = {"min": "min({v})", "mean": "avg({v})", "median": "median({v})", "max": "max({v})",
             "count": "count({v})", "std": "stddev_samp({v})", "skew": "skewness({v})"}

_PREP_SQL = f"""WITH {ENERGY_SQL.strip()},
t AS (SELECT en.*, epoch_us(ts) AS _t, max(epoch_us(ts)) OVER (PARTITION BY site, forecast) AS _M FROM en),
base AS (SELECT * FROM t WHERE _t >= _M - {(K + 1) * DAY_US} AND _t < _M - {K * DAY_US}),
hist AS (SELECT * FROM t WHERE _t < _M - {(K + 1) * DAY_US})"""


def _block_sql_parts(name, keys, hz, dhz):
    aggs, cols = [], []
    for n in hz:
        v = f"CASE WHEN _t >= _M - {(K + n) * DAY_US} THEN value END"
        for s in TR.STATS7:
            c = f"{name}_{s}{n}"
            aggs.append(_SQL_STAT[s].format(v=v) + f" AS {c}")
            cols.append(c)
    for n in dhz:
        cond = f"_t >= _M - {(K + n) * DAY_US}"
        w = f"pow(0.985, CAST((_M - {K * DAY_US}) - _t AS DOUBLE) / {float(UNIT_US)})"
        c = f"{name}_exp_mean{n}"
        aggs.append(f"sum(CASE WHEN {cond} THEN value * {w} END) / nullif(sum(CASE WHEN {cond} THEN {w} END), 0) AS {c}")
        cols.append(c)
    return aggs, cols


def _block_sql(name, keys, hz, dhz):
    aggs, cols = _block_sql_parts(name, keys, hz, dhz)
    k = ", ".join(keys)
    return (_PREP_SQL + f",\nagg AS (SELECT {k}, {', '.join(aggs)} FROM hist GROUP BY {k})\n"
            f"SELECT base.obs_id, {', '.join(f'coalesce(agg.{c}, 0) AS {c}' for c in cols)}\n"
            f"FROM base LEFT JOIN agg USING ({k})")


def _make(qname, spec):
    name, keys, hz, dhz = spec

    def fn(spark, d):
        base, hist = TR.split_base_history(energy(spark, d), "ts", GROUP, DAY_US, K, longest=max([*hz, *dhz]))
        return TR.feature_block(base, hist, "obs_id", keys, "value", name, hz, dhz, DAY_US, K, unit_us=UNIT_US)
    fn.__name__ = f"q_{qname}"
    query(qname, _block_sql(name, keys, hz, dhz))(fn)


for _q, _spec in BLOCKS.items():
    _make(_q, _spec)


@query("ts_split", f"""{_PREP_SQL}
SELECT obs_id, CASE WHEN _t >= _M - {(K + 1) * DAY_US} AND _t < _M - {K * DAY_US} THEN 'base'
                    WHEN _t < _M - {(K + 1) * DAY_US} THEN 'history' ELSE 'after' END AS part
FROM t""")
def q_ts_split(spark, d):
    base, hist = TR.split_base_history(energy(spark, d), "ts", GROUP, DAY_US, K, materialize=False)
    t = base.select("obs_id", F.lit("base").alias("part")).unionByName(hist.select("obs_id", F.lit("history").alias("part")))
    allrows = energy(spark, d).select("obs_id")
    after = allrows.join(t, "obs_id", "left_anti").withColumn("part", F.lit("after"))
    return t.unionByName(after)


def _assemble_sql():
    by_keys = {}
    for _q, (name, keys, hz, dhz) in BLOCKS.items():
        by_keys.setdefault(tuple(keys), []).append((name, hz, dhz))
    ctes, sel, joins = [], [], []
    for i, (keys, bl) in enumerate(by_keys.items()):
        aggs, cols = [], []
        for name, hz, dhz in bl:
            a, c = _block_sql_parts(name, keys, hz, dhz)
            aggs += a
            cols += c
        k = ", ".join(keys)
        ctes.append(f"a{i} AS (SELECT {k}, {', '.join(aggs)} FROM hist GROUP BY {k})")
        sel += [f"coalesce(a{i}.{c}, 0) AS {c}" for c in cols]
        joins.append(f"LEFT JOIN a{i} USING ({k})")
    return (_PREP_SQL + ",\n" + ",\n".join(ctes) + f"\nSELECT base.obs_id, {', '.join(sel)}\nFROM base "
            + " ".join(joins))


@query("ts_assemble", _assemble_sql())
def q_ts_assemble(spark, d):
    blocks = [{"name": n, "keys": k, "horizons": h, "decay_horizons": dh} for (n, k, h, dh) in BLOCKS.values()]
    return TR.assemble(energy(spark, d), "obs_id", "ts", GROUP, "value", blocks, DAY_US, K, unit_us=UNIT_US)


@query("ts_calendar", """
SELECT event_id, CAST(month(ts) AS BIGINT) AS month, CAST(dayofmonth(ts) AS BIGINT) AS day,
       CAST(weekofyear(ts) AS BIGINT) AS week, CAST(isodow(ts) - 1 AS BIGINT) AS weekday,
       CAST(hour(ts) AS BIGINT) AS hour, CAST(minute(ts) AS BIGINT) AS minute FROM events""")
def q_ts_calendar(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "ts")
    return TR.calendar(e, "ts").drop("ts")
