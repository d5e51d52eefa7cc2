"""Aggregation queries — SURVEY §2.4."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators.encode import one_hot
from ..sources.fixtures import table
from . import query


def T(spark, d, name):
    return table(spark, d, name)


@query("agg_multi", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity_SUM, avg(l_quantity) AS l_quantity_MEAN,
       min(l_extendedprice) AS l_extendedprice_MIN, max(l_extendedprice) AS l_extendedprice_MAX,
       avg(l_extendedprice) AS l_extendedprice_MEAN, avg(l_discount) AS l_discount_MEAN,
       stddev_samp(l_discount) AS l_discount_STD
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_agg_multi(spark, d):
    return A.profile(T(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "l_quantity": ["sum", "mean"], "l_extendedprice": ["min", "max", "mean"], "l_discount": ["mean", "std"]})


_ORD4 = """SELECT o_custkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS o_year,
                  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS o_prio FROM orders"""


@query("agg_all_stats4", f"""
SELECT o_custkey,
  avg(o_totalprice) AS o_totalprice_MEAN, count(o_totalprice) AS o_totalprice_COUNT,
  median(o_totalprice) AS o_totalprice_MEDIAN, max(o_totalprice) AS o_totalprice_MAX,
  avg(o_year) AS o_year_MEAN, count(o_year) AS o_year_COUNT, median(o_year) AS o_year_MEDIAN, max(o_year) AS o_year_MAX,
  avg(o_prio) AS o_prio_MEAN, count(o_prio) AS o_prio_COUNT, median(o_prio) AS o_prio_MEDIAN, max(o_prio) AS o_prio_MAX
FROM ({_ORD4}) t GROUP BY o_custkey""")
def q_agg_all_stats4(spark, d):
    o = T(spark, d, "orders").select("o_custkey", "o_totalprice", F.year("o_orderdate").cast("long").alias("o_year"),
                                     F.substring("o_orderpriority", 1, 1).cast("long").alias("o_prio"))
    return A.profile_all(o, "o_custkey", A.STATS4, median="distributed")


@query("agg_all_stats6", """
SELECT l_orderkey,
""" + ",\n".join(
    f"  min({c}) AS LI_{c}_MIN, max({c}) AS LI_{c}_MAX, avg({c}) AS LI_{c}_MEAN, var_samp({c}) AS LI_{c}_VAR, sum({c}) AS LI_{c}_SUM"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]) + """,
  avg(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS LI_l_returnflag_A_MEAN,
  avg(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS LI_l_returnflag_N_MEAN,
  avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS LI_l_returnflag_R_MEAN,
  avg(CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END) AS LI_l_returnflag_nan_MEAN,
  count(*) AS LI_COUNT
FROM lineitem GROUP BY l_orderkey""")
def q_agg_all_stats6(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                        "l_returnflag")
    li, oh = one_hot(li, ["l_returnflag"], null_as_category=True, max_values=100)
    return A.profile_all(li, "l_orderkey", A.STATS6, prefix="LI_", onehot_cols=oh, size=True)


_LO = """SELECT o.o_custkey, l.l_orderkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_partkey
         FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def _lo(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey")
    return T(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query("agg_two_level", f"""
WITH s AS (SELECT o_custkey, l_orderkey, avg(l_quantity) AS l_quantity_MEAN, max(l_quantity) AS l_quantity_MAX,
                  sum(l_extendedprice) AS l_extendedprice_SUM FROM ({_LO}) t GROUP BY o_custkey, l_orderkey)
SELECT o_custkey, avg(l_quantity_MEAN) AS l_quantity_MEAN, avg(l_quantity_MAX) AS l_quantity_MAX,
       avg(l_extendedprice_SUM) AS l_extendedprice_SUM FROM s GROUP BY o_custkey""")
def q_agg_two_level(spark, d):
    return A.profile_two_level(_lo(spark, d), "l_orderkey", "o_custkey",
                               {"l_quantity": ["mean", "max"], "l_extendedprice": ["sum"]})


@query("agg_nested_children", """
WITH c AS (SELECT l_orderkey AS o_orderkey, sum(l_quantity) AS LI_l_quantity_SUM, max(l_quantity) AS LI_l_quantity_MAX,
                  avg(l_discount) AS LI_l_discount_MEAN FROM lineitem GROUP BY l_orderkey),
p AS (SELECT o.o_custkey, o.o_totalprice, o.o_orderstatus, c.* EXCLUDE (o_orderkey) FROM orders o LEFT JOIN c USING (o_orderkey))
SELECT o_custkey, avg(o_totalprice) AS CC_o_totalprice_MEAN, max(o_totalprice) AS CC_o_totalprice_MAX,
       avg((o_orderstatus = 'F')::INT) AS CC_o_orderstatus_F_MEAN, avg((o_orderstatus = 'O')::INT) AS CC_o_orderstatus_O_MEAN,
       avg((o_orderstatus = 'P')::INT) AS CC_o_orderstatus_P_MEAN, avg((o_orderstatus IS NULL)::INT) AS CC_o_orderstatus_nan_MEAN,
       avg(LI_l_quantity_SUM) AS CC_LI_l_quantity_SUM_MEAN, max(LI_l_quantity_SUM) AS CC_LI_l_quantity_SUM_MAX,
       avg(LI_l_quantity_MAX) AS CC_LI_l_quantity_MAX_MEAN, max(LI_l_quantity_MAX) AS CC_LI_l_quantity_MAX_MAX,
       avg(LI_l_discount_MEAN) AS CC_LI_l_discount_MEAN_MEAN, max(LI_l_discount_MEAN) AS CC_LI_l_discount_MEAN_MAX
FROM p GROUP BY o_custkey""")
def q_agg_nested_children(spark, d):
    child = T(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return A.profile_children(child, T(spark, d, "orders"), "o_orderkey", "o_custkey",
                              {"l_quantity": ["sum", "max"], "l_discount": ["mean"]},
                              parent_stats=["mean", "max"], child_prefix="LI_", prefix="CC_",
                              parent_cols=["o_totalprice"], parent_onehot=["o_orderstatus"])


def _cond_sql(pre, cond):
    f = f" FILTER (WHERE {cond})" if cond else ""
    cnt = f"count_if({cond})" if cond else "count(*)"
    return (f"min(o_totalprice){f} AS {pre}o_totalprice_MIN, max(o_totalprice){f} AS {pre}o_totalprice_MAX, "
            f"avg(o_totalprice){f} AS {pre}o_totalprice_MEAN, sum(o_totalprice){f} AS {pre}o_totalprice_SUM, "
            f"{cnt} AS {pre}o_totalprice_SIZE")


@query("agg_conditional", "SELECT o_custkey, " + ", ".join(
    [_cond_sql("ALL_", None), _cond_sql("F_", "o_orderstatus = 'F'"), _cond_sql("O_", "o_orderstatus = 'O'")])
    + " FROM orders GROUP BY o_custkey")
def q_agg_conditional(spark, d):
    s = F.col("o_orderstatus")
    return A.profile_subsets(T(spark, d, "orders"), "o_custkey",
                             {"ALL_": None, "F_": s == "F", "O_": s == "O"},
                             {"o_totalprice": ["min", "max", "mean", "sum", "size"]})


@query("agg_conditional_counts", """
SELECT o_custkey, count_if(o_orderstatus = 'F') AS n_F, count_if(o_orderpriority = '1-URGENT') AS n_urgent,
       count_if(o_totalprice > 300000) AS n_big FROM orders GROUP BY o_custkey""")
def q_agg_conditional_counts(spark, d):
    return A.count_when(T(spark, d, "orders"), "o_custkey", {
        "n_F": F.col("o_orderstatus") == "F", "n_urgent": F.col("o_orderpriority") == "1-URGENT",
        "n_big": F.col("o_totalprice") > 300000})


_EV_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("agg_status_counts", "SELECT user_id, " + ", ".join(
    f"nullif(count_if(event_type = '{v}'), 0) AS STATUS_{v}, nullif(count_if(event_type = '{v}'), 0) / nullif(abs(min(month_no)), 0) AS STATUS_{v}_RATIO"
    for v in _EV_TYPES) + """, abs(min(month_no)) AS MONTHS
FROM (SELECT *, (year(ts) - 2030) * 12 + month(ts) AS month_no FROM events) GROUP BY user_id""")
def q_agg_status_counts(spark, d):
    ev = T(spark, d, "events").withColumn("month_no", ((F.year("ts") - 2030) * 12 + F.month("ts")).cast("long"))
    return A.status_counts(ev, "user_id", "event_type", _EV_TYPES, months="month_no")


@query("agg_first_last", """
SELECT user_id, arg_min(status, ts) FILTER (WHERE status IS NOT NULL) AS status_FIRST,
       arg_max(status, ts) FILTER (WHERE status IS NOT NULL) AS status_LAST
FROM (SELECT user_id, ts, nullif(event_type, 'view') AS status FROM events) t GROUP BY user_id""")
def q_agg_first_last(spark, d):
    e = T(spark, d, "events").select("user_id", "ts", F.nullif("event_type", F.lit("view")).alias("status"))
    return A.first_last(e, "user_id", "ts", "status")


@query("agg_last_when", """
WITH m AS (SELECT user_id, ts, event_type, date_diff('day', CAST(max(ts) OVER (PARTITION BY user_id) AS DATE), CAST(ts AS DATE)) AS month FROM events)
SELECT user_id, abs(min(month) FILTER (WHERE event_type = 'error')) AS error_oldest_month FROM m GROUP BY user_id""")
def q_agg_last_when(spark, d):
    e = A.with_group_max(T(spark, d, "events"), "user_id", "ts", "ts_max") \
        .withColumn("month", F.datediff("ts", "ts_max"))
    return A.last_when(e, "user_id", "month", F.col("event_type") == "error", "error_oldest_month")


@query("agg_size", "SELECT o_orderstatus, o_orderpriority, count(*) AS size FROM orders GROUP BY 1, 2")
def q_agg_size(spark, d):
    return A.group_size(T(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("agg_distinct", f"SELECT o_custkey, count(DISTINCT l_partkey) AS l_partkey_nunique FROM ({_LO}) t GROUP BY o_custkey")
def q_agg_distinct(spark, d):
    return A.distinct_count(_lo(spark, d), "o_custkey", "l_partkey")


@query("agg_sem", """
SELECT l_suppkey, avg(l_extendedprice) AS l_extendedprice_MEAN, max(l_extendedprice) AS l_extendedprice_MAX,
       min(l_extendedprice) AS l_extendedprice_MIN, stddev_samp(l_extendedprice) / sqrt(count(l_extendedprice)) AS l_extendedprice_SEM,
       stddev_samp(l_extendedprice) AS l_extendedprice_STD
FROM lineitem GROUP BY l_suppkey""")
def q_agg_sem(spark, d):
    return A.profile(T(spark, d, "lineitem"), "l_suppkey", {"l_extendedprice": ["mean", "max", "min", "sem", "std"]})


@query("agg_user_profile", """
WITH p AS (SELECT o_custkey AS c_custkey, avg(o_totalprice) AS o_totalprice_MEAN, sum(o_totalprice) AS o_totalprice_SUM,
                  max(o_totalprice) AS o_totalprice_MAX, count(o_orderkey) AS o_orderkey_COUNT
           FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey)
SELECT c.c_custkey, coalesce(o_totalprice_MEAN, 0) AS o_totalprice_MEAN, coalesce(o_totalprice_SUM, 0) AS o_totalprice_SUM,
       coalesce(o_totalprice_MAX, 0) AS o_totalprice_MAX, coalesce(o_orderkey_COUNT, 0) AS o_orderkey_COUNT
FROM customer c LEFT JOIN p USING (c_custkey)""")
def q_agg_user_profile(spark, d):
    o = T(spark, d, "orders").where(F.col("o_orderstatus") == "P").withColumnRenamed("o_custkey", "c_custkey")
    p = A.profile(o, "c_custkey", {"o_totalprice": ["mean", "sum", "max"], "o_orderkey": ["count"]})
    return T(spark, d, "customer").select("c_custkey").join(p, "c_custkey", "left").fillna(0)


@query("agg_concat_strings", """
SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ' ' ORDER BY l_partkey) AS l_partkey_list FROM lineitem GROUP BY l_orderkey""")
def q_agg_concat_strings(spark, d):
    return A.concat_ids(T(spark, d, "lineitem"), "l_orderkey", "l_partkey", " ")


@query("agg_group_max_ts", """
SELECT event_id, user_id, event_type, max(ts) OVER (PARTITION BY user_id, event_type) AS ts_max FROM events""")
def q_agg_group_max_ts(spark, d):
    e = T(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return A.with_group_max(e, ["user_id", "event_type"], "ts", "ts_max").drop("ts")


@query("agg_shape", f"SELECT count(*) AS n_rows, CAST({17} AS BIGINT) AS n_cols FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey")
def q_agg_shape(spark, d):
    o = T(spark, d, "orders")
    return A.shape(T(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")))
