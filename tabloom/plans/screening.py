"""Feature-screening queries — SURVEY §2.13.

Feature table: one row per customer with balance, nation, order count and
price statistics, a constant and a 0/1 column; class = segment BUILDING;
train/test = portable hash split (4/5 train).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.semantics import portable_hash
from ..operators import screen as S
from ..sources.fixtures import table
from . import query

FEATURES = ["f_acctbal", "f_nation", "f_orders", "f_avg_price", "f_max_price", "f_const", "f_pos"]

FEAT_SQL = """feat AS (
  SELECT c.c_custkey, c.c_acctbal AS f_acctbal, CAST(c.c_nationkey AS DOUBLE) AS f_nation, CAST(o.n AS DOUBLE) AS f_orders,
         CASE WHEN c.c_custkey % 7 <> 0 THEN o.avg_price END AS f_avg_price, CASE WHEN c.c_custkey % 7 <> 0 THEN o.max_price END AS f_max_price, 1.0 AS f_const, CAST(c.c_acctbal > 0 AS DOUBLE) AS f_pos,
         CAST(c.c_mktsegment = 'BUILDING' AS BIGINT) AS target,
         CAST(('0x' || substr(md5(CAST(c.c_custkey AS VARCHAR)), 1, 8))::BIGINT % 5 <> 0 AS BIGINT) AS is_train
  FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS avg_price, max(o_totalprice) AS max_price
                             FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey),
long AS (SELECT * FROM (UNPIVOT feat ON """ + ", ".join(FEATURES) + """ INTO NAME feature VALUE value) WHERE value IS NOT NULL)"""


def feature_table(spark, d):
    o = (table(spark, d, "orders").groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("avg_price"),
              F.max("o_totalprice").alias("max_price")))
    c = table(spark, d, "customer")
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.select("c_custkey", F.col("c_acctbal").alias("f_acctbal"), F.col("c_nationkey").cast("double").alias("f_nation"),
                    F.col("n").cast("double").alias("f_orders"), F.when(F.col("c_custkey") % 7 != 0, F.col("avg_price")).alias("f_avg_price"),
                    F.when(F.col("c_custkey") % 7 != 0, F.col("max_price")).alias("f_max_price"), F.lit(1.0).alias("f_const"),
                    (F.col("c_acctbal") > 0).cast("double").alias("f_pos"),
                    (F.col("c_mktsegment") == "BUILDING").cast("long").alias("target"),
                    (portable_hash("c_custkey") % 5 != 0).cast("long").alias("is_train"))


def _long(spark, d):
    return S.to_long(feature_table(spark, d), ["c_custkey", "target", "is_train"], FEATURES)


def _erfc_sql(x):
    t = f"(1 / (1 + {S.ERFC_P} * ({x})))"
    poly = "0.0"
    for a in reversed(S.ERFC_A):
        poly = f"(({poly} + {a}) * {t})"
    return f"({poly} * exp(-({x}) * ({x})))"


def _classdiff_sql(src, g, name="class_diff"):
    return f"""SELECT feature, CASE WHEN bool_and(value IN (0.0, 1.0))
          THEN abs(avg(value) FILTER (WHERE {g} = 0) - avg(value) FILTER (WHERE {g} = 1))
          ELSE abs(median(value) FILTER (WHERE {g} = 0) - median(value) FILTER (WHERE {g} = 1)) END AS {name},
          avg(value) AS mean FROM {src} GROUP BY feature"""


def _ranksum_sql(src, g):
    z = "(w - n1 * (n0 + n1 + 1) / 2.0) / nullif(sqrt(CAST(n0 AS DOUBLE) * n1 * (n0 + n1 + 1) / 12.0), 0)"
    return f"""SELECT feature, n0, n1, {z} AS z,
           CASE WHEN n0 < 20 OR n1 < 20 THEN 2.0 ELSE {_erfc_sql(f'abs({z}) / sqrt(2.0)')} END AS p
    FROM (SELECT feature, sum(n0v) AS n0, sum(n1v) AS n1, sum(n1v * (cum - nv + (nv + 1) / 2.0)) AS w
          FROM (SELECT *, sum(nv) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum
                FROM (SELECT feature, value, count_if({g} = 0) AS n0v, count_if({g} = 1) AS n1v, count(*) AS nv
                      FROM {src} GROUP BY feature, value)) GROUP BY feature)"""


@query("fs_constant", "WITH " + FEAT_SQL + "\nSELECT " + " UNION ALL SELECT ".join(
    f"'{c}' AS feature, CAST(coalesce(min({c}) = max({c}), true) AS BIGINT) AS is_constant FROM feat" for c in FEATURES))
def q_fs_constant(spark, d):
    return S.constant_columns(feature_table(spark, d), FEATURES)


@query("fs_class_diff", "WITH " + FEAT_SQL + "\n" + _classdiff_sql("long", "target"))
def q_fs_class_diff(spark, d):
    return S.class_diff(_long(spark, d), "target")


@query("fs_ranksum", "WITH " + FEAT_SQL + "\n" + _ranksum_sql("long", "target"))
def q_fs_ranksum(spark, d):
    return S.rank_sum(_long(spark, d), "target")


@query("fs_same_dist", "WITH " + FEAT_SQL + f""",
cd AS ({_classdiff_sql('long', 'target')}), rs AS ({_ranksum_sql('long', 'target')})
SELECT feature, abs(class_diff / nullif(mean, 0)) AS diff_norm, p,
       CAST(coalesce((class_diff = 0 AND p > 0.05) OR (abs(class_diff / nullif(mean, 0)) < 0.5 AND p > 0.05), false) AS BIGINT) AS "drop"
FROM cd JOIN rs USING (feature)""")
def q_fs_same_dist(spark, d):
    return S.same_distribution(_long(spark, d), "target")


@query("fs_drift", "WITH " + FEAT_SQL + f""",
dr AS ({_classdiff_sql('long', 'is_train', 'drift')}),
rs AS ({_ranksum_sql('long', 'is_train')}),
cd AS (SELECT feature, abs(class_diff / nullif(mean, 0)) AS class_norm FROM ({_classdiff_sql('(SELECT * FROM long WHERE is_train = 1)', 'target')}))
SELECT feature, abs(drift / nullif(mean, 0)) AS drift_norm, p,
       CAST(coalesce(p < 0.05 AND abs(drift / nullif(mean, 0)) > 1 AND class_norm = 0, false) AS BIGINT) AS "drop"
FROM dr JOIN rs USING (feature) LEFT JOIN cd USING (feature)""")
def q_fs_drift(spark, d):
    return S.train_test_drift(_long(spark, d), "is_train", "target")
