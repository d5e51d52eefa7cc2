"""Adapters: driver test tables → the input shapes the operators expect.

Each adapter has a Spark builder and the matching SQL text (a CTE list)
so that a query and its SQL oracle start from the same derived tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import ordered_pass
from .io import stage

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- basket
# orders → (order_id, user_id, eval_set, order_number, days_since_prior_order)
# lineitem → (order_id, product_id, add_to_cart_order, reordered)

def basket_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("order_date"))
    o = ordered_pass(o, "user_id", ["order_date", "order_id"], lag=["order_date"])
    o = (o.withColumn("days_since_prior_order", F.datediff("order_date", "prev_order_date").cast("double"))
          .withColumn("eval_set",
                      F.when(F.col("rn") < F.col("n"), "prior")
                       .when(F.col("user_id") % 4 != 0, "train").otherwise("test"))
          .withColumn("order_number", F.col("rn").cast("int")))
    # several features read the numbered orders: the pass is done once, not once per reader
    return stage(o.select("order_id", "user_id", "eval_set", "order_number", "days_since_prior_order"), "basket_orders")


def basket_lines(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """One row per (order, product); ``reordered`` = product in an earlier order of the user."""
    orders = orders if orders is not None else basket_orders(spark, sf_dir)
    # dealt by order once: equal products of an order are found and orders joined without another shuffle
    li = (table(spark, sf_dir, "lineitem")
          .select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), "l_linenumber").repartition("order_id")
          .groupBy("order_id", "product_id").agg(F.min("l_linenumber").alias("add_to_cart_order")))
    j = li.join(orders.select("order_id", "user_id", "order_number"), "order_id").where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
    # earlier order of the same user with the same product ⇔ not the pair's first order
    first = F.min("order_number").over(Window.partitionBy("user_id", "product_id"))
    return stage(j.select("order_id", "product_id", "add_to_cart_order", (F.col("order_number") > first).cast("int").alias("reordered")), "basket_lines")


BASKET_SQL = """
b_o1 AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
         row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS order_number
  FROM orders),
b_o2 AS (
  SELECT *, CAST(date_diff('day', lag(order_date) OVER (PARTITION BY user_id ORDER BY order_number), order_date) AS DOUBLE) AS days_since_prior_order,
         max(order_number) OVER (PARTITION BY user_id) AS n_orders
  FROM b_o1),
b_orders AS (
  SELECT order_id, user_id,
         CASE WHEN order_number < n_orders THEN 'prior' WHEN user_id % 4 <> 0 THEN 'train' ELSE 'test' END AS eval_set,
         order_number, days_since_prior_order
  FROM b_o2),
b_l1 AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, min(l_linenumber) AS add_to_cart_order
  FROM lineitem GROUP BY l_orderkey, l_partkey),
b_lines AS (
  SELECT l.order_id, l.product_id, l.add_to_cart_order,
         CAST(row_number() OVER (PARTITION BY o.user_id, l.product_id ORDER BY o.order_number) > 1 AS BIGINT) AS reordered
  FROM b_l1 l JOIN b_orders o USING (order_id))
"""


# ---------------------------------------------------------------- energy
# events → (obs_id, site, forecast, ts, value, minute, hour, day, dow)

def energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("obs_id"), F.col("user_id").alias("site"),
                    F.col("event_type").alias("forecast"), "ts", F.col("value"),
                    F.minute("ts").alias("minute"), F.hour("ts").alias("hour"),
                    F.dayofmonth("ts").alias("day"), F.weekday("ts").alias("dow"))


ENERGY_SQL = """
en AS (
  SELECT event_id AS obs_id, user_id AS site, event_type AS forecast, ts, value,
         CAST(minute(ts) AS BIGINT) AS minute, CAST(hour(ts) AS BIGINT) AS hour,
         CAST(dayofmonth(ts) AS BIGINT) AS day, CAST(isodow(ts) - 1 AS BIGINT) AS dow
  FROM events)
"""
