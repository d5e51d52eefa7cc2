"""Sessionised basket (re-order) features.

Input contract (column names are the conventional grocery-basket ones):

orders: order_id, user_id, eval_set ('prior' | 'train' | 'test'),
        order_number, days_since_prior_order
lines:  order_id, product_id, add_to_cart_order, reordered (0/1)

Every block is a grouped aggregation with map-side partial aggregation;
joins are on the aggregated keys, so each side is shuffled once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import safe_div
from ..sources.io import stage


def prior_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of prior orders with user and order number attached."""
    po = orders.where(F.col("eval_set") == "prior").select("order_id", "user_id", "order_number")
    return po.join(lines, "order_id", "inner")


def pair_counts(op: DataFrame) -> DataFrame:
    """One row per (user, product): what the product, user and pair features need of its lines."""
    return op.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("reordered").alias("_r"),
        F.count_if(F.col("reordered") == 1).alias("_r1"), F.count_if(F.col("order_number") > 1).alias("_later"),
        F.min("order_number").alias("_first"), F.max("order_number").alias("_last"),
        F.sum("add_to_cart_order").alias("_cart"), F.count("add_to_cart_order").alias("_carts"))


def product_features(op: DataFrame) -> DataFrame:
    """prod_orders, prod_reorder_probability, prod_reorder_times, prod_reorder_ratio.

    ``product_time == 1`` holds once per (user, product) pair and
    ``product_time == 2`` once per pair bought at least twice, so both
    counts come from a pair aggregate — no per-pair numbering is needed.
    """
    return _products(pair_counts(op))


def _products(pairs: DataFrame) -> DataFrame:
    a = pairs.groupBy("product_id").agg(
        F.sum("_n").alias("prod_orders"),
        F.sum("_r").alias("prod_reorders"),
        F.count(F.lit(1)).alias("prod_first_orders"),
        F.count_if(F.col("_n") >= 2).alias("prod_second_orders"))
    return a.select(
        "product_id", "prod_orders",
        safe_div("prod_second_orders", "prod_first_orders").alias("prod_reorder_probability"),
        (1 + safe_div("prod_reorders", "prod_first_orders")).alias("prod_reorder_times"),
        safe_div("prod_reorders", "prod_orders").alias("prod_reorder_ratio"))


def user_order_features(orders: DataFrame) -> DataFrame:
    """user_orders, user_period, user_mean_days_since_prior from prior orders."""
    return (orders.where(F.col("eval_set") == "prior").groupBy("user_id")
            .agg(F.max("order_number").alias("user_orders"),
                 F.sum("days_since_prior_order").alias("user_period"),
                 F.avg("days_since_prior_order").alias("user_mean_days_since_prior")))


def user_product_mix(op: DataFrame) -> DataFrame:
    """user_total_products, user_reorder_ratio, user_distinct_products."""
    return _mix(pair_counts(op))


def _mix(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("user_id").agg(
        F.sum("_n").alias("user_total_products"),
        safe_div(F.sum("_r1"), F.sum("_later")).alias("user_reorder_ratio"),
        F.count("product_id").alias("user_distinct_products"))


def user_features(orders: DataFrame, op: DataFrame) -> DataFrame:
    """Both user blocks + user_average_basket + the user's current (train/test) order."""
    return _users(orders, pair_counts(op))


def _users(orders: DataFrame, pairs: DataFrame) -> DataFrame:
    u = user_order_features(orders).join(_mix(pairs), "user_id", "inner")
    u = u.withColumn("user_average_basket", safe_div("user_total_products", "user_orders"))
    cur = orders.where(F.col("eval_set") != "prior").select(
        "user_id", "order_id", "eval_set", "days_since_prior_order")
    return u.join(cur, "user_id", "inner")


def pair_features(op: DataFrame) -> DataFrame:
    """up_first_order, up_last_order, up_orders, up_average_cart_position."""
    return _pairs(pair_counts(op))


def _pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select("user_id", "product_id", F.col("_first").alias("up_first_order"), F.col("_last").alias("up_last_order"),
                        F.col("_n").alias("up_orders"), safe_div("_cart", "_carts").alias("up_average_cart_position"))


def basket_features(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per (user, product) with user, product and pair features and the label.

    ``reordered`` is the label from the user's train order (0 when the
    product is absent from it); NULL for test users.

    Lines become (user, product) counts once, a written table that all three
    blocks read.  Labels and product features meet these narrow rows; the
    user's columns come last, so wide rows are never shuffled.
    """
    pairs = stage(pair_counts(prior_lines(orders, lines)), "basket_pairs")
    train_lines = (orders.where(F.col("eval_set") == "train").select("order_id", "user_id")
                   .join(lines.select("order_id", "product_id", F.col("reordered").alias("label")),
                         "order_id").drop("order_id"))
    up = _pairs(pairs).join(train_lines, ["user_id", "product_id"], "left")
    d = _users(orders, pairs).join(_products(pairs).join(up, "product_id", "inner"), "user_id", "inner")
    d = d.select("user_id", "product_id", *[c for c in d.columns if c not in ("user_id", "product_id", "label")],
                 safe_div("up_orders", "user_orders").alias("up_order_rate"),
                 (F.col("user_orders") - F.col("up_last_order")).alias("up_orders_since_last_order"),
                 safe_div("up_orders", F.col("user_orders") - F.col("up_first_order") + 1).alias("up_order_rate_since_first_order"), "label")
    return d.withColumn("reordered", F.when(F.col("eval_set") == "train",
                                            F.coalesce(F.col("label"), F.lit(0)))).drop("label")


def basket_submission(scored: DataFrame, score: str, threshold: float,
                      order_col: str = "order_id", item_col: str = "product_id") -> DataFrame:
    """One row per order: ids whose score exceeds ``threshold``, space-joined
    in ascending id order; NULL for orders with none (bk_submission)."""
    picked = (scored.where(F.col(score) > threshold)
              .groupBy(order_col)
              .agg(F.array_join(F.array_sort(F.collect_list(F.col(item_col))), " ").alias("products")))
    ids = scored.select(order_col).distinct()
    return ids.join(picked, order_col, "left")
