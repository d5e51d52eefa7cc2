"""Basket (re-order) queries — SURVEY §2.7."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import basket as bk
from ..sources.fixtures import BASKET_SQL, basket_lines, basket_orders
from . import query


def _inputs(spark, d):
    o = basket_orders(spark, d)
    return o, basket_lines(spark, d, o)


W = "WITH " + BASKET_SQL.strip() + ",\n"

OP_SQL = """
b_op AS (SELECT o.user_id, o.order_number, l.* FROM b_orders o JOIN b_lines l USING (order_id) WHERE o.eval_set = 'prior')
"""

PRD_SQL = """
b_pt AS (SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number) AS product_time FROM b_op),
b_prd AS (
  SELECT product_id, count(*) AS prod_orders,
         count_if(product_time = 2) / nullif(count_if(product_time = 1), 0) AS prod_reorder_probability,
         1 + sum(reordered) / nullif(count_if(product_time = 1), 0) AS prod_reorder_times,
         sum(reordered) / nullif(count(*), 0) AS prod_reorder_ratio
  FROM b_pt GROUP BY product_id)
"""

USR_SQL = """
b_u1 AS (SELECT user_id, max(order_number) AS user_orders, sum(days_since_prior_order) AS user_period,
                avg(days_since_prior_order) AS user_mean_days_since_prior
         FROM b_orders WHERE eval_set = 'prior' GROUP BY user_id),
b_u2 AS (SELECT user_id, count(*) AS user_total_products,
                count_if(reordered = 1) / nullif(count_if(order_number > 1), 0) AS user_reorder_ratio,
                count(DISTINCT product_id) AS user_distinct_products
         FROM b_op GROUP BY user_id),
b_users AS (
  SELECT b_u1.*, b_u2.user_total_products, b_u2.user_reorder_ratio, b_u2.user_distinct_products,
         b_u2.user_total_products / nullif(b_u1.user_orders, 0) AS user_average_basket,
         c.order_id, c.eval_set, c.days_since_prior_order
  FROM b_u1 JOIN b_u2 USING (user_id)
  JOIN (SELECT user_id, order_id, eval_set, days_since_prior_order FROM b_orders WHERE eval_set <> 'prior') c USING (user_id))
"""

UP_SQL = """
b_up AS (SELECT user_id, product_id, min(order_number) AS up_first_order, max(order_number) AS up_last_order,
                count(*) AS up_orders, avg(add_to_cart_order) AS up_average_cart_position
         FROM b_op GROUP BY user_id, product_id)
"""

FEAT_SQL = """
b_feat AS (
  SELECT u.*, p.prod_orders, p.prod_reorder_probability, p.prod_reorder_times, p.prod_reorder_ratio,
         up.product_id, up.up_first_order, up.up_last_order, up.up_orders, up.up_average_cart_position,
         up.up_orders / nullif(u.user_orders, 0) AS up_order_rate,
         u.user_orders - up.up_last_order AS up_orders_since_last_order,
         up.up_orders / nullif(u.user_orders - up.up_first_order + 1, 0) AS up_order_rate_since_first_order,
         CASE WHEN u.eval_set = 'train' THEN coalesce(t.reordered, 0) END AS reordered
  FROM b_users u JOIN b_up up USING (user_id) JOIN b_prd p USING (product_id)
  LEFT JOIN (SELECT o.user_id, l.product_id, l.reordered FROM b_orders o JOIN b_lines l USING (order_id)
             WHERE o.eval_set = 'train') t ON t.user_id = u.user_id AND t.product_id = up.product_id)
"""


@query("bk_product", W + OP_SQL.strip() + "," + PRD_SQL + "SELECT * FROM b_prd")
def q_bk_product(spark, d):
    o, l = _inputs(spark, d)
    return bk.product_features(bk.prior_lines(o, l))


@query("bk_user_orders", W.rstrip(",\n") + """
SELECT user_id, CAST(max(order_number) AS BIGINT) AS user_orders, sum(days_since_prior_order) AS user_period,
       avg(days_since_prior_order) AS user_mean_days_since_prior
FROM b_orders WHERE eval_set = 'prior' GROUP BY user_id""")
def q_bk_user_orders(spark, d):
    return bk.user_order_features(basket_orders(spark, d))


@query("bk_user_products", W + OP_SQL.strip() + """
SELECT user_id, count(*) AS user_total_products,
       count_if(reordered = 1) / nullif(count_if(order_number > 1), 0) AS user_reorder_ratio,
       count(DISTINCT product_id) AS user_distinct_products
FROM b_op GROUP BY user_id""")
def q_bk_user_products(spark, d):
    o, l = _inputs(spark, d)
    return bk.user_product_mix(bk.prior_lines(o, l))


@query("bk_user_product", W + OP_SQL.strip() + "," + UP_SQL + "SELECT * FROM b_up")
def q_bk_user_product(spark, d):
    o, l = _inputs(spark, d)
    return bk.pair_features(bk.prior_lines(o, l))


FEATURES_SQL = (W + OP_SQL.strip() + "," + PRD_SQL.strip() + "," + USR_SQL.strip() + ","
                + UP_SQL.strip() + "," + FEAT_SQL)


@query("bk_features", FEATURES_SQL + "SELECT * FROM b_feat")
def q_bk_features(spark, d):
    o, l = _inputs(spark, d)
    return bk.basket_features(o, l)


@query("bk_submission", FEATURES_SQL + """
, b_sc AS (SELECT * FROM b_feat WHERE eval_set = 'test')
SELECT ids.order_id, p.products
FROM (SELECT DISTINCT order_id FROM b_sc) ids
LEFT JOIN (SELECT order_id, string_agg(CAST(product_id AS VARCHAR), ' ' ORDER BY product_id) AS products
           FROM b_sc WHERE up_order_rate > 0.21 GROUP BY order_id) p USING (order_id)""")
def q_bk_submission(spark, d):
    o, l = _inputs(spark, d)
    test = bk.basket_features(o, l).where(F.col("eval_set") == "test")
    return bk.basket_submission(test, "up_order_rate", 0.21)
