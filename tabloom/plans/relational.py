"""Projection, filter, null handling, joins, sort/set queries — SURVEY §2.2, §2.3, §2.5."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import nulls as N
from ..operators import project as P
from ..operators import ranking as R
from ..operators.aggregate import concat_ids, profile
from ..sources.fixtures import BASKET_SQL, basket_lines, basket_orders, table
from . import query


def T(spark, d, name):
    return table(spark, d, name)


# ------------------------------------------------------------------ §2.2
@query("prj_drop", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def q_prj_drop(spark, d):
    return T(spark, d, "customer").drop("c_name", "c_mktsegment")


@query("prj_select_by_type", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def q_prj_select_by_type(spark, d):
    return P.select_by_type(T(spark, d, "lineitem"), "numeric", keep=["l_orderkey"])


@query("prj_rename", """
SELECT o_custkey, min(o_totalprice) AS o_totalprice_MIN, max(o_totalprice) AS o_totalprice_MAX,
       count(*) AS o_orderkey_SIZE
FROM orders GROUP BY o_custkey""")
def q_prj_rename(spark, d):
    return profile(T(spark, d, "orders"), "o_custkey", {"o_totalprice": ["min", "max"], "o_orderkey": ["size"]})


@query("prj_arith_features", """
SELECT l_orderkey, l_linenumber, l_partkey,
       l_extendedprice * (1 - l_discount) AS disc_price,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
       l_extendedprice / nullif(l_quantity, 0) AS price_per_unit,
       l_discount / nullif(l_tax, 0) AS discount_tax_ratio,
       l_extendedprice / 12 - l_quantity AS monthly_minus_qty,
       l_extendedprice / (1 + l_quantity) AS price_per_unit_plus1,
       l_quantity - l_linenumber AS qty_minus_line
FROM lineitem""")
def q_prj_arith_features(spark, d):
    li = T(spark, d, "lineitem")
    from ..functions.semantics import safe_div
    return P.derive(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                              "l_discount", "l_tax", "l_quantity"), {
        "disc_price": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "charge": F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")),
        "price_per_unit": safe_div("l_extendedprice", "l_quantity"),
        "discount_tax_ratio": safe_div("l_discount", "l_tax"),
        "monthly_minus_qty": F.col("l_extendedprice") / 12 - F.col("l_quantity"),
        "price_per_unit_plus1": safe_div("l_extendedprice", 1 + F.col("l_quantity")),
        "qty_minus_line": F.col("l_quantity") - F.col("l_linenumber"),
    }).drop("l_extendedprice", "l_discount", "l_tax", "l_quantity")


_LI_NULLS = "SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_discount, 0) AS disc, nullif(l_tax, 0) AS tax FROM lineitem"


def _li_nulls(spark, d):
    return T(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.nullif("l_discount", F.lit(0.0)).alias("disc"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))


@query("prj_row_stats", f"""
SELECT l_orderkey, l_linenumber,
       list_avg(list_filter([l_quantity, disc, tax], lambda x: x IS NOT NULL)) AS row_mean,
       CASE WHEN len(list_filter([l_quantity, disc, tax], lambda x: x IS NOT NULL)) > 1
            THEN list_stddev_samp(list_filter([l_quantity, disc, tax], lambda x: x IS NOT NULL)) END AS row_std
FROM ({_LI_NULLS}) t""")
def q_prj_row_stats(spark, d):
    t = _li_nulls(spark, d)
    return P.row_stats(t, ["l_quantity", "disc", "tax"]).select("l_orderkey", "l_linenumber", "row_mean", "row_std")


@query("prj_row_sum", f"""
SELECT l_orderkey, l_linenumber, coalesce(l_quantity, 0) + coalesce(disc, 0) + coalesce(tax, 0) AS row_total
FROM ({_LI_NULLS}) t""")
def q_prj_row_sum(spark, d):
    return P.row_sum(_li_nulls(spark, d), ["l_quantity", "disc", "tax"], "row_total") \
        .select("l_orderkey", "l_linenumber", "row_total")


@query("prj_indicator", f"""
SELECT l_orderkey, l_linenumber, CAST(coalesce(disc > 0.05, false) AS BIGINT) AS high_discount
FROM ({_LI_NULLS}) t""")
def q_prj_indicator(spark, d):
    return P.indicator(_li_nulls(spark, d), F.col("disc") > 0.05, "high_discount") \
        .select("l_orderkey", "l_linenumber", "high_discount")


@query("prj_line_indicator", """
SELECT l_orderkey, l_linenumber, CAST(coalesce(l_extendedprice > 1000 * l_quantity + 500, false) AS BIGINT) AS above_line
FROM lineitem""")
def q_prj_line_indicator(spark, d):
    return P.line_indicator(T(spark, d, "lineitem"), "l_extendedprice", "l_quantity", 1000, 500, "above_line") \
        .select("l_orderkey", "l_linenumber", "above_line")


@query("prj_isin_flag", """
SELECT p_partkey, CAST(coalesce(p_size IN (1, 5, 10, 25, 50), false) AS BIGINT) AS popular_size FROM part""")
def q_prj_isin_flag(spark, d):
    return P.isin_flag(T(spark, d, "part"), "p_size", [1, 5, 10, 25, 50], "popular_size") \
        .select("p_partkey", "popular_size")


@query("prj_abs", "SELECT c_custkey, abs(c_acctbal) AS c_acctbal FROM customer")
def q_prj_abs(spark, d):
    return P.abs_cols(T(spark, d, "customer"), ["c_acctbal"]).select("c_custkey", "c_acctbal")


@query("prj_log1p_cap", """
SELECT o_orderkey, least(ln(1 + coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, 0)), 12.5) AS price_log
FROM orders""")
def q_prj_log1p_cap(spark, d):
    o = T(spark, d, "orders")
    x = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return o.select("o_orderkey", P.log1p_cap(x, 12.5).alias("price_log"))


@query("prj_tail_flag", """
SELECT o_orderkey, CAST(coalesce(ln(1 + o_totalprice) >= 12.5, false) AS BIGINT) AS price_tail FROM orders""")
def q_prj_tail_flag(spark, d):
    return T(spark, d, "orders").select("o_orderkey", P.tail_flag("o_totalprice", 12.5).alias("price_tail"))


@query("prj_clip", "SELECT c_custkey, greatest(least(c_acctbal / 10000, 1.0), 0.0) AS score FROM customer")
def q_prj_clip(spark, d):
    return T(spark, d, "customer").select("c_custkey", P.clip(F.col("c_acctbal") / 10000, 0.0, 1.0).alias("score"))


@query("prj_threshold", """
SELECT c_custkey, CASE WHEN greatest(least(c_acctbal / 10000, 1.0), 0.0) > 0.21 THEN 1 ELSE 0 END AS label
FROM customer""")
def q_prj_threshold(spark, d):
    c = T(spark, d, "customer").select("c_custkey", P.clip(F.col("c_acctbal") / 10000, 0.0, 1.0).alias("p"))
    return P.classify(c, "p", 0.21, "label").drop("p")


@query("prj_cast", """
SELECT l_orderkey, CAST(l_linenumber AS TINYINT) AS l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
       CAST(l_discount AS FLOAT) AS l_discount FROM lineitem""")
def q_prj_cast(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return P.cast_cols(li, {"l_linenumber": "tinyint", "l_quantity": "int", "l_discount": "float"})


_NARROW_COLS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]


@query("prj_narrow_schema", """
WITH s AS (SELECT min(l_orderkey) a1, max(l_orderkey) b1, min(l_partkey) a2, max(l_partkey) b2,
                  min(l_linenumber) a3, max(l_linenumber) b3,
                  max(abs(l_quantity - CAST(CAST(l_quantity AS FLOAT) AS DOUBLE)) / greatest(abs(l_quantity), 1e-30)) e4,
                  max(abs(l_extendedprice - CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE)) / greatest(abs(l_extendedprice), 1e-30)) e5,
                  max(abs(l_discount - CAST(CAST(l_discount AS FLOAT) AS DOUBLE)) / greatest(abs(l_discount), 1e-30)) e6
           FROM lineitem),
r AS (SELECT 'l_orderkey' AS column_name, a1 AS lo, b1 AS hi, NULL::DOUBLE AS err FROM s
      UNION ALL SELECT 'l_partkey', a2, b2, NULL FROM s UNION ALL SELECT 'l_linenumber', a3, b3, NULL FROM s
      UNION ALL SELECT 'l_quantity', NULL, NULL, e4 FROM s UNION ALL SELECT 'l_extendedprice', NULL, NULL, e5 FROM s
      UNION ALL SELECT 'l_discount', NULL, NULL, e6 FROM s)
SELECT column_name,
       CASE WHEN column_name IN ('l_quantity', 'l_extendedprice', 'l_discount')
            THEN CASE WHEN err IS NULL OR err <= 1e-6 THEN 'float' ELSE 'double' END
            WHEN lo >= -128 AND hi <= 127 THEN 'tinyint' WHEN lo >= -32768 AND hi <= 32767 THEN 'smallint'
            WHEN lo >= -2147483648 AND hi <= 2147483647 THEN 'int' ELSE 'bigint' END AS narrow_type
FROM r""")
def q_prj_narrow_schema(spark, d):
    li = T(spark, d, "lineitem").select(*_NARROW_COLS)
    return P.narrow_plan_table(li)


@query("prj_narrow_table", """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_partkey AS BIGINT) AS l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_extendedprice AS FLOAT) AS l_extendedprice, CAST(l_discount AS FLOAT) AS l_discount FROM lineitem""")
def q_prj_narrow_table(spark, d):
    """The table itself in the types of its plan."""
    return P.narrow_schema(T(spark, d, "lineitem").select(*_NARROW_COLS))


# ------------------------------------------------------------------ filters / nulls
@query("flt_predicate", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_discount BETWEEN 0.02 AND 0.05 AND l_returnflag <> 'R'""")
def q_flt_predicate(spark, d):
    li = T(spark, d, "lineitem")
    return N.where(li, (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                   & F.col("l_discount").between(0.02, 0.05) & (F.col("l_returnflag") != "R")) \
        .select("l_orderkey", "l_linenumber", "l_extendedprice")


_CUST_NULLS = """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, nullif(c_nationkey, 0) AS nation,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance FROM customer"""


def _cust_nulls(spark, d):
    c = T(spark, d, "customer")
    return c.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
                    F.nullif("c_nationkey", F.lit(0)).alias("nation"),
                    F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))


@query("flt_drop_rows", f"""
SELECT * FROM ({_CUST_NULLS}) t WHERE NOT coalesce(segment = 'AUTOMOBILE' AND balance < 3000, false)""")
def q_flt_drop_rows(spark, d):
    c = _cust_nulls(spark, d)
    return N.drop_where(c, (F.col("segment") == "AUTOMOBILE") & (F.col("balance") < 3000))


@query("nul_outlier_to_null", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS l_quantity,
       CASE WHEN l_discount < 0.01 OR l_discount > 0.09 THEN NULL ELSE l_discount END AS l_discount
FROM lineitem""")
def q_nul_outlier_to_null(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return N.null_outliers(li, {"l_quantity": (">", 45), "l_discount": ("outside", (0.01, 0.09))})


@query("nul_sentinel", "SELECT p_partkey, nullif(p_size, 50) AS p_size, nullif(p_size, 50) AS p_size2 FROM part")
def q_nul_sentinel(spark, d):
    p = T(spark, d, "part").select("p_partkey", "p_size", F.col("p_size").alias("p_size2"))
    return N.null_sentinel(p, ["p_size", "p_size2"], 50)


@query("nul_fill_const", f"""
SELECT c_custkey, coalesce(segment, 'unknown') AS segment, coalesce(nation, -999) AS nation,
       coalesce(balance, -999) AS balance FROM ({_CUST_NULLS}) t""")
def q_nul_fill_const(spark, d):
    return N.fill_by_type(_cust_nulls(spark, d), numeric=-999, text="unknown")


@query("nul_count_row", f"""
SELECT c_custkey, CAST(segment IS NULL AS INT) + CAST(nation IS NULL AS INT) + CAST(balance IS NULL AS INT) AS n_null
FROM ({_CUST_NULLS}) t""")
def q_nul_count_row(spark, d):
    return N.count_nulls(_cust_nulls(spark, d), ["segment", "nation", "balance"], "n_null") \
        .select("c_custkey", "n_null")


@query("nul_flags", f"""
SELECT *, CAST(segment IS NULL AS INT) AS no_na_segment, CAST(balance IS NULL AS INT) AS no_na_balance
FROM ({_CUST_NULLS}) t""")
def q_nul_flags(spark, d):
    return N.null_flags(_cust_nulls(spark, d), ["segment", "balance"])


@query("nul_split_target", """
SELECT d.doc_id, l.toxic, CASE WHEN l.toxic IS NOT NULL THEN 'train' ELSE 'test' END AS split
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_nul_split_target(spark, d):
    t = T(spark, d, "documents").select("doc_id").join(T(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")
    tr, te = N.split_on_target(t, "toxic")
    return tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))


# ------------------------------------------------------------------ §2.3 joins
@query("jn_inner", """
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, l.l_extendedprice, o.o_orderpriority
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'F'""")
def q_jn_inner(spark, d):
    o = T(spark, d, "orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return J.join(li, o, "l_orderkey", "inner")


@query("jn_left", """
SELECT c.c_custkey, c.c_mktsegment, p.n_pending
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_pending FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) p
ON c.c_custkey = p.o_custkey""")
def q_jn_left(spark, d):
    p = (T(spark, d, "orders").where(F.col("o_orderstatus") == "P").groupBy(F.col("o_custkey").alias("c_custkey"))
         .agg(F.count(F.lit(1)).alias("n_pending")))
    return J.join(T(spark, d, "customer").select("c_custkey", "c_mktsegment"), p, "c_custkey", "left")


@query("jn_left_composite", """
WITH a AS (SELECT l_partkey, l_suppkey, avg(l_quantity) AS avg_qty_part_supp FROM lineitem GROUP BY l_partkey, l_suppkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, a.avg_qty_part_supp
FROM lineitem l LEFT JOIN a ON l.l_partkey = a.l_partkey AND l.l_suppkey = a.l_suppkey""")
def q_jn_left_composite(spark, d):
    li = T(spark, d, "lineitem")
    a = li.groupBy("l_partkey", "l_suppkey").agg(F.avg("l_quantity").alias("avg_qty_part_supp"))
    return J.join(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), a,
                  ["l_partkey", "l_suppkey"], "left")


@query("jn_index_left", """
WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders, avg(o_totalprice) AS avg_price FROM orders GROUP BY 1),
l AS (SELECT o.o_custkey AS c_custkey, sum(l.l_quantity) AS qty, count(DISTINCT l.l_partkey) AS n_parts
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1),
u AS (SELECT o.o_custkey AS c_custkey, max(o.o_orderdate) AS last_order_day_dummy FROM orders o WHERE o.o_orderstatus = 'O' GROUP BY 1)
SELECT c.c_custkey, c.c_acctbal, o.n_orders, o.avg_price, l.qty, l.n_parts, CASE WHEN u.c_custkey IS NULL THEN 0 ELSE 1 END AS has_open
FROM customer c LEFT JOIN o USING (c_custkey) LEFT JOIN l USING (c_custkey) LEFT JOIN u USING (c_custkey)""")
def q_jn_index_left(spark, d):
    o = T(spark, d, "orders")
    li = T(spark, d, "lineitem")
    f1 = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.avg("o_totalprice").alias("avg_price"))
    f2 = (li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
          .groupBy(F.col("o_custkey").alias("c_custkey"))
          .agg(F.sum("l_quantity").alias("qty"), F.count_distinct("l_partkey").alias("n_parts")))
    f3 = o.where(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("c_custkey")).distinct() \
        .withColumn("has_open", F.lit(1))
    base = T(spark, d, "customer").select("c_custkey", "c_acctbal")
    return J.join_features(base, [f1, f2, f3], "c_custkey").fillna({"has_open": 0})


@query("jn_star_dims", """
SELECT s.s_suppkey, s.s_acctbal, n.n_name, r.r_name
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_jn_star_dims(spark, d):
    s = T(spark, d, "supplier").select("s_suppkey", "s_acctbal", F.col("s_nationkey").alias("n_nationkey"))
    n = T(spark, d, "nation")
    r = T(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return J.join_dims(s, {"n_nationkey": n, "n_regionkey": r})


@query("jn_three_way", """
WITH lo AS (SELECT o.o_custkey AS user_id, l.l_partkey AS product_id, l.l_quantity FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
u AS (SELECT user_id, count(*) AS user_lines FROM lo GROUP BY 1),
p AS (SELECT product_id, avg(l_quantity) AS product_avg_qty FROM lo GROUP BY 1),
up AS (SELECT user_id, product_id, sum(l_quantity) AS up_qty FROM lo GROUP BY 1, 2)
SELECT up.user_id, up.product_id, u.user_lines, p.product_avg_qty, up.up_qty
FROM u JOIN up USING (user_id) JOIN p USING (product_id)""")
def q_jn_three_way(spark, d):
    o = T(spark, d, "orders")
    lo = T(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("product_id"), "l_quantity")
    u = lo.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_lines"))
    p = lo.groupBy("product_id").agg(F.avg("l_quantity").alias("product_avg_qty"))
    up = lo.groupBy("user_id", "product_id").agg(F.sum("l_quantity").alias("up_qty"))
    return J.basket_join(u, p, up)


@query("jn_map_lookup", """
SELECT c.c_custkey, n.n_name AS nation_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_jn_map_lookup(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_nationkey")
    return J.lookup(c, "c_nationkey", T(spark, d, "nation"), "n_nationkey", "n_name", "nation_name").drop("c_nationkey")


@query("jn_anti", """
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment = 'BUILDING')""")
def q_jn_anti(spark, d):
    b = T(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return J.missing_ids(T(spark, d, "orders").select("o_orderkey", "o_custkey"), b, "o_custkey", "c_custkey")


@query("jn_attach_pred", """
SELECT d.doc_id, l.quality AS prediction FROM documents d JOIN labels l USING (doc_id)""")
def q_jn_attach_pred(spark, d):
    pred = T(spark, d, "labels").select("doc_id", F.col("quality").alias("prediction"))
    return J.attach(T(spark, d, "documents").select("doc_id"), pred, "doc_id")


@query("jn_semi", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40)""")
def q_jn_semi(spark, d):
    big = T(spark, d, "part").where(F.col("p_size") > 40)
    return J.keep_known(T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), big,
                        "l_partkey", "p_partkey")


# ------------------------------------------------------------------ §2.5 windows, sort, sets
@query("win_cumcount", "WITH " + BASKET_SQL.strip() + """
SELECT o.user_id, l.product_id, o.order_number,
       row_number() OVER (PARTITION BY o.user_id, l.product_id ORDER BY o.order_number) AS product_time
FROM b_orders o JOIN b_lines l USING (order_id)""")
def q_win_cumcount(spark, d):
    o = basket_orders(spark, d)
    li = basket_lines(spark, d, o)
    j = o.select("order_id", "user_id", "order_number").join(li.select("order_id", "product_id"), "order_id")
    return R.running_number(j.drop("order_id"), ["user_id", "product_id"], ["order_number"], "product_time")


@query("srt_multi", "SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem ORDER BY l_shipdate DESC, l_orderkey, l_linenumber")
def q_srt_multi(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    return li.orderBy(F.col("l_shipdate").desc(), "l_orderkey", "l_linenumber")


@query("srt_topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def q_srt_topk(spark, d):
    return R.top_k(T(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 20,
                   tie_breaker=["o_orderkey"])


@query("srt_topk_both", """
SELECT * FROM (SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10)
UNION SELECT * FROM (SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)""")
def q_srt_topk_both(spark, d):
    return R.top_k_both(T(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 10,
                        tie_breaker=["c_custkey"])


@query("set_union", """
SELECT c_custkey, c_acctbal, CAST(c_mktsegment = 'BUILDING' AS BIGINT) AS target FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')
UNION ALL SELECT c_custkey, c_acctbal, NULL FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE')""")
def q_set_union(spark, d):
    c = T(spark, d, "customer")
    tr = c.where(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")).select(
        "c_custkey", "c_acctbal", (F.col("c_mktsegment") == "BUILDING").cast("long").alias("target"))
    te = c.where(~F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")).select("c_custkey", "c_acctbal")
    return tr.unionByName(te, allowMissingColumns=True)


@query("set_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def q_set_distinct(spark, d):
    return T(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("set_complete_ids", """
SELECT c.c_custkey, p.pending_orders FROM customer c LEFT JOIN
 (SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY o_orderkey) AS pending_orders
  FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) p ON c.c_custkey = p.o_custkey""")
def q_set_complete_ids(spark, d):
    o = T(spark, d, "orders").where(F.col("o_orderstatus") == "P")
    p = concat_ids(o, "o_custkey", "o_orderkey", " ", "pending_orders").withColumnRenamed("o_custkey", "c_custkey")
    return T(spark, d, "customer").select("c_custkey").join(p, "c_custkey", "left")


@query("smp_frac", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE ('0x' || substr(md5(concat_ws(':', '7', CAST(o_orderkey AS VARCHAR))), 1, 8))::BIGINT < 2147483648""")
def q_smp_frac(spark, d):
    return R.hash_sample(T(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 0.5, seed=7)
