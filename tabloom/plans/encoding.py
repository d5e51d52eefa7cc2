"""Categorical encoding queries — SURVEY §2.8."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as E
from ..sources.fixtures import table
from . import query


def T(spark, d, name):
    return table(spark, d, name)


_CUST = """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_nationkey,
                  c_acctbal, CAST(c_mktsegment = 'BUILDING' AS BIGINT) AS target FROM customer"""


def _cust(spark, d):
    c = T(spark, d, "customer")
    return c.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_nationkey",
                    "c_acctbal", (F.col("c_mktsegment") == "BUILDING").cast("long").alias("target"))


@query("enc_label", """
WITH p AS (SELECT p_partkey, coalesce(p_brand, 'nan') AS b, coalesce(p_type, 'nan') AS t FROM part)
SELECT p_partkey, (dense_rank() OVER (ORDER BY b)) - 1 AS p_brand, (dense_rank() OVER (ORDER BY t)) - 1 AS p_type FROM p""")
def q_enc_label(spark, d):
    p = T(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    return E.label_encode(p, ["p_brand", "p_type"])


@query("enc_categorical_codes", f"""
SELECT c_custkey, CASE WHEN segment IS NULL THEN -1 ELSE (dense_rank() OVER (ORDER BY segment)) - 1 END AS segment
FROM ({_CUST}) t""")
def q_enc_categorical_codes(spark, d):
    return E.category_codes(_cust(spark, d).select("c_custkey", "segment"), ["segment"])


@query("enc_factorize", """
WITH f AS (SELECT o_orderpriority AS v, min((o_orderdate, o_orderkey)) AS fst FROM orders GROUP BY 1),
c AS (SELECT v, row_number() OVER (ORDER BY fst, v) - 1 AS code FROM f)
SELECT o.o_orderkey, coalesce(c.code, -1) AS o_orderpriority FROM orders o LEFT JOIN c ON o.o_orderpriority = c.v""")
def q_enc_factorize(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return E.factorize(o, "o_orderpriority", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderpriority")


@query("enc_onehot_dense", f"""
SELECT c_custkey, """ + ", ".join(
    f"CAST(coalesce(segment = '{v}', false) AS BIGINT) AS \"segment_{v}\"" for v in
    ["AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + f""", CAST(segment IS NULL AS BIGINT) AS segment_nan
FROM ({_CUST}) t""")
def q_enc_onehot_dense(spark, d):
    out, _ = E.one_hot(_cust(spark, d).select("c_custkey", "segment"), ["segment"], null_as_category=True)
    return out


@query("enc_onehot_sparse", """
WITH s AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM (SELECT DISTINCT c_mktsegment AS v FROM customer)),
n AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS v FROM customer))
SELECT c_custkey, (SELECT count(*) + 1 FROM s) + (SELECT count(*) + 1 FROM n) AS size, s.k || ',' || ((SELECT count(*) + 1 FROM s) + n.k) AS ones
FROM customer JOIN s ON s.v = c_mktsegment JOIN n ON n.v = CAST(c_nationkey AS VARCHAR)""")
def q_enc_onehot_sparse(spark, d):
    """Size of the vector (a place for unseen values per column included) and the places that hold one."""
    c = T(spark, d, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    v = E.one_hot_vector(c, ["c_mktsegment", "nation"])
    from pyspark.ml.functions import vector_to_array
    v = v.select("c_custkey", vector_to_array("onehot").alias("x"))
    ones = F.filter(F.transform("x", lambda e, i: F.when(e == 1.0, i)), lambda i: i.isNotNull())
    return v.select("c_custkey", F.size("x").alias("size"), F.array_join(ones.cast("array<string>"), ",").alias("ones"))


@query("enc_hash", """
SELECT o_orderkey,
  ('0x' || substr(md5('o_orderpriority=' || coalesce(CAST(o_orderpriority AS VARCHAR), 'nan')), 1, 8))::BIGINT % 3000 AS o_orderpriority_hash,
  ('0x' || substr(md5('o_orderstatus=' || coalesce(CAST(o_orderstatus AS VARCHAR), 'nan')), 1, 8))::BIGINT % 3000 AS o_orderstatus_hash,
  ('0x' || substr(md5('o_custkey=' || coalesce(CAST(o_custkey AS VARCHAR), 'nan')), 1, 8))::BIGINT % 3000 AS o_custkey_hash
FROM orders""")
def q_enc_hash(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey")
    return E.hash_encode(o, ["o_orderpriority", "o_orderstatus", "o_custkey"], 3000) \
        .select("o_orderkey", "o_orderpriority_hash", "o_orderstatus_hash", "o_custkey_hash")


@query("enc_target_max", """
WITH c AS (SELECT c_custkey, c_nationkey, CAST(c_mktsegment = 'BUILDING' AS BIGINT) AS target FROM customer),
m AS (SELECT c_nationkey AS v, avg(target) AS m FROM c GROUP BY 1),
s AS (SELECT max(m) AS mx, avg(m) AS mm FROM m)
SELECT c.c_custkey, coalesce(m.m / nullif(s.mx, 0), s.mm) AS c_nationkey_target
FROM c LEFT JOIN m ON c.c_nationkey = m.v, s""")
def q_enc_target_max(spark, d):
    c = _cust(spark, d).select("c_custkey", "c_nationkey", "target")
    return E.target_mean_max(c, ["c_nationkey"], "target").select("c_custkey", "c_nationkey_target")


@query("enc_target_smooth", """
WITH c AS (SELECT c_custkey, c_nationkey, CAST(c_mktsegment = 'BUILDING' AS BIGINT) AS target,
                  ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 5 AS fold FROM customer),
tr AS (SELECT * FROM c WHERE fold <> 0),
pr AS (SELECT avg(target) AS prior FROM tr),
st AS (SELECT c_nationkey AS v, count(*) AS n, avg(target) AS m FROM tr GROUP BY 1),
enc AS (SELECT v, prior * (1 - 1 / (1 + exp(-(n - 10) / 5.0))) + m * (1 / (1 + exp(-(n - 10) / 5.0))) AS e FROM st, pr)
SELECT c.c_custkey, CASE WHEN c.fold <> 0 THEN 'train' ELSE 'test' END AS split, coalesce(enc.e, pr.prior) AS c_nationkey_te
FROM c LEFT JOIN enc ON c.c_nationkey = enc.v, pr""")
def q_enc_target_smooth(spark, d):
    from ..functions.semantics import portable_hash
    c = _cust(spark, d).select("c_custkey", "c_nationkey", "target").withColumn("fold", portable_hash("c_custkey") % 5)
    tr, te = E.target_encode(c.where("fold <> 0"), c.where("fold = 0"), "c_nationkey", "target",
                             min_samples_leaf=10, smoothing=5.0)
    return (tr.select("c_custkey", F.lit("train").alias("split"), "c_nationkey_te")
            .unionByName(te.select("c_custkey", F.lit("test").alias("split"), "c_nationkey_te")))


def _uniform_sql(i):
    return f"((('0x' || substr(md5(concat_ws(':', '42.{i}', CAST(c_custkey AS VARCHAR))), 1, 8))::BIGINT + 1) / 4294967297.0::DOUBLE)"


@query("enc_target_oof", f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 50 <> 0 THEN c_nationkey END AS v, CAST(c_mktsegment = 'BUILDING' AS BIGINT) AS target,
                  ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 5 AS fold FROM customer),
f AS (SELECT DISTINCT fold FROM c),
pr AS (SELECT f.fold, avg(target) AS prior FROM f JOIN c ON c.fold <> f.fold GROUP BY f.fold),
st AS (SELECT f.fold, v, count(*) AS n, avg(target) AS m FROM f JOIN c ON c.fold <> f.fold WHERE v IS NOT NULL GROUP BY f.fold, v),
e AS (SELECT c_custkey, c.fold, coalesce(prior * (1 - 1 / (1 + exp(-(n - 10) / 5.0))) + m * (1 / (1 + exp(-(n - 10) / 5.0))), prior) AS te
      FROM c JOIN pr USING (fold) LEFT JOIN st ON st.fold = c.fold AND st.v = c.v)
SELECT c_custkey, fold, te, te * (1 + 0.02::DOUBLE * sqrt(-2 * ln({_uniform_sql(1)})) * cos({_uniform_sql(2)} * 6.283185307179586::DOUBLE)) AS te_noisy FROM e""")
def q_enc_target_oof(spark, d):
    from ..functions.semantics import portable_hash
    c = _cust(spark, d).select("c_custkey", F.when(F.col("c_custkey") % 50 != 0, F.col("c_nationkey")).alias("v"), "target").withColumn("fold", portable_hash("c_custkey") % 5)
    plain = E.target_encode_oof(c, "v", "target", "fold", min_samples_leaf=10, smoothing=5.0, out="te")
    return E.add_noise(plain, "te", "c_custkey", 0.02, seed=42, out="te_noisy").select("c_custkey", "fold", "te", "te_noisy")


@query("enc_noise", f"""SELECT c_custkey, c_acctbal,
  c_acctbal * (1 + 0.01::DOUBLE * sqrt(-2 * ln({_uniform_sql(1)})) * cos({_uniform_sql(2)} * 6.283185307179586::DOUBLE)) AS c_acctbal_noisy
FROM customer""")
def q_enc_noise(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_acctbal")
    return E.add_noise(c, "c_acctbal", "c_custkey", 0.01, seed=42, out="c_acctbal_noisy")


@query("enc_concat_keys", f"""
SELECT c_custkey, concat_ws(' ', coalesce(segment, ' '), CAST(c_nationkey AS VARCHAR)) AS segment_nation FROM ({_CUST}) t""")
def q_enc_concat_keys(spark, d):
    return E.cross_key(_cust(spark, d), ["segment", "c_nationkey"], "segment_nation").select("c_custkey", "segment_nation")
