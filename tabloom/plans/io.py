"""Source / sink queries — SURVEY §2.1.  Writes go to the shared checkpoint folder."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as TO
from ..sources import io as IO
from ..sources.fixtures import table
from . import REGISTRY, query
from . import basket, text  # noqa: F401  their SQL is reused
from .text import s_tokens

ORDERS_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string")


_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@query("io_read_csv", _ORDERS_SQL)
def q_io_read_csv(spark, d):
    p = IO.stage_dir(spark, "orders_csv")
    IO.write_csv(table(spark, d, "orders"), p)
    return IO.read_csv(spark, p, ORDERS_SCHEMA)


@query("io_read_csv_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, dayofyear(o_orderdate) AS day_of_year FROM orders")
def q_io_read_csv_dates(spark, d):
    p = IO.stage_dir(spark, "orders_dates")
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    IO.write_csv(o, p)
    r = IO.read_table(spark, p, "o_orderkey long, o_orderdate date", date_format="yyyy-MM-dd")
    return r.select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"), F.dayofyear("o_orderdate").alias("day_of_year"))


@query("io_read_compressed", _ORDERS_SQL)
def q_io_read_compressed(spark, d):
    p = IO.stage_dir(spark, "orders_gz")
    IO.write_csv(table(spark, d, "orders"), p, compression="gzip")
    return IO.read_table(spark, p, ORDERS_SCHEMA, compression="gzip")


@query("io_read_zip", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def q_io_read_zip(spark, d):
    """Orders written to zip archives and three of their columns read back, one partition per archive member."""
    from ..sources import zipfiles as Z
    p = IO.stage_dir(spark, "orders_zip")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    Z.write_zip(o.repartition(4), p)
    return Z.read_zip(spark, p, "o_orderkey long, o_custkey long, o_orderpriority string, o_totalprice double", columns=["o_totalprice", "o_orderkey", "o_orderpriority"]) \
        .select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("io_read_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def q_io_read_columns(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice")


@query("io_read_head", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def q_io_read_head(spark, d):
    return IO.head_rows(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 100)


@query("io_parquet", "SELECT * FROM lineitem")
def q_io_parquet(spark, d):
    return IO.stage(table(spark, d, "lineitem"), "lineitem_stage")


@query("io_read_vectors", "SELECT 'w' || vec_id AS word, len(embedding)::BIGINT AS dim, list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) AS total FROM embeddings")
def q_io_read_vectors(spark, d):
    p = IO.stage_dir(spark, "vectors_txt")
    e = table(spark, d, "embeddings").select(F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), "embedding")
    IO.write_vectors(e, "word", "embedding", p)
    v = IO.read_vectors(spark, p, 64, min_line_len=100)
    return v.select("word", F.size("vector").alias("dim"), F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")).alias("total"))


@query("io_read_aggregates", """
WITH p AS (SELECT o_custkey AS c_custkey, avg(o_totalprice) AS avg_price, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT c.c_custkey, c.c_acctbal, p.avg_price, p.n_orders FROM customer c LEFT JOIN p USING (c_custkey)""")
def q_io_read_aggregates(spark, d):
    prof = (table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.avg("o_totalprice").alias("avg_price"), F.count(F.lit(1)).alias("n_orders")))
    prof = IO.stage(prof, "user_profile")
    return IO.join_profile(table(spark, d, "customer").select("c_custkey", "c_acctbal"), prof, "c_custkey")


@query("io_write_csv", REGISTRY["bk_submission"][1])
def q_io_write_csv(spark, d):
    from .basket import q_bk_submission
    p = IO.stage_dir(spark, "submission")
    IO.write_csv(q_bk_submission(spark, d), p)
    return IO.read_csv(spark, p, "order_id long, products string")


@query("io_write_corpus", f"SELECT len({s_tokens('clean')})::BIGINT AS n_words FROM ({REGISTRY['cl_profile_corpus'][1]})")
def q_io_write_corpus(spark, d):
    from ..functions import text as X
    p = IO.stage_dir(spark, "corpus")
    docs = TO.clean_corpus(table(spark, d, "documents").select("doc_id", "text"), "text", out="clean")
    TO.write_corpus(docs, "clean", p)
    return spark.read.text(p).select(X.n_words("value").alias("n_words"))
