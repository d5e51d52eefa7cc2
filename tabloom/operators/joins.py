"""Equi-joins.

Joins carry no broadcast hints: adaptive execution turns one into a broadcast
when the shuffled side is measured (in bytes) to be small, and splits skewed
partitions of a sort-merge join.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def join(df: DataFrame, other: DataFrame, keys, how: str = "inner") -> DataFrame:
    return df.join(other, keys, how)


def join_features(base: DataFrame, tables: Sequence[DataFrame], key) -> DataFrame:
    """Left-join feature tables that are already aggregated to ``key``.

    Each side is hash-partitioned on the key once; Spark reuses that
    partitioning for the chain of sort-merge joins.
    """
    out = base
    for t in tables:
        out = out.join(t, key, "left")
    return out


def join_dims(fact: DataFrame, dims: Mapping[str, DataFrame], drop_keys: bool = True) -> DataFrame:
    """Inner-join dimension tables on their keys."""
    out = fact
    for key, dim in dims.items():
        out = out.join(dim, key, "inner")
        if drop_keys:
            out = out.drop(key)
    return out


def basket_join(users: DataFrame, products: DataFrame, pairs: DataFrame,
                user_key: str = "user_id", product_key: str = "product_id") -> DataFrame:
    """users ⋈ (products ⋈ pairs): the three-way feature join."""
    return users.join(products.join(pairs, product_key, "inner"), user_key, "inner")


def lookup(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``series.map(dict)``: left join against a (key, value) table."""
    t = table.select(F.col(key).alias("_lk"), F.col(value).alias(out))
    return df.join(t, F.col(col) == F.col("_lk"), "left").drop("_lk")


def missing_ids(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of df whose key is absent from other (left anti join, NULL-safe unlike NOT IN)."""
    ok = other_key or key
    return df.join(other.select(F.col(ok).alias("_ak")), F.col(key) == F.col("_ak"), "left_anti")


def attach(ids: DataFrame, predictions: DataFrame, id_col: str) -> DataFrame:
    """Attach predictions to the id list by key — never by position."""
    return ids.join(predictions, id_col, "inner")


def keep_known(tokens: DataFrame, vocab: DataFrame, token_col: str, vocab_col: str | None = None) -> DataFrame:
    """Rows whose token is in the vocabulary (left semi join)."""
    vc = vocab_col or token_col
    return tokens.join(vocab.select(F.col(vc).alias("_vk")), F.col(token_col) == F.col("_vk"), "left_semi")


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate (a global statistic) to every row.

    The one-row side is broadcast: its size is one row by construction.
    Spark folds the constant key and plans a broadcast nested-loop join,
    which against a single row is a linear pass over ``df``.
    """
    return (df.withColumn("_one", F.lit(0))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(0))), "_one", "inner").drop("_one"))
