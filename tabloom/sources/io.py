"""Readers and writers.

CSV is read with an explicit schema (never inferred).  Staging tables go to
the shared folder named by ``spark.checkpoint.dir`` — never a
machine-local temporary folder — so a lost executor can re-read them.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def stage_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabloom-stage/{name}-{uuid.uuid4().hex[:12]}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, **opts) -> DataFrame:
    return spark.read.schema(schema).option("header", header).options(**opts).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, date_format: str | None = None,
               compression: str | None = None, columns=None, header: bool = True) -> DataFrame:
    """Typed CSV with optional date format, compression codec and column subset
    (the projection is pruned by the planner)."""
    r = spark.read.schema(schema).option("header", header)
    if date_format:
        r = r.option("dateFormat", date_format)
    if compression:
        r = r.option("compression", compression)
    df = r.csv(path)
    return df.select(*columns) if columns else df


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = None, mode: str = "overwrite") -> None:
    """A directory of part files — never ``coalesce(1)`` at scale."""
    w = df.write.mode(mode).option("header", header)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def stage(df: DataFrame, name: str, partition_by=None) -> DataFrame:
    """Write a stage boundary as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    p = stage_dir(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(p)
    return spark.read.parquet(p)


def head_rows(df: DataFrame, order_by, n: int) -> DataFrame:
    """First n rows in an explicit order (repeatable)."""
    return df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)).limit(n)


def write_vectors(df: DataFrame, word: str, vec: str, path: str) -> None:
    """``word f1 … fn`` text lines."""
    line = F.concat_ws(" ", F.col(word), F.array_join(F.transform(vec, lambda x: x.cast("string")), " "))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_vectors(spark: SparkSession, path: str, dim: int, min_line_len: int = 0) -> DataFrame:
    """Parse ``word f1 … fn`` lines into (word, vector array<float>); malformed rows dropped."""
    t = spark.read.text(path)
    if min_line_len:
        t = t.where(F.length("value") > min_line_len)
    parts = F.split(F.col("value"), " ")
    nums = F.transform(F.slice(parts, 2, dim), lambda x: x.try_cast("float"))
    v = t.select(F.element_at(parts, 1).alias("word"), nums.alias("vector"), F.size(parts).alias("_n"))
    ok = (F.col("_n") == dim + 1) & F.forall("vector", lambda x: x.isNotNull())
    return v.where(ok).drop("_n")


def join_profile(df: DataFrame, profile: DataFrame, key: str) -> DataFrame:
    """Left join a (re-computed, staged) per-key aggregate table."""
    return df.join(profile, key, "left")
