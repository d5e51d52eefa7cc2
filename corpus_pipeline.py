"""Corpus pipeline: documents through five stages of ``tabloom.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All stages
but the last return the columns of ``docs``.

Defined results: null and empty texts fail the quality rules; null ids and
repeated rows go through like others (near duplicates: one row of each group
stays); an empty table stays empty.  Rows travel as one struct beside id and
text, so further columns may have any names.  Very long texts are one row each
for every stage.
"""
from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import line_dedup as lines
from tabloom.llm import ngram_join, packing, pii, quality
from tabloom.llm.common import checkpoint
from tabloom.session import ensure_checkpoint_dir


def _has_words(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the rows whose text passes the base rule and the rule table.  The rules are
    a projection, so the row keeps its columns; its text is carried through as it is."""
    return quality.keep(docs)


def _carried(docs: DataFrame) -> DataFrame:
    """Id and text, and the whole row as a struct: no other column's name can clash with an operator's own."""
    return docs.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row"), "doc_id", "text")


def _restored(d: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the text that ``d`` holds."""
    return d.select(*[F.col("text").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs; a row whose last word goes that way goes too."""
    d = lines.line_dedup(_carried(docs))
    return _restored(d.where((F.col("__n_removed") == 0) | _has_words("text")), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: the one with the smallest id (of texts that share it, or have none, by text hash).
    The table of what stays is small and written once; of rows that repeat an id and a text with a word, any one stays."""
    d = _carried(docs)
    stays = (ngram_join.near_duplicate_rows(d).where("first")
             .select(F.col("doc_id").alias("__keep"), F.col("text_hash").alias("__th"), F.expr("n_grams > 0 and n_rows > 1").alias("__many")))
    stays = checkpoint(stays)
    same = F.col("doc_id").eqNullSafe(F.col("__keep")) & (F.xxhash64("text") == F.col("__th"))
    repeated = d.join(stays.where("__many"), same).dropDuplicates(["doc_id", "__th"]).select(*d.columns)
    return _restored(d.join(stays.where("not __many"), same, "left_semi").unionByName(repeated), docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets."""
    d = pii.find_pii(_carried(docs))
    return _restored(d.withColumn("text", F.when(F.size("__spans") > 0, pii.mask(F.col("text"), F.col("__spans"))).otherwise(F.col("text"))), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("near_duplicates", near_duplicate_stage),
          ("pii", pii_stage), ("best_fit_packing", packing_stage)]

#: SQL cannot express MinHash banding or tokenization; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the checkpoint folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
