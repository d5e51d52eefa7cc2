"""Evaluation metrics as aggregations."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import safe_div
from .ranking import cumulative_sum_by


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC with ties (rank-sum form) per ``by`` group.

    Scores are reduced to (score → positives, negatives) counts first; the
    running count of negatives below each score is a range-partitioned
    running sum, so no single task sees all distinct scores.
    """
    by = list(by)
    c = df.groupBy(*by, score).agg(F.count_if(F.col(label) == 1).alias("_p"),
                                   F.count_if(F.col(label) == 0).alias("_n"))
    c = cumulative_sum_by(c, by, [score], "_n", out="_cn")
    s = c.groupBy(*by).agg(F.sum(F.col("_p") * (F.col("_cn") - F.col("_n") + 0.5 * F.col("_n"))).alias("_u"),
                           F.sum("_p").alias("_P"), F.sum("_n").alias("_N"))
    return s.select(*by, safe_div("_u", F.col("_P") * F.col("_N")).alias("auc"))


def macro_auc(df: DataFrame, score: str, label: str, by: str) -> DataFrame:
    """One row: the mean of the groups' AUC (groups where it is not defined left out) and their number."""
    return roc_auc(df, score, label, [by]).agg(F.avg("auc").alias("macro_auc"), F.count("auc").alias("n_labels"))


def confusion(df: DataFrame, pred: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    p, y = F.col(pred), F.col(label)
    return df.groupBy(*by).agg(F.count_if((p == 1) & (y == 1)).alias("tp"), F.count_if((p == 1) & (y == 0)).alias("fp"),
                               F.count_if((p == 0) & (y == 1)).alias("fn"), F.count_if((p == 0) & (y == 0)).alias("tn"))


def f1(df: DataFrame, score: str, label: str, t: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    x = df.withColumn("_pred", (F.col(score) > t).cast("int"))
    c = confusion(x, "_pred", label, by)
    return c.select(*by, safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def precision_recall(df: DataFrame, pred: str, label: str) -> DataFrame:
    """(class, precision, recall, support) for classes 0 and 1."""
    c = confusion(df, pred, label)
    one = c.select(F.lit(1).alias("class"), safe_div("tp", F.col("tp") + F.col("fp")).alias("precision"),
                   safe_div("tp", F.col("tp") + F.col("fn")).alias("recall"), (F.col("tp") + F.col("fn")).alias("support"))
    zero = c.select(F.lit(0).alias("class"), safe_div("tn", F.col("tn") + F.col("fn")).alias("precision"),
                    safe_div("tn", F.col("tn") + F.col("fp")).alias("recall"), (F.col("tn") + F.col("fp")).alias("support"))
    return one.unionByName(zero)


def rmse(df: DataFrame, pred: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.sqrt(F.avg(F.pow(F.col(pred) - F.col(y), 2))).alias("rmse"))


def score_table(metrics: DataFrame, names: Sequence[str], step: str = "step", metric: str = "metric",
                value: str = "value") -> DataFrame:
    """Long (step, metric, value) → one row per step, one column per metric of ``names``."""
    return metrics.groupBy(step).pivot(metric, list(names)).agg(F.first(value))
