"""Splits, folds and MLlib model work on tables.

Splits and folds come from a portable hash of the id, so they are
repeatable and need no driver state.  Model fits are MLlib estimators —
distributed training over the assembled feature column.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import portable_hash
from .joins import attach_row
from .ranking import row_number_by


def split(df: DataFrame, id_col: str, frac: float, seed: int = 0, out: str = "split") -> DataFrame:
    """'train' for a hash fraction ``frac`` of ids, 'valid' for the rest."""
    h = portable_hash(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))) % 10000
    return df.withColumn(out, F.when(h < int(frac * 10000), "train").otherwise("valid"))


def split_stratified(df: DataFrame, id_col: str, label: str, frac: float, seed: int = 0, out: str = "split") -> DataFrame:
    """'train' for the share ``frac`` of every class, in hash order of the ids, 'valid' for the rest."""
    r = stratified_rank(df, id_col, label, seed)
    return r.withColumn(out, F.when(F.col("_srank") <= F.floor(F.col("_csize") * frac), "train").otherwise("valid")).drop("_srank", "_csize")


def stratified_rank(df: DataFrame, id_col: str, label: str, seed: int = 0) -> DataFrame:
    """Rank of each row within its class in hash order (``_srank``) and class size (``_csize``)."""
    h = portable_hash(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    x = df.withColumn("_h", h)
    r = row_number_by(x, [label], ["_h", id_col], out="_srank")
    # one row per class: broadcast, so that two label values do not become two tasks
    n = F.broadcast(df.groupBy(label).agg(F.count(F.lit(1)).alias("_csize")))
    return r.join(n, label).drop("_h")


def stratified_sample(df: DataFrame, id_col: str, label: str, frac: float = 0.5, seed: int = 0) -> DataFrame:
    """Exactly ⌊frac·n_c⌋ rows of each class, chosen by hash order."""
    r = stratified_rank(df, id_col, label, seed)
    return r.where(F.col("_srank") <= F.floor(F.col("_csize") * frac)).drop("_srank", "_csize")


def add_fold(df: DataFrame, id_col: str, k: int, label: str | None = None, seed: int = 0, out: str = "fold") -> DataFrame:
    """fold = hash(id) mod k; stratified: rank within class (hash order) mod k."""
    if label is None:
        h = portable_hash(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
        return df.withColumn(out, (h % k).cast("int"))
    r = stratified_rank(df, id_col, label, seed)
    return r.withColumn(out, ((F.col("_srank") - 1) % k).cast("int")).drop("_srank", "_csize")


def class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (2 · n_c) per class as a small table."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    k = c.agg(F.count(F.lit(1)).alias("_k"))
    return attach_row(attach_row(c, n), k).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    return df.join(F.broadcast(class_weight(df, label, out)), label)  # one row per class


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def fit_gbt(df: DataFrame, features: str, label: str, **params):
    """Boosted trees; ``validationIndicatorCol`` (with ``validationTol``) stops early on the rows it marks."""
    from pyspark.ml.classification import GBTClassifier
    return GBTClassifier(featuresCol=features, labelCol=label, **params).fit(df)


def fit_gbt_reg(df: DataFrame, features: str, label: str, **params):
    from pyspark.ml.regression import GBTRegressor
    return GBTRegressor(featuresCol=features, labelCol=label, **params).fit(df)


def fit_logreg(df: DataFrame, features: str, label: str, C: float = 20.0, weight: str | None = None):
    """Logistic regression with sklearn's C: regParam = 1 / (C · Σw)."""
    from pyspark.ml.classification import LogisticRegression
    sw = df.agg(F.sum(F.col(weight)) if weight else F.count(F.lit(1))).first()[0]
    kw = {"weightCol": weight} if weight else {}
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (C * float(sw)),
                              elasticNetParam=0.0, standardization=False, **kw).fit(df)


def fit_ridge(df: DataFrame, features: str, label: str, alpha: float = 1.0, weight: str | None = None):
    """Ridge classifier: least squares on ±1 targets; predict sign."""
    from pyspark.ml.regression import LinearRegression
    x = df.withColumn("_pm", F.when(F.col(label) == 1, 1.0).otherwise(-1.0))
    sw = x.agg(F.sum(F.col(weight)) if weight else F.count(F.lit(1))).first()[0]
    kw = {"weightCol": weight} if weight else {}
    return LinearRegression(featuresCol=features, labelCol="_pm", regParam=alpha / float(sw), elasticNetParam=0.0,
                            standardization=False, **kw).fit(x)


def probability(pred: DataFrame, col: str = "probability", out: str = "prob") -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return pred.withColumn(out, vector_to_array(col)[1])


def cross_predict(train: DataFrame, test: DataFrame, id_col: str, fit: Callable[[DataFrame], object],
                  k: int = 5, fold_col: str = "fold", score: str = "prob"):
    """Out-of-fold predictions for train and the fold-mean prediction for test.

    ``train`` must carry ``fold_col``.  Returns (oof (id, fold, score),
    test (id, score), models).
    """
    oof, tst, models = None, None, []
    for f in range(k):
        m = fit(train.where(F.col(fold_col) != f))
        models.append(m)
        p = probability(m.transform(train.where(F.col(fold_col) == f))).select(id_col, F.lit(f).alias("fold"), F.col("prob").alias(score))
        t = probability(m.transform(test)).select(id_col, F.lit(f).alias("fold"), F.col("prob").alias(score))
        oof = p if oof is None else oof.unionByName(p)
        tst = t if tst is None else tst.unionByName(t)
    return oof, tst.groupBy(id_col).agg(F.avg(score).alias(score)), models


def importances(spark, models: Sequence, names: Sequence[str]) -> DataFrame:
    """(feature, fold, importance) from fitted tree models (size = features × folds)."""
    rows = [(n, i, float(m.featureImportances[j])) for i, m in enumerate(models) for j, n in enumerate(names)]
    return spark.createDataFrame(rows, "feature string, fold int, importance double")


def top_coefficients(spark, coefficients, vocab: DataFrame, idx: str = "term_id", n: int = 40) -> DataFrame:
    """n smallest ∪ n largest coefficients joined to their vocabulary terms."""
    from .ranking import top_k_both
    arr = coefficients.toArray().tolist()
    c = spark.createDataFrame([(i, float(v)) for i, v in enumerate(arr)], f"{idx} long, coef double")
    return top_k_both(c.join(vocab, idx), "coef", n, tie_breaker=[idx])


def vote(preds: DataFrame, id_col: str, cols: Sequence[str], t: float = 0.5, out: str = "vote") -> DataFrame:
    """1 when the mean of the model votes exceeds ``t``."""
    m = sum(F.col(c) for c in cols) / len(cols)
    return preds.select(id_col, (m > t).cast("int").alias(out))


def stack(preds: DataFrame, cols: Sequence[str], label: str):
    """Logistic regression over model votes."""
    from pyspark.ml.classification import LogisticRegression
    x = assemble(preds, cols, "_stack")
    return LogisticRegression(featuresCol="_stack", labelCol=label).fit(x)


def search(df: DataFrame, estimator, grid, evaluator, k: int = 3, parallelism: int = 2, seed: int = 0):
    """k-fold search over a parameter grid (CrossValidator)."""
    from pyspark.ml.tuning import CrossValidator
    return CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=k,
                          parallelism=parallelism, seed=seed).fit(df)


def random_search(df: DataFrame, features: str, label: str, id_col: str, ranges: dict, n: int = 5, k: int = 3,
                  seed: int = 0) -> list[tuple[dict, float]]:
    """(parameters, out-of-fold AUC) of ``n`` seeded random candidates for boosted trees.

    ``ranges`` maps a parameter to (low, high) of its type or to a list of choices.
    """
    import random

    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = random.Random(seed)
    labels, out = df.select(id_col, label), []
    for _ in range(n):
        p = {name: rng.choice(r) if isinstance(r, list) else rng.randint(*r) if isinstance(r[0], int) else rng.uniform(*r)
             for name, r in ranges.items()}
        oof, _, _ = cross_predict(df, df.limit(0), id_col, lambda x: fit_gbt(x, features, label, seed=seed, **p), k=k)
        out.append((p, BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol=label).evaluate(oof.join(labels, id_col))))
    return out


def prune_by_model(df: DataFrame, features: Sequence[str], label: str, auc: float = 0.7, **gbt) -> list[str]:
    """Fit trees, take out the features they use, and repeat until the in-sample AUC is at most ``auc``.

    Returns all features of the last fit: those without which the label could
    already be told.  Empty when the features run out first.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    left = list(features)
    ev = BinaryClassificationEvaluator(labelCol=label)
    while left:
        x = assemble(df, left, "_f")
        m = fit_gbt(x, "_f", label, **gbt)
        used = {n for n, v in zip(left, m.featureImportances.toArray()) if v > 0}
        if ev.evaluate(m.transform(x)) <= auc or not used:
            break
        left = [n for n in left if n not in used]
    return left
