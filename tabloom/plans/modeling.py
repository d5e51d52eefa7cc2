"""Splits, folds, metrics and MLlib model queries — SURVEY §2.14 (and agg_importance, fs_model_loop).

Scores for the metric queries come from the data: score = distinct /
total tokens of a document, labels from ``labels``.  Model fits use the
customer feature table of the screening queries.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregate as A
from ..operators import metrics as M
from ..operators import model as ML
from ..sources.fixtures import table
from ..sources.io import stage
from . import query
from .screening import FEATURES, feature_table
from .text import s_tokens

SCORE_SQL = f"""sc AS (SELECT d.doc_id, CAST(len(list_distinct({s_tokens('d.text')})) AS DOUBLE) / nullif(len({s_tokens('d.text')}), 0) AS score,
                   CAST(length(d.text) AS BIGINT) AS n_chars, l.toxic, l.quality
            FROM documents d JOIN labels l USING (doc_id))"""


def scored(spark, d):
    docs = table(spark, d, "documents")
    s = docs.select("doc_id", F.try_divide(X.n_unique("text").cast("double"), X.n_words("text").cast("double")).alias("score"),
                    F.length("text").cast("long").alias("n_chars"))
    return s.join(table(spark, d, "labels").select("doc_id", "toxic", "quality"), "doc_id")


def _hash_sql(x, seed="0"):
    return f"('0x' || substr(md5(concat_ws(':', '{seed}', CAST({x} AS VARCHAR))), 1, 8))::BIGINT"


@query("ml_split_holdout", f"SELECT doc_id, CASE WHEN {_hash_sql('doc_id')} % 10000 < 9000 THEN 'train' ELSE 'valid' END AS split FROM documents")
def q_ml_split_holdout(spark, d):
    return ML.split(table(spark, d, "documents").select("doc_id"), "doc_id", 0.9)


_SRANK = f"""r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {_hash_sql('doc_id')}, doc_id) AS rk,
                  count(*) OVER (PARTITION BY toxic) AS n FROM labels)"""


@query("ml_stratified_half", f"WITH {_SRANK} SELECT doc_id, toxic FROM r WHERE rk <= floor(n * 0.5)")
def q_ml_stratified_half(spark, d):
    return ML.stratified_sample(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "toxic", 0.5)


@query("ml_split_stratified", f"""WITH {_SRANK}
SELECT doc_id, toxic, CASE WHEN rk <= floor(n * 0.9) THEN 'train' ELSE 'valid' END AS split FROM r""")
def q_ml_split_stratified(spark, d):
    return ML.split_stratified(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "toxic", 0.9)


@query("udf_pipe", "SELECT doc_id, n_chars, 2 * n_chars AS twice FROM documents WHERE n_chars > 100")
def q_udf_pipe(spark, d):
    from ..operators.udf import pipe
    return pipe(table(spark, d, "documents").select("doc_id", "n_chars"),
                lambda df: df.where("n_chars > 100"), (lambda df, k: df.withColumn("twice", F.col("n_chars") * k), 2))


@query("udf_partition_map", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_points, ends_with(text, '.') AS closed FROM documents")
def q_udf_partition_map(spark, d):
    from ..operators.udf import map_batches
    return map_batches(table(spark, d, "documents").select("doc_id", "text"),
                       lambda b: b.assign(n_points=b["text"].str.len(), closed=b["text"].str.endswith("."))[["doc_id", "n_points", "closed"]],
                       "doc_id long, n_points long, closed boolean")


@query("ml_kfold", f"""WITH {_SRANK}
SELECT doc_id, CAST({_hash_sql('doc_id')} % 5 AS BIGINT) AS fold, CAST((rk - 1) % 5 AS BIGINT) AS sfold FROM r""")
def q_ml_kfold(spark, d):
    lab = table(spark, d, "labels").select("doc_id", "toxic")
    a = ML.add_fold(lab, "doc_id", 5)
    b = ML.add_fold(lab, "doc_id", 5, label="toxic", out="sfold").select("doc_id", "sfold")
    return a.join(b, "doc_id").select("doc_id", "fold", "sfold")


@query("ml_class_weight", """
SELECT toxic, (SELECT count(*) FROM labels) / (2.0 * count(*)) AS weight FROM labels GROUP BY toxic""")
def q_ml_class_weight(spark, d):
    return ML.class_weight(table(spark, d, "labels"), "toxic")


@query("ml_vote_mean", f"""WITH {SCORE_SQL}
SELECT doc_id, CAST((CAST(coalesce(score > 0.6, false) AS INT) + CAST(coalesce(score > 0.7, false) AS INT)
                     + CAST(n_chars > 1000 AS INT)) / 3.0 > 0.5 AS INT) AS vote FROM sc""")
def q_ml_vote_mean(spark, d):
    s = scored(spark, d).select("doc_id", F.coalesce(F.col("score") > 0.6, F.lit(False)).cast("int").alias("m1"),
                                F.coalesce(F.col("score") > 0.7, F.lit(False)).cast("int").alias("m2"),
                                (F.col("n_chars") > 1000).cast("int").alias("m3"))
    return ML.vote(s, "doc_id", ["m1", "m2", "m3"])


_AUC_SQL = f"""WITH {SCORE_SQL},
x AS (SELECT score, 'toxic' AS lab, toxic AS y FROM sc WHERE score IS NOT NULL
      UNION ALL SELECT score, 'quality', quality FROM sc WHERE score IS NOT NULL),
c AS (SELECT lab, score, count_if(y = 1) AS p, count_if(y = 0) AS n FROM x GROUP BY 1, 2),
r AS (SELECT *, sum(n) OVER (PARTITION BY lab ORDER BY score ROWS UNBOUNDED PRECEDING) AS cn FROM c)
SELECT lab, sum(p * (cn - n + 0.5 * n)) / nullif(sum(p) * sum(n), 0) AS auc FROM r GROUP BY lab"""


@query("mt_auc", _AUC_SQL)
def q_mt_auc(spark, d):
    return M.roc_auc(_labelled(spark, d), "score", "y", by=["lab"])


def _labelled(spark, d):
    """Both labels from one pass over the scored documents."""
    s = scored(spark, d).where(F.col("score").isNotNull())
    pairs = F.array(*[F.struct(F.lit(c).alias("lab"), F.col(c).alias("y")) for c in ("toxic", "quality")])
    return s.select("score", F.inline(pairs))


@query("mt_auc_macro", f"""SELECT avg(auc) AS macro_auc, count(auc) AS n_labels FROM ({_AUC_SQL})""")
def q_mt_auc_macro(spark, d):
    return M.macro_auc(_labelled(spark, d), "score", "y", "lab")


@query("mt_f1", f"""WITH {SCORE_SQL}
SELECT 2.0 * count_if(score > 0.7 AND toxic = 1) / nullif(2 * count_if(score > 0.7 AND toxic = 1) + count_if(score > 0.7 AND toxic = 0)
       + count_if(NOT coalesce(score > 0.7, false) AND toxic = 1), 0) AS f1 FROM sc""")
def q_mt_f1(spark, d):
    s = scored(spark, d).withColumn("score", F.coalesce("score", F.lit(0.0)))
    return M.f1(s, "score", "toxic", 0.7)


@query("mt_precision_recall", f"""WITH {SCORE_SQL}, p AS (SELECT CAST(coalesce(score > 0.7, false) AS INT) AS pred, toxic FROM sc)
SELECT 1 AS class, count_if(pred = 1 AND toxic = 1) / nullif(count_if(pred = 1), 0) AS precision,
       count_if(pred = 1 AND toxic = 1) / nullif(count_if(toxic = 1), 0) AS recall, count_if(toxic = 1) AS support FROM p
UNION ALL
SELECT 0, count_if(pred = 0 AND toxic = 0) / nullif(count_if(pred = 0), 0), count_if(pred = 0 AND toxic = 0) / nullif(count_if(toxic = 0), 0),
       count_if(toxic = 0) FROM p""")
def q_mt_precision_recall(spark, d):
    s = scored(spark, d).withColumn("pred", F.coalesce(F.col("score") > 0.7, F.lit(False)).cast("int"))
    return M.precision_recall(s, "pred", "toxic")


@query("mt_rmse", f"""WITH {SCORE_SQL}, f AS (SELECT *, CAST({_hash_sql('doc_id')} % 5 AS BIGINT) AS fold FROM sc WHERE score IS NOT NULL)
SELECT fold, sqrt(avg(pow(score - quality, 2))) AS rmse FROM f GROUP BY fold
UNION ALL SELECT -1, sqrt(avg(pow(score - quality, 2))) FROM f""")
def q_mt_rmse(spark, d):
    s = ML.add_fold(scored(spark, d).where(F.col("score").isNotNull()), "doc_id", 5)
    return M.rmse(s, "score", "quality", by=["fold"]).unionByName(
        M.rmse(s, "score", "quality").withColumn("fold", F.lit(-1)))


@query("mt_scores_table", f"""WITH {SCORE_SQL},
x AS (SELECT 'toxic' AS step, toxic AS y, score FROM sc UNION ALL SELECT 'quality', quality, score FROM sc)
SELECT step, 2.0 * count_if(score > 0.7 AND y = 1) / nullif(2 * count_if(score > 0.7 AND y = 1) + count_if(score > 0.7 AND y = 0)
       + count_if(NOT coalesce(score > 0.7, false) AND y = 1), 0) AS f1,
       sqrt(avg(pow(score - y, 2))) AS rmse FROM x GROUP BY step""")
def q_mt_scores_table(spark, d):
    # both metrics of both labels read the scores: the texts are split once
    s = stage(scored(spark, d).select("score", "toxic", "quality"), "scores")
    x = s.select(F.lit("toxic").alias("step"), F.col("toxic").alias("y"), "score").unionByName(
        s.select(F.lit("quality").alias("step"), F.col("quality").alias("y"), "score"))
    f = M.f1(x.withColumn("score", F.coalesce("score", F.lit(0.0))), "score", "y", 0.7, by=["step"]) \
        .select("step", F.lit("f1").alias("metric"), F.col("f1").alias("value"))
    r = M.rmse(x, "score", "y", by=["step"]).select("step", F.lit("rmse").alias("metric"), F.col("rmse").alias("value"))
    return M.score_table(f.unionByName(r), ["f1", "rmse"])


# ------------------------------------------------------------------ model fits (rows-only)
def _train(spark, d):
    t = feature_table(spark, d).fillna(0.0, FEATURES)
    # every fit and every prediction reads it: written once
    return ML.assemble(ML.add_fold(t, "c_custkey", 5), FEATURES).checkpoint()


@query("ml_gbt_binary")
def q_ml_gbt_binary(spark, d):
    t = _train(spark, d)
    fit = t.where("is_train = 1").withColumn("held", F.col("fold") == 0)
    m = ML.fit_gbt(fit, "features", "target", maxIter=30, maxDepth=3, seed=1, validationIndicatorCol="held", validationTol=0.005)
    return ML.probability(m.transform(t.where("is_train = 0"))).select("c_custkey", "prob")


@query("ml_gbt_regress")
def q_ml_gbt_regress(spark, d):
    t = _train(spark, d).withColumn("y", F.col("f_avg_price"))
    t = ML.assemble(t.drop("features"), [c for c in FEATURES if c != "f_avg_price"])
    m = ML.fit_gbt_reg(t.where("is_train = 1"), "features", "y", maxIter=10, maxDepth=3, lossType="absolute", seed=1)
    return m.transform(t.where("is_train = 0")).select("c_custkey", "prediction")


@query("ml_ridge_class")
def q_ml_ridge_class(spark, d):
    t = ML.with_class_weight(_train(spark, d), "target")
    m = ML.fit_ridge(t.where("is_train = 1"), "features", "target", alpha=1.0, weight="weight")
    return m.transform(t.where("is_train = 0")).select("c_custkey", (F.col("prediction") > 0).cast("int").alias("pred"))


@query("ml_logreg")
def q_ml_logreg(spark, d):
    t = ML.with_class_weight(_train(spark, d), "target")
    m = ML.fit_logreg(t.where("is_train = 1"), "features", "target", C=20.0, weight="weight")
    return ML.probability(m.transform(t.where("is_train = 0"))).select("c_custkey", "prob")


def _oof(spark, d):
    t = _train(spark, d)
    return ML.cross_predict(t.where("is_train = 1"), t.where("is_train = 0"), "c_custkey",
                            lambda x: ML.fit_gbt(x, "features", "target", maxIter=10, maxDepth=3, seed=1), k=5)


@query("ml_oof")
def q_ml_oof(spark, d):
    oof, test, _ = _oof(spark, d)
    return oof.withColumn("part", F.lit("oof")).unionByName(test.withColumn("fold", F.lit(-1)).withColumn("part", F.lit("test")))


@query("ml_importance_table")
def q_ml_importance_table(spark, d):
    _, _, models = _oof(spark, d)
    return ML.importances(spark, models, FEATURES)


@query("agg_importance")
def q_agg_importance(spark, d):
    _, _, models = _oof(spark, d)
    return A.mean_importance(ML.importances(spark, models, FEATURES), n=50)


@query("ml_top_coef")
def q_ml_top_coef(spark, d):
    from ..operators import vectorize as V
    docs = table(spark, d, "documents").select("doc_id", X.tokens(F.lower("text")).alias("tk"))
    lab = docs.join(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id")
    vec, cv = V.count_vector(lab, "tk", "features", binary=True, min_df=5.0, vocab_size=2000)
    # the fit reads its rows several times: the texts are split once for it
    vec = stage(vec.select("features", "toxic"), "term_vectors")
    m = ML.fit_logreg(vec, "features", "toxic", C=20.0)
    vocab = spark.createDataFrame(list(enumerate(cv.vocabulary)), "term_id long, term string")
    return ML.top_coefficients(spark, m.coefficients, vocab, n=10).select("term", "coef")


@query("ml_stack")
def q_ml_stack(spark, d):
    s = scored(spark, d).fillna(0.0, ["score"]).withColumn("m2", F.log1p("n_chars"))
    m = ML.stack(s, ["score", "m2"], "toxic")
    return ML.probability(m.transform(ML.assemble(s, ["score", "m2"], "_stack"))).select("doc_id", "prob")


@query("ml_param_search")
def q_ml_param_search(spark, d):
    """Seeded random candidates over nine ranges of boosted trees; out-of-fold AUC of each."""
    t = _train(spark, d).where("is_train = 1").withColumn("fold", F.col("fold") % 3)
    ranges = {"maxDepth": (2, 5), "maxIter": (3, 8), "maxBins": (16, 64), "minInstancesPerNode": (1, 40), "minInfoGain": (0.0, 0.01),
              "stepSize": (0.02, 0.3), "subsamplingRate": (0.5, 1.0), "minWeightFractionPerNode": (0.0, 0.05),
              "featureSubsetStrategy": ["all", "sqrt", "0.5"]}
    found = ML.random_search(t, "features", "target", "c_custkey", ranges, n=4, k=3, seed=1)
    return spark.createDataFrame([(i, ", ".join(f"{n}={v:.6g}" if isinstance(v, float) else f"{n}={v}" for n, v in sorted(p.items())), float(auc))
                                  for i, (p, auc) in enumerate(found)], "candidate int, params string, auc double")


@query("fs_model_loop")
def q_fs_model_loop(spark, d):
    t = feature_table(spark, d).fillna(0.0, FEATURES).checkpoint()
    left = ML.prune_by_model(t, FEATURES, "target", auc=0.7, maxIter=5, maxDepth=2, seed=1)
    return spark.createDataFrame([(f,) for f in FEATURES], "feature string").withColumn(
        "dropped_by_model", F.col("feature").isin(left).cast("int"))


@query("ml_saved_pipeline", """
WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS bal, CAST(c_nationkey AS DOUBLE) AS nat FROM customer),
f AS (SELECT c_custkey, c_nationkey, coalesce(bal, avg(bal) OVER ()) AS bal, nat FROM c),
s AS (SELECT avg(bal) AS mb, stddev_samp(bal) AS sb, avg(nat) AS mn, stddev_samp(nat) AS sn FROM f)
SELECT c_custkey, round((bal - mb) / sb, 9) + 0.0::DOUBLE AS z_bal, round((nat - mn) / sn, 9) + 0.0::DOUBLE AS z_nat FROM f, s""")
def q_ml_saved_pipeline(spark, d):
    """A fitted pipeline (column choice, imputer, assembler, scaler) written, loaded and applied."""
    import uuid

    from pyspark.ml.functions import vector_to_array

    from ..operators import pipelines as P
    from ..session import ensure_checkpoint_dir
    c = table(spark, d, "customer")
    c = c.withColumn("bal", F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal"))).withColumn("nat", F.col("c_nationkey").cast("double"))
    model = P.scaled_features(["c_custkey"], ["bal", "nat"]).fit(c)
    loaded = P.save_and_load(model, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabloom-stage/pipeline-{uuid.uuid4().hex}")
    z = vector_to_array("features")
    return loaded.transform(c).select("c_custkey", *[(F.round(z[i], 9) + 0.0).alias(n) for i, n in enumerate(["z_bal", "z_nat"])])
