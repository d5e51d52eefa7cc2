"""Hand-made rows for cases that the test tables do not have."""
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tabloom.operators import aggregate as A
from tabloom.operators import embed as EM
from tabloom.operators import encode as EN
from tabloom.operators import metrics as M
from tabloom.operators import model as ML
from tabloom.operators import trailing as TR


@pytest.mark.parametrize("n", [3, 250])
@pytest.mark.parametrize("median", ["exact", "distributed", "approx"])
def test_null_keys_form_no_group(spark, n, median):
    d = spark.createDataFrame([(1, 2.0), (1, 4.0), (None, 3.0), (2, None)], "k int, v double")
    d = d.withColumns({f"v{i}": F.col("v") for i in range(n)})
    got = {r["k"]: r["v_MEDIAN"] for r in A.profile(d, "k", {"v": ["median"], **{f"v{i}": ["max"] for i in range(n)}}, median=median).collect()}
    assert got == {1: 3.0 if median != "approx" else 2.0, 2: None}


def test_exact_median_with_one_common_value(spark):
    rng = random.Random(1)
    values = [(k, 5.0 if rng.random() < 0.9 else rng.random() * 10) for k in (1, 2) for _ in range(2001)] + [(3, 1.0), (3, 2.0), (None, 9.0)]
    got = {r["k"]: r["m"] for r in A.exact_median(spark.createDataFrame(values, "k int, v double"), ["k"], "v", "m").collect()}
    assert got == {k: statistics.median(v for q, v in values if q == k) for k in (1, 2, 3)}


def test_prune_returns_features_of_last_fit(spark):
    rng = random.Random(2)
    rows = [(i % 2, float(i % 2), rng.random(), rng.random(), rng.random()) for i in range(200)]
    d = spark.createDataFrame(rows, "y int, p double, a double, b double, z double")
    assert ML.prune_by_model(d, ["p", "a", "b", "z"], "y", auc=0.99, maxIter=2, maxDepth=2, seed=1) == ["a", "b", "z"]


@pytest.mark.parametrize("ids,want", [([1, 0], [7.0]), ([1], [0.0]), ([1, 0, 0], [7.0])])
def test_embed_default(spark, ids, want):
    vocab = spark.createDataFrame([("a", 1), ("b", 5)], "word string, idx int")
    vec = spark.createDataFrame([(i, [7.0 if i == 0 else 1.0]) for i in ids], "vec_id int, embedding array<float>")
    got = {r["word"]: r["vector"] for r in EM.embed(vocab, vec, 1, default=0).collect()}
    assert got == {"a": [1.0], "b": want}


def test_status_counts_by_months(spark):
    d = spark.createDataFrame([(1, "C", 0), (1, "C", -1), (1, "X", -2), (2, "C", 0), (None, "C", 0)], "id int, s string, m int")
    got = {r["id"]: (r["STATUS_C"], r["STATUS_X"], r["MONTHS"], r["STATUS_C_RATIO"]) for r in A.status_counts(d, "id", "s", ["C", "X"], months="m").collect()}
    assert got == {1: (2, 1, 2, 1.0), 2: (1, None, 0, None)}


def test_one_hot_name_clash(spark):
    d = spark.createDataFrame([("nan",), (None,)], "c string")
    with pytest.raises(ValueError, match="same column name"):
        EN.one_hot(d, ["c"])


def test_score_table_keeps_every_metric(spark):
    names = [f"m{i}" for i in range(1200)]
    got = M.score_table(spark.createDataFrame([(1, n, float(i)) for i, n in enumerate(names)], "step int, metric string, value double"), names)
    assert len(got.columns) == 1201 and got.first()["m1199"] == 1199.0


def test_old_history_changes_nothing(spark):
    """Rows older than the longest horizon neither add nor change features."""
    us = TR.MINUTES
    rows = [(i, "g", f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", float(i)) for i in range(300)]
    d = spark.createDataFrame(rows, "id int, g string, ts string, v double")
    young = d.where("id >= 200")
    a, b = (sorted(map(tuple, TR.trailing_stats(x, "id", "ts", ["g"], ["g"], "v", [2, 5], "f", moment_us=10 * us, k=1).collect())) for x in (d, young))
    assert a == b and len(a) == 10


def test_checkpoint_folder_is_required_on_a_cluster():
    from tabloom.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
