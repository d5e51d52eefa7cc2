"""Hand-made rows for the pandas semantics the fixture tables lack (FIXTURES.md §C)."""
from pyspark.sql import functions as F

from tabloom.functions.semantics import safe_div, sample_skew
from tabloom.operators import nulls as N
from tabloom.operators import project as P
from tabloom.operators.aggregate import exact_median, first_last
from tabloom.operators.ranking import cumulative_sum_by, row_number_by


def test_safe_div_zero_and_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 1), (3, 2)], "a int, b int")
    got = [r[0] for r in df.select(safe_div("a", "b")).collect()]
    assert got == [None, None, None, 1.5]


def test_skew_needs_three_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 1.0), (2, 2.0), (2, 3.0), (2, 10.0)], "k int, x double")
    r = {k: v for k, v in df.groupBy("k").agg(sample_skew("x")).collect()}
    assert r[1] is None
    assert abs(r[2] - 1.763632614803888) < 1e-9


def test_row_stats_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (2.0, 2.0, None)], "a double, b double, c double")
    r = P.row_stats(df, ["a", "b", "c"]).select("row_mean", "row_std").collect()
    assert r[0][0] == 2.0 and abs(r[0][1] - 2 ** 0.5) < 1e-12
    assert r[1][0] is None and r[1][1] is None
    assert r[2][0] == 2.0 and r[2][1] == 0.0


def test_drop_where_keeps_null_condition(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    assert N.drop_where(df, F.col("x") > 2).count() == 2


def test_sentinel(spark):
    df = spark.createDataFrame([(365243.0,), (365242.0,)], "d double")
    assert [r[0] for r in N.null_sentinel(df, ["d"]).collect()] == [None, 365242.0]


def test_row_number_by_matches_window_with_hot_key(spark):
    rows = [(0, i) for i in range(500)] + [(k, i) for k in range(1, 40) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, v int")
    got = {(r.k, r.v): r.rn for r in row_number_by(df, "k", ["v"], num_partitions=7).collect()}
    for (k, v), rn in got.items():
        assert rn == v + 1
    assert len(got) == len(rows)


def test_global_numbering(spark):
    df = spark.range(1000).withColumn("x", (F.col("id") * 7919) % 1000)
    got = sorted((r.x, r.rn) for r in row_number_by(df, None, ["x"], num_partitions=5).collect())
    assert [rn for _, rn in got] == list(range(1, 1001))


def test_cumulative_sum(spark):
    df = spark.createDataFrame([(0, i, 1) for i in range(300)] + [(1, i, 2) for i in range(10)], "k int, o int, w int")
    got = {(r.k, r.o): r.cum for r in cumulative_sum_by(df, ["k"], ["o"], "w", num_partitions=6).collect()}
    assert got[(0, 299)] == 300 and got[(1, 9)] == 20 and got[(0, 0)] == 1


def test_exact_median_even_odd(spark):
    df = spark.createDataFrame([(0, float(i)) for i in range(1, 101)] + [(1, 1.0), (1, 5.0), (1, 2.0)], "k int, v double")
    r = {row.k: row.median for row in exact_median(df, ["k"], "v").collect()}
    assert r == {0: 50.5, 1: 2.0}


def test_first_last_skips_null_values(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "a"), (1, 3, "b"), (1, 4, None)], "k int, m int, s string")
    r = first_last(df, "k", "m", "s").collect()[0]
    assert (r.s_FIRST, r.s_LAST) == ("a", "b")


def test_profile_distributed_median_equals_exact(spark):
    from tabloom.operators.aggregate import profile_all
    rows = [(0, float(i % 17)) for i in range(400)] + [(k, float(k * i)) for k in range(1, 6) for i in range(4)]
    df = spark.createDataFrame(rows, "k int, x double")
    a = {r.k: r.x_MEDIAN for r in profile_all(df, "k", ["median", "mean"]).collect()}
    b = {r.k: r.x_MEDIAN for r in profile_all(df, "k", ["median", "mean"], median="distributed").collect()}
    assert a == b


def test_pipe_and_map_batches(spark):
    from tabloom.operators.udf import map_batches, pipe
    df = spark.range(10)
    out = pipe(df, (lambda d, n: d.where(f"id < {n}"), 5), lambda d: d.withColumn("y", d.id * 2))
    assert [r.y for r in out.orderBy("id").collect()] == [0, 2, 4, 6, 8]
    m = map_batches(df, lambda b: b.assign(id=b["id"] + 1), "id long")
    assert sorted(r.id for r in m.collect()) == list(range(1, 11))
