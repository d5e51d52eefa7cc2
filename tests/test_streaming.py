"""The micro-batch runner applies a batch operator to a file stream."""
import tempfile

from pyspark.sql import functions as F

from tabloom.operators.aggregate import profile
from tabloom.streaming import run_per_batch


def test_run_per_batch_on_events(spark):
    src = "/root/testdata/sf0.001/events.parquet"
    schema = spark.read.parquet(src).schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .parquet("/root/testdata/sf0.001"))
    out = tempfile.mkdtemp(prefix="tabloom-stream-out-")
    ck = tempfile.mkdtemp(prefix="tabloom-stream-ck-")
    q = run_per_batch(stream, lambda b: profile(b, "user_id", {"value": ["sum", "count"]}), out, ck)
    q.awaitTermination(120)
    got = spark.read.parquet(out).groupBy("user_id").agg(F.sum("value_SUM").alias("s1"))
    want = spark.read.parquet(src).groupBy("user_id").agg(F.sum("value").alias("s2"))
    diff = got.join(want, "user_id").where(F.abs(F.col("s1") - F.col("s2")) > 1e-6)
    assert got.count() == want.count() and diff.count() == 0
