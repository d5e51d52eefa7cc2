"""Properties from the test strategy: folds partition ids, padding has fixed
length, encoders are bijective, OOF covers each id once, decay means stay
within the value range, numbering is a permutation."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from tabloom.operators import encode as EN
from tabloom.operators import model as ML
from tabloom.operators import trailing as TR
from tabloom.sources.fixtures import energy, table

SF = "/root/testdata/sf0.001"


def test_folds_partition_ids(spark):
    lab = table(spark, SF, "labels")
    f = ML.add_fold(lab, "doc_id", 5)
    s = ML.add_fold(lab, "doc_id", 5, label="toxic", out="sfold")
    assert f.count() == lab.count() == f.select("doc_id").distinct().count()
    assert {r[0] for r in f.select("fold").distinct().collect()} <= set(range(5))
    # stratified folds: class counts per fold differ by at most one
    per = s.groupBy("toxic", "sfold").count().groupBy("toxic").agg(F.max("count") - F.min("count")).collect()
    assert all(r[1] <= 1 for r in per)


def test_padding_fixed_length(spark):
    for name in ("sq_pad_pre", "sq_pad_post"):
        df = E.queries()[name](spark, SF)
        lens = {r[0] for r in df.select(F.size(F.split("padded", " "))).distinct().collect()}
        assert lens == {100}


def test_label_encoder_bijective(spark):
    p = table(spark, SF, "part").select("p_partkey", "p_brand")
    e = EN.label_encode(p.withColumn("code_src", F.col("p_brand")), ["p_brand"])
    pairs = e.select("code_src", "p_brand").distinct()
    assert pairs.count() == pairs.select("code_src").distinct().count() == pairs.select("p_brand").distinct().count()
    codes = sorted(r[0] for r in pairs.select("p_brand").collect())
    assert codes == list(range(len(codes)))


def test_oof_covers_each_train_id_once(spark):
    df = E.queries()["ml_oof"](spark, SF)
    oof = df.where("part = 'oof'")
    assert oof.count() == oof.select("c_custkey").distinct().count()
    test = df.where("part = 'test'")
    assert test.join(oof, "c_custkey").count() == 0


def test_decay_mean_within_range_and_no_leak(spark):
    base, hist = TR.split_base_history(energy(spark, SF), "ts", ["site", "forecast"], 86_400_000_000, 0)
    f = TR.feature_block(base, hist, "obs_id", ["site"], "value", "S", [3], [3], 86_400_000_000, 0,
                         unit_us=6 * 3_600_000_000)
    lim = hist.agg(F.min("value"), F.max("value")).first()
    r = f.where("S_count3 > 0").agg(F.min("S_exp_mean3"), F.max("S_exp_mean3")).first()
    assert lim[0] - 1e-9 <= r[0] and r[1] <= lim[1] + 1e-9
    # history rows all lie before their group's base window
    assert hist.where(F.col("_t") >= F.col("_L1")).count() == 0


def test_global_ids_are_a_permutation(spark):
    v = E.queries()["vc_index_insertion"](spark, SF)
    n = v.count()
    assert sorted(r[0] for r in v.select("idx").collect()) == list(range(n))
