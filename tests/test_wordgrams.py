"""Word n-grams counted level by level, against brute force and the path that counts every n-gram."""
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabloom.operators import vectorize as V
from tabloom.operators import wordgrams as W


def _texts(seed=7):
    rng = random.Random(seed)
    word = lambda: rng.choices("abcdefghij", [60, 40, 30, 20, 10, 5, 3, 2, 1, 1])[0]
    rows = [(i, [word() for _ in range(rng.randrange(25))]) for i in range(40)]
    # shared, NULL and empty: one document per id; nothing runs over the end of a row
    return rows + [(3, ["a", "b", "a"]), (3, ["b", "a"]), (None, ["a", "a"]), (None, ["zz", "é", "zz"]), (90, []), (91, None), (92, ["é", "\U0001F600", "é"] * 3), (93, ["once"])]


def _brute(rows, lo, hi, min_df, k, binary):
    docs = defaultdict(Counter)
    for i, t in rows:
        for n in range(lo, hi + 1):
            docs[i].update(" ".join(t[p:p + n]) for p in range(len(t or []) - n + 1))
    df, tf = Counter(g for c in docs.values() for g in c), sum(docs.values(), Counter())
    top = sorted((g for g in df if df[g] >= min_df), key=lambda g: (-tf[g], g))[:k]
    ids = {g: i for i, g in enumerate(sorted(top))}
    want = {}
    for i, c in docs.items():
        w = {g: (1 if binary else c[g]) * (math.log((1 + len(rows)) / (1 + df[g])) + 1) for g in c if g in ids}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want.update({(i, g, ids[g]): x / norm for g, x in w.items()})
    return want


@pytest.mark.parametrize("lo,hi,min_df,k,binary", [(1, 4, 3, 30, True), (1, 2, 2, 7, False), (1, 4, 1, 100_000, False), (2, 3, 2, 20, True), (1, 1, 1, 3, False), (1, 4, 99, 5, True)])
@pytest.mark.parametrize("block", [1 << 20, 1])
def test_tfidf_of_grams_against_brute_force(spark, monkeypatch, lo, hi, min_df, k, binary, block):
    monkeypatch.setattr(W, "BLOCK_TOKENS", block)
    rows = _texts()
    d = spark.createDataFrame(rows, "i int, t array<string>")
    want = _brute(rows, lo, hi, min_df, k, binary)
    g = W.gram_index(d, "i", "t", lo, hi, min_df, k)
    got = {(r["i"], r["term"], r["term_id"]): r["weight"] for r in W.gram_rows(g, binary).collect()}
    assert got == pytest.approx(want) and len(got) == len(want)
    assert g.vocab.count() == len({x[1] for x in want})


def test_grams_beyond_the_bounds_take_the_other_path(spark, monkeypatch):
    rows = _texts()
    d = spark.createDataFrame(rows, "i int, t array<string>")
    monkeypatch.setattr(W, "MAX_KNOWN", 3)
    assert W.gram_index(d, "i", "t", 1, 2, 2, 7) is None
    got = {(r["i"], r["term"], r["term_id"]): r["weight"] for r in V.tfidf_grams(d, "i", "t", 1, 2, 2, 7).collect()}
    assert got == pytest.approx(_brute(rows, 1, 2, 2, 7, False))


@pytest.mark.parametrize("tfidf", [True, False])
def test_packed_block_in_a_union(spark, tfidf):
    rows = [(i, t, float(i or 0)) for i, t in _texts()]
    d = spark.createDataFrame(rows, "i int, t array<string>, v double")
    union = lambda text: {r["i"]: r for r in V.sparse_union([V.dense_block(d, "i", ["v"]), text, V.hash_block(d, "i", ["v"], 3)], "i").collect()}
    one = union(V.gram_block(d, "i", "t", 1, 2, "t", 2, 9, tfidf))
    two = union(V.text_block(d, "i", V.ngram_range(F.col("t"), 1, 2), "t", 2, 9, tfidf))
    assert one.keys() == two.keys()
    for i, r in one.items():
        assert (r["size"], r["indices"]) == (two[i]["size"], two[i]["indices"]) and r["values"] == pytest.approx(two[i]["values"])


def test_grams_are_not_shuffled_with_their_document(spark):
    """Documents find their terms inside their row: the plan has no exchange but the broadcast of the terms."""
    d = spark.createDataFrame([(i, ["a", "b", "c"]) for i in range(9)], "i int, t array<string>")
    out = V.tfidf_grams(d, "i", "t", 1, 4, 2, 5, binary=True)
    assert out.count() == 45
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan


def test_queries_shuffle_no_terms_with_their_document(spark, tmp_path):
    """The weights and norms of both queries are found in the row: no exchange of (document, term) and no window over a document."""
    import __spark_entry__ as E
    rows = [(i, "the one two three one two " * 2 + f"w{i}", "en", "web", 40) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    plan = lambda name: E.queries()[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan("vz_tfidf_binary")
    assert "Window" not in plan("vz_union")
