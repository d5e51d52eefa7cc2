"""Operators against brute force on small tables: lookups, top-k, ordered passes, trailing rings, encodings, blocks."""
import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabloom.operators import encode, lookup, pipelines, ranking, screen, trailing, vectorize, vocab

US = 60 * 1_000_000


def test_lookup_inside_the_row(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)] + ["", "ü'\"\\", "a\nb"]
    pairs = spark.createDataFrame([(w, i) for i, w in enumerate(words)] + [(None, 5), ("null", None)], "word string, idx long")
    texts = [None, [], ["w1", None, "none"], *[[rng.choice(words + ["x", "y"]) for _ in range(n)] for n in (3, 30, 400)]]
    d = spark.createDataFrame(list(enumerate(texts)), "id long, t array<string>")
    look = lookup.constant_map(pairs, "word", "idx")
    got = {r["id"]: r for r in d.select("id", lookup.known(F.col("t"), look).alias("all"), lookup.first_known(F.col("t"), look, 5).alias("first"),
                                        lookup.first_known(F.col("t"), look, 5, last=True).alias("last")).collect()}
    number = {w: i for i, w in enumerate(words)}
    for i, t in enumerate(texts):
        want = None if t is None else [number[w] for w in t if w in number]
        assert got[i]["all"] == want
        assert (got[i]["first"], got[i]["last"]) == ((None, None) if t is None else (want[:5], want[-5:]))
    assert lookup.constant_map(pairs, "word", "idx", max_rows=10) is None and lookup.constant_map(pairs, "word", "idx", max_bytes=10) is None


@pytest.mark.parametrize("bounded", [True, False])
def test_encode_and_drop_rare_either_way(spark, monkeypatch, bounded):
    if not bounded:
        monkeypatch.setattr(vocab, "constant_map", lambda *a, **k: None)
    rng = random.Random(2)
    texts = [[], ["rare"], *[["the"] * 20 + [f"w{int(rng.expovariate(.2))}" for _ in range(30)] for _ in range(40)]]
    d = spark.createDataFrame(list(enumerate(texts)), "id long, t array<string>").repartition(3)
    v = vocab.build_vocab(d, "t", max_size=20)
    order = sorted(Counter(w for t in texts for w in t).items(), key=lambda x: (-x[1], x[0]))[:19]
    ids = {w: i for i, (w, _) in enumerate(order, 1)}
    assert {r["word"]: r["idx"] for r in v.collect()} == ids
    for last in (False, True):
        got = {r["id"]: r["ids"] for r in vocab.encode(d, "id", "t", v, 10, last=last).collect()}
        assert got == {i: ([ids[w] for w in t if w in ids][-10:] if last else [ids[w] for w in t if w in ids][:10]) for i, t in enumerate(texts)}
    df = Counter(w for t in texts for w in set(t))
    assert {r["id"]: r["kept"] for r in vocab.drop_rare(d, "id", "t", 5).collect()} == {i: [w for w in t if df[w] >= 5] for i, t in enumerate(texts)}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_split_join_equals_join(spark, how):
    rows = [("the" if i % 3 else f"w{i % 50}" if i % 2 else None, i) for i in range(3000)]
    d, t = spark.createDataFrame(rows, "k string, n long"), spark.createDataFrame([("the", 1), ("w3", 2), ("w9", 3)], "k string, v long")
    assert "the" in lookup.heavy_values(d, "k")
    a, b = (sorted(map(tuple, x.collect()), key=str) for x in (lookup.split_join(d, t, "k", how, share=0.1), d.join(t, "k", how)))
    assert a == b


@pytest.mark.parametrize("small_top,cells", [(10_000, 4096), (2, 4), (2, 4096)])
@pytest.mark.parametrize("k", [0, 1, 7, 40, 5000])
def test_top_by_count(spark, monkeypatch, small_top, cells, k):
    monkeypatch.setattr(ranking, "SMALL_TOP", small_top)
    monkeypatch.setattr(ranking, "CELLS", cells)
    rng = random.Random(k)
    rows = [(f"t{i:03d}", rng.choice([1, 1, 1, 2, 3, 50, 10 ** 9 + i % 3])) for i in range(200)]
    got = ranking.top_by_count(spark.createDataFrame(rows, "term string, tf long").repartition(4), "tf", ["term"], k)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
    assert sorted((r["rank"], r["term"], r["tf"]) for r in got.collect()) == [(i, *r) for i, r in enumerate(want, 1)]


def test_ordered_pass_and_running_totals(spark):
    rng = random.Random(3)
    rows = [(1 if rng.random() < .6 else rng.randrange(2, 9), rng.randrange(500), i) for i in range(1500)]
    d = spark.createDataFrame(rows, "k long, t long, i long").repartition(5)
    got = {r["i"]: (r["rn"], r["n"], r["prev_t"]) for r in ranking.ordered_pass(d, "k", ["t", "i"], lag=["t"]).collect()}
    by = defaultdict(list)
    for k, t, i in rows:
        by[k].append((t, i))
    want = {i: (n, len(x), x[n - 2][0] if n > 1 else None) for x in map(sorted, by.values()) for n, (_, i) in enumerate(x, 1)}
    assert got == want
    c = Counter((k, float(t)) for k, t, _ in rows)
    t = spark.createDataFrame([(*x, n) for x, n in c.items()], "k long, v double, n long")
    for cuts in (None, [], [3.0, 250.0]):
        for r in ranking.running_totals(t, "k", "v", ["n"], cuts).collect():
            assert r["n_upto"] == sum(n for (k, v), n in c.items() if k == r["k"] and v <= r["v"])
            assert r["n_all"] == sum(n for (k, _), n in c.items() if k == r["k"])


def test_trailing_rings(spark):
    """Horizons with empty rings, one value, equal values, NULL values and keys, against a plain recount."""
    rng = random.Random(4)
    rows = []
    for g in "abc":
        for i in range(90):
            rows.append((len(rows), g, None if i % 17 == 0 else rng.choice("xyz"), rng.randrange(0, 200), None if i % 13 == 0 else rng.choice([5.0, 5.0, 1e6 + rng.random(), -3.25])))
    rows += [(1000 + i, "d", "x", 10 * i, 7.5) for i in range(20)]
    d = spark.createDataFrame(rows, "id long, g string, h string, m long, v double").withColumn("ts", F.timestamp_micros(F.col("m") * US))
    hz, stats = [2, 3, 9], ("min", "mean", "median", "max", "count", "std", "skew", "sum")
    base, hist = trailing.split_base_history(d, "ts", ["g"], 10 * US, 0)
    blocks = [[{"name": "G", "horizons": hz, "decay_horizons": [3]}], [{"name": "H", "horizons": [3, 9]}], [{"name": "GH", "horizons": [2]}]]
    got = {r["id"]: r.asDict() for r in trailing.keyset_features(base, hist, "id", [["g"], ["h"], ["g", "h"]], "v", blocks, 10 * US, 0, stats, unit_us=US).collect()}
    top = {g: max(r[3] for r in rows if r[1] == g) for g in "abcd"}
    old = [r for r in rows if r[3] < top[r[1]] - 10]

    def value(s, x):
        n = len(x)
        if s == "count":
            return n
        if not n:
            return 0
        if s in ("std", "skew") and (n < (2 if s == "std" else 3) or len(set(x)) == 1):
            return 0
        if s == "skew":
            m = statistics.fmean(x)
            m2, m3 = (sum((y - m) ** p for y in x) / n for p in (2, 3))
            return m3 / m2 ** 1.5 * math.sqrt(n * (n - 1)) / (n - 2)
        return {"min": min, "max": max, "mean": statistics.fmean, "median": statistics.median, "sum": math.fsum, "std": statistics.stdev if n > 1 else None}[s](x)

    new = [r for r in rows if top[r[1]] - 10 <= r[3] < top[r[1]]]
    assert got.keys() == {r[0] for r in new}
    for r in new:
        for (bl,), keys in zip(blocks, ((1,), (2,), (1, 2))):
            mine = [o for o in old if all(o[k] == r[k] and r[k] is not None for k in keys)]
            for n in bl["horizons"]:
                x = [o[4] for o in mine if o[3] >= top[o[1]] - 10 * n and o[4] is not None]
                for s in stats:
                    assert got[r[0]][f"{bl['name']}_{s}{n}"] == pytest.approx(value(s, x), rel=1e-7, abs=1e-9), (r, n, s)
            for n in bl.get("decay_horizons", ()):
                x = [(o[4], 0.985 ** (top[o[1]] - o[3])) for o in mine if o[3] >= top[o[1]] - 10 * n]
                want = sum(v * w for v, w in x if v is not None) / sum(w for _, w in x) if x else 0
                assert got[r[0]][f"{bl['name']}_exp_mean{n}"] == pytest.approx(want, rel=1e-9)


def test_trailing_plan_holds_no_group(spark):
    import __spark_entry__ as E
    p = E.queries()["ts_trail_site"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "median(" not in p and "collect_list" not in p and "Generate" not in p


def test_sequences_shuffles_no_tokens(spark):
    import __spark_entry__ as E
    p = E.queries()["sq_pad_pre"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p and "collect_list" not in p


def test_out_of_fold_encoding(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]) if i else "once", rng.choice([0, 0, 1]), None if i % 29 == 3 else i % 3) for i in range(200)]
    d = spark.createDataFrame(rows, "id long, c string, y int, fold int")
    got = {r["id"]: r["c_te"] for r in encode.target_encode_oof(d, "c", "y", "fold", 4, 2.0).collect()}
    for i, c, _, f in rows:
        rest = [y for _, _, y, g in rows if f is None or g != f]
        prior = statistics.fmean(rest)
        own = [y for _, v, y, g in rows if v == c and g is not None and g != f]
        s = 1 / (1 + math.exp(-(len(own) - 4) / 2.0))
        assert got[i] == pytest.approx(prior * (1 - s) + statistics.fmean(own) * s if own and c is not None and f is not None else prior), (i, c, f)
    noisy = [{r["id"]: r["c_te"] for r in encode.target_encode_oof(x, "c", "y", "fold", 4, 2.0, noise_level=0.1, id_col="id", seed=3).collect()} for x in (d, d.repartition(7))]
    assert noisy[0] == pytest.approx(noisy[1]) and noisy[0] != got
    with pytest.raises(ValueError):
        encode.target_encode_oof(d, "c", "y", "fold", noise_level=0.1)


def test_sparse_union(spark):
    d = spark.createDataFrame([(0, "x", 2.0, "a b a"), (1, "y", 0.0, "b"), (2, None, None, "")], "id long, c string, v double, t string")
    terms = F.filter(F.split("t", " "), lambda w: w != "")
    blocks = [vectorize.dense_block(d, "id", ["v"]), vectorize.one_hot_block(d, "id", "c"), vectorize.hash_block(d, "id", ["c", "t"], 4),
              vectorize.text_block(d, "id", terms, "text", 1, 10)]
    got = {r["id"]: r for r in vectorize.sparse_union(blocks, "id").collect()}
    assert {r["size"] for r in got.values()} == {1 + 3 + 4 + 2}
    cells = {i: dict(zip(r["indices"], r["values"])) for i, r in got.items()}
    assert cells[0][0] == 2.0 and 0 not in cells[1] and 0 not in cells[2]
    assert [{k for k in cells[i] if 1 <= k < 4} for i in range(3)] == [{2}, {3}, {1}]  # "nan" < "x" < "y"
    assert all(sum(v for k, v in cells[i].items() if 4 <= k < 8) == 2 for i in range(3))
    assert [{k for k in cells[i] if k >= 8} for i in range(3)] == [{8, 9}, {9}, set()]
    assert all(list(r["indices"]) == sorted(r["indices"]) for r in got.values())


def test_group_statistics_of_two_groupings(spark):
    rng = random.Random(6)
    rows = [(f, rng.choice([1.0, 2.0, 2.0, 9.5, rng.random()]) if f == "a" else float(rng.randrange(2)), rng.choice([0, 1, None]), rng.choice([0, 1])) for f in "ab" for _ in range(300)]
    d = spark.createDataFrame(rows, "feature string, value double, y int, t int")
    got = {r["feature"]: r for r in screen.group_statistics(d, {"y": screen._halves("y"), "s": screen._halves("y", F.col("t") == 1)}).collect()}
    for f in "ab":
        for name, rows_ in (("y", rows), ("s", [r for r in rows if r[3] == 1])):
            x = [[v for g, v, y, _ in rows_ if g == f and y == k] for k in (0, 1)]
            stat = statistics.fmean if f == "b" else statistics.median
            assert got[f][f"{name}_diff"] == pytest.approx(abs(stat(x[0]) - stat(x[1])))
            assert got[f][f"{name}_mean"] == pytest.approx(statistics.fmean(r[1] for r in rows_ if r[0] == f))
            both = sorted(x[0] + x[1])
            rank = {v: both.index(v) + (both.count(v) + 1) / 2 for v in set(both)}
            assert got[f][f"{name}_w"] == pytest.approx(sum(rank[v] for v in x[1])) and (got[f][f"{name}_n0"], got[f][f"{name}_n1"]) == (len(x[0]), len(x[1]))


def test_column_selector_is_saved(spark, tmp_path):
    d = spark.createDataFrame([(1, 2.0, "a", 5.0), (2, None, "b", 7.0)], "id long, `a.b` double, c string, v double")
    s = pipelines.ColumnSelector(inputCols=["a.b", "id"])
    assert s.transform(d).columns == ["a.b", "id"]
    s.write().overwrite().save(str(tmp_path / "s"))
    assert pipelines.ColumnSelector.load(str(tmp_path / "s")).transform(d).columns == ["a.b", "id"]
    with pytest.raises(ValueError):
        pipelines.ColumnSelector(inputCols=["none"]).transform(d)
    x = d.select("id", F.col("`a.b`").alias("ab"), "v")
    m = pipelines.scaled_features(["id"], ["ab", "v"]).fit(x)
    again = pipelines.save_and_load(m, str(tmp_path / "m"))
    assert [r["features"] for r in m.transform(x).orderBy("id").collect()] == [r["features"] for r in again.transform(x).orderBy("id").collect()]


def test_term_stats_of_repeated_and_null_ids_and_terms(spark):
    from tabloom.operators import vectorize as V
    rows = [(1, ["a", "b", "a"]), (2, ["a"]), (2, ["b", None, None]), (None, ["c", None]), (None, ["c"]), (3, []), (4, None), (5, [None, None])]
    df = spark.createDataFrame(rows, "i int, t array<string>")
    got = {r["term"]: (r["df"], r["tf"]) for r in V.term_stats(df, "i", F.col("t")).collect()}
    assert got == {"a": (2, 3), "b": (2, 2), "c": (1, 2), None: (3, 5)}


def test_vocabulary_terms_alone_are_shuffled_with_their_document(spark):
    from tabloom.operators import vectorize as V
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a", "z"]), (2, ["b"])], "i int, t array<string>")
    voc = V.select_vocab(df, "i", F.col("t"), 2)
    out = V.count_long(df, "i", F.col("t"), voc, binary=False)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 0, 2), (1, "b", 1, 1), (2, "a", 0, 1), (2, "b", 1, 1)]
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_word_vectors_are_trained_in_several_tasks(spark, monkeypatch):
    from pyspark.ml import feature
    from tabloom.operators import embed as EM
    seen, fit = [], feature.Word2Vec.fit
    monkeypatch.setattr(feature.Word2Vec, "fit", lambda self, df: seen.append(self.getNumPartitions()) or fit(self, df))
    monkeypatch.setattr(EM, "TRAIN_TOKENS", 100)
    df = spark.createDataFrame([(["a", "b", "c", "d"],)] * 100, "t array<string>")
    assert EM.train_vectors(df, "t", dim=4).count() == 4
    assert seen == [4]


def test_word_vectors_of_the_query_are_trained_in_full(spark, monkeypatch, tmp_path):
    """400 dimensions and 5 passes over every text, as the reference trains."""
    import __spark_entry__ as E
    from pyspark.ml import feature
    seen, fit = [], feature.Word2Vec.fit
    monkeypatch.setattr(feature.Word2Vec, "fit", lambda self, df: seen.append((self.getVectorSize(), self.getMaxIter(), self.getWindowSize(), self.getMinCount(), df.count())) or fit(self, df))
    spark.createDataFrame([(i, "One two ONE three" if i else "rare") for i in range(6)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["word"]: r["vector"] for r in E.queries()["em_train"](spark, str(tmp_path)).collect()}
    assert seen == [(400, 5, 5, 5, 6)]
    assert {w: len(v) for w, v in got.items()} == {"one": 400, "two": 400, "three": 400}


@pytest.mark.parametrize("bound", [64 << 20, 40, 0])
def test_doc_vectors_against_brute_force(spark, monkeypatch, bound):
    """Whatever part of the vectors is broadcast; repeated and NULL ids, unknown words, a NULL vector, a word with two ids."""
    from tabloom.operators import embed as EM
    monkeypatch.setattr(EM, "BROADCAST_BYTES", bound)
    docs = [(1, ["a", "b", "a"]), (1, ["c"]), (2, ["x"]), (3, []), (4, None), (None, ["a"]), (5, ["d", "e", "e", "x"])]
    vocab, vecs = [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("e", 6), ("f", 7)], {1: [1.0, 2.0], 2: [4.0, 8.0], 3: [3.0, -1.0], 4: None, 5: [5.0, 0.5], 6: [1.0, 1.0]}
    got = EM.doc_vectors(spark.createDataFrame(docs, "id int, t array<string>"), "id", "t", spark.createDataFrame(vocab, "word string, idx long"),
                         spark.createDataFrame([*vecs.items()], "vec_id long, embedding array<float>"), 2)
    text = {i: [w for j, t in docs if j == i for w in t or []] for i, _ in docs if i is not None}
    hits = {i: [vecs[k] for w in t for x, k in vocab if x == w and vecs.get(k)] for i, t in text.items()}
    want = sorted((i or -1, p, sum(v[p] for v in hits.get(i, [])) / max(1, len(hits.get(i, [])))) for i, _ in docs for p in range(2))
    assert sorted((-1 if r["id"] is None else r["id"], r["pos"], round(r["value"], 9)) for r in got.collect()) == [(i, p, round(x, 9)) for i, p, x in want]


def test_doc_vectors_shuffles_no_tokens(spark):
    """Nothing is shuffled by document and token, or by a token's number; only sums by document are."""
    from tabloom.operators import embed as EM
    docs, vocab = spark.createDataFrame([(1, ["a"])], "id int, t array<string>"), spark.createDataFrame([("a", 1)], "word string, idx long")
    plan = EM.doc_vectors(docs, "id", "t", vocab, spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>"), 1)._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert moved and not any("_w" in x or "_k" in x for x in moved)


@pytest.mark.parametrize("chars,big", [(1 << 22, False), (7, False), (1, True)])
def test_char_grams_against_brute_force(spark, monkeypatch, chars, big):
    """Any block size, alphabets whose grams need more than 63 bits, shared and NULL ids, NULL and empty texts, zero characters; vocabulary sent or joined."""
    from tabloom.operators import chargrams as C
    monkeypatch.setattr(C, "BLOCK_CHARS", chars)
    rng = random.Random(3)
    wide = "".join(chr(0x4E00 + i) for i in range(4000))
    texts = [(1, "abcabcabc"), (2, "ab"), (2, "bcab"), (None, "abc"), (None, "cab"), (3, None), (4, ""), (5, "a\0\0\0"), (6, "\0"), (7, "é€\U0001F600x" * 3), (8, wide + wide[:50]), (9, "".join(rng.choices("ab" + wide[:90], k=300)))]
    d = spark.createDataFrame(texts, "id int, t string")
    grams = defaultdict(Counter)
    for i, t in texts:
        for n in range(2, 7):
            grams[i].update((t or "")[k:k + n] for k in range(len(t or "") - n + 1))
    df, tf = Counter(g for c in grams.values() for g in c), sum(grams.values(), Counter())
    stats = C.char_term_stats(d, "id", "t", 2, 6)
    assert {r["term"]: (r["df"], r["tf"]) for r in stats.collect()} == {g: (df[g], tf[g]) for g in tf}
    voc = {g: i for i, g in enumerate(sorted(g for g in df if df[g] > 1 or tf[g] > 1))}
    if big:
        monkeypatch.setattr(C, "MAX_ROWS", 1)
    hits = C.char_hits(d, "id", "t", 2, 6, spark.createDataFrame([*voc.items()], "term string, term_id long"))
    assert Counter(map(tuple, hits.collect())) == Counter((i, voc[g]) for i, c in grams.items() for g in c if g in voc)


def test_char_ngram_query_shuffles_no_grams(spark):
    """A document's grams are counted in its task: what is shuffled with a document is a sum."""
    import __spark_entry__ as E
    plan = E.queries()["vz_char_ngram"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in x and "term" in x for x in plan.splitlines())


def test_basket_features_shuffle_no_wide_rows(spark):
    """Labels meet the narrow (user, product) rows: after the join with the users nothing is shuffled."""
    from tabloom.operators import basket
    o = spark.createDataFrame([(1, 7, "prior", 1, None), (2, 7, "prior", 2, 3.0), (3, 7, "train", 3, 4.0), (4, 8, "prior", 1, None), (5, 8, "test", 2, 1.0)],
                              "order_id long, user_id long, eval_set string, order_number int, days_since_prior_order double")
    li = spark.createDataFrame([(1, 10, 1, 0), (2, 10, 2, 1), (2, 11, 1, 0), (3, 11, 1, 1), (3, 12, 2, 0), (4, 10, 3, 0), (5, 10, 1, 1)],
                               "order_id long, product_id long, add_to_cart_order int, reordered int")
    b = basket.basket_features(o, li)
    got = {(r["user_id"], r["product_id"]): r for r in b.collect()}
    assert {k: r["reordered"] for k, r in got.items()} == {(7, 10): 0, (7, 11): 1, (8, 10): None}
    r = got[7, 10]
    assert (r["up_orders"], r["up_average_cart_position"], r["prod_orders"], r["prod_reorder_probability"], r["user_distinct_products"], r["user_reorder_ratio"]) == (2, 1.5, 3, 0.5, 2, 0.5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = basket.basket_features(o, li)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Join" in plan.split("Exchange")[0] and "SortMergeJoin [user_id" in plan.split("Exchange")[0] and "product_id" not in plan.split("Exchange")[0].split("SortMergeJoin")[1].split("]")[0]


@pytest.mark.parametrize("rows", [0, 1, 4])
def test_tokens_beyond_the_bounds(spark, monkeypatch, rows):
    """Commonest keys in the row, the others joined: repeated rows and ids, NULL and empty texts, a form with two lemmas."""
    from tabloom.operators import text as TO
    monkeypatch.setattr(lookup, "MAX_ROWS", rows)
    none = lambda real: lambda *a, **k: None
    for m in (vocab, TO):
        monkeypatch.setattr(m, "constant_map", none(m.constant_map))
    texts = [(1, "cats and dogs and cats"), (1, "cats and dogs and cats"), (1, "dogs"), (2, ""), (3, None), (None, "and and birds"), (4, "cats  cats birds and fish")]
    d = spark.createDataFrame(texts, "id int, x string")
    lem = spark.createDataFrame([("cats", "cat"), ("birds", "bird"), ("birds", "birdy"), ("fish", "fisch")], "form string, lemma string")
    new = {"cats": "cat", "birds": "bird", "fish": "fisch"}
    got = TO.normalize_tokens(d, "id", "x", lem, out="y").select("id", "x", "y").collect()
    assert Counter(map(tuple, got)) == Counter((i, x, None if x is None else " ".join(new.get(w, w) for w in x.split())) for i, x in texts)
    t = d.selectExpr("id", "split(x, ' +') AS t").where("x != ''")
    kept = {"cats", "and", "dogs"}
    got = vocab.drop_rare(t, "id", "t", 2).collect()
    df = {w: len({i for i, x in texts if x and w in x.split()}) for w in ("cats", "and", "dogs", "birds", "fish")}
    rows_with = Counter(w for _, x in texts if x for w in set(x.split()))
    assert kept and Counter((r["id"], tuple(r["kept"])) for r in got) == Counter((i, tuple(w for w in x.split() if rows_with[w] >= 2)) for i, x in texts if x) and df
