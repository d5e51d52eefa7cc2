"""Cleaners and text features against Python ``re`` on hand-made strings."""
import re

from pyspark.sql import functions as F

from tabloom.functions import text as X
from tabloom.operators import vectorize as V
from tabloom.operators.vocab import pad

CASES = ["won't they'll I've dont", "  lead  and\ttrail \n", "12abc abc12 1a 2b 3c", "café'll 3é x12y",
         "", "a", "Ünïcode ÄÖ Б б 12"]


def _apply(spark, expr_fn):
    df = spark.createDataFrame([(s,) for s in CASES], "t string")
    return [r[0] for r in df.select(expr_fn(F.col("t"))).collect()]


def test_tokens_like_str_split(spark):
    assert _apply(spark, lambda c: F.array_join(X.tokens(c), "|")) == ["|".join(s.split()) for s in CASES]


def test_split_digit_word_like_python_re(spark):
    py = [re.sub(r"\b(\d+)([a-z]+)\b", r"\1 \2", s) for s in CASES]
    assert _apply(spark, X.split_digit_word) == py


def test_digit_runs_like_re_split(spark):
    py = [" ".join(re.split(r"(\d+)", s)) for s in CASES]
    assert _apply(spark, X.space_digit_runs) == py


def test_collapse(spark):
    assert _apply(spark, X.collapse_ws) == [re.sub(r"\s+", " ", s).strip() for s in CASES]


def test_longest_word(spark):
    def py(s):
        return len(max({k: len(k) for k in s.split(" ")}.items(), key=lambda kv: kv[1])[0]) if len(s) > 1 else 0
    assert _apply(spark, X.longest_word) == [py(s) for s in CASES]


def test_char_ngrams_short_strings(spark):
    df = spark.createDataFrame([("",), ("a",), ("ab",), ("abc",)], "t string")
    got = [r[0] for r in df.select(V.char_ngrams(F.col("t"), 2)).collect()]
    assert got == [[], [], ["ab"], ["ab", "bc"]]


def test_pad_both_sides(spark):
    df = spark.createDataFrame([([],), ([1],), ([1, 2, 3],), ([1, 2, 3, 4],)], "ids array<long>")
    pre = [r[0] for r in df.select(pad("ids", 3, "pre")).collect()]
    post = [r[0] for r in df.select(pad("ids", 3, "post")).collect()]
    assert pre == [[0, 0, 0], [0, 0, 1], [1, 2, 3], [2, 3, 4]]
    assert post == [[0, 0, 0], [1, 0, 0], [1, 2, 3], [1, 2, 3]]


def test_contractions_like_python_re(spark):
    rules = [(r"won't", "will not"), (r"can't", "cannot"), (r"i'm", "i am"), (r"ain't", "is not"),
             (r"(\w+)'ll", r"\g<1> will"), (r"(\w+)n't", r"\g<1> not"), (r"(\w+)'ve", r"\g<1> have"),
             (r"(\w+)'s", r"\g<1> is"), (r"(\w+)'re", r"\g<1> are"), (r"(\w+)'d", r"\g<1> would"),
             (r"dont", "do not"), (r"wont", "will not")]
    cases = CASES + ["don't isn't it's we're they'd", "x'll'll ab'sn't", "l'été n'est pas"]

    def py(s):
        for p, r in rules:
            s = re.sub(p, r, s)
        return s
    df = spark.createDataFrame([(s,) for s in cases], "t string")
    got = [r[0] for r in df.select(X.expand_contractions(F.col("t"))).collect()]
    assert got == [py(s) for s in cases]


def test_contractions_one_after_another_like_python_re(spark):
    """A word directly behind an expanded contraction is one of its own; a suffix alone is not."""
    cases = ["a'llb'll x", "a'll'll", "'ll n't xn't", "an'tn't", "we've they're he'd it's", "é'll _'d ,'s"]
    out = cases
    for pat, rep in X.CONTRACTIONS:
        out = [re.sub(pat.replace(r"[\p{L}\p{N}_]", r"\w"), rep.replace("$1", r"\1"), s) for s in out]
    df = spark.createDataFrame([(s,) for s in cases], "t string")
    assert [r[0] for r in df.select(X.expand_contractions("t")).collect()] == out


def test_character_classes_of_the_engine_are_those_of_the_sql(spark):
    every = spark.range(1, 0x3100).where("id < 55296").select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("t"))
    bad = every.where(F.col("t").rlike(f"[{X._WS}]") != F.col("t").rlike(f"[{X.WS}]"))
    assert bad.count() == 0
    assert every.where(F.col("t").rlike(f"[{X.ALNUM}]") != F.col("t").rlike("[A-Za-z0-9]")).count() == 0


def test_full_profile_has_its_lemma_step(spark, tmp_path):
    """Code and SQL: tokens left by the stop words get their lemma; NULL and empty texts, repeated rows and ids."""
    import duckdb

    import __spark_entry__ as E
    rows = [(1, "Cats and the cat won't see dogs"), (1, "Cats and the cat won't see dogs"), (1, "a dog's bones"), (2, None), (3, ""), (4, "12trees trees tree bone, bone trees!"), (None, "birds")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = E.queries()["cl_profile_full"](spark, str(tmp_path)).collect()
    same = "cat cat will not see dogs"  # the corpus has "dog's", not "dog"
    want = [(1, same), (1, same), (1, "dog bone"), (2, None), (3, ""), (4, "12 tree tree tree bone bone tree"), (None, "birds")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(E.oracle_sql()["cl_profile_full"]).fetchall(), key=str) == sorted(want, key=str)
