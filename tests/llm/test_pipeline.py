"""The corpus pipeline's stages, and the SQL of the registered queries."""
import random
import re

import duckdb
import pytest

import corpus_pipeline as P
from tabloom.llm import ngram_join, pii, quality
from tabloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(P.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append((name, before, docs))
    return out


def as_map(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _, _ in stages] == ["quality_rules", "line_dedup", "near_duplicates", "pii", "best_fit_packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and 0 < after.count() <= before.count()


def test_quality_stage(stages):
    _, before, after = stages[0]
    assert as_map(after) == {r["doc_id"]: r["text"] for r in quality.quality(before).where("kept").select("doc_id").join(before, "doc_id").collect()}


def test_line_stage(stages):
    from test_operators import brute_lines
    _, before, after = stages[1]
    want, gone = brute_lines(sorted(as_map(before).items()), 3)
    assert as_map(after) == {d: t for d, t in want.items() if not gone[d] or re.search(r"[^\x20\x09-\x0D]", t)}


def test_near_duplicate_stage(stages):
    from test_operators import brute_near
    _, before, after = stages[2]
    want = brute_near(sorted(as_map(before).items()))
    assert set(as_map(after)) == {d for d, (c, _) in want.items() if c == d}


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark):
    from test_operators import prose, table
    rng = random.Random(13)
    a, b, c, d, e = (prose(rng, 60, 5000) for _ in range(5))
    texts = [a, a + " one", a + " two", b, b + " one", c, c, d, e, e, "", ""]
    docs = table(spark, texts, [None, None, 5, None, None, None, None, None, 9, 9, None, None])
    got = sorted(r["text"] for r in P.near_duplicate_stage(spark, docs, SF).collect())
    assert got in (sorted([a + " two", x, c, d, e, "", ""]) for x in (b, b + " one"))


def test_pii_stage(stages):
    from test_operators import brute_pii
    _, before, after = stages[3]
    masked = as_map(after)
    for d, t in as_map(before).items():
        if brute_pii(t):
            assert masked[d] != t
        elif "[" not in masked[d]:
            assert masked[d] == t


def test_packing_stage(stages):
    _, before, after = stages[4]
    assert {r["doc_id"] for r in after.select("doc_id").distinct().collect()} == set(as_map(before))


def test_run(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, P.run(spark, SF).select(key).collect())) == sorted(map(tuple, stages[-1][2].select(key).collect()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, want = QUERIES[name](spark, SF), con.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_stages_keep_clashing_columns(spark):
    """Columns named as the operators' own, or with a dot, go through every stage but the last as they are."""
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(["the", "of", "and"]) + f" w{rng.randrange(400)}" for _ in range(n))
    lines = "\n".join(say(8) for _ in range(4))
    texts = [None, "", "short", say(60), say(60), lines + "\n" + say(40), lines + "\n" + say(40), say(50) + " mail bob@example.org now"] + [say(70)] * 3
    extra = ["a.b", "__spans", "__n_removed", "__th", "__keep", "row", "__gone", "kept", "h"]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in extra)
    docs = spark.createDataFrame([(None if i == 3 else i, t, *[f"{c}{i}" for c in extra]) for i, t in enumerate(texts)], schema)
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = [r.asDict() for r in out.collect()]
        number = [int(r["a.b"][3:]) for r in rows]
        assert rows and all(r[c] == f"{c}{i}" for i, r in zip(number, rows) for c in extra)
        docs = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in rows], schema)
    assert number and {3, 4} <= set(number) and len({8, 9, 10} & set(number)) == 1
    assert all("bob@example.org" not in (r["text"] or "") for r in rows)
    empty = docs.limit(0)
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, empty, SF).collect() == []
