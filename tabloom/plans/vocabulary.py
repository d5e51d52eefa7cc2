"""Vocabulary, sequence and vectoriser queries — SURVEY §2.11.

Tokens are the whitespace tokens of the lower-cased document text.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chargrams as C
from ..operators import vectorize as V
from ..operators import vocab as VO
from ..sources.fixtures import table
from . import query
from .text import s_tokens

TK = s_tokens("lower(text)")
DOCS_TK = f"SELECT doc_id, {TK} AS tk FROM documents"


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", X.tokens(F.lower("text")).alias("tk"), "text")


def _ids_str(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), " ")


@query("vc_doc_freq", f"""
SELECT word, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct(tk)) AS word FROM ({DOCS_TK})) GROUP BY word""")
def q_vc_doc_freq(spark, d):
    return VO.doc_freq(_docs(spark, d), "doc_id", "tk")


_POS = f"""tok AS (SELECT doc_id, unnest(tk) AS t, generate_subscripts(tk, 1) AS pos FROM ({DOCS_TK}))"""


@query("vc_drop_rare", f"""WITH {_POS},
v AS (SELECT t FROM (SELECT DISTINCT doc_id, t FROM tok) GROUP BY t HAVING count(*) >= 5),
k AS (SELECT doc_id, string_agg(t, ' ' ORDER BY pos) AS kept FROM tok SEMI JOIN v USING (t) GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.kept, '') AS kept FROM documents d LEFT JOIN k USING (doc_id)""")
def q_vc_drop_rare(spark, d):
    r = VO.drop_rare(_docs(spark, d), "doc_id", "tk", 5, "kept")
    return r.select("doc_id", F.array_join("kept", " ").alias("kept"))


_VOCAB_SQL = f"""vocab AS (SELECT word, idx FROM (SELECT word, row_number() OVER (ORDER BY cnt DESC, word) AS idx
          FROM (SELECT t AS word, count(*) AS cnt FROM (SELECT unnest(tk) AS t FROM ({DOCS_TK})) GROUP BY t)) WHERE idx < 2000)"""


@query("vc_index", f"WITH {_VOCAB_SQL} SELECT * FROM vocab")
def q_vc_index(spark, d):
    return VO.build_vocab(_docs(spark, d), "tk", max_size=2000)


@query("vc_index_insertion", f"""
WITH v AS (SELECT t AS word FROM (SELECT DISTINCT doc_id, t FROM (SELECT doc_id, unnest(tk) AS t FROM ({DOCS_TK}))) GROUP BY t HAVING count(*) >= 5)
SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM v""")
def q_vc_index_insertion(spark, d):
    words = VO.doc_freq(_docs(spark, d), "doc_id", "tk").where(F.col("df") >= 5).select("word")
    return VO.build_vocab_sorted(words, start=0)


_ENC_SQL = f"""WITH {_VOCAB_SQL}, {_POS},
e AS (SELECT doc_id, list(idx ORDER BY pos) AS ids FROM tok JOIN vocab ON tok.t = vocab.word GROUP BY doc_id),
enc AS (SELECT d.doc_id, coalesce(e.ids, []) AS ids FROM documents d LEFT JOIN e USING (doc_id))"""


def _encoded(spark, d, n, last=False):
    docs = _docs(spark, d)
    return VO.encode(docs, "doc_id", "tk", VO.build_vocab(docs, "tk", max_size=2000), n, last=last)


@query("sq_encode", _ENC_SQL + """
SELECT doc_id, array_to_string(list_slice(ids, 1, 40), ' ') AS ids FROM enc""")
def q_sq_encode(spark, d):
    return _encoded(spark, d, 40).select("doc_id", _ids_str(F.col("ids")).alias("ids"))


@query("sq_pad_pre", _ENC_SQL + """
SELECT doc_id, array_to_string(list_concat(list_resize([]::BIGINT[], greatest(100 - len(ids), 0), 0),
       CASE WHEN len(ids) > 100 THEN list_slice(ids, len(ids) - 99, len(ids)) ELSE ids END), ' ') AS padded FROM enc""")
def q_sq_pad_pre(spark, d):
    return _encoded(spark, d, 100, last=True).select("doc_id", _ids_str(VO.pad("ids", 100, "pre")).alias("padded"))


@query("sq_pad_post", _ENC_SQL + """
SELECT doc_id, array_to_string(list_concat(list_slice(ids, 1, 100), list_resize([]::BIGINT[], greatest(100 - len(ids), 0), 0)), ' ') AS padded FROM enc""")
def q_sq_pad_post(spark, d):
    return _encoded(spark, d, 100).select("doc_id", _ids_str(VO.pad("ids", 100, "post")).alias("padded"))


def _vocab_sql(terms_sql, min_df, max_features):
    top = (f"QUALIFY row_number() OVER (ORDER BY tf DESC, term) <= {max_features}" if max_features else "")
    return f"""x AS (SELECT doc_id, unnest(terms) AS term FROM ({terms_sql})),
st AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf FROM x GROUP BY term HAVING count(DISTINCT doc_id) >= {min_df} {top}),
voc AS (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS term_id FROM st)"""


_STOP_LIST = "['the', 'a', 'an', 'and', 'of', 'to', 'in', 'is', 'it']"
_CB_TERMS = f"SELECT doc_id, list_filter(tk, lambda t: NOT list_contains({_STOP_LIST}, t)) AS terms FROM ({DOCS_TK})"


@query("vz_count_binary", f"""WITH {_vocab_sql(_CB_TERMS, 10, 2500)}
SELECT DISTINCT x.doc_id, x.term, voc.term_id, CAST(1 AS BIGINT) AS value FROM x JOIN voc USING (term)""")
def q_vz_count_binary(spark, d):
    stop = ["the", "a", "an", "and", "of", "to", "in", "is", "it"]
    docs = _docs(spark, d).withColumn("terms", F.filter("tk", lambda t: ~t.isin(stop)))
    voc = V.select_vocab(docs, "doc_id", F.col("terms"), 10, 2500)
    return V.count_long(docs, "doc_id", F.col("terms"), voc, binary=True)


def _ngram_sql(n):
    return (f"CASE WHEN len(tk) >= {n} THEN list_transform(range(1, len(tk) - {n} + 2), "
            f"lambda i: array_to_string(list_slice(tk, i, i + {n - 1}), ' ')) ELSE [] END")


_NG_TERMS = f"SELECT doc_id, list_concat({_ngram_sql(2)}, {_ngram_sql(3)}) AS terms FROM ({DOCS_TK})"


@query("vz_count_ngram", f"""WITH {_vocab_sql(_NG_TERMS, 25, 30)}
SELECT DISTINCT x.doc_id, x.term, voc.term_id, CAST(1 AS BIGINT) AS value FROM x JOIN voc USING (term)""")
def q_vz_count_ngram(spark, d):
    docs = _docs(spark, d).withColumn("terms", V.ngram_range(F.col("tk"), 2, 3))
    voc = V.select_vocab(docs, "doc_id", F.col("terms"), 25, 30)
    return V.count_long(docs, "doc_id", F.col("terms"), voc, binary=True)


def _char_sql(n):
    return (f"CASE WHEN length(t) >= {n} THEN list_transform(range(1, length(t) - {n} + 2), "
            f"lambda i: substr(t, i, {n})) ELSE [] END")


_CH_TERMS = ("SELECT doc_id, list_concat(" + ", ".join(_char_sql(n) for n in range(1, 7)) + ") AS terms "
             "FROM (SELECT doc_id, lower(text) AS t FROM documents)")


@query("vz_char_ngram", f"""WITH {_vocab_sql(_CH_TERMS, 5, 200_000)},
c AS (SELECT DISTINCT x.doc_id, x.term, voc.term_id FROM x JOIN voc USING (term))
SELECT d.doc_id, count(c.term) AS n_grams, coalesce(sum(c.term_id), 0)::BIGINT AS id_sum
FROM documents d LEFT JOIN c USING (doc_id) GROUP BY d.doc_id""")
def q_vz_char_ngram(spark, d):
    """Binary character 1- to 6-grams against a vocabulary of 200,000; per document their number and id sum."""
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("t"))
    voc = V.vocab_from_stats(C.char_term_stats(docs, "doc_id", "t", 1, 6), 5, 200_000).checkpoint()
    kept = C.char_hits(docs, "doc_id", "t", 1, 6, voc)
    n = kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_grams"), F.sum("term_id").alias("id_sum"))
    return docs.select("doc_id").join(n, "doc_id", "left").fillna(0, ["n_grams", "id_sum"])


_TF_TERMS = f"SELECT doc_id, tk AS terms FROM ({DOCS_TK})"


@query("vz_tfidf", f"""WITH {_vocab_sql(_TF_TERMS, 2, 5000)},
n AS (SELECT count(*) AS n FROM documents),
c AS (SELECT x.doc_id, x.term, voc.term_id, count(*) AS value, any_value(voc.df) AS df FROM x JOIN voc USING (term) GROUP BY 1, 2, 3),
w AS (SELECT doc_id, term, term_id, value * (ln((1 + n.n) / (1 + df)) + 1) AS weight FROM c, n)
SELECT doc_id, term, term_id, weight / nullif(sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 0) AS weight FROM w""")
def q_vz_tfidf(spark, d):
    return V.tfidf_long(_docs(spark, d), "doc_id", F.col("tk"), min_df=2, max_features=5000)


def _tfidf_variant(name, lo, hi, min_df, max_features, binary, stop):
    """Register TF-IDF of word ``lo``- to ``hi``-grams, with its SQL."""
    grams = ", ".join(_ngram_sql(n) for n in range(lo, hi + 1))
    base = f"SELECT doc_id, list_filter(tk, lambda t: NOT list_contains({_STOP_LIST}, t)) AS tk FROM ({DOCS_TK})" if stop else DOCS_TK
    terms = f"SELECT doc_id, {f'list_concat({grams})' if hi > lo else grams} AS terms FROM ({base})"
    sql = f"""WITH {_vocab_sql(terms, min_df, max_features)},
n AS (SELECT count(*) AS n FROM documents),
c AS (SELECT x.doc_id, x.term, voc.term_id, {1 if binary else 'count(*)'} AS value, any_value(voc.df) AS df FROM x JOIN voc USING (term) GROUP BY 1, 2, 3),
w AS (SELECT doc_id, term, term_id, value * (ln((1 + n.n) / (1 + df)) + 1) AS weight FROM c, n)
SELECT doc_id, term, term_id, weight / nullif(sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 0) AS weight FROM w"""

    @query(name, sql)
    def run(spark, d):
        docs = _docs(spark, d)
        if stop:
            docs = docs.withColumn("tk", F.filter("tk", lambda t: ~t.isin(["the", "a", "an", "and", "of", "to", "in", "is", "it"])))
        return V.tfidf_grams(docs, "doc_id", "tk", lo, hi, min_df, max_features, binary=binary)


_tfidf_variant("vz_tfidf_words", 1, 1, 5, 100_000, False, False)
_tfidf_variant("vz_tfidf_bigrams", 1, 2, 10, 15_000, False, True)
_tfidf_variant("vz_tfidf_binary", 1, 4, 5, 200_000, True, True)


def _bag_sql(terms, min_df, max_features, tfidf=False):
    """(rows, width) of a text block."""
    voc = _vocab_sql(terms, min_df, max_features)
    if tfidf:
        rows = f"""WITH {voc}, n AS (SELECT count(*) AS n FROM documents),
c AS (SELECT x.doc_id, voc.term_id, count(*) * (ln((1 + any_value(n.n)) / (1 + any_value(voc.df))) + 1) AS w FROM x JOIN voc USING (term), n GROUP BY 1, 2)
SELECT doc_id, term_id AS i, w / nullif(sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 0) AS v FROM c"""
    else:
        rows = f"WITH {voc} SELECT DISTINCT x.doc_id, voc.term_id AS i, 1.0::DOUBLE AS v FROM x JOIN voc USING (term)"
    return rows, f"SELECT count(*) FROM (WITH {voc} SELECT * FROM voc)"


_HEAD_TERMS = f"SELECT doc_id, list_filter(list_slice(tk, 1, 12), lambda t: NOT list_contains({_STOP_LIST}, t)) AS terms FROM ({DOCS_TK})"
_UNI_BI = f"SELECT doc_id, list_concat({_ngram_sql(1)}, {_ngram_sql(2)}) AS terms FROM (SELECT doc_id, list_filter(tk, lambda t: NOT list_contains({_STOP_LIST}, t)) AS tk FROM ({DOCS_TK}))"
_PARAMS = f"SELECT doc_id, list_concat({_ngram_sql(2)}, {_ngram_sql(3)}) AS terms FROM (SELECT doc_id, [lang, source] || list_slice({TK}, 1, 2) AS tk FROM documents)"
_BUCKET = "('0x' || substr(md5('{c}=' || coalesce(CAST({c} AS VARCHAR), 'nan')), 1, 8))::BIGINT % 3000"


def _union_sql():
    blocks = [("SELECT doc_id, unnest([0, 1]) AS i, unnest([length(text), n_chars])::DOUBLE AS v FROM documents", "SELECT 2"),
              (f"SELECT doc_id, unnest([{_BUCKET.format(c='source')}, {_BUCKET.format(c='lang')}]) AS i, 1.0::DOUBLE AS v FROM documents", "SELECT 3000"),
              ("SELECT doc_id, k - 1 AS i, 1.0::DOUBLE AS v FROM documents JOIN (SELECT lang, row_number() OVER (ORDER BY lang) AS k FROM (SELECT DISTINCT lang FROM documents)) USING (lang)",
               "SELECT count(DISTINCT lang) FROM documents"),
              _bag_sql(_HEAD_TERMS, 10, 2500), _bag_sql(_UNI_BI, 10, 15000, True), _bag_sql(_PARAMS, 25, 30)]
    ctes = ", ".join(f"b{k} AS ({rows}), w{k} AS (SELECT ({width}) AS w)" for k, (rows, width) in enumerate(blocks))
    off = lambda k: " + ".join(["0", *[f"(SELECT w FROM w{j})" for j in range(k)]])
    union = " UNION ALL ".join(f"SELECT doc_id, i + {off(k)} AS i, v FROM b{k}" for k in range(len(blocks)))
    return f"""WITH {ctes}, u AS ({union})
SELECT doc_id, ({off(len(blocks))})::BIGINT AS size, i::BIGINT AS index, sum(v) AS value FROM u GROUP BY doc_id, i HAVING sum(v) <> 0"""


@query("vz_union", _union_sql())
def q_vz_union(spark, d):
    """Two numbers, 3,000 hash buckets, a one-hot and three text blocks in one sparse vector per document, given out cell by cell."""
    docs = table(spark, d, "documents").select("doc_id", X.tokens(F.lower("text")).alias("tk"), "text", "lang", "source", "n_chars")
    plain = F.filter("tk", lambda t: ~t.isin(["the", "a", "an", "and", "of", "to", "in", "is", "it"]))
    head = F.filter(F.slice("tk", 1, 12), lambda t: ~t.isin(["the", "a", "an", "and", "of", "to", "in", "is", "it"]))
    params = F.concat(F.array("lang", "source"), F.slice("tk", 1, 2))
    blocks = [V.dense_block(docs.withColumn("n_text", F.length("text")), "doc_id", ["n_text", "n_chars"]), V.hash_block(docs, "doc_id", ["source", "lang"], 3000),
              V.one_hot_block(docs, "doc_id", "lang"), V.text_block(docs, "doc_id", head, "head", 10, 2500),
              V.gram_block(docs.withColumn("plain", plain), "doc_id", "plain", 1, 2, "body", 10, 15000, tfidf=True),
              V.text_block(docs.withColumn("params", params), "doc_id", V.ngram_range(F.col("params"), 2, 3), "params", 25, 30)]
    v = V.sparse_union(blocks, "doc_id")
    return v.select("doc_id", "size", F.explode(F.arrays_zip("indices", "values")).alias("x")).select("doc_id", "size", F.col("x.indices").alias("index"), F.col("x.values").alias("value"))


@query("nm_log1p_scale", """
WITH t AS (SELECT doc_id, ln(1 + CAST(length(text) AS DOUBLE)) AS a, ln(1 + CAST(n_chars AS DOUBLE)) AS b FROM documents),
s AS (SELECT avg(a) ma, stddev_pop(a) sa, avg(b) mb, stddev_pop(b) sb FROM t)
SELECT doc_id, coalesce((a - ma) / nullif(sa, 0), 0) AS n_len, coalesce((b - mb) / nullif(sb, 0), 0) AS n_chars FROM t, s""")
def q_nm_log1p_scale(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.length("text").alias("n_len"), "n_chars")
    return V.scale(t, ["n_len", "n_chars"], log1p=True)


@query("nm_scale", """
WITH s AS (SELECT avg(c_acctbal) m, stddev_pop(c_acctbal) sd FROM customer)
SELECT c_custkey, coalesce((c_acctbal - m) / nullif(sd, 0), 0) AS c_acctbal FROM customer, s""")
def q_nm_scale(spark, d):
    return V.scale(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
