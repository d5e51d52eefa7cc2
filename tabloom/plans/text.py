"""Text feature and cleaning queries — SURVEY §2.9, §2.10.

Input: ``documents`` (doc_id, text); the title is the first line.  Oracles
use the same character classes as the Spark expressions; look-around-free
forms are used where the SQL regex engine lacks them.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import text as TO
from ..sources.fixtures import table
from . import query

# Stop words used by the registered cleaning queries (the
# library default is MLlib's English list; the list is a parameter).
STOP = ("the", "a", "an", "and", "of", "to", "in", "is", "it", "that", "on", "for", "as", "with",
        "by", "at", "be", "this", "are", "or", "de", "la", "le", "et", "el", "en", "und", "der", "die")
FIRST = X.FIRST_WORDS + ("The", "And", "In")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


# ------------------------------------------------------------------ SQL forms of the steps
def s_count(x, pat):
    return f"len(regexp_extract_all({x}, {q(pat)}))"


def s_tokens(x):
    return f"list_filter(regexp_split_to_array({x}, {q('[' + X.WS + ']+')}), lambda t: t <> '')"


def s_rr(x, pat, rep):
    return f"regexp_replace({x}, {q(pat)}, {q(rep)}, 'g')"


def _java_to_re2(rep: str) -> str:
    return rep.replace("$1", "\\1").replace("$2", "\\2")


def s_step(x, step, arg):
    if step == "truncate":
        return f"array_to_string(list_slice({s_tokens(x)}, 1, {arg}), ' ')"
    if step == "normalize_ws":
        return f"array_to_string({s_tokens(x)}, ' ')"
    if step == "contractions":
        for pat, rep in X.CONTRACTIONS:
            x = s_rr(x, pat, _java_to_re2(rep))
        return x
    if step == "lower":
        return f"lower({x})"
    if step == "masks":
        for pat, rep in X.MASKS:
            x = s_rr(x, pat, rep)
        return x
    if step in ("split_digit_word", "split_word_digit"):
        a, b = (f"{X.DIGIT}+", "[a-z]+") if step == "split_digit_word" else ("[a-z]+", f"{X.DIGIT}+")
        pat = f"([^{X.WORD}])({a})({b})([^{X.WORD}])"
        p = f"(' ' || {x} || ' ')"
        r = s_rr(s_rr(p, pat, "\\1\\2 \\3\\4"), pat, "\\1\\2 \\3\\4")
        return f"substr({r}, 2, length({r}) - 2)"
    if step == "strip_nonword":
        return s_rr(x, f"[^{X.WORD}{X.WS}{arg or ''}]", "")
    if step == "stopwords":
        lst = "[" + ", ".join(q(w) for w in arg) + "]"
        return f"array_to_string(list_filter({s_tokens(x)}, lambda t: NOT list_contains({lst}, t)), ' ')"
    if step == "ascii_only":
        return s_rr(x, f"[^A-Za-z0-9{arg or ''}]+", " ")
    if step == "digit_runs":
        return s_rr(x, f"({X.DIGIT}+)", " \\1 ")
    if step == "collapse":
        return s_rr(s_rr(x, f"[{X.WS}]+", " "), "^ | $", "")
    if step == "punct":
        return s_rr(x, f"[{X.PUNCT}]", arg)
    if step == "digits":
        return s_rr(x, "[0-9]+", arg)
    if step == "literals":
        for a, b in arg:
            x = f"replace({x}, {q(a)}, {q(b)})"
        return x
    if step == "remove":
        return s_rr(x, arg, "")
    if step == "ws_to_blank":
        return s_rr(x, f"[{X.WS}]+", " ")
    raise ValueError(step)


def s_clean_ctes(steps, src="SELECT doc_id, text AS x FROM documents"):
    """CTE chain, one step per CTE (keeps the SQL linear in the number of steps)."""
    ctes = [f"c0 AS ({src})"]
    for i, (st, arg) in enumerate(steps, 1):
        ctes.append(f"c{i} AS (SELECT doc_id, {s_step('x', st, arg)} AS x FROM c{i - 1})")
    return "WITH " + ",\n".join(ctes), f"c{len(steps)}"


def clean_sql(steps, out="clean"):
    w, last = s_clean_ctes(steps)
    return f"{w}\nSELECT doc_id, x AS {out} FROM {last}"


# ------------------------------------------------------------------ §2.9 scalar features
def _feature(name, out, spark_expr, sql_expr):
    def fn(spark, d):
        return _docs(spark, d).select("doc_id", spark_expr(F.col("text")).alias(out))
    fn.__name__ = f"q_{name}"
    query(name, f"SELECT doc_id, {sql_expr('text')} AS {out} FROM documents")(fn)


_feature("tx_len", "n_chars", X.text_len, lambda x: f"length({x})")
_feature("tx_words_space", "n_pieces", X.n_pieces, lambda x: f"len(string_split({x}, ' '))")
_feature("tx_words", "n_words", X.n_words, lambda x: f"len({s_tokens(x)})")
_feature("tx_unique_words", "n_unique", X.n_unique, lambda x: f"len(list_distinct({s_tokens(x)}))")
_feature("tx_unique_ratio", "unique_ratio", X.unique_ratio,
         lambda x: f"CAST(len(list_distinct({s_tokens(x)})) AS DOUBLE) / nullif(len({s_tokens(x)}), 0) * 100")
_feature("tx_max_word", "longest_word", X.longest_word,
         lambda x: f"CASE WHEN length({x}) > 1 THEN list_max(list_transform(string_split({x}, ' '), lambda w: length(w))) ELSE 0 END")
_feature("tx_digits", "n_digits", X.n_digits, lambda x: s_count(x, X.DIGIT))
_feature("tx_has_digits", "has_digits", X.has_digits, lambda x: f"CAST({s_count(x, X.DIGIT)} > 1 AS INT)")
_feature("tx_upper", "n_upper", X.n_upper, lambda x: s_count(x, r"\p{Lu}"))
_feature("tx_caps_latin_cyr", "n_caps", X.n_caps, lambda x: s_count(x, "[A-ZА-Я]"))
_feature("tx_caps_cyr", "n_caps_cyr", lambda c: X.n_caps(c, "cyr"), lambda x: s_count(x, "[А-Я]"))
_feature("tx_nonword", "n_nonword", X.n_nonword, lambda x: s_count(x, f"[^{X.WORD}]"))
_feature("tx_word_chars", "n_word_chars", X.n_word_chars, lambda x: s_count(x, f"[{X.WORD}]"))
_SPECIAL = "".join("\\" + ch if ch in "\\]^-[" else ch for ch in X.PUNCT_CHARS + " ")
_feature("tx_special_flag", "has_special", X.has_special,
         lambda x: f"CAST(regexp_matches({x}, {q('[' + _SPECIAL + ']')}) AS INT)")
_feature("tx_punct", "n_punct", X.n_punct, lambda x: s_count(x, f"[{X.PUNCT}]"))
_feature("tx_newlines", "n_newlines", X.n_newlines, lambda x: s_count(x, f"[{X.WS_NOT_BLANK}]"))
_feature("tx_bad_start_flag", "bad_start", lambda c: X.pattern_flag(c, "r[^a-я0-9]", 2),
         lambda x: f"CAST({s_count(x, 'r[^a-я0-9]')} > 2 AS INT)")
_feature("tx_foreign_flag", "has_latin", X.has_latin_run,
         lambda x: f"CAST(regexp_matches({x}, '[a-zA-Z]{{2,15}}') AS INT)")
_feature("tx_foreign_words", "latin_runs", X.latin_runs,
         lambda x: f"array_to_string(regexp_extract_all({x}, '[a-zA-Z0-9]{{2,15}}'), ' ')")


@query("tx_first_word", "SELECT doc_id, " + ", ".join(
    f"CAST(coalesce({s_tokens('text')}[1] = {q(w)}, false) AS INT) AS \"{w}\"" for w in FIRST) + " FROM documents")
def q_tx_first_word(spark, d):
    return TO.first_word_flags(_docs(spark, d), "text", FIRST).drop("text")


_FULL_W, _FULL_LAST = s_clean_ctes(X.full_steps(STOP))


@query("tx_postclean_ratio", f"""{_FULL_W}
SELECT d.doc_id, CAST(len(list_distinct({s_tokens(f'{_FULL_LAST}.x')})) AS DOUBLE)
                 / nullif(len(list_distinct({s_tokens('d.text')})), 0) * 100 AS postclean_ratio
FROM documents d JOIN {_FULL_LAST} USING (doc_id)""")
def q_tx_postclean_ratio(spark, d):
    t = TO.clean_full(_docs(spark, d), "text", STOP, out="clean", lemmas=None)
    return t.select("doc_id", X.postclean_ratio(F.col("text"), F.col("clean")).alias("postclean_ratio"))


_MASK_W, _MASK_LAST = s_clean_ctes(X.masked_steps(STOP, None))


@query("tx_clean_len", f"{_MASK_W}\nSELECT doc_id, len(string_split(x, ' ')) AS clean_len FROM {_MASK_LAST}")
def q_tx_clean_len(spark, d):
    t = TO.clean_masked(_docs(spark, d), "text", STOP, max_words=None, out="clean")
    return t.select("doc_id", X.n_pieces(F.col("clean")).alias("clean_len"))


# ------------------------------------------------------------------ §2.10 cleaning
def _cleaner(name, steps):
    def fn(spark, d):
        return TO.clean(_docs(spark, d), "text", steps, "clean").select("doc_id", "clean")
    fn.__name__ = f"q_{name}"
    query(name, clean_sql(steps))(fn)


_cleaner("cl_truncate_words", [("truncate", 50)])
_cleaner("cl_contractions", [("lower", None), ("contractions", None)])
_cleaner("cl_mask_numbers", [("masks", None)])
_cleaner("cl_strip_punct", [("punct", " ")])
_cleaner("cl_split_alnum", [("lower", None), ("split_digit_word", None), ("split_word_digit", None)])
_cleaner("cl_drop_digits", [("digits", " #")])
_cleaner("cl_non_ascii", [("ascii_only", None)])
_cleaner("cl_collapse_ws", [("collapse", None)])
_cleaner("cl_stopwords", [("lower", None), ("stopwords", list(STOP))])
_cleaner("cl_profile_masked", X.masked_steps(STOP, 60))
_cleaner("cl_profile_letters", X.letters_steps(50))
_cleaner("cl_profile_corpus", X.corpus_steps())
_cleaner("cl_profile_cyr", X.cyr_steps(100))

# Lemma dictionary derived from the corpus: a lower-cased word ending in "s"
# whose form without the "s" is also a word of the corpus maps to that form.
_LEMMA_SQL = f"""
w AS (SELECT DISTINCT t AS w FROM (SELECT unnest({s_tokens('lower(text)')}) AS t FROM documents)),
lem AS (SELECT a.w AS form, b.w AS lemma FROM w a JOIN w b ON b.w = substr(a.w, 1, length(a.w) - 1)
        WHERE length(a.w) > 3 AND a.w LIKE '%s')"""


def lemma_table(docs):
    w = docs.select(F.explode(X.tokens(F.lower("text"))).alias("w")).distinct()
    a, b = w.alias("a"), w.alias("b")
    return (a.where((F.length("w") > 3) & F.col("w").endswith("s"))
            .join(b, F.col("b.w") == F.expr("substr(a.w, 1, length(a.w) - 1)"))
            .select(F.col("a.w").alias("form"), F.col("b.w").alias("lemma")))


@query("cl_lemma_join", f"""WITH {_LEMMA_SQL.strip()},
tok AS (SELECT doc_id, unnest(tk) AS t, generate_subscripts(tk, 1) AS pos
        FROM (SELECT doc_id, {s_tokens('lower(text)')} AS tk FROM documents)),
n AS (SELECT doc_id, string_agg(coalesce(lem.lemma, tok.t), ' ' ORDER BY pos) AS x
      FROM tok LEFT JOIN lem ON tok.t = lem.form GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.x, '') AS clean FROM documents d LEFT JOIN n USING (doc_id)""")
def q_cl_lemma_join(spark, d):
    docs = _docs(spark, d)
    low = docs.select("doc_id", F.lower("text").alias("text"))
    return TO.normalize_tokens(low, "doc_id", "text", lemma_table(docs), out="clean").select("doc_id", "clean")


_FULL = X.full_steps(STOP)
_CUT = [n for n, _ in _FULL].index("stopwords") + 1


@query("cl_profile_full", f"""WITH {_LEMMA_SQL.strip()},
pre AS (SELECT row_number() OVER () AS r, doc_id, clean FROM ({clean_sql(_FULL[:_CUT])})),
tok AS (SELECT r, unnest(tk) AS t, generate_subscripts(tk, 1) AS pos FROM (SELECT r, {s_tokens('clean')} AS tk FROM pre)),
n AS (SELECT r, string_agg(coalesce(lem.lemma, tok.t), ' ' ORDER BY pos) AS x FROM tok LEFT JOIN lem ON tok.t = lem.form GROUP BY r),
lemmas AS (SELECT pre.doc_id, CASE WHEN pre.clean IS NOT NULL THEN coalesce(n.x, '') END AS text FROM pre LEFT JOIN n USING (r))
SELECT doc_id, clean FROM ({clean_sql(_FULL[_CUT:]).replace("FROM documents", "FROM lemmas")})""")
def q_cl_profile_full(spark, d):
    """The whole cleaner, row by row: its lemma step stands between stop words and the last strips."""
    docs = _docs(spark, d)
    return TO.clean_full(docs, "text", STOP, out="clean", lemmas=lemma_table(docs), id_col="doc_id").select("doc_id", "clean")


@query("cl_profile_full_lemma", f"""WITH {_LEMMA_SQL.strip()},
pre AS ({clean_sql(_FULL[:_CUT])}),
tok AS (SELECT doc_id, unnest(tk) AS t, generate_subscripts(tk, 1) AS pos FROM (SELECT doc_id, {s_tokens('clean')} AS tk FROM pre)),
n AS (SELECT doc_id, string_agg(coalesce(lem.lemma, tok.t), ' ' ORDER BY pos) AS x FROM tok LEFT JOIN lem ON tok.t = lem.form GROUP BY doc_id),
lemmas AS (SELECT pre.doc_id, coalesce(n.x, '') AS text FROM pre LEFT JOIN n USING (doc_id))
SELECT doc_id, clean FROM ({clean_sql(_FULL[_CUT:]).replace("FROM documents", "FROM lemmas")})""")
def q_cl_profile_full_lemma(spark, d):
    """The whole cleaner with its lemma step between stop words and the last strips."""
    docs = _docs(spark, d)
    return TO.clean_full(docs, "text", STOP, out="clean", lemmas=lemma_table(docs), id_col="doc_id").select("doc_id", "clean")
