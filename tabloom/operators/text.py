"""DataFrame-level text operators.

Scalar features and cleaners are native column expressions
(``tabloom.functions.text``), evaluated inside whole-stage codegen; no Python
UDF runs on the data path.  Token normalisation against a dictionary is a
join (the lemmatiser/stemmer of the reference re-aimed as a table lookup).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import ensure_checkpoint_dir
from ..sources.io import stage
from .lookup import constant_map, replace_tokens


def english_stopwords() -> list[str]:
    """MLlib's default English stop-word list (the list is a parameter everywhere)."""
    from pyspark.ml.feature import StopWordsRemover
    return list(StopWordsRemover.loadDefaultStopWords("english"))


def text_features(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """Length / word / ratio / longest-word features of one text column."""
    c = F.col(col)
    return df.withColumns({
        f"{prefix}n_chars": X.text_len(c), f"{prefix}n_pieces": X.n_pieces(c),
        f"{prefix}n_words": X.n_words(c), f"{prefix}n_unique": X.n_unique(c),
        f"{prefix}unique_ratio": X.unique_ratio(c), f"{prefix}longest_word": X.longest_word(c)})


def char_features(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """Character-class counts and flags of one text column."""
    c = F.col(col)
    return df.withColumns({
        f"{prefix}n_digits": X.n_digits(c), f"{prefix}has_digits": X.has_digits(c),
        f"{prefix}n_upper": X.n_upper(c), f"{prefix}n_caps": X.n_caps(c),
        f"{prefix}n_nonword": X.n_nonword(c), f"{prefix}n_word_chars": X.n_word_chars(c),
        f"{prefix}has_special": X.has_special(c), f"{prefix}n_punct": X.n_punct(c),
        f"{prefix}n_newlines": X.n_newlines(c)})


def first_word_flags(df: DataFrame, col: str, words: Sequence[str] = X.FIRST_WORDS) -> DataFrame:
    return df.withColumns(X.first_word_flags(F.col(col), words))


def clean(df: DataFrame, col: str, steps, out: str | None = None) -> DataFrame:
    """Apply a cleaner (list of steps from ``functions.text``) to ``col``."""
    return df.withColumn(out or col, X.apply_steps(F.col(col), steps))


def clean_full(df, col, stop, out=None, *, lemmas: DataFrame | None, id_col: str | None = None):
    """Composed cleaner; the tokens that stop words leave are normalised with ``lemmas`` (form, lemma).

    The lemma step belongs to the cleaner: only who says ``lemmas=None`` does without it.
    """
    if lemmas is None:
        return clean(df, col, X.full_steps(stop), out)
    steps = X.full_steps(stop)
    i = [s for s, _ in steps].index("stopwords") + 1
    tmp = clean(df, col, steps[:i], "_pre")
    tmp = normalize_tokens(tmp, id_col, "_pre", lemmas, out="_pre")
    return clean(tmp, "_pre", steps[i:], out or col).drop("_pre") if (out or col) != "_pre" else tmp


def clean_masked(df, col, stop, max_words=60, out=None, keep_mask=True):
    return clean(df, col, X.masked_steps(stop, max_words, keep_mask), out)


def clean_letters(df, col, max_words=50, out=None):
    return clean(df, col, X.letters_steps(max_words), out)


def clean_corpus(df, col, out=None):
    return clean(df, col, X.corpus_steps(), out)


def clean_cyr(df, col, max_words=100, out=None):
    return clean(df, col, X.cyr_steps(max_words), out)


def normalize_tokens(df: DataFrame, id_col: str, col: str, dictionary: DataFrame, form: str = "form",
                     lemma: str = "lemma", out: str | None = None) -> DataFrame:
    """Replace each token by its dictionary lemma (unknown tokens unchanged).

    A dictionary within the bounds of ``lookup`` replaces tokens inside the
    row.  With a larger one (one lemma per form) the commonest words of the texts
    are replaced inside the row, and only the others are joined.  Rows with no
    tokens keep ''.
    """
    out = out or col
    ensure_checkpoint_dir(df.sparkSession)
    d = dictionary.select(F.col(form).alias("_tok"), F.col(lemma).alias("_lem")).checkpoint()
    look = constant_map(d, "_tok", "_lem", "string")
    if look:
        return df.withColumn(out, F.array_join(F.transform(X.tokens(F.col(col)), lambda t: F.coalesce(look(t), t)), " "))
    # the text may be the end of a long cleaner, and is read twice
    df = stage(df.withColumn("_t", X.tokens(F.col(col))), "tokens")
    n = df.select(F.explode("_t").alias("_tok")).groupBy("_tok").agg(F.count(F.lit(1)).alias("_n"))
    every = n.join(d.groupBy("_tok").agg(F.min("_lem").alias("_lem")), "_tok", "left").select("_tok", "_n", F.coalesce("_lem", "_tok").alias("_w")).checkpoint()
    return replace_tokens(df, "_t", every, "_tok", "_w", "_n", "_words").withColumn(out, F.array_join("_words", " ")).drop("_t", "_words")


def write_corpus(df: DataFrame, col: str, path: str, mode: str = "overwrite") -> None:
    """One cleaned text per line (a directory of part files)."""
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)
