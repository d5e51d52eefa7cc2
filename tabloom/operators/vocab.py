"""Vocabulary, document frequency and integer sequences.

Vocabularies are DataFrames.  Bounded ones are searched inside the row
(``lookup``).  Where tokens meet a larger table they are exploded, joined and
put together again per document, so a group is one document's tokens.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import bound
from ..session import ensure_checkpoint_dir
from .lookup import constant_map, first_known, known, replace_tokens, split_join
from .ranking import row_number_by, top_by_count


def doc_freq(df: DataFrame, id_col: str, tokens: Column | str, word: str = "word", out: str = "df") -> DataFrame:
    """Documents per word."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return (df.select(id_col, F.explode(F.array_distinct(t)).alias(word))
              .groupBy(word).agg(F.count(F.lit(1)).alias(out)))


def term_freq(df: DataFrame, tokens: Column | str, word: str = "word", out: str = "count") -> DataFrame:
    """Corpus occurrences per word."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return df.select(F.explode(t).alias(word)).groupBy(word).agg(F.count(F.lit(1)).alias(out))


def build_vocab(df: DataFrame, tokens: Column | str, max_size: int | None = None, start: int = 1,
                word: str = "word", idx: str = "idx") -> DataFrame:
    """word → id by corpus frequency (count desc, word asc), ids from ``start``;
    words whose id would reach ``max_size`` are left out (Keras ``num_words``)."""
    tf = term_freq(df, tokens, word, "_cnt")
    if max_size:
        r = top_by_count(tf, "_cnt", [word], max(max_size - start, 0), out=idx)
    else:
        r = row_number_by(tf, None, [F.col("_cnt").desc(), F.col(word)], out=idx)
    return r.select(word, (F.col(idx) + (start - 1)).alias(idx))


def build_vocab_sorted(vocab_words: DataFrame, word: str = "word", idx: str = "idx", start: int = 0) -> DataFrame:
    """Dense ids start.. over a word list, in word order."""
    r = row_number_by(vocab_words.select(word).distinct(), None, [word], out=idx)
    return r.withColumn(idx, F.col(idx) + (start - 1))


def _explode_pos(df: DataFrame, id_col: str, tokens: Column | str):
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return df.select(id_col, F.posexplode(t).alias("_pos", "_tok"))


def _reassemble(df: DataFrame, j: DataFrame, id_col: str, value: str, out: str, empty) -> DataFrame:
    back = (j.groupBy(id_col)
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", value))), lambda s: s[value]).alias(out)))
    return df.select(id_col).join(back, id_col, "left").withColumn(out, F.coalesce(F.col(out), empty))


def drop_rare(df: DataFrame, id_col: str, tokens: Column | str, min_df: int = 5, out: str = "kept") -> DataFrame:
    """Tokens with document frequency ≥ min_df, in their original order (array).

    A vocabulary within the bounds of ``lookup`` filters inside the row; of a
    larger one its commonest words do, and only other tokens are joined.
    """
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    ensure_checkpoint_dir(df.sparkSession)
    vocab = doc_freq(df, id_col, t, "_tok").where(F.col("df") >= min_df).select("_tok", "df").checkpoint()
    look = constant_map(vocab, "_tok", "df")
    if look:
        return df.select(id_col, F.filter(t, lambda w: look(w).isNotNull()).alias(out))
    d = df.select(id_col, t.alias("_t"))
    r = replace_tokens(d, "_t", vocab.withColumn("_kept", F.col("_tok")), "_tok", "_kept", "df", "_k")
    return r.select(id_col, F.coalesce("_k", F.array().cast("array<string>")).alias(out))


def encode(df: DataFrame, id_col: str, tokens: Column | str, vocab: DataFrame, max_len: int | None = None,
           word: str = "word", idx: str = "idx", out: str = "ids", last: bool = False) -> DataFrame:
    """Token list → id list; unknown tokens dropped; the first (``last``: the last) ``max_len`` ids kept.

    A vocabulary within the bounds of ``lookup`` is searched inside the row,
    which ends early once ``max_len`` ids are found.  A larger one is joined.
    """
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    ensure_checkpoint_dir(df.sparkSession)
    vocab = vocab.checkpoint()
    look = constant_map(vocab, word, idx)
    if look:
        return df.select(id_col, (first_known(t, look, max_len, last) if max_len else bound(t, lambda x: known(x, look))).alias(out))
    v = vocab.select(F.col(word).alias("_tok"), F.col(idx).cast("long").alias("_id"))
    r = _reassemble(df, split_join(_explode_pos(df, id_col, t), v, "_tok", "inner"), id_col, "_id", out, F.array().cast("array<bigint>"))
    if max_len:
        r = r.withColumn(out, F.slice(out, F.greatest(F.size(out) - max_len, F.lit(0)) + 1, max_len) if last else F.slice(out, 1, max_len))
    return r


def pad(c: Column | str, n: int, side: str = "pre", value: int = 0) -> Column:
    """Fixed length ``n``: 'pre' keeps the last n and left-pads, 'post' keeps the first n and right-pads."""
    x = F.col(c) if isinstance(c, str) else c
    size = F.size(x)
    fill = F.array_repeat(F.lit(value).cast("long"), F.greatest(F.lit(n) - size, F.lit(0)))
    xs = x.cast("array<long>")
    if side == "pre":
        last = F.when(size > n, F.slice(xs, size - n + 1, n)).otherwise(xs)
        return F.concat(fill, last)
    first = F.slice(xs, 1, n)
    return F.concat(first, fill)
