"""Count / n-gram / character n-gram / TF-IDF vectorisers and scaling.

Every vectoriser has a long form — (doc, term, value) rows — computed with
joins and aggregations, plus MLlib versions producing sparse vectors.  The
long form is what scales to 100 TB (no vocabulary on the driver); the MLlib
forms hold the vocabulary in each task and need a bounded ``vocab_size``.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import bound
from ..session import ensure_checkpoint_dir
from .joins import attach_row
from .lookup import constant_map, known
from .ranking import SMALL_TOP, numbered_small, row_number_by, top_by_count


def ngrams(tokens: Column, n: int) -> Column:
    """Word n-grams joined by ' ' (empty when fewer than n tokens).

    Built by zipping n shifted slices, so no lambda refers to ``tokens``:
    the optimizer may inline the token expression, and a reference inside a
    per-element lambda would re-tokenise the text once per element.
    """
    m = F.greatest(F.size(tokens) - n + 1, F.lit(0))
    acc = F.slice(tokens, 1, m)
    for k in range(2, n + 1):
        acc = F.zip_with(acc, F.slice(tokens, k, m), lambda a, b: F.concat(a, F.lit(" "), b))
    return acc


def ngram_range(tokens: Column, lo: int, hi: int) -> Column:
    return F.concat(*[ngrams(tokens, n) for n in range(lo, hi + 1)])


def _zip_grams(items: Column, n: int, sep: str) -> Column:
    m = F.greatest(F.size(items) - n + 1, F.lit(0))
    acc = F.slice(items, 1, m)
    for k in range(2, n + 1):
        acc = F.zip_with(acc, F.slice(items, k, m), lambda a, b: F.concat(a, F.lit(sep), b))
    return acc


def char_ngrams(text: Column, n: int) -> Column:
    """Character n-grams (empty for strings shorter than n).

    The text is split into characters once and n shifted slices are
    zipped: linear in the text length (position-based ``substring`` on a
    UTF-8 string rescans from the start and would be quadratic).
    """
    return _zip_grams(F.split(text, "", -1), n, "")


def char_ngram_range(text: Column, lo: int, hi: int) -> Column:
    return F.concat(*[char_ngrams(text, n) for n in range(lo, hi + 1)])


def char_ngram_rows(df: DataFrame, id_col: str, text: str, lo: int, hi: int) -> DataFrame:
    """Distinct (doc, gram) rows of character n-grams, lo ≤ n ≤ hi."""
    chars = df.select(id_col, F.split(F.col(text), "", -1).alias("_c"))
    out = chars.select(id_col, F.explode(F.concat(*[_zip_grams(F.col("_c"), n, "") for n in range(lo, hi + 1)]))
                       .alias("term"))
    return out.distinct()


def binary_doc_terms(pairs: DataFrame, id_col: str, min_df: int = 1) -> DataFrame:
    """Distinct (doc, term) pairs kept when the term occurs in ≥ min_df documents."""
    dfreq = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)
    return pairs.join(dfreq.select("term"), "term", "left_semi")


def doc_term_counts(df: DataFrame, id_col: str, terms: Column) -> DataFrame:
    """(doc, term, value): occurrences of each term in each document (map-side combined)."""
    return df.select(id_col, F.explode(terms).alias("term")).groupBy(id_col, "term") \
        .agg(F.count(F.lit(1)).alias("value"))


def vocab_from_counts(per_doc: DataFrame, min_df: int = 1, max_features: int | None = None) -> DataFrame:
    """(term, df, tf, term_id) from (doc, term, value) counts; see ``select_vocab``."""
    return _numbered(per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("value").alias("tf")), min_df, max_features)


def vocab_from_stats(stats: DataFrame, min_df: int = 1, max_features: int | None = None) -> DataFrame:
    """(term, df, tf, term_id) from (term, df, tf); see ``select_vocab``."""
    return _numbered(stats, min_df, max_features)


def _numbered(st: DataFrame, min_df: int, max_features: int | None) -> DataFrame:
    """The chosen rows of (term, df, tf) with their ``term_id``."""
    st = st.where(F.col("df") >= min_df)
    if max_features:
        st = top_by_count(st, "tf", ["term"], max_features, out="_rank").drop("_rank")
        if max_features <= SMALL_TOP:
            return numbered_small(st, ["term"], "term_id", start=0)
    st = row_number_by(st, None, ["term"], out="term_id")
    return st.withColumn("term_id", F.col("term_id") - 1)


def _first_flags(terms: Column) -> Column:
    """Structs (term, first) of a row's terms; ``first`` is 1 at one place of each distinct term, else 0."""
    def flags(s: Column) -> Column:
        return F.transform(s, lambda x, i: F.struct(x.alias("term"), ((i == 0) | ~x.eqNullSafe(F.get(s, i - 1))).cast("long").alias("first")))
    return bound(F.sort_array(terms), flags)


def term_stats(df: DataFrame, id_col: str, terms: Column) -> DataFrame:
    """(term, df, tf): documents and occurrences of each term.

    A document in one row counts its terms inside the row, so terms are
    shuffled once, combined before, and never together with their document.
    Rows that share their id with others are one document: theirs are counted
    per (document, term) first.
    """
    ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1).select(F.col(id_col).alias("_id")).checkpoint()
    one = lambda d: d.select(F.explode(_first_flags(terms)).alias("_t")).select("_t.term", F.col("_t.first").alias("_d"), F.lit(1).cast("long").alias("_v"))
    if ids.isEmpty():
        rows = one(df)
    else:
        shared = F.col(id_col).eqNullSafe(F.col("_id"))
        many = doc_term_counts(df.join(ids, shared, "left_semi"), id_col, terms)
        rows = one(df.join(ids, shared, "left_anti")).unionByName(many.select("term", F.lit(1).cast("long").alias("_d"), F.col("value").alias("_v")))
    return rows.groupBy("term").agg(F.sum("_d").alias("df"), F.sum("_v").alias("tf"))


def select_vocab(df: DataFrame, id_col: str, terms: Column, min_df: int = 1, max_features: int | None = None) -> DataFrame:
    """(term, df, tf, term_id): terms with df ≥ min_df; the ``max_features`` most
    frequent (corpus count desc, term asc); ids 0.. in term order.

    With ``max_features`` a histogram of the counts gives the cut-off count
    (``top_by_count``); what reaches it is numbered by range.  The vocabulary
    is a written table.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return _numbered(term_stats(df, id_col, terms), min_df, max_features).checkpoint()


def _hits(df: DataFrame, id_col: str, terms: Column, vocab: DataFrame) -> tuple[DataFrame, bool]:
    """(doc, term_id), a row per occurrence of a vocabulary term, and whether the vocabulary is bounded.

    A vocabulary (a written table) within the bounds of ``lookup`` is searched
    inside the row, so other terms never leave it; a larger one is joined.
    """
    look = constant_map(vocab, "term", "term_id")
    if look:
        return df.select(id_col, F.explode(known(terms, look)).alias("term_id")), True
    return df.select(id_col, F.explode(terms).alias("term")).join(vocab.select("term", "term_id"), "term").select(id_col, "term_id"), False


def _with_vocab(rows: DataFrame, vocab: DataFrame, small: bool) -> DataFrame:
    """Rows with the columns of ``vocab``, by ``term_id``; broadcast when it was measured to be small."""
    return rows.join(F.broadcast(vocab) if small else vocab, "term_id")


def count_long(df: DataFrame, id_col: str, terms: Column, vocab: DataFrame, binary: bool = True) -> DataFrame:
    """(doc, term, term_id, value) for vocabulary terms; binary → 1.  ``vocab`` should be a written table."""
    x, small = _hits(df, id_col, terms, vocab)
    agg = F.lit(1).cast("long") if binary else F.count(F.lit(1))
    x = x.groupBy(id_col, "term_id").agg(agg.alias("value"))
    return _with_vocab(x, vocab.select("term", "term_id"), small).select(id_col, "term", "term_id", "value")


def tfidf_long(df: DataFrame, id_col: str, terms: Column, min_df: int = 1, max_features: int | None = None,
               binary: bool = False, norm: bool = True) -> DataFrame:
    """(doc, term, weight): tf · (ln((1+n)/(1+df)) + 1), L2-normalised per document (smooth idf).

    Only vocabulary terms are shuffled with their document, by number; the
    terms themselves are put back last.
    """
    vocab = select_vocab(df, id_col, terms, min_df, max_features)
    return _weighted(df, id_col, terms, vocab, binary, norm)


def _weighted(df: DataFrame, id_col: str, terms: Column, vocab: DataFrame, binary: bool = False, norm: bool = True) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    idf = attach_row(vocab, n).select("term_id", (F.log((1 + F.col("_n")) / (1 + F.col("df"))) + 1).alias("idf"))
    x, small = _hits(df, id_col, terms, vocab)
    w = _with_vocab(x.groupBy(id_col, "term_id").agg(F.count(F.lit(1)).alias("value")), idf, small)
    tf = F.lit(1).cast("long") if binary else F.col("value")
    w = w.select(id_col, "term_id", (tf * F.col("idf")).alias("weight"))
    if norm:
        # one document's terms fit one task: the norm is a window over them, one shuffle of the weights
        l2 = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col)))
        w = w.withColumn("weight", F.try_divide(F.col("weight"), l2))
    return _with_vocab(w, vocab.select("term", "term_id"), small).select(id_col, "term", "term_id", "weight")


def count_vector(df: DataFrame, tokens: str, out: str = "counts", binary: bool = True, min_df: float = 1.0,
                 vocab_size: int = 1 << 18):
    """MLlib CountVectorizer (sparse vectors); returns (DataFrame, model)."""
    from pyspark.ml.feature import CountVectorizer
    m = CountVectorizer(inputCol=tokens, outputCol=out, binary=binary, minDF=min_df, vocabSize=vocab_size).fit(df)
    return m.transform(df), m


def tfidf_vector(df: DataFrame, tokens: str, out: str = "tfidf", min_df: float = 1.0, vocab_size: int = 1 << 18):
    """MLlib CountVectorizer + IDF, rescaled to the smooth-idf convention
    (MLlib's idf is ln((n+1)/(df+1)); the +1 is added as a per-term offset)."""
    from pyspark.ml.feature import IDF, Normalizer
    c, _ = count_vector(df, tokens, "_tf", binary=False, min_df=min_df, vocab_size=vocab_size)
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(c)
    t = idf.transform(c)
    return Normalizer(inputCol="_idf", outputCol=out, p=2.0).transform(t).drop("_tf", "_idf")


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Concatenate dense columns and vector blocks into one vector."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


@dataclass(frozen=True)
class Block:
    """A block of features in long form: ``rows`` (id, index from 0, value) and the number of its features,
    a number or a one-row table with column ``width``.  ``packed``: ``rows`` is (id, indices, values) instead, no index twice for an id."""
    name: str
    rows: DataFrame
    width: int | DataFrame
    packed: bool = False


def dense_block(df: DataFrame, id_col: str, cols: Sequence[str], name: str = "dense") -> Block:
    """Numeric columns as they are, one feature each."""
    values = F.array(*[F.col(c).cast("double") for c in cols])
    return Block(name, df.select(id_col, F.posexplode(values).alias("index", "value")), len(cols))


def hash_block(df: DataFrame, id_col: str, cols: Sequence[str], buckets: int = 3000, name: str = "hash") -> Block:
    """Hashing trick: the bucket of each ``column=value`` counts one."""
    from .encode import hash_bucket
    at = F.array(*[hash_bucket(c, F.col(c), buckets) for c in cols])
    return Block(name, df.select(id_col, F.explode(at).alias("index"), F.lit(1.0).alias("value")), buckets)


def one_hot_block(df: DataFrame, id_col: str, col: str, name: str | None = None) -> Block:
    """One feature per distinct value, in value order (NULL as text); the dictionary is joined, not collected."""
    from .encode import NULL_TEXT, dictionary
    d = dictionary(df, col).checkpoint()
    rows = df.select(id_col, F.coalesce(F.col(col).cast("string"), F.lit(NULL_TEXT)).alias("_v")).join(d, "_v")
    return Block(name or f"onehot_{col}", rows.select(id_col, F.col("_code").alias("index"), F.lit(1.0).alias("value")), d.agg(F.count(F.lit(1)).alias("width")))


def tfidf_grams(df: DataFrame, id_col: str, tokens: str, lo: int, hi: int, min_df: int, max_features: int, binary: bool = False, norm: bool = True) -> DataFrame:
    """``tfidf_long`` of the word n-grams, lo ≤ n ≤ hi, of a column of tokens without blanks; counted level by level (``wordgrams``) within its bounds."""
    from .wordgrams import gram_index, gram_rows
    g = gram_index(df, id_col, tokens, lo, hi, min_df, max_features)
    return gram_rows(g, binary, norm) if g else tfidf_long(df, id_col, ngram_range(F.col(tokens), lo, hi), min_df, max_features, binary, norm)


def gram_block(df: DataFrame, id_col: str, tokens: str, lo: int, hi: int, name: str, min_df: int, max_features: int, tfidf: bool = False) -> Block:
    """``text_block`` of the word n-grams, lo ≤ n ≤ hi, of a column of tokens without blanks."""
    from .wordgrams import gram_arrays, gram_index
    g = gram_index(df, id_col, tokens, lo, hi, min_df, max_features)
    if g is None:
        return text_block(df, id_col, ngram_range(F.col(tokens), lo, hi), name, min_df, max_features, tfidf)
    return Block(name, gram_arrays(g, tfidf, binary=not tfidf), len(g.df), packed=True)


def text_block(df: DataFrame, id_col: str, terms: Column, name: str, min_df: int, max_features: int, tfidf: bool = False) -> Block:
    """Bag of terms over a bounded vocabulary: presence, or TF-IDF weights (L2 norm per document)."""
    vocab = select_vocab(df, id_col, terms, min_df, max_features)
    rows = _weighted(df, id_col, terms, vocab) if tfidf else count_long(df, id_col, terms, vocab).withColumn("weight", F.col("value").cast("double"))
    return Block(name, rows.select(id_col, F.col("term_id").alias("index"), F.col("weight").alias("value")), vocab.agg(F.count(F.lit(1)).alias("width")))


def sparse_union(blocks: Sequence[Block], id_col: str) -> DataFrame:
    """(id, size, indices, values): one sparse vector per document, the blocks side by side in the order given.

    Each block's rows are shifted by the widths of the blocks before it and
    put together per document; no vocabulary or vector passes through the
    driver.  Features that meet in an index (hashing) are added first; packed
    blocks, where none do, are shuffled once, as arrays.  Zeros and NULLs are
    left out.
    """
    width = [b.width if isinstance(b.width, DataFrame) else None for b in blocks]
    first = next((w for w in width if w is not None), None)
    spark = blocks[0].rows.sparkSession
    one = first.select(F.lit(0).alias("_z")) if first is not None else spark.range(1).select(F.lit(0).alias("_z"))
    offset, names = F.lit(0).cast("long"), []
    for i, b in enumerate(blocks):
        names.append(offset.alias(f"_o{i}"))
        if width[i] is not None:
            one = attach_row(one, width[i].select(F.col("width").alias(f"_w{i}")))
            offset = offset + F.col(f"_w{i}")
        else:
            offset = offset + F.lit(b.width)
    offsets = one.select(*names, offset.alias("size"))
    rows, packed = None, []
    for i, b in enumerate(blocks):
        if b.packed:
            by = F.col(f"_o{i}")
            packed.append(attach_row(b.rows, offsets).select(id_col, F.transform("indices", lambda x: x.cast("long") + by).alias("_i"), F.col("values").cast("array<double>").alias("_v")))
            continue
        r = b.rows.select(id_col, F.lit(i).alias("_b"), F.col("index").cast("long").alias("index"), F.col("value").cast("double").alias("value"))
        rows = r if rows is None else rows.unionByName(r)
    if rows is not None:
        shift = F.element_at(F.array(*[F.col(f"_o{i}") for i in range(len(blocks))]), F.col("_b") + 1)
        cells = attach_row(rows, offsets).select(id_col, (F.col("index") + shift).alias("index"), "value").groupBy(id_col, "index").agg(F.sum("value").alias("value"))
        packed.append(cells.groupBy(id_col).agg(F.collect_list(F.struct("index", F.coalesce("value", F.lit(0.0)).alias("value"))).alias("_c"))
                      .select(id_col, F.col("_c.index").alias("_i"), F.col("_c.value").alias("_v")))
    every = packed[0]
    for p in packed[1:]:
        every = every.unionByName(p)
    v = every.groupBy(id_col).agg(F.flatten(F.collect_list("_i")).alias("_i"), F.flatten(F.collect_list("_v")).alias("_v"))
    pairs = F.sort_array(F.filter(F.arrays_zip("_i", "_v"), lambda x: F.coalesce(x["_v"], F.lit(0.0)) != 0))
    v = attach_row(v.select(id_col, pairs.alias("_p")), offsets.select("size"))
    return v.select(id_col, "size", F.col("_p._i").alias("indices"), F.col("_p._v").alias("values"))


def scale(df: DataFrame, cols: Sequence[str], log1p: bool = False, suffix: str = "") -> DataFrame:
    """Standardise with the population std (one stats row, attached by broadcast); constant → 0."""
    src = {c: (F.log1p(F.col(c).cast("double")) if log1p else F.col(c).cast("double")) for c in cols}
    t = df.withColumns({f"_s_{c}": e for c, e in src.items()})
    st = t.agg(*[F.avg(f"_s_{c}").alias(f"_m_{c}") for c in cols],
               *[F.stddev_pop(f"_s_{c}").alias(f"_d_{c}") for c in cols])
    t = attach_row(t, st)
    t = t.withColumns({f"{c}{suffix}": F.coalesce(F.try_divide(F.col(f"_s_{c}") - F.col(f"_m_{c}"),
                                                                F.nullif(F.col(f"_d_{c}"), F.lit(0.0))), F.lit(0.0))
                       for c in cols})
    return t.drop(*[f"_s_{c}" for c in cols], *[f"_m_{c}" for c in cols], *[f"_d_{c}" for c in cols])
