"""The commonest word n-grams of a corpus, and their TF-IDF weights (numpy inside tasks).

An n-gram occurs in no more documents, and no more often, than the shorter
ones in it.  So the n-grams are counted level by level: n-grams whose parts
reach the document frequency and the k-th largest count found so far, and no
others, can be in the vocabulary.  All counts are exact.  A text is one array
of word numbers, written once; an n-gram is a pair of numbers of shorter ones,
and only pairs are shuffled, combined before.  The vocabulary is as large as
``max_features`` allows and goes to the tasks, where a document finds its terms
and weights inside its row.

Tokens hold no blank and are not NULL, as ``functions.text.tokens`` gives them.
Rows that share their id are one document.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.io import stage
from .chargrams import _shared
from .lookup import MAX_ROWS
from .ranking import count_cut

#: Tokens of a block that a task works on at a time; a longer text is a block of its own.
BLOCK_TOKENS = 1 << 19
#: Most n-grams of one length, and bytes of words, that are sent to tasks.
MAX_KNOWN, MAX_WORD_BYTES = 1_000_000, 32 << 20


@dataclass(frozen=True)
class GramIndex:
    """``own`` and ``shared`` (id, ids): word numbers, -1 for other words, of rows with an id of their own and of the others;
    ``vocab`` (term, df, tf, term_id), a written table; ``sent``, for the tasks: pairs and vocabulary numbers of each length; ``df`` by ``term_id``."""
    id_col: str
    own: DataFrame
    shared: DataFrame | None
    vocab: DataFrame
    sent: Any
    df: Any


def _numbered(batches, words):
    """The token lists as numbers of ``words``."""
    import pyarrow as pa
    import pyarrow.compute as pc
    for b in batches:
        t = b.column(1)
        flat = t.flatten()
        ids = pc.index_in(flat, value_set=words.value.cast(flat.type)).fill_null(-1)
        size = pc.list_value_length(t).fill_null(0).cast(pa.int64())
        ends = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(size)]).cast(pa.int32())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, ids)], ["id", "ids"])


def _blocks(batch, most: int):
    """(first row, tokens, row of each within the block, rows) of the blocks of an Arrow batch."""
    import numpy as np
    import pyarrow.compute as pc
    t = batch.column(1)
    size = pc.list_value_length(t).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, flat = np.cumsum(size), t.flatten()
    first = 0
    while first < len(size):
        start = ends[first] - size[first]
        last = max(first + 1, int(np.searchsorted(ends, start + most, side="right")))
        yield first, flat.slice(start, ends[last - 1] - start), np.repeat(np.arange(last - first), size[first:last]), last - first
        first = last


def _pairs(at, number, row, base: int):
    """Places whose n-gram and the next place's are known, and the pairs of their numbers."""
    on = (at[1:] == at[:-1] + 1) & (row[at[1:]] == row[at[:-1]])
    return at[:-1][on], number[:-1][on] * base + number[1:][on]


def _levels(ids, row, known):
    """(places, numbers) of the known n-grams for each n; ``known``: their number, and from n = 2 the sorted pairs."""
    import numpy as np
    ids = ids.to_numpy(zero_copy_only=False)
    at = np.flatnonzero(ids >= 0)
    number = ids[at].astype(np.int64)
    yield at, number
    for (base, _), (n, pairs) in zip(known, known[1:]):
        at, key = _pairs(at, number, row, base)
        spot = np.searchsorted(pairs, key)
        hit = pairs[np.minimum(spot, n - 1)] == key if n else np.zeros(len(key), bool)
        at, number = at[hit], spot[hit]
        yield at, number


def _starts(x):
    """Places of sorted numbers that differ from the one before."""
    import numpy as np
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _words(tokens, row):
    """The words of a block: numbers, their rows, and the words of numbers."""
    import numpy as np
    import pyarrow as pa
    d = tokens.dictionary_encode()
    number = d.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    on = number >= 0
    return number[on].astype(np.int64), row[on], lambda k: d.dictionary.take(pa.array(k))


def _longer(ids, row, known):
    """``_words`` for the n-grams one longer than the known ones."""
    import pyarrow as pa
    *_, (at, number) = _levels(ids, row, known.value)
    at, pair = _pairs(at, number, row, known.value[-1][0])
    return pair, row[at], pa.array


def _stats(batches, grams, most: int, by_id: bool):
    """(key, df, tf) of the n-grams that ``grams`` finds in each block; ``by_id``: (id, key, tf) of each row."""
    import numpy as np
    import pyarrow as pa
    for b in batches:
        for first, tokens, row, rows in _blocks(b, most):
            key, of, names = grams(tokens, row)
            x = np.sort(key * rows + of)
            one = _starts(x)
            key, times = x[one] // rows, np.diff(np.append(one, len(x)))
            if by_id:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(x[one] % rows + first)), names(key), pa.array(times)], ["id", "key", "tf"])
            else:
                new = _starts(key)
                tf = np.add.reduceat(times, new) if len(new) else times
                yield pa.RecordBatch.from_arrays([names(key[new]), pa.array(np.diff(np.append(new, len(key)))), pa.array(tf)], ["key", "df", "tf"])


def _found(batches, sent, most: int, weight):
    """(id, indices, values) of each row with a vocabulary term: term numbers ascending, and ``weight`` of their counts."""
    import numpy as np
    import pyarrow as pa
    known, chosen, size = sent.value
    for b in batches:
        for first, ids, row, rows in _blocks(b, most):
            x = []
            for (at, number), term in zip(_levels(ids, row, known), chosen):
                t = term[number]
                x.append((row[at] * size + t)[t >= 0])
            x = np.sort(np.concatenate(x))
            one = _starts(x)
            if not len(one):
                continue
            doc, term = np.divmod(x[one], size)
            value = weight(doc, term, np.diff(np.append(one, len(x))))
            new = _starts(doc)
            ends = pa.array(np.append(new, len(doc)), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc[new] + first)), pa.ListArray.from_arrays(ends, pa.array(term)), pa.ListArray.from_arrays(ends, pa.array(value))], ["id", "indices", "values"])


def _weights(idf, binary: bool, norm: bool):
    """``weight`` of ``_found``: tf · idf, divided by the document's L2 norm (``idf`` None: 1 or the count)."""
    def weight(doc, term, times):
        import numpy as np
        tf = np.ones(len(times)) if binary else times.astype(float)
        w = tf if idf is None else tf * idf.value[term]
        return w / np.sqrt(np.bincount(doc, w * w))[doc] if norm else w
    return weight


def gram_index(df: DataFrame, id_col: str, tokens: str, lo: int, hi: int, min_df: int, max_features: int) -> GramIndex | None:
    """The vocabulary that ``select_vocab`` takes from all word n-grams, lo <= n <= hi; None when more would have to be sent to tasks than the bounds allow."""
    import numpy as np
    import pyarrow as pa
    if max_features > MAX_ROWS:
        return None
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    most, send = BLOCK_TOKENS, spark.sparkContext.broadcast
    kind = df.schema[id_col].dataType.simpleString()
    counts: list[np.ndarray] = []

    def reached() -> int:
        """What a term's count must reach: the ``max_features``-th largest so far."""
        tf = np.concatenate([np.zeros(0, np.int64), *counts])
        return int(np.partition(tf, -max_features)[-max_features]) if len(tf) >= max_features else 0

    def level(own: DataFrame, shared: DataFrame | None, grams, key: str, n: int):
        """(key, df, tf) of the n-grams of ``n`` tokens that a vocabulary may need, by key; None beyond the bounds."""
        rows = own.mapInArrow(lambda batches: _stats(batches, grams, most, False), f"key {key}, df long, tf long")
        if shared is not None:
            many = shared.mapInArrow(lambda batches: _stats(batches, grams, most, True), f"id {kind}, key {key}, tf long").groupBy("id", "key").agg(F.sum("tf").alias("tf"))
            rows = rows.unionByName(many.select("key", F.lit(1).cast("long").alias("df"), "tf"))
        t = rows.groupBy("key").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf")).where((F.col("df") >= min_df) & (F.col("tf") >= reached())).checkpoint()
        cut = count_cut(t, "tf", max_features) if n >= lo else None
        if cut is not None:
            t = t.where(F.col("tf") >= cut)
        size, octets = t.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col("key").cast("string"))), F.lit(0))).first()
        if size > MAX_KNOWN or octets > MAX_WORD_BYTES:
            return None
        a = t.toArrow().sort_by("key")
        if n >= lo:
            counts.append(a["tf"].to_numpy())
            a = a.filter(pa.array(a["tf"].to_numpy() >= reached()))
        return a

    own, shared = _shared(df.select(F.col(id_col).alias("id"), tokens), "id")
    words = level(own, shared, _words, "string", 1)
    if words is None:
        return None
    word = words["key"].to_pylist()
    sent = send(pa.array(word, pa.string()))
    own, shared = (x if x is None else stage(x.mapInArrow(lambda batches: _numbered(batches, sent), f"id {kind}, ids array<int>"), "word-numbers") for x in (own, shared))
    known, found, terms, last = [(len(word), None)], [words], [word], list(range(len(word)))
    for n in range(2, hi + 1):
        seen = send(known)
        a = level(own, shared, lambda ids, row, seen=seen: _longer(ids, row, seen), "long", n)
        if a is None:
            return None
        pairs = a["key"].to_numpy()
        left, right = np.divmod(pairs, max(1, known[-1][0]))
        last = [last[k] for k in right]
        terms.append([f"{terms[-1][i]} {word[k]}" for i, k in zip(left, last)])
        known = [*known, (len(pairs), pairs)]
        found.append(a)

    all_df, all_tf = (np.concatenate([a[c].to_numpy() for a in found[lo - 1:]]) for c in ("df", "tf"))
    every = [t for x in terms[lo - 1:] for t in x]
    kept = sorted(sorted(range(len(every)), key=lambda i: (-all_tf[i], every[i]))[:max_features], key=every.__getitem__)
    number = np.full(len(every), -1, np.int64)
    number[kept] = np.arange(len(kept))
    vocab = pa.table({"term": pa.array([every[i] for i in kept], pa.string()), "df": pa.array(all_df[kept]), "tf": pa.array(all_tf[kept]), "term_id": pa.array(np.arange(len(kept)))})
    schema = "term string, df long, tf long, term_id long"
    written = (spark.createDataFrame(vocab, schema) if len(kept) else spark.createDataFrame([], schema)).checkpoint()
    chosen = [np.full(len(x), -1, np.int64) for x in terms[:lo - 1]] + np.split(number, np.cumsum([len(x) for x in terms[lo - 1:]])[:-1])
    return GramIndex(id_col, own, shared, written, send((known, chosen, max(1, len(kept)))), all_df[kept])


def gram_arrays(g: GramIndex, tfidf: bool = True, binary: bool = False, norm: bool = True) -> DataFrame:
    """(id, indices, values), a row per document with a vocabulary term: its ``term_id`` ascending with their weights.

    The weights are those of ``tfidf_long``; without ``tfidf`` counts, or 1 if
    ``binary``.  A document in one row never leaves it; only rows that share
    their id are counted together.
    """
    import numpy as np
    most, sent, send = BLOCK_TOKENS, g.sent, g.own.sparkSession.sparkContext.broadcast
    schema = f"id {g.own.schema['id'].dataType.simpleString()}, indices array<long>, values array<double>"
    n = g.own.count() + (g.shared.count() if g.shared is not None else 0)
    idf = np.log((1 + n) / (1 + g.df)) + 1 if tfidf else None
    weight = _weights(None if idf is None else send(idf), binary, norm and tfidf)
    out = g.own.mapInArrow(lambda batches: _found(batches, sent, most, weight), schema)
    if g.shared is not None:
        count = _weights(None, False, False)
        x = _cells(g.shared.mapInArrow(lambda batches: _found(batches, sent, most, count), schema)).groupBy("id", "index").agg(F.sum("value").alias("value"))
        if binary:
            x = x.withColumn("value", F.lit(1.0))
        if tfidf:
            table = g.vocab.select(F.col("term_id").alias("index"), (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf"))
            x = x.join(F.broadcast(table), "index").select("id", "index", (F.col("value") * F.col("idf")).alias("value"))
            if norm:
                x = x.withColumn("value", F.try_divide("value", F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy("id")))))
        x = x.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("index", "value"))).alias("x"))
        out = out.unionByName(x.select("id", F.col("x.index").alias("indices"), F.col("x.value").alias("values")))
    return out.withColumnRenamed("id", g.id_col)


def _cells(arrays: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, index, value) from (id, indices, values)."""
    return arrays.select(id_col, F.explode(F.arrays_zip("indices", "values")).alias("_x")).select(id_col, F.col("_x.indices").alias("index"), F.col("_x.values").alias("value"))


def gram_rows(g: GramIndex, binary: bool = False, norm: bool = True) -> DataFrame:
    """(doc, term, term_id, weight) of ``tfidf_long``."""
    x = _cells(gram_arrays(g, True, binary, norm), g.id_col).withColumnsRenamed({"index": "term_id", "value": "weight"})
    return x.join(F.broadcast(g.vocab.select("term", "term_id")), "term_id").select(g.id_col, "term", "term_id", "weight")
