"""Character n-grams of many texts at once (numpy inside tasks).

A text has about as many distinct n-grams as characters, per n; as strings in
rows they are many times the text.  Here a task numbers the characters of a
block of texts, packs an n-gram and its document into one integer, sorts the
integers and reads off them what each gram counts.  Only a block's distinct
grams become strings, and no (document, gram) row is shuffled.

NULL texts have no grams, an empty text neither.  Rows that share their id
are one document.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .lookup import MAX_BYTES, MAX_ROWS
from .vectorize import char_ngram_rows

#: Characters and texts of a block; a longer text is a block of its own.
BLOCK_CHARS, BLOCK_TEXTS = 1 << 21, 1 << 18


def _blocks(batch, most: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of the blocks of an Arrow batch with columns id and text."""
    texts, chars, first = [], 0, 0
    for i, t in enumerate(batch.column(1).to_pylist()):
        if texts and (chars + len(t) > most or len(texts) == BLOCK_TEXTS):
            yield first, texts
            texts, chars, first = [], 0, i
        texts.append(t)
        chars += len(t)
    if texts:
        yield first, texts


def _levels(texts: list[str], lo: int, hi: int):
    """For each n: the sorted (gram, document) numbers of all places, gram the quotient by ``len(texts)``, and a function from grams to strings."""
    import numpy as np
    import pyarrow as pa
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    if not len(points):
        return
    size = np.array([len(t) for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(points))
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    letter = (np.cumsum(seen) - 1)[points]
    base, docs = len(alphabet), len(texts)
    gram, bound, known, width = np.zeros(len(points), np.int64), 1, np.zeros((1, 0), np.uint32), 0
    at = np.arange(len(points))

    def strings(grams, n, known=None, width=0):
        rows = np.empty((len(grams), n), np.uint32)
        for k in range(n - 1, width - 1, -1):
            grams, x = np.divmod(grams, base)
            rows[:, k] = alphabet[x]
        rows[:, :width] = known[grams]
        octets = (1 + (rows > 0x7F) + (rows > 0x7FF) + (rows > 0xFFFF)).sum(axis=1)
        offsets = np.concatenate([[0], np.cumsum(octets)]).astype(np.int64)
        data = rows.tobytes().decode("utf-32-le").encode()
        return pa.LargeStringArray.from_buffers(len(grams), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))

    for n in range(1, hi + 1):
        on = left[at] >= n
        at, gram = at[on], gram[on]
        if not len(at):
            return
        if bound * base * docs >= 1 << 63:  # the grams so far get small numbers of their own
            u, gram = np.unique(gram, return_inverse=True)
            table = np.empty((len(u), n - 1), np.uint32)
            rest = u
            for k in range(n - 2, width - 1, -1):
                rest, x = np.divmod(rest, base)
                table[:, k] = alphabet[x]
            table[:, :width] = known[rest]
            bound, known, width = len(u), table, n - 1
        gram = gram * base + letter[at + n - 1]
        bound *= base
        if n >= lo:
            yield np.sort(gram * docs + doc[at]), lambda g, n=n, known=known, width=width: strings(g, n, known, width)


def _starts(x):
    """Places at which a sorted array has a new value."""
    import numpy as np
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def _stats(batches, lo: int, hi: int, chars: int, by_id: bool):
    """(term, df, tf) of each block; ``by_id``: (id, term, tf) of each text."""
    import numpy as np
    import pyarrow as pa
    for b in batches:
        for first, texts in _blocks(b, chars):
            for x, strings in _levels(texts, lo, hi):
                g = x // len(texts)
                new, one = _starts(g), _starts(x)
                terms = strings(g[new]).cast(pa.string())
                if by_id:
                    of = np.searchsorted(new, one, side="right") - 1
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(x[one] % len(texts) + first)), terms.take(pa.array(of)), pa.array(np.diff(np.append(one, len(x))))], ["id", "term", "tf"])
                else:
                    df = np.diff(np.append(np.searchsorted(one, new), len(one)))
                    yield pa.RecordBatch.from_arrays([terms, pa.array(df), pa.array(np.diff(np.append(new, len(x))))], ["term", "df", "tf"])


def _found(batches, lo: int, hi: int, chars: int, vocab):
    """(id, term_id) of the vocabulary's terms in each text, once a text."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    terms, ids = vocab.value
    by_len: dict[int, list[int]] = {}
    for i, t in enumerate(terms):
        by_len.setdefault(len(t), []).append(i)
    sets = {n: (pa.array([terms[i] for i in rows], pa.large_string()), np.array([ids[i] for i in rows], np.int64)) for n, rows in by_len.items()}
    for b in batches:
        for first, texts in _blocks(b, chars):
            for n, (x, strings) in enumerate(_levels(texts, 1, hi), 1):
                if n < lo or n not in sets:
                    continue
                x = x[_starts(x)]
                g, doc = np.divmod(x, len(texts))
                new = _starts(g)
                spot = pc.index_in(strings(g[new]), value_set=sets[n][0]).fill_null(-1).to_numpy(zero_copy_only=False)
                spot = np.repeat(spot, np.diff(np.append(new, len(x))))
                hit = spot >= 0
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc[hit] + first)), pa.array(sets[n][1][spot[hit]])], ["id", "term_id"])


def _shared(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows with an id of their own, and those that share theirs (None: there are none)."""
    ensure_checkpoint_dir(df.sparkSession)
    ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1).select(F.col(id_col).alias("_id")).checkpoint()
    if ids.isEmpty():
        return df, None
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    return df.join(ids, same, "left_anti"), df.join(ids, same, "left_semi")


def char_term_stats(df: DataFrame, id_col: str, text: str, lo: int, hi: int) -> DataFrame:
    """(term, df, tf): documents and occurrences of each character n-gram, lo <= n <= hi."""
    chars = BLOCK_CHARS
    own, shared = _shared(df.select(id_col, text).where(F.col(text).isNotNull()), id_col)
    rows = own.mapInArrow(lambda batches: _stats(batches, lo, hi, chars, False), "term string, df long, tf long")
    if shared is not None:
        kind = df.schema[id_col].dataType.simpleString()
        many = shared.mapInArrow(lambda batches: _stats(batches, lo, hi, chars, True), f"id {kind}, term string, tf long").groupBy("id", "term").agg(F.sum("tf").alias("tf"))
        rows = rows.unionByName(many.select("term", F.lit(1).cast("long").alias("df"), "tf"))
    return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def char_hits(df: DataFrame, id_col: str, text: str, lo: int, hi: int, vocab: DataFrame) -> DataFrame:
    """Distinct (doc, term_id) of the character n-grams that ``vocab`` (term, term_id; a written table) has.

    A vocabulary within the bounds of ``lookup`` goes to the tasks; a larger one is joined.
    """
    chars, d = BLOCK_CHARS, df.select(id_col, text).where(F.col(text).isNotNull())
    v = vocab.select("term", "term_id").where("term is not null")
    n, size = v.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term") + 8), F.lit(0))).first()
    if n > MAX_ROWS or size > MAX_BYTES + 8 * MAX_ROWS:
        return char_ngram_rows(d.where(F.col(text) != ""), id_col, text, lo, hi).join(v, "term").select(id_col, "term_id")
    rows = v.collect()
    sent = df.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))
    find = lambda x: x.mapInArrow(lambda batches: _found(batches, lo, hi, chars, sent), f"id {df.schema[id_col].dataType.simpleString()}, term_id long").withColumnRenamed("id", id_col)
    own, shared = _shared(d, id_col)
    return find(own) if shared is None else find(own).unionByName(find(shared).distinct())
