"""Line de-duplication by winnowing over line hashes, in DataFrame operations.

The lines with a word of each document are hashed.  Of every window of
``window`` consecutive lines the smallest hash (the rightmost of ties) is the
window's fingerprint, so a run of ``window`` lines that occurs twice has the
same fingerprint in both places.  Windows whose fingerprint stands at a single
position of a single document are dropped (``candidates``).  The rest are
grouped by two hashes of all their lines; positions are not joined and matches
are not extended: a longer run is found as its overlapping windows.  The lines
of all windows that have an earlier equal (lower id, or higher up in the
document) are deleted: the later copies of every repeated run of at least
``window`` lines, at its full length.  Shorter runs stay, however long their
lines are.

Each window is compared with the first of its kind only, so a run found in a
third of all documents costs one row per occurrence; counts and firsts are
aggregated before the shuffle, and the joins are plain equi-joins that
adaptive execution splits.

Defined results: lines without a word are never deleted and do not interrupt
a run; null and empty texts are kept as they are with 0 deletions; documents
with fewer than ``window`` such lines lose nothing; a document is an id with a
text, so rows that share an id (or have none) but not their text are cut each
on its own, in the order of a hash of the text, and rows that repeat both get
the same result; empty tables give empty ones.  A very long text is one row whose
lines become windows one by one.  Other columns are kept; their names must not
begin with two underscores (callers with such names carry the row as a struct).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_or_empty

#: Lines in a window, and so in the shortest run that is deleted.
WINDOW = 3


def _windows(lines: Column, window: int) -> Column:
    """Array of (fingerprint, its line number, start, two hashes of the window, its line numbers) of an array of (number, hash)."""
    def at(i):
        rows = [F.get(lines, i + j) for j in range(window)]
        least = F.least(*[F.struct(r["h"].alias("h"), (-r["n"]).alias("n")) for r in rows]) if window > 1 else F.struct(rows[0]["h"].alias("h"), (-rows[0]["n"]).alias("n"))
        return F.struct(least["h"].alias("fp"), (-least["n"]).alias("at"), rows[0]["n"].alias("start"), F.xxhash64(*[r["h"] for r in rows]).alias("k1"),
                        F.xxhash64(F.lit(window), *[r["g"] for r in rows]).alias("k2"), F.array(*[r["n"] for r in rows]).alias("n"))
    return F.when(F.size(lines) >= window, F.transform(F.sequence(F.lit(0), F.size(lines) - window), at))


def candidates(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The windows whose fingerprint stands at more than one position: ``__id``, ``__th`` (hash of the text), ``start``, ``k1``, ``k2``, ``n``."""
    lines = F.filter(F.transform(F.split(F.col(text_col), "\n"), lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), F.struct(
        i.alias("n"), F.xxhash64(x).alias("h"), F.hash(F.reverse(x)).alias("g")))), lambda x: x.isNotNull())
    found = (docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__th"), let(lines, lambda a: _windows(a, window)).alias("w"))
             .select("__id", "__th", F.inline("w")))
    # Equal windows hold their fingerprint at the same place, so two of them hold it at two positions.
    place = F.xxhash64("__id", "__th", "at")
    repeated = found.groupBy("fp").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("fp")
    return found.join(repeated, "fp", "left_semi").select("__id", "__th", "start", "k1", "k2", "n")


def deletions(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id``, ``__th`` (hash of the text) and the sorted numbers ``gone`` of its lines to delete; documents without any are absent."""
    near = candidates(docs, window, id_col, text_col)
    first = (near.groupBy("k1", "k2").agg(F.min(F.struct(F.col("__id").alias("id"), F.col("__th").alias("th"), F.col("start").alias("start"))).alias("first"), F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("k1", "k2", "first"))
    later = near.join(first, ["k1", "k2"]).where(
        ~(F.col("__id").eqNullSafe(F.col("first.id")) & (F.col("__th") == F.col("first.th")) & (F.col("start") == F.col("first.start"))))
    return later.groupBy("__id", "__th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("n")))).alias("gone"))


def line_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with the text cut, plus ``__n_lines``, ``__n_removed`` and ``__n_runs`` (runs deleted)."""
    gone = deletions(docs, window, id_col, text_col).select(F.col("__id").alias("__gone_id"), F.col("__th").alias("__gone_th"), F.col("gone").alias("__gone"))
    both = docs.join(gone, F.col(id_col).eqNullSafe(F.col("__gone_id")) & (F.xxhash64(text_col) == F.col("__gone_th")), "left")

    def cut(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    runs = F.size("__gone") - F.size(F.filter("__gone", lambda x, i: F.coalesce(F.get(F.col("__gone"), i - 1) == x - 1, F.lit(False))))
    long = lambda c: c.cast("long")
    return (both.withColumn("__n_lines", long(F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_or_empty(text_col), "\n")))))
            .withColumn("__n_removed", long(F.coalesce(F.when(F.col("__gone").isNotNull(), F.size("__gone")), F.lit(0))))
            .withColumn("__n_runs", long(F.coalesce(F.when(F.col("__gone").isNotNull(), runs), F.lit(0))))
            .withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(let(F.split(F.col(text_col), "\n"), cut)))
            .drop("__gone_id", "__gone_th", "__gone"))
