"""Benchmark decontamination: a broadcast set of test n-grams against every window of the corpus.

Words are runs of letters and digits with A-Z lower-cased.  Each benchmark
item gives its windows of ``SIZE`` consecutive words (a shorter item: one
window of all its words).

* The windows are grouped by their text, once per distinct window with all
  items that hold it, and a bit array over their hashes is attached to the
  documents as one row.  Its size follows the number of windows up to
  ``2 ** MOST_BITS`` bits; a fuller array lets more candidates through, never
  fewer.
* Documents are cut into pieces of ``PIECE`` words (overlapping by a window),
  so that no row grows with a text.  A piece hashes its words once, tests each
  window's hash against the array and spells out only the windows that pass.
* Candidates are verified by joining the spelled-out window with the set:
  broadcast while its measured size is within ``BROADCAST_BYTES``, by a
  shuffle of the candidates beyond.
* Hits are collected per distinct text, not per row, so copies of a text are
  merged before they leave their task.  The items of a text depend on the set
  of its windows' item lists only and are gathered once per distinct set.

All of it is column expressions, joins and aggregations.

Defined results: null and empty texts have no words, no hits and are never
contaminated; rows that repeat (or share an id) get the same result each; an
item without words has no window, null item ids count as the empty string and
rows of one item id as one item; empty tables give no rows or no hits; very
long texts go piece by piece.  Further columns may have any names: the
functions that return documents carry each row as a struct.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach_row
from .common import checkpoint, let
from .variants import lower_ascii

SIZE = 10
PIECE = 1024
BROADCAST_BYTES = 64 << 20
LEAST_BITS, MOST_BITS = 12, 23
#: Everything below 0x80 that is no digit and no lower-case letter separates words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same in text whose case is kept.
ANY_BETWEEN, ANY_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Normalised words of a text; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _quoted(df: DataFrame) -> list:
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def _hash(word_hashes: Column) -> Column:
    return F.xxhash64(word_hashes)


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(bench: DataFrame, size: int = SIZE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per distinct window: gram, len (words), h (hash), items (sorted ids), cls (one value per list of items)."""
    b = bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    b = b.withColumn("len", F.least(F.size("w"), F.lit(size)))
    b = b.select("item", "len", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda i: F.slice("w", i, F.col("len")))).alias("g"))
    b = b.select("item", "len", F.array_join("g", " ").alias("gram"), _hash(_word_hashes(F.col("g"))).alias("h"))
    b = b.groupBy("gram", "len", "h").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return b.withColumn("cls", F.md5(F.to_json("items")))


def bit_array(grams: DataFrame, count: int) -> tuple[DataFrame, int]:
    """One row with a bit per hash value, as ``bits`` (array of longs), and the mask of a hash."""
    power = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(64 * max(count, 1)))))
    mask = (1 << power) - 1
    at = F.col("h").bitwiseAND(F.lit(mask))
    one = F.expr("shiftleft(1L, cast(h & 63 as int))")
    cells = grams.groupBy(F.shiftright(at, 6).alias("id")).agg(F.bit_or(one).alias("bit"))
    cells = grams.sparkSession.range(1 << (power - 6)).join(cells, "id", "left")
    cells = cells.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bit", F.lit(0).cast("long")).alias("bit")))).alias("c"))
    return cells.select(F.col("c.bit").alias("bits")), mask


def _candidates(lengths: list[int], mask: int, piece: int) -> Column:
    """Windows of column ``w`` (one piece) whose hash is in ``bits``: place in the piece, words, text."""
    def in_set(h: Column) -> Column:
        cell = F.get("bits", F.shiftright(h.bitwiseAND(F.lit(mask)), 6).cast("int"))
        return F.getbit(cell, h.bitwiseAND(F.lit(63)).cast("int")) != 0

    def of(hashes: Column, n: int) -> Column:
        starts = F.sequence(F.lit(0), F.least(F.size("w") - n, F.lit(piece - 1)))
        found = F.filter(starts, lambda i: let(_hash(F.slice(hashes, i + 1, n)), in_set))
        made = F.transform(found, lambda i: F.struct(i.alias("p"), F.lit(n).alias("len"), F.array_join(F.slice("w", i + 1, n), " ").alias("gram")))
        return F.when(F.size("w") >= n, made).otherwise(F.array().cast("array<struct<p:int,len:int,gram:string>>"))

    return let(_word_hashes(F.col("w")), lambda hashes: F.concat(*[of(hashes, n) for n in lengths]))


def _covered(hits: Column) -> Column:
    """Number of words inside the sorted (p, len) windows."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def step(acc: Column, x: Column) -> Column:
        end = x["p"] + x["len"]
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], x["p"]))).alias("n"), F.greatest(acc["end"], end).alias("end"))
    return F.aggregate(hits, zero, step, lambda a: a["n"])


def scan(docs: DataFrame, bench: DataFrame, size: int = SIZE, text_col: str = "text", id_col: str | None = None, bench_id: str = "item_id", bench_text: str = "text",
         piece: int = PIECE, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows, texts): one row per document (id, key, n_words), and one per distinct text that holds a window (key, hits, n_hit, n_items, items_sha256).

    ``hits`` are the windows found, (p, len) in words from 0, sorted.
    """
    grams = checkpoint(windows(bench, size, bench_id, bench_text))
    about = grams.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("gram") + 64).alias("bytes"), F.sort_array(F.collect_set("len")).alias("lens")).first()
    bits, mask = bit_array(grams, about["n"])
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select((F.col(id_col) if id_col else F.lit(None).cast("long")).alias("id"), F.md5(text).alias("key"), words_of(text).alias("all"))
    d = d.withColumn("n_words", F.size("all").cast("long"))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.size("all") - 1, F.lit(0)), F.lit(piece)),
                      lambda k: F.struct(k.alias("off"), F.slice("all", k + 1, piece + size - 1).alias("w")))
    d = d.select("id", "key", "n_words", F.explode(cut).alias("x")).select("id", "key", "n_words", "x.off", "x.w")
    empty = F.array().cast("array<struct<p:int,len:int,gram:string>>")
    found = _candidates(list(about["lens"]), mask, piece) if about["n"] else empty
    d = checkpoint(attach_row(d, bits).select("id", "key", "n_words", "off", found.alias("c")))
    rows = d.where("off = 0").select("id", "key", "n_words")
    c = d.where(F.size("c") > 0).select("key", "off", F.explode("c").alias("x")).select("key", (F.col("x.p") + F.col("off")).cast("long").alias("p"), "x.len", "x.gram")
    known = grams.select("gram", "cls")
    hits = c.join(F.broadcast(known) if (about["bytes"] or 0) <= broadcast_bytes else known, "gram")
    texts = (hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("p", F.col("len").cast("long").alias("len")))).alias("hits"), F.sort_array(F.collect_set("cls")).alias("classes"))
             .select("key", "hits", _covered(F.col("hits")).alias("n_hit"), "classes", F.md5(F.array_join("classes", "")).alias("set")))
    texts = checkpoint(texts)
    sets = texts.groupBy("set").agg(F.first("classes").alias("classes")).select("set", F.explode("classes").alias("cls"))
    lists = grams.groupBy("cls").agg(F.first("items").alias("items"))
    sets = (sets.join(lists, "cls").select("set", F.explode("items").alias("item")).distinct()
            .groupBy("set").agg(F.sort_array(F.collect_list("item")).alias("items"))
            .select("set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")))
    return rows, texts.drop("classes").join(sets, "set").drop("set")


def report(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, texts = scan(docs, bench, id_col=id_col, **options)
    zero, none = F.lit(0).cast("long"), F.sha2(F.lit(""), 256)
    return (rows.join(texts.drop("hits"), "key", "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
                    F.coalesce("items_sha256", none).alias("items_sha256"), (F.coalesce("n_hit", zero) > 0).alias("contaminated")))


def _spans(hits: Column, size: int) -> Column:
    """The (p, len) windows merged to spans (s, e).  Windows have ``size`` words at most, so where the
    words covered so far end is known from the last ``size`` places; no running list is built."""
    def merged(m: Column) -> Column:
        def before(i: Column) -> Column:
            return F.array_max(F.transform(F.slice(m, F.greatest(i - size + 1, F.lit(1)), F.least(i, F.lit(size))), lambda x: x["p"] + x["len"]))

        starts = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: (i == 0) | (F.get(m, i)["p"] > before(i)))
        return let(starts, lambda t: F.transform(t, lambda i, j: F.struct(
            F.get(m, i)["p"].cast("int").alias("s"), F.when(j + 1 < F.size(t), before(F.get(t, j + 1))).otherwise(before(F.size(m))).cast("int").alias("e"))))

    longest = F.filter(hits, lambda x, i: F.coalesce(F.get(hits, i + 1)["p"] != x["p"], F.lit(True)))
    return let(longest, merged)


def without_spans(text: Column, hits: Column, size: int = SIZE) -> Column:
    """``text`` without its hit words and what stands between the words of one span; the rest is kept as written."""
    gaps, words = F.split(text, ANY_WORD), F.array_remove(F.split(text, ANY_BETWEEN), "")
    parts = F.flatten(F.zip_with(gaps, words, lambda g, w: F.array(g, F.coalesce(w, F.lit("")))))

    def cut(t: Column, spans: Column) -> Column:
        kept = F.transform(spans, lambda x, j: let(F.when(j > 0, F.get(spans, j - 1)["e"]).otherwise(0) * 2,
                                                   lambda a: F.array_join(F.slice(t, a + 1, x["s"] * 2 - a + 1), "")))
        last = F.element_at(spans, -1)["e"] * 2
        return F.concat(F.array_join(kept, ""), F.array_join(F.slice(t, last + 1, F.size(t)), ""))

    return let(parts, lambda t: let(_spans(hits, size), lambda s: cut(t, s)))


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", spans: bool = True, size: int = SIZE, most_hit: float = 0.0, **options) -> DataFrame:
    """``docs`` with the hit spans cut out of their texts (``spans``), or without the documents of
    which more than the share ``most_hit`` of the words is hit.  Rows keep all their columns."""
    _, texts = scan(docs, bench, size, text_col, **options)
    row = F.struct(*_quoted(docs)).alias("row")
    quoted = "`" + text_col.replace("`", "``") + "`"
    d = docs.select(row, F.md5(F.coalesce(F.col(quoted), F.lit(""))).alias("key"))
    d = d.join(texts.select("key", "hits", "n_hit"), "key", "left")
    if not spans:
        share = F.coalesce(F.col("n_hit"), F.lit(0)) / F.greatest(F.size(words_of(F.col("row")[text_col])), F.lit(1))
        return d.where(share <= most_hit).select("row.*")
    text = F.col("row")[text_col]
    mended = F.when(F.col("n_hit") > 0, without_spans(text, F.col("hits"), size)).otherwise(text)
    return d.select(*[mended.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
