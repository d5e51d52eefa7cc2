"""Document fingerprints from closed syncmers, in DataFrame functions.

A text's words are hashed.  A k-mer of ``K`` consecutive words is a closed
syncmer when the smallest of its ``K - S + 1`` inner substrings of ``S`` words
is its first or its last one.  Whether a k-mer is chosen depends on its own
words only, so two texts that share a passage choose the same anchors in it,
wherever it stands and whatever surrounds it.  ``anchors`` returns them with
their word positions for positional matching.

A fingerprint is the set of all anchor hashes of a text, ascending, 16
hexadecimal digits each.  The likeness of two fingerprints is the Jaccard
similarity of the sets, over all anchors.  A text without an anchor has its
words' hash as its only one; a text without words has an empty fingerprint,
and two empty ones have likeness 1.  Anchors are also matched by position:
``placed`` is the share of anchors that both texts have at the same word.

``edited`` pairs each document with the next one by descending id.  Rows are
dealt to ranges of (id, text hash) of bounded size, whose borders come from a
bounded sample; each range is sorted on its own, and only the first text of
each range crosses a border.

Defined results: null texts count as empty; null ids come last; ids of any
type that sorts will do; rows that share an id (or have none) are ordered by a
hash of their text; a single document is its own next; empty tables give empty
tables.  Very long texts are one row each, in time and space linear in their
words.  Only the id and text columns are read, so further columns may have any
names.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, split_words, text_or_empty

#: Words of a k-mer and of its inner substrings.
K, S = 4, 2
#: Documents in one range, about, ranges at most (their borders are a constant of the plan; beyond, ranges grow and are sorted with spilling), sampled rows a range.
RANGE_ROWS, MOST_RANGES, SAMPLE = 2_000, 20_000, 20


def _anchor_list(hs: Column, k: int, s: int) -> Column:
    """(hash, position) of the closed syncmers of an array of word hashes."""
    inner = k - s + 1

    def of(ss: Column) -> Column:
        def at(i: Column) -> Column:
            parts = [F.get(ss, i + j) for j in range(inner)]
            edge = F.least(parts[0], parts[-1]) <= F.least(*parts[1:-1]) if inner > 3 else F.least(parts[0], parts[-1]) <= parts[1]
            return F.when(edge, F.struct(F.xxhash64(*[F.get(hs, i + j) for j in range(k)]).alias("hash"), i.alias("position")))
        return F.filter(F.transform(F.sequence(F.lit(0), F.size(hs) - k), at), lambda x: x.isNotNull())

    subs = F.transform(F.sequence(F.lit(0), F.size(hs) - s), lambda i: F.xxhash64(*[F.get(hs, i + j) for j in range(s)]))
    none = F.array().cast("array<struct<hash:bigint,position:int>>")
    return F.when(F.size(hs) < k, none).otherwise(let(subs, of))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Closed syncmers of a non-null text: array of (hash, word position), by position."""
    return let(F.transform(split_words(text), lambda w: F.xxhash64(w)), lambda hs: _anchor_list(hs, k, s))


def _found(text: Column, k: int, s: int) -> Column:
    """Anchors of a text, or its words' hash as the only one: array of (hash, position)."""
    def of(hs: Column) -> Column:
        def known(a: Column) -> Column:
            whole = F.when(F.size(hs) > 0, F.array(F.struct(F.xxhash64(hs).alias("hash"), F.lit(0).alias("position")))).otherwise(F.array().cast("array<struct<hash:bigint,position:int>>"))
            return F.when(F.size(a) == 0, whole).otherwise(a)
        return let(_anchor_list(hs, k, s), known)
    return let(F.transform(split_words(text), lambda w: F.xxhash64(w)), of)


def hashes(text: Column, k: int = K, s: int = S) -> Column:
    """The fingerprint (ascending hashes) and the anchors with their places (one number each)."""
    return let(_found(text, k, s), lambda a: F.struct(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["hash"]))).alias("set"),
                                                      F.transform(a, lambda x: F.xxhash64(x["hash"], x["position"])).alias("placed")))


def as_string(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays without repeats; 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    n = F.size(a) + F.size(b) - common
    return F.when(n == 0, F.lit(1.0)).otherwise(common.cast("double") / n)


def _below(every: Column, coarse: Column, step: int, value: Column) -> Column:
    """How many of the ascending ``every`` are smaller than ``value``; ``coarse`` is each ``step``-th of them."""
    whole = F.size(F.filter(coarse, lambda c: c < value)) * step
    return let(whole, lambda n: n + F.size(F.filter(F.slice(every, n + 1, step), lambda c: c < value)))


def _constant(keys: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps([{"id": i, "tie": t} for i, t in keys], default=str)), f"array<struct<id:{kind},tie:bigint>>")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """One row per input row: fingerprints of the text and its edited text, likenesses to the edited and the next text,
    and the shares of anchors that keep their place (``placed_edited``, ``placed_next``)."""
    kind = docs.schema[id_col].dataType.simpleString()
    # ascending (id, inverted hash) is descending id, ties by hash, read backwards
    key = F.struct(F.col("doc_id").alias("id"), F.bitwise_not(F.xxhash64("text")).alias("tie"))
    d = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("key", key)
    rows, top = d.agg(F.count(F.lit(1)), F.max("key")).first()
    ranges = min(MOST_RANGES, max(1, rows // RANGE_ROWS))
    keep = max(1, rows // (SAMPLE * ranges))
    sample = d.where(F.pmod(F.xxhash64("key"), F.lit(keep)) == 0).select("key.id", "key.tie").distinct().collect() if ranges > 1 else []
    sample = sorted(((r[0], r[1]) for r in sample), key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1]))
    cuts = sorted({len(sample) * i // ranges for i in range(1, ranges)}) if sample else []
    cuts = [sample[i] for i in cuts]
    # A cut is a document: the first of its range in descending order.  It also
    # goes, as a guest, to the end of the range before, and the very first to the end of all.
    is_top = F.col("key") == F.struct(F.lit(top[0]).cast(kind).alias("id"), F.lit(top[1]).alias("tie")) if top else F.lit(False)
    if top and top[0] is None:
        is_top = F.col("key.id").isNull() & (F.col("key.tie") == F.lit(top[1]))
    spot, is_cut = F.lit(0), F.lit(False)
    if cuts:
        step = max(1, int(len(cuts) ** 0.5))
        every = _constant(cuts, kind)
        spot = _below(every, _constant(cuts[step - 1::step], kind), step, F.col("key"))
        is_cut = F.coalesce(F.get(every, F.col("spot")) == F.col("key"), F.lit(False))
    spots = F.array_compact(F.array(F.struct(F.col("spot").alias("at"), F.lit(0).alias("guest")),
                                    F.when(is_cut, F.struct((F.col("spot") + 1).alias("at"), F.lit(1).alias("guest"))),
                                    F.when(is_top, F.struct(F.lit(0).alias("at"), F.lit(1).alias("guest")))))
    d = d.withColumn("spot", spot).select("doc_id", "text", "key", F.inline(spots))
    inside = Window.partitionBy("at").orderBy("guest", F.col("key").desc())
    d = d.withColumn("next_text", F.lead("text").over(inside))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    d = d.select("doc_id", "at", "guest", "key", n.cast("long").alias("n_chars"), hashes(F.col("text"), k, s).alias("fp"),
                 F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)).alias("edited"))
    d = d.withColumn("next_fp", F.lead("fp").over(inside)).where("guest = 0")
    d = d.select("doc_id", "n_chars", "fp", "next_fp", F.sha2("edited", 256).alias("edited_sha256"), hashes(F.col("edited"), k, s).alias("efp"))
    return d.select("doc_id", "n_chars", "edited_sha256", as_string(F.col("fp.set")).alias("fingerprint"), as_string(F.col("efp.set")).alias("edited_fingerprint"),
                    likeness(F.col("fp.set"), F.col("efp.set")).alias("near_edited"), likeness(F.col("fp.set"), F.col("next_fp.set")).alias("near_next"),
                    likeness(F.col("fp.placed"), F.col("efp.placed")).alias("placed_edited"), likeness(F.col("fp.placed"), F.col("next_fp.placed")).alias("placed_next"))
