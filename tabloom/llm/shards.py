"""Sharding: minimax contiguous partition of atomic groups of equal texts.

Groups are ordered by the 64-bit hash of their text; a shard is a contiguous
range of hashes, so a document's shard follows from its own hash and no join
is needed, however large a group is.  The smallest feasible capacity is found
by binary search; each trial fills shards greedily over prefix sums.

The prefix sums come from a histogram over hash ranges (bounded rows on the
driver).  Only ranges in which a trial's cut may fall are split further, 256
ways a round, until the cut is exact: a range with one group is atomic.  The
driver therefore never holds more than ``BUCKETS`` ranges plus 256 per
undecided range, whatever the number of documents.

Defined results: null texts count as empty; equal texts (null and empty among
them) share a shard; empty tables give empty tables; repeated rows are rows.  A
very long text is a group like any other, which no cut divides; only its hashes
and sizes are shuffled.  Columns other than id and text are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, text_or_empty

#: Hash ranges of the first histogram, and pieces into which an undecided range is split, as bits.
FIRST_BITS, SPLIT_BITS = 12, 8
#: Rows that one numbering task sorts, about.
SLOT_ROWS = 200_000


def fill(rows: list[tuple], capacity: int, shards: int, whole: bool) -> tuple[bool, list[int]]:
    """Greedy filling of ordered ranges ``(low, high, mass, atomic)``: (fits, the range at each cut and where filling failed).

    ``whole`` True cuts at range borders only, as if each range were one
    group; False lets a cut split any range that holds several groups, which
    no real cut can beat.
    """
    cuts, load = [], 0
    for i, (_, _, mass, atomic) in enumerate(rows):
        while load + mass > capacity:
            if len(cuts) == shards - 1 or ((whole or atomic) and mass > capacity):
                return False, [*cuts, i]
            cuts.append(i)
            mass, load = mass if whole or atomic else mass - (capacity - load), 0
        load += mass
    return True, cuts


def smallest(rows: list[tuple], low: int, high: int, shards: int, whole: bool) -> int:
    """Smallest capacity in [low, high] that greedy filling accepts; ``high`` is accepted."""
    while low < high:
        mid = (low + high) // 2
        if fill(rows, mid, shards, whole)[0]:
            high = mid
        else:
            low = mid + 1
    return low


def histogram(groups: DataFrame, ranges: list[tuple[int, int]] | None, bits: int) -> list[tuple]:
    """Mass of the pieces of ``ranges`` (equally wide; None: all hashes), each split ``2**bits`` ways."""
    wide = 64 if ranges is None else (ranges[0][1] - ranges[0][0]).bit_length() - 1
    shift = max(0, wide - bits)
    if ranges is not None:  # an arithmetic shift keeps the order of signed hashes
        groups = groups.where(F.shiftright("h", wide).isin([low >> wide for low, _ in ranges]))
    found = groups.groupBy(F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("mass"), (F.min("h") == F.max("h")).alias("atomic"))
    return [(r["b"] << shift, (r["b"] + 1) << shift, r["mass"], r["atomic"]) for r in found.collect()]


def cut_points(groups: DataFrame, shards: int) -> list[int]:
    """Hashes at which shards 1, 2, ... begin; ``groups`` has a row ``h`` (long), ``size`` per text."""
    rows = sorted(histogram(groups, None, FIRST_BITS))
    every = sum(r[2] for r in rows)
    while rows:
        low = smallest(rows, -(-every // shards), every, shards, whole=False)
        high = smallest(rows, low, every, shards, whole=True)
        first, last = fill(rows, low, shards, True)[1], fill(rows, high, shards, False)[1]
        if low == high:
            return [rows[i][0] for i in fill(rows, high, shards, True)[1]]
        # at any capacity between the two, a cut lies between its places in these two fillings
        end = len(rows) - 1
        pairs = [(first[min(k, len(first) - 1)] if first else 0, last[k] if k < len(last) else end) for k in range(shards - 1)]
        split = {i for x, y in pairs for i in range(min(x, y), max(x, y) + 1) if not rows[i][3]}
        assert split, "every cut lies at a border, so both capacities agree"
        by_width: dict[int, list] = {}
        for i in split:
            by_width.setdefault(rows[i][1] - rows[i][0], []).append(rows[i][:2])
        rows = sorted([r for i, r in enumerate(rows) if i not in split] + [r for same in by_width.values() for r in histogram(groups, same, SPLIT_BITS)])
    return []


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: size, text_crc32, law, shard, slot, grown_shard (null: the law is ``bytes``)."""
    t = text_or_empty(text_col)
    narrow = checkpoint(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
                                    F.crc32(t).alias("text_crc32"), F.xxhash64(t).alias("h")))
    cuts = cut_points(narrow.groupBy("h").agg(F.sum("size").alias("size")), shards)
    place = F.lit(0)
    for c in cuts:
        place = place + (F.col("h") >= F.lit(c).cast("long")).cast("int")
    placed = narrow.withColumn("shard", place.cast("int"))
    salts = max(1, narrow.count() // SLOT_ROWS // shards)
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("doc_id", "h"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("shard", "salt").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    local = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("doc_id", "h"))
    return (placed.withColumn("local", local).join(starts, ["shard", "salt"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.col("local") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
