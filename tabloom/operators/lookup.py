"""Bounded dictionaries searched inside the row (no join, no shuffle of tokens).

A dictionary whose measured size is within a bound becomes one constant of
the plan: an array of hash buckets, each a small map.  Spark folds it once
and ships it with the tasks; a token is found by its hash in the JVM, and a
document's tokens never leave its row.  Larger dictionaries return None and
the caller joins instead.
"""
from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import bound

#: Largest dictionary that becomes a constant: entries, and bytes of their keys.
MAX_ROWS, MAX_BYTES = 200_000, 8 << 20


def constant_map(pairs: DataFrame, key: str, value: str, kind: str = "bigint", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Callable[[Column], Column] | None:
    """``key -> value`` (of type ``kind``: bigint or string) as a function on columns, NULL for unknown keys; None when the table exceeds the bounds.

    ``pairs`` should be a written table: it is measured first and read then.  Of repeated keys one counts.
    """
    p = pairs.select(F.col(key).alias("k"), F.col(value).cast(kind).alias("v")).where("k is not null and v is not null")
    n, size = p.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("k") + F.octet_length(F.col("v").cast("string"))), F.lit(0))).first()
    if n > max_rows or size > max_bytes:
        return None
    buckets = 1 << max(0, (n - 1).bit_length())
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")
    table: list[dict] = [{} for _ in range(buckets)]
    for b, k, v in p.select(spot(F.col("k")), "k", "v").collect():
        table[b].setdefault(k, v)
    constant = F.from_json(F.lit(json.dumps(table)), f"array<map<string,{kind}>>")
    return lambda c: F.try_element_at(F.get(constant, spot(c)), c)


def known(tokens: Column, look: Callable[[Column], Column]) -> Column:
    """Values of the tokens that the dictionary has, in order."""
    return F.filter(F.transform(tokens, look), lambda x: x.isNotNull())


def first_known(tokens: Column, look: Callable[[Column], Column], n: int, last: bool = False) -> Column:
    """The first (``last``: the last) ``n`` values of ``known``.

    A stretch of ``4 n`` tokens is searched first; the others only where it does not give ``n`` values.
    """
    def search(t: Column) -> Column:
        size, near = F.size(t), 4 * n
        rest = F.greatest(size - near, F.lit(0))
        at = F.slice(t, rest + 1, near) if last else F.slice(t, 1, near)
        more = F.slice(t, 1, rest) if last else F.slice(t, near + 1, F.greatest(rest, F.lit(1)))

        def enough(x: Column) -> Column:
            whole = F.when((F.size(x) >= n) | (size <= near), x).otherwise(F.concat(known(more, look), x) if last else F.concat(x, known(more, look)))
            return bound(whole, lambda w: F.slice(w, F.greatest(F.size(w) - n, F.lit(0)) + 1, n) if last else F.slice(w, 1, n))
        return bound(known(at, look), enough)
    return bound(tokens, search)


#: A token in this share of all tokens is heavy; there are at most ``1 / HEAVY`` of them.
HEAVY = 0.002


def heavy_values(df: DataFrame, col: str, share: float = HEAVY) -> list[str]:
    """Values that may hold ``share`` of the rows or more, found by a counted sketch in one pass (all that do, and perhaps a few others)."""
    return [x for x in (df.where(F.col(col).isNotNull()).freqItems([col], share).first()[0] or []) if x is not None]


def split_join(df: DataFrame, table: DataFrame, key: str, how: str = "left", share: float = HEAVY) -> DataFrame:
    """``df.join(table, key, how)`` (left, inner or left_semi) with heavy keys kept out of the shuffle.

    The few heavy keys meet their rows of ``table`` as a broadcast side, whose
    size the sketch bounds when ``table`` has a row per key; the others are
    shuffled, and no task gets more than its share of them.
    """
    heavy = heavy_values(df, key, share)
    if not heavy:
        return df.join(table, key, how)
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    return (df.where(is_heavy).join(F.broadcast(table.where(F.col(key).isin(heavy))), key, how)
            .unionByName(df.where(~is_heavy).join(table.where(~F.col(key).isin(heavy)), key, how)))


def replace_tokens(df: DataFrame, tokens: str, table: DataFrame, key: str, value: str, count: str, out: str) -> DataFrame:
    """Adds ``out``: the values that ``table`` (a written table, one row per key; ``count``: how often the key occurs) has for a row's tokens, in order.

    For a table beyond the bounds of ``constant_map``: its commonest keys
    are searched inside the row, up to those bounds.  Only the other tokens,
    all of them rare, are exploded and joined, and meet their row again by
    two 64-bit hashes of all its columns, which equal rows share.
    """
    pairs = table.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(F.col(key).alias("_tok"), F.col(value).alias("_val"), F.col(count).cast("double").alias("_n"))
    n, size = pairs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("_tok") + F.octet_length(F.col("_val").cast("string"))), F.lit(0))).first()
    share = min(1.0, 0.9 * MAX_ROWS / max(1, n), 0.9 * MAX_BYTES / max(1, size))
    cut = (pairs.approxQuantile("_n", [1 - share], share / 20) or [0.0])[0]
    kind = dict(pairs.dtypes)["_val"]
    look = constant_map(pairs.where(F.col("_n") > cut), "_tok", "_val", kind)
    rest = pairs.where(F.col("_n") <= cut) if look else pairs
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    d = df.withColumns({"_g1": F.xxhash64(row), "_g2": F.xxhash64(F.lit("2"), row)})
    x = d.select("_g1", "_g2", F.posexplode(tokens).alias("_pos", "_tok"))
    rest = rest.select("_tok", "_val")
    x = x.where(look(F.col("_tok")).isNull()).join(rest, "_tok") if look else split_join(x, rest, "_tok", "inner")
    back = x.groupBy("_g1", "_g2").agg(F.collect_set(F.struct("_pos", "_val")).alias("_rest"))
    found = F.transform(F.col(tokens), lambda t, i: F.struct(i.alias("_pos"), (look(t) if look else F.lit(None).cast(kind)).alias("_val")))
    found = F.filter(found, lambda s: s["_val"].isNotNull())
    every = F.when(F.col("_rest").isNull(), found).otherwise(F.sort_array(F.concat(found, F.col("_rest"))))
    return d.join(back, ["_g1", "_g2"], "left").withColumn(out, F.transform(every, lambda s: s["_val"])).drop("_g1", "_g2", "_rest")
