"""Best-fit packing: a configuration linear program over the length histogram.

Documents become token pieces of at most ``capacity``.  Only the histogram of
piece lengths (at most ``capacity`` rows) reaches the driver.  There the
configuration LP (how often to use each multiset of lengths that fits one
sequence) is solved by multiplicative weights: a length's price falls
exponentially with the share of it already covered, a knapsack dynamic
program finds the best-priced configuration, which is then used as often as
the scarcest of its lengths allows.  Usage is rounded down, the rest goes
through the same steps again, and what is left (bounded by the number of
configurations, not by the data) is placed by best fit, longest first.

The solution is a table of runs: a slot of a configuration takes a range of
the ranks of one length.  Each piece gets its rank within its length by a
salted numbering and looks its place up, so no length, however frequent,
meets in one task.

Defined results: null texts are empty; an empty text is the single id 2;
repeated rows are packed as rows; empty tables give empty tables.  Very long texts
are cut into pieces of ``capacity`` ids; other columns are not read.
"""
from __future__ import annotations

import bisect
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

CAPACITY = 1024
#: Id that ends a document.
END_ID = 2
#: Steps of one round of draining weights, rounds, exponent of the price in the uncovered share, and what long pieces are worth beyond their size.
STEPS, ROUNDS, ETA, LONG = 2000, 8, 0.02, 0.1
#: Steps and rate of averaging weights, and the gap to the lower bound at which they are not tried.
AVERAGE_STEPS, AVERAGE_RATE, GAP = 600, 0.2, 0.002
#: Pieces that one numbering task sorts, about.
RANK_ROWS = 100_000

#: Characters beyond those that both tokenizer libraries were tested to class alike go through ``tokenizers`` itself.
_OTHER = re.compile("[^\x00-˿Ͱ-ϿЀ-ӿ‐-‧€]|[\x1c-\x1f\x85]")
_ENCODERS: dict = {}


def encoder(path: str):
    """``texts -> list of id arrays`` for a byte-level BPE file, one per process.

    ``tiktoken`` runs the vocabulary of the ``tokenizers`` file, read from
    that file, several times faster and with the same ids (tested); special
    strings in a text become their ids, as in ``tokenizers``.
    """
    if path in _ENCODERS:
        return _ENCODERS[path]
    import json

    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    # the printable stand-ins of byte-level BPE, by its rule
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain}
    back |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    ranks = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    import public_tokenizers
    fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        if _OTHER.search(text):
            return np.array(exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(fast.encode(text, allowed_special="all"), dtype=np.uint32)

    _ENCODERS[path] = encode
    return encode


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces: doc_id, piece, start, length, ids_crc32; the first of several may be shorter."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for b in batches:
            out = []
            for d, t in zip(b["doc_id"].to_list(), b["text"]):
                ids = np.append(encode(t or ""), np.uint32(END_ID)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                out += [(d, k, a, z - a, zlib.crc32(ids[a:z].tobytes())) for k, (a, z) in enumerate(zip(edges, edges[1:]))]
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = frame["doc_id"].astype("object").where(frame["doc_id"].notna(), None)
            yield frame

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInPandas(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_configuration(price: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per length of the best-priced multiset that fits ``capacity`` (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        worth = price[1:c + 1] + best[c - 1::-1]
        k = int(worth.argmax())
        best[c], took[c] = worth[k], k + 1
    counts, c = np.zeros(len(price), dtype=np.int64), capacity
    while c > 0:
        counts[took[c]] += price[took[c]] > 0  # a length without price is room left over
        c -= took[c]
    return counts


def _rounded(use: dict[tuple[int, ...], float], scale: float, rest: np.ndarray, plan: list) -> bool:
    """Round the LP's uses down and take their pieces from ``rest``; False when nothing is left of them."""
    done = 0
    for key, x in sorted(use.items(), key=lambda p: -p[1]):
        ls, ks = np.unique(key, return_counts=True)
        x = min(math.floor(x * scale + 1e-6), int((rest[ls] // ks).min()))
        if x > 0:
            rest[ls] -= x * ks
            plan.append((x, key))
            done += x
    return done > 0


def _draining(need: np.ndarray, capacity: int) -> tuple[dict[tuple[int, ...], float], float]:
    """Weights close to the sizes, lengths leave the LP once covered: best where sequences can be filled to the brim."""
    sizes, left = np.arange(capacity + 1), need.copy()
    limit = max(1.0, float((need * sizes).sum()) / capacity / (STEPS / 2))
    use: dict[tuple[int, ...], float] = {}
    for _ in range(STEPS):
        open_ = left > 1e-9
        if not open_.any():
            break
        share = np.divide(left, need, out=np.zeros_like(left), where=need > 0)
        price = np.where(open_, sizes / capacity * (1 + LONG * sizes / capacity) * np.exp(ETA * (share - share.max())), 0.0)
        a = best_configuration(price, capacity)
        on = a > 0
        step = min(limit, float((left[on] / a[on]).min()))
        left[on] -= step * a[on]
        left[left < 1e-6] = 0
        key = tuple(int(x) for x in np.repeat(sizes[on], a[on])[::-1])
        use[key] = use.get(key, 0.0) + step
    return use, 1.0


def _averaging(need: np.ndarray, capacity: int) -> tuple[dict[tuple[int, ...], float], float]:
    """Weights fall with all coverage so far and uses are averaged: finds the true prices where lengths do not combine well."""
    sizes, some = np.arange(capacity + 1), need > 0
    log_weight, cover = np.zeros(capacity + 1), np.zeros(capacity + 1)
    use: dict[tuple[int, ...], float] = {}
    for t in range(AVERAGE_STEPS):
        price = np.where(some, np.exp(log_weight - log_weight[some].max()) * sizes / capacity, 0.0)
        a = best_configuration(price, capacity)
        on = a > 0
        step = float((need[on] / a[on]).min())
        covered = np.divide(step * a, need, out=np.zeros_like(need), where=some)
        log_weight -= AVERAGE_RATE * covered
        if t >= AVERAGE_STEPS // 10:  # the first prices are far off
            cover += covered
            key = tuple(int(x) for x in np.repeat(sizes[on], a[on])[::-1])
            use[key] = use.get(key, 0.0) + step
    return use, 1 / max(1e-9, float(np.quantile(cover[some], 0.9)))


def solve(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """``(uses, lengths)`` of configurations that hold all pieces; ``counts[l]`` pieces of length l.

    Both weight updates are tried unless the first comes within ``GAP`` of
    the least number of sequences that the total length allows.
    """
    least = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    best: list[tuple[int, tuple[int, ...]]] | None = None
    for weights in (_draining, _averaging):
        rest = counts.astype(np.int64).copy()
        plan = [(int(rest[capacity]), (capacity,))] if rest[capacity] else []
        rest[capacity] = 0
        for _ in range(ROUNDS):
            if rest.sum() <= 2 * capacity or not _rounded(*weights(rest.astype(float), capacity), rest, plan):
                break
        plan += best_fit(rest, capacity)
        if best is None or sum(n for n, _ in plan) < sum(n for n, _ in best):
            best = plan
        if sum(n for n, _ in best) <= least * (1 + GAP):
            break
    return best


def best_fit(rest: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best fit, longest first, over counts: equal sequences are handled together."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}  # by room left
    rooms: list[int] = []
    for size in range(capacity, 0, -1):
        n = int(rest[size])
        while n:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                fits = capacity // size
                full, over = divmod(n, fits)
                fresh = [(full, (size,) * fits)] * bool(full) + [(1, (size,) * over)] * bool(over)
                n = 0
            else:
                room = rooms[at]
                key, m = next(iter(open_[room].items()))
                k = min(room // size, n)  # into one sequence
                m_used = min(m, n // k)
                if m_used == m:
                    del open_[room][key]
                else:
                    open_[room][key] -= m_used
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
                fresh = [(m_used, key + (size,) * k)]
                n -= m_used * k
            for m, key in fresh:
                room = capacity - sum(key)
                if room not in open_:
                    bisect.insort(rooms, room)
                    open_[room] = {}
                open_[room][key] = open_[room].get(key, 0) + m
    return [(m, key) for same in open_.values() for key, m in same.items()]


def runs_of(plan: list[tuple[int, tuple[int, ...]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first ranks, first sequence ids and offsets of its runs, in order of rank."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for uses, key in plan:
        offset = 0
        for size in key:
            first = ranks.get(size, 0)
            rows.setdefault(size, []).append((first, sequence, offset))
            ranks[size] = first + uses
            offset += size
        sequence += uses
    return {size: tuple(np.array(x, dtype=np.int64) for x in zip(*r)) for size, r in rows.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = checkpoint(pieces(docs, tokenizer, capacity, id_col, text_col))
    histogram = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in histogram:
        counts[r["length"]] = r["n"]
    table = runs_of(solve(counts, capacity))
    salts = max(1, int(counts.max()) // RANK_ROWS + 1)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (salted.withColumn("within", within).join(starts, ["length", "salt"])
              .withColumn("rank", F.col("before") + F.col("within") - 1).drop("salt", "within", "before"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sequence, offset = np.zeros(len(b), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
            sizes, ranks = b["length"].to_numpy(), b["rank"].to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                first, base, off = table[int(size)]
                k = np.searchsorted(first, ranks[at], side="right") - 1
                sequence[at], offset[at] = base[k] + ranks[at] - first[k], off[k]
            yield b.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    kind = cut.schema["doc_id"].dataType.simpleString()
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*cols, "rank").mapInPandas(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
