"""Spelling variant grouping: words one edit apart, found in k-d trees over letter counts.

One edit moves a word's letter counts by an L1 distance of two at most: a
replaced letter takes one count up and one down, an inserted letter takes one
up.  So the words near a word of length L have length L (counts: one up, one
down) or L + 1 (one up), and each pair of lengths is a range search.

* Words are counted on the JVM side; the table of words that are long and
  frequent enough is written once.
* A k-d tree per length is cut from a bounded sample of that table
  (``SAMPLE`` words).  It only deals out work: every word is stored in one
  leaf and sent to each leaf whose box its search may reach.  Along any path
  at most one cut may be crossed upwards and one downwards, so a word reaches
  few leaves however many there are.
* In a leaf a second tree prunes boxes down to small buckets; what is left is
  compared by counts first, by letter order then.  Only totals per word leave
  the task, never pairs.
* Links from a word to its form lead to ever more frequent words (five times
  at least), so doubling them a logarithmic number of times gives the root.

Defined results: null and empty texts have no words; a null id counts as the
empty string in the hash; rows that repeat count as often as they occur; an
empty table gives no words; very long texts are split like others, and a very
long word is compared like any other.  Ties for the form go to the smallest
word in code-point order.  Only the id and text columns are read, so further
columns, whatever their names, do not matter.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, partitions

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words on which the dealing trees are fitted, at most about so many; words a leaf should hold; sampled words below which no leaf is cut.
SAMPLE, LEAF, LEAST = 40_000, 4_096, 16
#: Points in a bucket of the tree inside a leaf, and cells of one comparison.
BUCKET, CELLS = 96, 1 << 20
#: Dimension of each Latin-1 code: a-z, then the letters from U+00C0.
DIMS = 26 + 64
_DIM = np.zeros(256, np.int64)
_DIM[97:123] = np.arange(26)
_DIM[0xC0:0x100] = 26 + np.arange(64)


# ---------------------------------------------------------------- words
def lower_ascii(text: Column) -> Column:
    """``text`` with only A-Z lower-cased."""
    return F.translate(text, UPPER, LOWER)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = 199, min_length: int = 6) -> DataFrame:
    """One row per letter run that may count, with the planted slip: where the hash of
    id and run is a multiple of ``drop_every`` the run loses one letter (0: none does)."""
    runs = F.split(lower_ascii(F.col(text_col)), f"[^{LETTERS}]+")
    d = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.filter(runs, lambda w: F.length(w) >= min_length)).alias("run"))
    if not drop_every:
        return d.select(F.col("run").alias("word"))
    d = d.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (d.select(F.when(F.col("h") % drop_every == 0, short).otherwise(F.col("run")).alias("word"))
             .where(F.length("word") >= min_length))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = 199, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """Words of ``min_length`` letters with ``min_count`` occurrences: columns word, n."""
    d = occurrences(docs, id_col, text_col, drop_every, min_length)
    return d.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- letters
def codes(words: list, length: int) -> np.ndarray:
    """Latin-1 codes of words that all have ``length`` letters, one row a word."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def counts(code: np.ndarray) -> np.ndarray:
    """Letter counts of each row of ``code``."""
    out, rows = np.zeros((len(code), DIMS), np.int32), np.arange(len(code))
    for i in range(code.shape[1]):
        out[rows, _DIM[code[:, i]]] += 1
    return out


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of equal length that differ in exactly one place."""
    return (a != b).sum(1) == 1


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of ``b`` (one letter longer) that become the row of ``a`` without one letter."""
    n = a.shape[1]
    head = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= n


# ---------------------------------------------------------------- trees
def cut(points: np.ndarray) -> tuple[int, int] | None:
    """Dimension and threshold (left: below it) that halve ``points`` best, None if all are equal."""
    low, high = points.min(0), points.max(0)
    best = None
    for d in np.argsort(-points.var(0), kind="stable")[:4]:
        if low[d] == high[d]:
            continue
        t = int(np.clip(np.median(points[:, d]), low[d] + 1, high[d]))
        for at in (t, t + 1):
            if low[d] < at <= high[d]:
                share = abs(int((points[:, d] < at).sum()) * 2 - len(points))
                if best is None or share < best[0]:
                    best = (share, int(d), at)
    return best and best[1:]


def dealing_tree(points: np.ndarray, least: int) -> list:
    """Nodes ``(dim, threshold, left, right)``, or ``leaf number`` for leaves, node 0 the top."""
    nodes, todo, leaves = [None], [(0, points)], 0
    while todo:
        k, p = todo.pop()
        c = cut(p) if len(p) >= 2 * least else None
        if c is None:
            nodes[k], leaves = leaves, leaves + 1
            continue
        d, t = c
        nodes[k] = (d, t, len(nodes), len(nodes) + 1)
        todo += [(len(nodes), p[p[:, d] < t]), (len(nodes) + 1, p[p[:, d] >= t])]
        nodes += [None, None]
    return nodes


def reach(nodes: list, q: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows of ``q``) for the leaves that hold points with ``up`` counts more and ``down`` counts fewer at most.

    Lower bounds of both distances to a node's box are kept per dimension, so
    a dimension cut twice is not counted twice.
    """
    todo = [(0, np.arange(len(q)), {}, {})]
    while todo:
        k, rows, low, high = todo.pop()
        if not len(rows):
            continue
        if isinstance(nodes[k], int):
            yield nodes[k], rows
            continue
        d, t, left, right = nodes[k]
        for child, lo, hi in ((left, low, high | {d: t - 1}), (right, low | {d: t}, high)):
            x = q[rows]
            more = sum((np.maximum(v - x[:, e], 0) for e, v in lo.items()), np.zeros(len(rows), np.int64))
            fewer = sum((np.maximum(x[:, e] - v, 0) for e, v in hi.items()), np.zeros(len(rows), np.int64))
            todo.append((child, rows[(more <= up) & (fewer <= down)], lo, hi))


def _unary(c: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """0/1 features whose dot product is the sum of the smaller counts."""
    if not tops.any():
        return np.zeros((len(c), 1), np.float32)
    return np.concatenate([c[:, d:d + 1] > np.arange(t) for d, t in enumerate(tops) if t], axis=1).astype(np.float32)


def near_rows(query: np.ndarray, point: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``query`` and ``point`` (codes; points as long or one letter longer) that are one edit apart."""
    if not len(query) or not len(point):
        return
    longer = point.shape[1] - query.shape[1]
    cq, cp = counts(query), counts(point)
    tops = cp.max(0)
    dense = int(tops.sum()) <= 512
    fq, fp = (_unary(cq, tops), _unary(cp, tops)) if dense else (None, None)
    shared = query.shape[1] - (0 if longer else 1)
    todo = [(np.arange(len(point)), np.arange(len(query)))]
    while todo:
        p, q = todo.pop()
        box = cp[p]
        low, high, x = box.min(0), box.max(0), cq[q]
        q = q[(np.maximum(low - x, 0).sum(1) <= 1) & (np.maximum(x - high, 0).sum(1) <= (0 if longer else 1))]
        if not len(q):
            continue
        c = cut(box) if len(p) > BUCKET else None
        if c:
            side = box[:, c[0]] < c[1]
            todo += [(p[side], q), (p[~side], q)]
            continue
        width = query.shape[1] if not dense else 1
        step = max(1, CELLS // max(1, min(len(p), BUCKET * 8) * width))
        for j in range(0, len(p), BUCKET * 8):
            pj = p[j:j + BUCKET * 8]
            for i in range(0, len(q), step):
                qi = q[i:i + step]
                if dense:
                    same = fq[qi] @ fp[pj].T == shared
                else:
                    same = np.stack([np.minimum(cq[a], cp[pj]).sum(1) for a in qi]) == shared
                a, b = np.nonzero(same)
                a, b = qi[a], pj[b]
                for s in range(0, len(a), max(1, CELLS // query.shape[1])):
                    a1, b1 = a[s:s + max(1, CELLS // query.shape[1])], b[s:s + max(1, CELLS // query.shape[1])]
                    ok = (inserted if longer else replaced)(query[a1], point[b1])
                    yield a1[ok], b1[ok]


# ---------------------------------------------------------------- search
def _deal(trees: dict):
    """Each word to its own leaf (role 0) and to the leaves its searches reach (role 1)."""
    first, start = {}, 0
    for length, nodes in sorted(trees.items()):
        first[length], start = start, start + sum(isinstance(x, int) for x in nodes)

    def run(batches):
        import pandas as pd
        for b in batches:
            size = b["word"].str.len().to_numpy()
            for length in np.unique(size):
                rows = b[size == length]
                q = counts(codes(rows["word"].tolist(), length))
                leaf, row, role = [], [], []
                for points, up, down, kind in ((length, 0, 0, 0), (length, 1, 1, 1), (length + 1, 1, 0, 1)):
                    # lengths the sample missed have one leaf, numbered below zero
                    tree, base = (trees[points], first[points]) if points in trees else ([0], -int(points))
                    for k, found in reach(tree, q, up, down):
                        leaf.append(np.full(len(found), base + k))
                        row.append(found)
                        role.append(np.full(len(found), kind))
                row = np.concatenate(row)
                yield pd.DataFrame({"leaf": np.concatenate(leaf), "size": np.int64(length), "role": np.concatenate(role),
                                    "word": rows["word"].to_numpy()[row], "n": rows["n"].to_numpy()[row]})
    return run


def _search(g):
    """Totals of one leaf: how many near words each word has in it, and the most frequent of them."""
    import pandas as pd

    names, n = g["word"].to_numpy(), g["n"].to_numpy()
    role, size = g["role"].to_numpy(), g["size"].to_numpy()
    point = np.nonzero(role == 0)[0]
    me, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(point):
        length = int(size[point[0]])
        cp = codes(names[point].tolist(), length)
        for short in (0, 1):
            query = np.nonzero((role == 1) & (size == length - short))[0]
            if not len(query):
                continue
            for a, b in near_rows(codes(names[query].tolist(), length - short), cp):
                me += [query[a], point[b]] if short else [query[a]]
                other += [point[b], query[a]] if short else [point[b]]
    me, other = np.concatenate(me), np.concatenate(other)
    # a word may stand here as point and as query: bring both to one number
    words, number = np.unique(names.astype(str), return_inverse=True)
    count = np.zeros(len(words), np.int64)
    count[number] = n
    me, other = number[me], number[other]
    order = np.lexsort((other, -count[other], me))
    me, other = me[order], other[order]
    start = np.nonzero(np.diff(me, prepend=-1))[0]
    total = np.diff(start, append=len(me))
    return pd.DataFrame({"word": words[me[start]].astype(object), "n_near": total, "best_n": count[other[start]], "best": words[other[start]].astype(object)})


def nearest(words: DataFrame, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """``words`` (word, n: distinct, best read from a written table) with n_near, best_n and best: the most frequent near word."""
    total = words.count()
    keep = max(1, math.ceil(total / sample))
    picked = words.where(F.pmod(F.xxhash64("word"), F.lit(keep)) == 0).select("word").collect()
    by_length: dict = {}
    for r in picked:
        by_length.setdefault(len(r[0]), []).append(r[0])
    least = max(LEAST, leaf // keep // 2)
    trees = {k: dealing_tree(counts(codes(sorted(v), k)), least) for k, v in by_length.items()}
    dealt = words.mapInPandas(_deal(trees), "leaf long, size long, role long, word string, n long")
    found = dealt.groupBy("leaf").applyInPandas(_search, "word string, n_near long, best_n long, best string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b"))
    return (words.join(best, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best")))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """word, root: the links word -> form followed to their end; no chain has more than ``2 ** steps`` links."""
    at = checkpoint(forms.select("word", F.col("form").alias("root")))
    for _ in range(steps):
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = checkpoint(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = 199, min_length: int = 6, min_count: int = 5,
             ratio: int = 5, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """Words with the form they are a variant of: word, form, root, n, n_near, form_n.

    ``ratio`` (two at least) is how many times as frequent a form must be.
    """
    words = checkpoint(word_counts(docs, id_col, text_col, drop_every, min_length, min_count).repartition(partitions(docs.sparkSession)))
    near = nearest(words, sample, leaf)
    is_form = F.col("best_n") >= ratio * F.col("n")
    near = checkpoint(near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", "n_near", F.when(is_form, F.col("best_n")).alias("form_n")))
    most = near.agg(F.max("n")).first()[0] or min_count
    links = max(1, math.floor(math.log(max(most, 2) / max(min_count, 1), ratio) + 1e-9)) if most > min_count else 1
    end = roots(near.where("form is not null"), math.ceil(math.log2(links)) if links > 1 else 0)
    return near.join(end, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
