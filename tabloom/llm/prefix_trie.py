"""Conversation prefix trie: what conversations share from their first turn on.

A node is a distinct sequence of first turns.  Conversations are sorted by
their turns' digests; neighbours' longest common prefixes (LCP) then hold the
whole trie: taken as edges in descending depth and united by union-find, every
merge of two components makes the branching node at that depth.

* A turn is a 16-byte digest of role and text, and the bytes of its text; no
  text is shuffled.
* Conversations are range-partitioned by (digests, id), so that neither equal
  conversations nor a common opening gather in one task; each partition builds
  its own forest.
* What a partition cannot finish are the nodes it shares with a neighbour: the
  ancestors of its first and last conversation down to the LCP across that
  border.  These are contracted to the branching ones among them, a few per
  partition, and merged by the same union-find over the border edges.  Finished
  nodes whose parent is such a node take its id by a join.
* Branching nodes are expanded to one row per node where they are finished:
  along an unbranched path members stay the same and sums run upwards.
* The hash over the ids that end at a shared node needs them in order: they
  travel as joined pieces of ``PIECE`` bytes and are read as a stream.

Defined results: rows without an id belong to no conversation; null roles and
texts are empty; null turns come first and rows that tie on the turn stand in
the order of their digests, so that the result is fixed; rows that repeat are
turns of their own; an empty table gives no node.  Texts of any length count by
their bytes.  Only the named columns are read.  One conversation's digests (32
bytes a turn) must fit in a task.
"""
from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, partitions

DIGEST = 16
PIECE = 8 << 10
#: Bytes of digests that a partition should hold at most.
PART_BYTES = 32 << 20
EMPTY = hashlib.sha256(b"").hexdigest()
NO_ID = np.iinfo(np.int64).max


# ---------------------------------------------------------------- conversations
def _turns(table: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    mark = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    return table.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), mark.alias("k"), F.octet_length(text).cast("long").alias("size")).alias("t"))


def _packed(turns: Column) -> list:
    """Digests in one binary, text sizes in an array."""
    return [F.unhex(F.array_join(F.transform(turns, lambda t: t["k"]), "")).alias("seq"), F.transform(turns, lambda t: t["size"]).alias("sizes")]


def sequences(table: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, seq, sizes: each conversation's turns in order."""
    t = _turns(table, id_col, turn_col, role_col, text_col).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return t.select("conv_id", *_packed(F.col("t")))


def rebuilt_sequences(table: DataFrame, every: int = 5, most: int = 9, **columns) -> DataFrame:
    """As ``sequences``, each conversation c opened by the first h turns of conversation ``c - c % every``
    and followed by its own after its first h; h is the hash of c modulo ``most``."""
    named = {"id_col": "conv_id", "turn_col": "turn", "role_col": "role", "text_col": "text"} | columns
    t = _turns(table, **named).withColumn("first", F.col("conv_id") - F.col("conv_id") % every)
    t = t.repartition(partitions(table.sparkSession), "first").groupBy("first", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    head = F.first(F.when(F.col("conv_id") == F.col("first"), F.slice("t", 1, most - 1)), ignorenulls=True).over(Window.partitionBy("first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    t = t.withColumn("head", head).withColumn("h", h)
    whole = F.concat(F.slice(F.coalesce("head", F.slice("t", 1, 0)), F.lit(1), F.col("h")), F.slice("t", F.col("h") + 1, F.size("t")))
    return t.select("conv_id", whole.alias("t")).select("conv_id", *_packed(F.col("t")))


# ---------------------------------------------------------------- forests
def shared(a: bytes, b: bytes) -> int:
    """Turns that both begin with."""
    if a[:DIGEST] != b[:DIGEST]:
        return 0
    low, high = 1, min(len(a), len(b)) // DIGEST
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low * DIGEST:mid * DIGEST] == b[low * DIGEST:mid * DIGEST] else (low, mid - 1)
    return low


def united(depth: list, edges: list) -> tuple[list, list]:
    """Union-find over ``edges`` (i, j, depth) in descending depth: (parent, same).

    Merges append branching nodes to ``depth``.  ``same`` leads from nodes that
    turned out to be one to the one that stands for them; parents are resolved.
    """
    n = len(depth)
    group, top, parent, same = list(range(n)), list(range(n)), [-1] * n, list(range(n))

    def find(x):
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    for i, j, d in sorted(edges, key=lambda e: -e[2]):
        a, b = find(i), find(j)
        if a == b:
            continue
        s, t = top[a], top[b]
        if depth[s] > depth[t]:
            s, t = t, s
        if depth[s] > d:
            depth.append(d)
            same.append(len(same))
            parent.append(-1)
            parent[s] = parent[t] = s = len(depth) - 1
        elif depth[t] > d:
            parent[t] = s
        else:
            same[t] = s
        group[b], top[a] = a, s
    for x in range(len(same)):
        y = x
        while same[y] != y:
            y = same[y]
        same[x] = y
    return [p if p < 0 else same[p] for p in parent], same


class Forest:
    """Nodes with totals; a node's path covers the depths from below its parent down to its own."""

    def __init__(self, depth, parent):
        k = len(depth)
        self.depth, self.parent = np.array(depth, np.int64), np.array(parent, np.int64)
        self.n, self.kids, self.leaves, self.below = (np.zeros(k, np.int64) for _ in range(4))
        self.conv, self.ends = np.full(k, NO_ID), [EMPTY] * k
        self.sizes = [None] * k  # text bytes of the depths up to the node's own, as far as they are known

    def path(self, x: int) -> np.ndarray:
        """Text bytes from below the parent to the node, the root's own depth counting 0."""
        p = self.parent[x]
        return self.sizes[x][len(self.sizes[x]) - int(self.depth[x] - (self.depth[p] if p >= 0 else -1)):]

    def settle(self, nodes, open_nodes=frozenset()) -> None:
        """Totals upwards, deepest first; nodes left open pass nothing on."""
        for x in sorted(nodes, key=lambda x: -self.depth[x]):
            p = self.parent[x]
            if p >= 0 and self.sizes[p] is None:
                self.sizes[p] = self.sizes[x][:len(self.sizes[x]) - int(self.depth[x] - self.depth[p])]
            if x in open_nodes:
                continue
            if not self.kids[x]:
                self.leaves[x] = 1
            if p >= 0:
                self.n[p] += self.n[x]
                self.kids[p] += 1
                self.leaves[p] += self.leaves[x]
                self.below[p] += self.below[x] + (self.n[x] - 1) * int(self.path(x).sum())
                self.conv[p] = min(self.conv[p], self.conv[x])

    def rows(self, nodes, open_nodes=frozenset()) -> dict:
        """Columns of the result for ``nodes``, one row per depth of their paths; ``ref`` is the open parent that ``parent_conv_id`` waits for, or the node."""
        if not len(nodes):
            return {}
        x = np.asarray(nodes)
        paths = [self.path(i) for i in nodes]
        length = np.array([len(p) for p in paths])
        node, end = np.repeat(x, length), np.cumsum(length)
        up = np.repeat(end, length) - 1 - np.arange(end[-1])  # steps above the node
        sums = np.concatenate([np.cumsum(p[::-1])[::-1] for p in paths])
        over = self.parent[node]
        first = up == np.repeat(length, length) - 1
        waits = first & np.isin(over, list(open_nodes))
        none = first & (over < 0)
        return {"depth": self.depth[node] - up, "conv_id": self.conv[node], "n_convs": self.n[node], "n_leaves": self.leaves[node],
                "n_children": np.where(up == 0, self.kids[node], 1), "saved_tokens": self.below[node] + (self.n[node] - 1) * sums,
                "parent_conv_id": np.where(first, self.conv[over], self.conv[node]), "none": none | waits, "waits": waits, "over": over, "node": node, "last": up == 0,
                "ends_sha256": np.array([self.ends[i] if u == 0 else EMPTY for i, u in zip(node, up)], object)}


FIELDS = ("kind int, pid int, ref long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "ends_sha256 string, sizes array<long>, above long, border long")
ROW, WAITING, OPEN, IDS = range(4)
COLUMNS = [f.split()[0] for f in FIELDS.split(", ")]


def _frame(kind, pid, **columns):
    import pandas as pd

    size = len(columns["ref"])
    out = {c: columns.get(c, [None] * size) for c in COLUMNS}
    out |= {"kind": [kind] * size, "pid": [pid] * size}
    for c in COLUMNS:
        if c not in ("kind", "pid", "ends_sha256", "sizes"):
            out[c] = pd.array(out[c], "Int64")
    return pd.DataFrame(out)


def _result(rows: dict, pick: np.ndarray, kind: int, pid: int, ref: np.ndarray):
    import pandas as pd

    columns = {c: rows[c][pick] for c in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")}
    over = pd.array(rows["parent_conv_id"][pick], "Int64")
    over[rows["none"][pick]] = pd.NA
    return _frame(kind, pid, ref=ref[pick], parent_conv_id=over, **columns)


def _classes(batches):
    """Distinct sequences of a sorted partition: seq, sizes, the first id, their number, the ids joined."""
    out, pid = [], None
    for b in batches:
        for p, seq, sizes, conv in zip(b["pid"], b["seq"], b["sizes"], b["conv_id"]):
            pid, seq = int(p), bytes(seq)
            if out and out[-1][0] == seq:
                out[-1][3].append(int(conv))
            else:
                out.append((seq, np.concatenate([np.zeros(1, np.int64), np.asarray(sizes, np.int64)]), int(conv), [int(conv)]))
    return pid, out


def _partition(borders: dict):
    """The forest of one partition; ``borders`` has the turns each partition shares with those before and behind it."""
    def run(batches):
        pid, classes = _classes(batches)
        if pid is None:
            return
        before, behind = (max(b, 0) for b in borders[pid])
        k = len(classes)
        # after the classes come stand-ins for the two border nodes and the root
        depth = [len(c[0]) // DIGEST for c in classes] + [before, behind, 0]
        edges = [(i, i + 1, shared(classes[i][0], classes[i + 1][0])) for i in range(k - 1)]
        parent, same = united(depth, edges + [(0, k, before), (k - 1, k + 1, behind), (0, k + 2, 0)])
        f = Forest(depth, parent)
        for i, (_, sizes, conv, ids) in enumerate(classes):
            x = same[i]
            f.n[x], f.conv[x], f.sizes[x] = len(ids), conv, sizes
        for i, c in ((k, classes[0]), (k + 1, classes[-1]), (k + 2, classes[0])):
            x = same[i]
            f.sizes[x] = c[1][:depth[i] + 1] if f.sizes[x] is None else f.sizes[x]
        left, right, open_nodes = same[k], same[k + 1], set()
        for x in (left, right):
            while x >= 0:
                open_nodes.add(x)
                x = int(f.parent[x])
        nodes = [x for x in range(len(depth)) if same[x] == x]
        done = [x for x in nodes if x not in open_nodes]
        for i, (_, _, _, ids) in enumerate(classes):
            text = ",".join(map(str, ids))
            if same[i] not in open_nodes:
                f.ends[same[i]] = hashlib.sha256(text.encode()).hexdigest()
                continue
            step = max(1, PIECE // 20)
            pieces = [",".join(map(str, ids[a:a + step])) for a in range(0, len(ids), step)]
            yield _frame(IDS, pid, ref=[same[i]] * len(pieces), depth=list(range(len(pieces))), ends_sha256=pieces)
        f.settle(nodes, open_nodes)
        for a in range(0, len(done), 20_000):
            r = f.rows(done[a:a + 20_000], open_nodes)
            for pick, kind, ref in ((~r["waits"], ROW, r["node"]), (r["waits"], WAITING, r["over"])):
                if pick.any():
                    yield _result(r, pick, kind, pid, ref)
        x = sorted(open_nodes, key=lambda x: f.depth[x])
        lone = lambda v: [None if v[i] == NO_ID else int(v[i]) for i in x]
        yield _frame(OPEN, pid, ref=x, conv_id=lone(f.conv), depth=f.depth[x], n_convs=f.n[x], n_children=f.kids[x], n_leaves=f.leaves[x], saved_tokens=f.below[x],
                     sizes=[f.path(i) for i in x], above=f.parent[x], border=[(i == left) + 2 * (i == right) for i in x])
    return run


def _borders(sorted_rows: DataFrame) -> dict:
    """Turns that each partition's first and last sequence share with the neighbours; a few numbers per partition."""
    ends = sorted_rows.groupBy("pid").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    ends = ends.withColumn("prev", F.lag("last").over(Window.orderBy("pid")))

    def run(batches):
        for b in batches:
            yield b.assign(n=[-1 if p is None else shared(bytes(p), bytes(x)) for p, x in zip(b["prev"], b["first"])])[["pid", "n"]]

    found = sorted((r[0], r[1]) for r in ends.mapInPandas(run, "pid int, n long").collect())
    behind = [n for _, n in found[1:]] + [-1]
    return {pid: (n, m) for (pid, n), m in zip(found, behind)}


def _merge(borders: dict):
    """Contracted forests of all partitions, in order: their nodes united across the borders, as rows and as (pid, ref) -> node."""
    def run(batches):
        import pandas as pd

        b = [x for x in batches if len(x)]
        if not b:
            return
        b = pd.concat(b, ignore_index=True).sort_values(["pid", "ref"], kind="stable").reset_index(drop=True)
        place = {(p, r): i for i, (p, r) in enumerate(zip(b["pid"], b["ref"]))}
        depth = [int(d) for d in b["depth"]]
        edges = [(i, place[p, a], depth[place[p, a]]) for i, (p, a) in enumerate(zip(b["pid"], b["above"])) if a >= 0]
        left = {p: i for i, (p, x) in enumerate(zip(b["pid"], b["border"])) if x & 1}
        right = {p: i for i, (p, x) in enumerate(zip(b["pid"], b["border"])) if x & 2}
        pids = sorted(left)
        edges += [(right[p], left[q], max(borders[q][0], 0)) for p, q in zip(pids, pids[1:])]
        parent, same = united(depth, edges)
        f = Forest(depth, parent)
        for i in range(len(b)):
            x = same[i]
            conv = b["conv_id"][i]
            f.n[x] += b["n_convs"][i]
            f.kids[x] += b["n_children"][i]
            f.leaves[x] += b["n_leaves"][i]
            f.below[x] += b["saved_tokens"][i]
            f.conv[x] = min(f.conv[x], NO_ID if pd.isna(conv) else int(conv))
            own = np.asarray(b["sizes"][i], np.int64)
            if f.sizes[x] is None or len(own) > len(f.sizes[x]):
                f.sizes[x] = own
        nodes = [x for x in range(len(depth)) if same[x] == x]
        f.settle(nodes)
        r = f.rows(nodes)
        yield _result(r, np.ones(len(r["depth"]), bool), ROW, -1, np.where(r["last"], r["node"], -1))
        yield _frame(OPEN, -1, ref=same, conv_id=f.conv[same], depth=b["ref"], border=b["pid"])
    return run


def _streamed(batches):
    """(node, hash of its ids) from pieces sorted by node and order; nothing but the running hash is kept."""
    import pandas as pd

    node, h = None, None
    for b in batches:
        out = []
        for x, text in zip(b["node"], b["text"]):
            if x != node:
                if node is not None:
                    out.append((node, h.hexdigest()))
                node, h = x, hashlib.sha256(text.encode())
            else:
                h.update(b"," + text.encode())
        yield pd.DataFrame(out, columns=["node", "sha"])
    if node is not None:
        yield pd.DataFrame([(node, h.hexdigest())], columns=["node", "sha"])


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(seqs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per trie node of ``seqs`` (conv_id, seq, sizes): conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (bytes that sharing saves in the subtree) and ends_sha256."""
    spark = seqs.sparkSession
    seqs = checkpoint(seqs)
    total = seqs.agg(F.sum(F.octet_length("seq") + 16)).first()[0] or 0
    parts = max(partitions(spark), -(-total // part_bytes))
    ordered = checkpoint(seqs.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id").withColumn("pid", F.spark_partition_id()))
    borders = _borders(ordered)
    made = checkpoint(ordered.mapInPandas(_partition(borders), FIELDS))
    merged = checkpoint(made.where(F.col("kind") == OPEN).repartition(1).mapInPandas(_merge(borders), FIELDS))
    known = merged.where(F.col("kind") == OPEN).select(F.col("border").cast("int").alias("pid"), F.col("depth").alias("ref"), F.col("ref").alias("node"), F.col("conv_id").alias("over"))
    waiting = made.where(F.col("kind") == WAITING).drop("parent_conv_id").join(known, ["pid", "ref"]).withColumnRenamed("over", "parent_conv_id")
    ids = made.where(F.col("kind") == IDS).join(known.drop("over"), ["pid", "ref"]).select("node", "pid", F.col("depth").alias("part"), F.col("ends_sha256").alias("text"))
    ids = ids.repartition(partitions(spark), "node").sortWithinPartitions("node", "pid", "part").select("node", "text").mapInPandas(_streamed, "node long, sha string")
    top = merged.where(F.col("kind") == ROW).join(ids, F.col("ref") == F.col("node"), "left").withColumn("ends_sha256", F.coalesce("sha", "ends_sha256"))
    return made.where(F.col("kind") == ROW).select(*RESULT).unionByName(waiting.select(*RESULT)).unionByName(top.select(*RESULT))
