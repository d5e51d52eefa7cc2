"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

1. One pass makes a signature per text: ``bands * rows`` minima of its word
   n-gram hashes, folded into one hash per band.  Texts with the same words
   are one class from here on.
2. Bands are shuffled on (band, hash).  Counts and a checksum of the members
   are aggregated before the shuffle; of several bands with the same members
   only the first is kept.
3. The n-gram sets of the members go to their bands, once per band kept.  A
   band with more than ``BLOCK`` classes is dealt into blocks by hash and its
   pairs of blocks become tasks of their own, so a band with a third of all
   texts is not one task.  A task multiplies membership matrices and returns
   one row per class: links, and the smallest class it is linked to.  A pair
   counts in the first band that its two signatures share, so each link is
   counted once; pairs never become rows.
4. Groups are the connected components of the links, by alternating
   large-star and small-star rounds, each written to the checkpoint folder.

``choose_bands`` gives the fewest hashes with the recall asked for at the
threshold; pairs above it have more.

Defined results: texts with fewer than ``n`` words are one n-gram; texts
without a word (null and empty among them) are linked to none, also not to
each other; a document is an id with a text, so rows that share an id (or have
none) are compared each with its own text (``near_duplicate_rows``), and rows
that repeat both are one document; ``near_duplicates`` sums the documents of an
id up; empty tables give empty ones.  A very long text is one set of n-grams, sent
once per band kept; words of any length are hashed.  Other columns are not read.

A class goes by the first 64 bits of its 128-bit hash.  Its text is taken from
one of its documents, found by id and text hash; a Python task sends each class
once, so many rows that repeat one document do not become one large task.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, runs

#: Words of an n-gram, least similarity, recall of banding at that similarity.
NGRAM, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Classes in a block of a band, and columns of one membership matrix.
BLOCK, COLUMNS = 512, 1 << 14
#: Rows per band at least: fewer would join texts that only share a passage.
LEAST_ROWS = 6

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, least_rows: int = LEAST_ROWS) -> tuple[int, int]:
    """(bands, rows): with ``least_rows`` rows, the fewest bands with 1 - (1 - s**rows)**bands >= recall."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold ** least_rows))), least_rows


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hashes of words; short ones are kept, so many at most."""

    def __missing__(self, word: str) -> int:
        import xxhash
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 48:
            if len(self) > 500_000:
                self.clear()
            self[word] = h
        return h


_WORD_HASHES = _WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    words = _WORD.findall(text or "")
    return np.fromiter(map(_WORD_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def ngrams(words: np.ndarray, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text's word hashes; a shorter text is one n-gram."""
    if not len(words):
        return words
    width = min(n, len(words))
    h = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for j in range(width):
        h = h * _MIX + words[j:len(words) - width + 1 + j]
    return np.unique(_mix(h + np.uint64(width)))


@lru_cache(maxsize=4)
def _families(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 1 << 32, count, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, count, dtype=np.uint32)


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of the minima over ``bands * rows`` hash functions."""
    a, b = _families(bands * rows)
    least = np.full(bands * rows, np.uint32(0xFFFFFFFF))
    h32 = (grams >> np.uint64(32)).astype(np.uint32) ^ grams.astype(np.uint32)
    for at in range(0, len(h32), 1024):
        h = h32[at:at + 1024, None] * a + b
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        np.minimum(least, h.min(axis=0), out=least)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        out = _mix(out * _MIX + least[j::rows][:bands])
    return out


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """__id, __th, k1, k2 (hash of the word sequence), grams (number), bands; from columns __id, __th and __text."""
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for b in batches:
            out = []
            for text in b["__text"]:
                w = word_hashes(text)
                g = ngrams(w, n)
                d = xxhash.xxh128_digest(w.tobytes())
                k1, k2 = np.frombuffer(d, dtype=np.int64)
                out.append((int(k1), int(k2), len(g), band_hashes(g, bands, rows).view(np.int64).tobytes() if len(g) else b""))
            yield pd.concat([b[["__id", "__th"]].reset_index(drop=True), pd.DataFrame(out, columns=["k1", "k2", "grams", "bands"])], axis=1)

    return docs.mapInPandas(sign, f"__id {docs.schema['__id'].dataType.simpleString()}, __th long, k1 long, k2 long, grams long, bands binary")


def verify(sets: list[np.ndarray], threshold: float, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Boolean matrix left x right: whether the Jaccard similarity of two sets reaches the threshold."""
    both = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(both, kind="stable")
    both, owner = both[order], owner[order]
    starts = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.empty(0, dtype=int)
    uses = np.diff(np.r_[starts, len(both)])
    column = np.repeat(np.arange(len(starts)), uses)
    shared = np.repeat(uses > 1, uses)
    column, owner = column[shared], owner[shared]
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(column), COLUMNS):
        # a column cut by this border would only be split in two, which changes no product if it is kept whole
        begin = at if at == 0 else int(np.searchsorted(column, column[at], side="left"))
        end = len(column) if at + COLUMNS >= len(column) else int(np.searchsorted(column, column[at + COLUMNS], side="left"))
        if end <= begin:
            continue
        c, o = column[begin:end], owner[begin:end]
        _, c = np.unique(c, return_inverse=True)
        m = np.zeros((len(sets), int(c.max()) + 1), dtype=np.float32)
        m[o, c] = 1
        common += m[left] @ m[right].T
    size = np.array([len(s) for s in sets], dtype=np.float64)
    union = size[left][:, None] + size[right][None, :] - common
    return common >= threshold * union - 1e-9


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For band rows a (x bands) and b (y bands): the first band in which each pair agrees, or the number of bands."""
    out = np.full((len(a), len(b)), a.shape[1], dtype=np.int16)
    for j in range(a.shape[1] - 1, -1, -1):
        out[a[:, j][:, None] == b[:, j][None, :]] = j
    return out


def _task_links(cls: np.ndarray, copies: np.ndarray, block: np.ndarray, bi: int, bj: int, band: int, bands: list[bytes], grams: list[bytes], threshold: float) -> tuple:
    """Links within one pair of blocks of one band, for classes in ascending order: (links in documents, place of the smallest linked class)."""
    left, right = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
    linked = verify([np.frombuffer(s, dtype=np.uint64) for s in grams], threshold, left, right)
    sign = np.stack([np.frombuffer(s, dtype=np.int64) for s in bands])
    linked &= _first_shared(sign[left], sign[right]) == band
    if bi == bj:
        np.fill_diagonal(linked, False)
    links = np.zeros(len(cls), dtype=np.int64)
    near = np.arange(len(cls))
    links[left] += linked @ copies[right]
    if bi != bj:
        links[right] += linked.T @ copies[left]
    x, y = np.nonzero(linked)
    x, y = left[x], right[y]
    while len(x):  # follow links to the smallest of the component found here
        before = near.copy()
        low = np.minimum(near[x], near[y])
        np.minimum.at(near, x, low)
        np.minimum.at(near, y, low)
        near = near[near]
        if (near == before).all():
            break
    return links, near


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component of ``edges`` (a, b), by alternating star rounds."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = checkpoint(e)
    seen = None
    while True:
        # large star: larger neighbours move to the smallest neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: smaller neighbours and the node itself move to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        e = checkpoint(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                       .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == seen:
            return e.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        seen = now


def near_duplicate_rows(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document (id and text): doc_id, text_hash (``xxhash64`` of the text), class_id (smallest id of its group), n_links (documents linked to it),
    n_copies (documents with the same words), n_rows (rows that repeat the document), n_grams and first (it has the smallest id, then hash, of its group)."""
    bands, rows = choose_bands(threshold, recall)
    texts = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__th"), F.col(text_col).alias("__text"))
    sign = checkpoint(signatures(texts, n, bands, rows))
    ids = sign.groupBy("__id", "__th", "k1", "k2", "grams").agg(F.count(F.lit(1)).alias("n_rows"))
    low = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__th").alias("th"))
    classes = (ids.where("grams > 0").groupBy("k1", "k2").agg(F.min(low).alias("low"), F.count(F.lit(1)).alias("copies"))
               .select("k1", "k2", F.col("k1").alias("cls"), "low", "copies"))
    signed = sign.where("grams > 0").groupBy("k1", "k2").agg(F.first("bands").alias("bands"))
    members = checkpoint(classes.join(signed, ["k1", "k2"]).select("cls", "copies", "k1", "k2", "bands", "low"))

    at = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring(F.col("bands"), i * 8 + 1, F.lit(8)))))
    dealt = members.select("cls", at.alias("band", "key"))
    shared = (dealt.groupBy("key", "band").agg(F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("s1"), F.min("cls").alias("s2"), F.max("cls").alias("s3"))
              .where("m > 1"))
    kept = (shared.groupBy("m", "s1", "s2", "s3").agg(F.min(F.struct("band", "key")).alias("k"))
            .select("k.band", "k.key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("cls", "key"), F.col("blocks")).cast("int")
    own = dealt.join(kept, ["key", "band"]).withColumn("block", block)
    tasks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.col("band").alias("band"), F.col("key").alias("key"), F.col("block").alias("block"), F.least(F.col("block"), j).alias("bi"), F.greatest(F.col("block"), j).alias("bj")))
    places = own.select("cls", F.explode(tasks).alias("t")).groupBy("cls").agg(F.collect_list("t").alias("tasks"))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        columns = ["band", "key", "block", "bi", "bj", "cls", "copies", "bands", "grams"]
        sent = set()
        for b in batches:
            out = []
            for text, cls, copies, k1, k2, sig, tasks in zip(b["__text"], b["cls"], b["copies"], b["k1"], b["k2"], b["bands"], b["tasks"]):
                if (k1, k2) in sent:  # another row of the same document
                    continue
                w = word_hashes(text)
                if tuple(np.frombuffer(xxhash.xxh128_digest(w.tobytes()), dtype=np.int64)) == (k1, k2):  # else the text hashes are equal by chance
                    sent.add((k1, k2))
                    g = ngrams(w, n).tobytes()
                    out += [(t["band"], t["key"], t["block"], t["bi"], t["bj"], cls, copies, sig, g) for t in tasks]
                if len(out) > 2000:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    with_text = (texts.join(members.join(places, "cls"), texts["__id"].eqNullSafe(F.col("low.id")) & (texts["__th"] == F.col("low.th")))
                 .where(F.col("__text").isNotNull()).select("__text", "cls", "copies", "k1", "k2", "bands", "tasks"))
    sent = (with_text.mapInPandas(spread, "band int, key long, block int, bi int, bj int, cls long, copies long, bands binary, grams binary")
            .withColumn("task", F.xxhash64("band", "key", "bi", "bj")))

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in runs(batches, "task"):
            f = f.sort_values(["task", "cls"], kind="stable").drop_duplicates(["task", "cls"])
            task, cls, copies, block = (f[c].to_numpy() for c in ("task", "cls", "copies", "block"))
            bi, bj, band, bands, grams = (f[c].to_list() for c in ("bi", "bj", "band", "bands", "grams"))
            edges = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1), len(f)]
            out = []
            for a, z in zip(edges, edges[1:]):
                if z - a > 1:
                    links, near = _task_links(cls[a:z], copies[a:z], block[a:z], bi[a], bj[a], band[a], bands[a:z], grams[a:z], threshold)
                    some = np.flatnonzero(links)
                    out.append((cls[a:z][some], links[some], cls[a:z][near[some]]))
            if out:
                yield pd.DataFrame(dict(zip(("cls", "links", "near"), map(np.concatenate, zip(*out)))))

    links = checkpoint(sent.repartition("task").sortWithinPartitions("task").mapInPandas(link, "cls long, links long, near long"))
    roots = connected(links.select(F.col("cls").alias("a"), F.col("near").alias("b")))
    counts = links.groupBy("cls").agg(F.sum("links").alias("links"))
    found = (members.drop("bands").join(counts, "cls", "left").join(roots, F.col("cls") == F.col("node"), "left")
             .select("k1", "k2", F.coalesce("root", "cls").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "copies", "low"))
    found = found.join(found.groupBy("root").agg(F.min("low").alias("lowest")), "root").drop("root", "low")
    joined = ids.join(found, ["k1", "k2"], "left")
    return joined.select(F.col("__id").alias("doc_id"), F.col("__th").alias("text_hash"), F.when(F.col("lowest").isNull(), F.col("__id")).otherwise(F.col("lowest.id")).alias("class_id"),
                         F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"), "n_rows", F.col("grams").alias("n_grams"),
                         (F.col("lowest").isNull() | (low == F.col("lowest"))).alias("first"))


def near_duplicates(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct id: doc_id, class_id (smallest id of its group), n_links (documents linked to it), n_copies (documents with the same words).
    An id with several texts has the smallest class id of its documents and the sums of their numbers."""
    d = near_duplicate_rows(docs, n, threshold, recall, id_col, text_col)
    return d.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.sum("n_links").alias("n_links"), F.sum("n_copies").alias("n_copies"))
