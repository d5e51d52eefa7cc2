"""Web archives: WARC records written and read back, and a merged capture index.

Writing.  Payload digests (SHA-1) are grouped; of records with equal payloads
of at least ``least_bytes`` the one with the largest id is the response and
the others are revisits that refer to it, without a body.  Records are text
rows ``head CRLF CRLF payload``, made by column expressions, so no batch of
payloads is held, and Spark's text writer ends each with CRLF
CRLF, the record separator of the format; files are gzip streams.  Pages are
dealt to files by id, so that files hold about ``FILE_BYTES``.

Reading.  Archives are read as binary files, one to a batch, unpacked in
pieces and cut by ``Content-Length``, never by the separator, so payloads may
hold anything and one record is held at a time.  Digests and lengths
are taken anew from the bodies; a revisit takes them from the record that it
refers to.

Index.  Each file's captures are sorted by (URL key, timestamp, id): a run.
Range borders come from a bounded sample of sort keys (a URL with a third of
all captures is cut within, by timestamp and id); every run is sent to the
ranges as sorted, packed pieces.  A range merges its runs with a loser tree
that unpacks one piece of each run at a time, so its output, and by the order of ranges the whole index,
is globally ordered.  Each capture gets its place in the index.

Defined results: null html is an empty payload; null urls count as empty;
repeated rows are records of their own that share the id, and the digest
decides; empty tables give empty tables.  A very long page is one record, held
whole once in a task.  Columns other than id, url and html are not read.
"""
from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import checkpoint, let, partitions

#: Payload bytes per archive file, about.
FILE_BYTES = 16_000_000
#: Captures that an index range should hold at most, sort keys sampled per range to find the borders, and in all.
RANGE_ROWS, SAMPLE, MOST_SAMPLE = 500_000, 60, 400_000
#: Rows of the frames that tasks give out, and captures in one packed piece of a run.
BATCH = 2_000
EPOCH = "2024-01-01"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def url_key(url: str) -> str:
    """Sort key of a URL: host names reversed, then port, path and query, in lower case; scheme, www and fragment go."""
    try:
        parts = urlsplit(url if "//" in url else "//" + url)
    except ValueError:  # not a URL by the standard: its own key
        return url.lower()
    try:
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        host, port = parts.netloc.lower(), None
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "") + ")" + (parts.path or "/")
    return (key + (f"?{parts.query}" if parts.query else "")).lower()


def _base32(hexed: Column) -> Column:
    """Upper-case base32 of a 160-bit digest given as 40 hex digits: five of them make four letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def four(x: Column) -> Column:
        return F.concat(*[F.substring(letters, (F.shiftright(x, n).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for n in (15, 10, 5, 0)])

    return F.concat(*[let(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int"), four) for i in range(8)])


def _record_id(page: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page.cast("string"), F.lit(""))))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _stamp(page: Column) -> Column:
    """WARC-Date of a page without a time of its own: so many seconds after EPOCH as its id says, within a year."""
    s = F.pmod(F.coalesce(page, F.lit(0)), F.lit(31_536_000))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    day = F.date_add(F.lit(EPOCH).cast("date"), F.floor(s / 86_400).cast("int"))
    return F.concat(day.cast("string"), F.lit("T"), two(F.floor(s % 86_400 / 3600)), F.lit(":"), two(F.floor(s % 3600 / 60)), F.lit(":"), two(s % 60), F.lit("Z"))


def record(page: Column, url: Column, payload: Column, sha1_hex: Column, refers_to: Column) -> Column:
    """One WARC record without its closing separator; a revisit (``refers_to`` not null) has no body."""
    revisit, line = refers_to.isNotNull(), F.lit("\r\n")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], line)
    body = F.when(revisit, F.lit("")).otherwise(payload)
    more = F.when(revisit, F.concat(text("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), text("WARC-Refers-To: ", _record_id(refers_to)),
                                    text("X-Refers-To-Page: ", refers_to.cast("string")))).otherwise(F.lit(""))
    return F.concat(text("WARC/1.1"), text("WARC-Type: ", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), text("WARC-Record-ID: ", _record_id(page)),
                    text("WARC-Date: ", _stamp(page)), text("WARC-Target-URI: ", F.translate(url, "\r\n", "")), text("WARC-Payload-Digest: sha1:", _base32(sha1_hex)),
                    text("Content-Type: text/html; charset=utf-8"), text("X-Page-ID: ", F.coalesce(page.cast("string"), F.lit(""))), more,
                    text("Content-Length: ", F.octet_length(body).cast("string")), line, body)


def read_records(chunks: Iterable[bytes]) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, body) of the records of one plain archive, given in pieces; holds one record and one piece."""
    held, start, source = bytearray(), 0, iter(chunks)

    def until(size: int) -> bool:
        while len(held) < size:
            piece = next(source, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while until(1):
        end = held.find(b"\r\n\r\n")
        while end < 0:
            if not until(len(held) + 1):
                raise ValueError("archive ends within a record's head")
            end = held.find(b"\r\n\r\n")
        lines = bytes(held[:end]).decode("utf-8").split("\r\n")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(fields["Content-Length"])
        if not until(end + 4 + size):
            raise ValueError("archive ends within a record's body")
        yield start, end + 4 + size, fields, bytes(held[end + 4:end + 4 + size])
        until(end + 8 + size)
        del held[:end + 8 + size]
        start += end + 8 + size


def unpacked(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The content of a plain or gzip archive in pieces of at most ``step`` bytes."""
    if data[:2] != b"\x1f\x8b":
        for a in range(0, len(data), step):
            yield data[a:a + step]
        return
    rest = memoryview(data)
    while rest:
        d = zlib.decompressobj(31)
        for a in range(0, len(rest), step):
            piece = bytes(rest[a:a + step])
            while piece:
                yield d.decompress(piece, step)
                piece = d.unconsumed_tail
            if d.eof:
                rest = rest[min(a + step, len(rest)) - len(d.unused_data):]
                break
        else:
            rest = rest[len(rest):]


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write a WARC record per row of ``pages`` into gzip archives under ``folder``."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    narrow = p.select("page_id", F.octet_length("html").alias("size"), F.sha1(F.col("html").cast("binary")).alias("digest"))
    whole = narrow.agg(F.sum("size")).first()[0] or 0
    files = max(1, -(-whole // FILE_BYTES))
    response = narrow.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("owner"))
    # one key for the join and for dealing pages to files, so that the payloads are shuffled once
    key = F.xxhash64("page_id", "digest").alias("key")
    marked = narrow.join(response, "digest", "left").groupBy("page_id", "digest").agg(F.max("owner").alias("owner"))
    marked = marked.select(key, F.col("digest").alias("__digest"), "owner")
    dealt = p.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("key", key)
    dealt = dealt.repartition(max(files, partitions(pages.sparkSession)), "key")
    both = dealt.join(marked, (dealt["key"] == marked["key"]) & (F.col("digest") == F.col("__digest")), "left").select("page_id", "url", "html", "digest", "owner")

    other = F.when(F.col("owner") != F.col("page_id"), F.col("owner"))
    both = both.withColumn("refers_to", F.when(F.col("page_id").isNull(), F.col("owner")).otherwise(other))
    lines = both.select(record(F.col("page_id"), F.col("url"), F.col("html"), F.col("digest"), F.col("refers_to")).alias("value"))
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").mode("error").text(folder)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record: page_id, url, urlkey, timestamp, record_type, refers_to, digest (stated), payload_bytes, payload_digest (of the body), file, record_offset, record_length."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = lambda x: int(x) if x else None
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                out = []
                for offset, length, f, body in read_records(unpacked(bytes(content))):
                    out.append((number(f["X-Page-ID"]), f["WARC-Target-URI"], url_key(f["WARC-Target-URI"]), f["WARC-Date"].translate({45: None, 58: None, 84: None, 90: None}), f["WARC-Type"],
                                number(f.get("X-Refers-To-Page", "")), f["WARC-Payload-Digest"].removeprefix("sha1:"), len(body), payload_digest(body), path.rsplit("/", 1)[-1], offset, length))
                    if len(out) == BATCH:
                        yield frame(out)
                        out = []
                yield frame(out)

    def frame(out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=[c.split()[0] for c in RECORD.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(folder).select("path", "content")
    return files.mapInPandas(parse, RECORD)


RECORD = "page_id long, url string, urlkey string, timestamp string, record_type string, refers_to long, digest string, payload_bytes long, payload_digest string, file string, record_offset long, record_length long"


class LoserTree:
    """k-way merge of sorted streams: a tournament whose inner nodes keep the losers, one replay per item."""

    def __init__(self, streams: Iterable[Iterable]):
        self.streams = [iter(x) for x in streams]
        self.head = [next(x, None) for x in self.streams]  # items are never None
        self.k = len(self.streams)
        self.tree = [-1] * max(self.k, 1)  # node 0: the winner
        for leaf in range(self.k - 1, -1, -1):
            self._replay(leaf)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:  # while building: wait here for the other side
                self.tree[node] = winner
                return
            if self._before(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while self.k and self.head[self.tree[0]] is not None:
            w = self.tree[0]
            yield self.head[w]
            self.head[w] = next(self.streams[w], None)
            self._replay(w)


def _opened(pieces: list[bytes]) -> Iterator:
    """The items of one run from its packed pieces, one piece unpacked at a time."""
    import pickle
    for x in pieces:
        yield from pickle.loads(zlib.decompress(x))


def merged_index(captures: DataFrame) -> DataFrame:
    """``captures`` (urlkey, timestamp, page_id, file, record_offset, ...) with ``index_place``: 0.. in global order."""
    spark = captures.sparkSession
    total = captures.count()
    ranges = max(partitions(spark), -(-total // RANGE_ROWS))
    key = F.struct("urlkey", "timestamp", F.coalesce("page_id", F.lit(-1)).alias("page"), "file", "record_offset")
    step = max(1, total // min(SAMPLE * ranges, MOST_SAMPLE))
    sampled = captures.where(F.pmod(F.xxhash64("file", "record_offset"), F.lit(step)) == 0).select(key.alias("k")).select("k.*").collect()
    keys = sorted(tuple(r) for r in sampled)
    borders = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []
    names = captures.columns
    entry = captures.schema

    def cut_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Locally sorted runs, one row per run and range."""
        import bisect
        import pickle
        for b in batches:
            rows = [tuple(None if pd.isna(x) else x for x in r) for r in b.itertuples(index=False, name=None)]
            u, t, p, f, o = (names.index(x) for x in ("urlkey", "timestamp", "page_id", "file", "record_offset"))
            run = sorted(((r[u], r[t], -1 if r[p] is None else int(r[p]), r[f], int(r[o])), r) for r in rows)
            ks = [x[0] for x in run]
            edges = [0, *(bisect.bisect_left(ks, x) for x in borders), len(run)]
            number = run[0][0][3:] if run else ()  # file and offset of the first: no other run has them
            pack = lambda x: zlib.compress(pickle.dumps(x, protocol=4), 1)
            out = [(i, repr(number), at, min(z - at, BATCH), pack(run[at:min(z, at + BATCH)])) for i, (a, z) in enumerate(zip(edges, edges[1:])) for at in range(a, z, BATCH)]
            yield pd.DataFrame(out, columns=["range", "run", "part", "n", "block"])

    blocks = checkpoint(captures.mapInPandas(cut_runs, "range int, run string, part int, n long, block binary"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.groupBy("range").agg(F.sum("n").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    dealt = blocks.join(starts, "range").repartition(ranges, "range").sortWithinPartitions("range", "run", "part")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from .common import runs
        for frame in runs(batches, "range"):
            for _, one in frame.groupby("range"):
                start, out = int(one["start"].iloc[0]), []
                for place, (_, row) in enumerate(LoserTree([_opened(list(x)) for _, x in one.groupby("run")["block"]])):
                    out.append((*row, start + place))
                    if len(out) == BATCH:
                        yield frame_of(out)
                        out = []
                if out:
                    yield frame_of(out)

    def frame_of(out: list) -> pd.DataFrame:
        f = pd.DataFrame(out, columns=[*names, "index_place"])
        return f.astype({c.name: "Int64" for c in entry if c.dataType.simpleString() == "bigint"})

    return dealt.mapInPandas(merge, ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in entry) + ", index_place long")


def archive_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write, read back and index: one row per page in capture order.

    ``folder`` (default: a new one in the checkpoint folder) holds the
    archives; they stay there, since the result reads them.
    """
    spark = pages.sparkSession
    folder = folder or archive_folder(spark)
    write_archives(pages, folder, least_bytes, id_col, url_col, html_col)
    with small_batches(spark, 1):  # a row is an archive
        captures = checkpoint(read_archives(spark, folder).drop("url"))
    index = checkpoint(merged_index(captures))
    bodies = index.where("record_type = 'response'").groupBy(F.col("page_id").alias("r_page"), F.col("payload_digest").alias("r_digest")).agg(F.max("payload_bytes").alias("r_bytes"))
    out = index.join(bodies, (F.col("refers_to") == F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left")
    revisit = F.col("record_type") == "revisit"
    return out.select("page_id", F.when(revisit, F.col("r_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                      F.when(revisit, F.col("r_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to",
                      "urlkey", "timestamp", "file", "record_offset", "record_length", "index_place")
