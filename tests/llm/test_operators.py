"""The training-data operators against brute force, on odd rows and on the small tables."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tabloom.llm import line_dedup, ngram_join, packing, piece_codec, pii, quality, shards, suffix_dedup, syncmers, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, h string, band string, k1 string, start string, gone string, text_crc32 string, spot string, __t string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, texts, ids=None):
    """Documents with extra columns whose names clash with the operators' own."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "hot", 1, 2, 3, "h", "b", "k", "s", "g", "c", "p", "t") for i, t in zip(ids, texts)], SCHEMA).repartition(3)


def prose(rng, n, words=200):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    base = "\n".join(prose(rng, 30) for _ in range(6))
    long_text = "\n".join(prose(rng, 40) for _ in range(250))
    near = base.replace("w1 ", "x1 ", 2)
    return [None, "", " \t\r\n", "a", "one two", base, base, base, near, base + "\nmail bob@example.org", long_text, long_text, None, "",
            "x" * 5000, "1" * 3000, "Ünï çödé 日本 " * 30, "same line\n" * 12, "  lead and trail  ", "<|endoftext|> </s> ▁ ▁▁", "\x00 zero", "a\r\n\r\nb"]


@pytest.fixture(scope="module")
def small(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    return d, {r["doc_id"]: r["text"] for r in d.collect()}


def rows(df, key="doc_id"):
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=lambda r: (r[key] is None, r[key]))


EMPTY_OK = {
    "op1": quality.quality, "op2": shards.shard, "op3": line_dedup.line_dedup, "op4": suffix_dedup.dedup,
    "op5": lambda d: packing.pack(d, public_tokenizers.path("byte_bpe_50k.json")), "op6": pii.pii_table, "op8": ngram_join.near_duplicates,
    "op9": lambda d: piece_codec.encode_table(d, public_tokenizers.path("piece_bpe_32k.model")), "op10": syncmers.fingerprints}


@pytest.mark.parametrize("op", sorted(EMPTY_OK))
def test_empty_table_and_null_ids(spark, op):
    run = EMPTY_OK[op]
    assert run(table(spark, [])).collect() == []
    got = run(table(spark, [None, "", "some words here", "some words here", "x"], [None, None, 7, 7, None])).collect()
    assert len(got) == (2 if op == "op8" else 5)


# ---------------------------------------------------------------- 1
def brute_quality(text):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(hit), "base_failed": len(w) < 20 or 100 * len(hit) > 30 * len(w)}


def test_quality(spark, odd, small):
    rng = random.Random(1)
    texts = odd + [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(80)] + list(small[1].values())
    got = rows(quality.quality(table(spark, texts)))
    for r, t in zip(got, texts):
        want = brute_quality(t)
        assert {k: r[k] for k in want} == want, t
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])


def test_quality_keeps_columns(spark, odd):
    d = table(spark, odd + ["the end of " + prose(random.Random(1), 40) + " and the rest"])
    kept = quality.keep(d)
    assert kept.schema == d.schema
    want = [r["doc_id"] for r in rows(quality.quality(d)) if r["kept"]]
    assert [r["doc_id"] for r in rows(kept)] == want and want


def test_quality_judges_by_label(spark):
    """Rows labelled good stay, and most labelled bad go."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r["quality"]: (r["k"], r["n"], r["ok"]) for r in quality.quality(d).join(lab, "doc_id").groupBy("quality").agg(
        F.sum(F.col("kept").cast("int")).alias("k"), F.count(F.lit(1)).alias("n"), F.sum((~F.col("base_failed")).cast("int")).alias("ok")).collect()}
    assert got[1][0] >= 0.98 * got[1][2]  # of those that the base rule leaves
    assert got[0][0] <= 0.4 * got[0][1]


# ---------------------------------------------------------------- 2
def check_shards(spark, texts, n):
    got = rows(shards.shard(table(spark, texts), n))
    h = {r["doc_id"]: r["h"] for r in table(spark, texts).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    sizes = defaultdict(int)
    for r, t in zip(got, texts):
        b = (t or "").encode()
        assert r["size"] == len(b) + 1 and r["text_crc32"] == zlib.crc32(b) and r["law"] == "bytes" and r["grown_shard"] is None
        sizes[h[r["doc_id"]]] += r["size"]
    order = sorted(sizes)

    def fits(c):
        used, load = 1, 0
        for x in order:
            if sizes[x] > c:
                return False
            if load + sizes[x] > c:
                used, load = used + 1, 0
            load += sizes[x]
        return used <= n
    best = next(c for c in range(max(sizes.values()), sum(sizes.values()) + 1) if fits(c))
    loads, slots, of = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of[h[r["doc_id"]]].add(r["shard"])
    assert max(loads.values()) == best and set(loads) <= set(range(n))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    placed = [of[x] for x in order]
    assert all(len(p) == 1 for p in placed) and placed == sorted(placed, key=min)


def test_shards(spark, odd, small, monkeypatch):
    rng = random.Random(3)
    check_shards(spark, odd, 8)
    check_shards(spark, ["hot " * 50] * 40 + [prose(rng, rng.randrange(1, 40)) for _ in range(60)], 8)
    monkeypatch.setattr(shards, "FIRST_BITS", 3)
    monkeypatch.setattr(shards, "SPLIT_BITS", 2)
    monkeypatch.setattr(shards, "SLOT_ROWS", 5)
    check_shards(spark, list(small[1].values()), 8)
    check_shards(spark, [prose(rng, rng.randrange(1, 40)) for _ in range(90)], 5)


# ---------------------------------------------------------------- 3
def brute_lines(docs, window):
    seen, gone = {}, defaultdict(set)
    for d, t in docs:
        lines = [] if t is None else t.split("\n")
        idx = [i for i, x in enumerate(lines) if WORD.search(x)]
        for a in range(len(idx) - window + 1):
            key = tuple(lines[i] for i in idx[a:a + window])
            if seen.setdefault(key, (d, a)) != (d, a):
                gone[d] |= set(idx[a:a + window])
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in docs}, gone


@pytest.mark.parametrize("window", [1, 2, 3])
def test_line_dedup(spark, odd, small, window):
    rng = random.Random(window)
    texts = odd + ["\n".join(rng.choice(["", " ", "a", "b", "c", "d e"]) for _ in range(rng.randrange(1, 14))) for _ in range(60)] + list(small[1].values())
    want, gone = brute_lines(list(enumerate(texts)), window)
    d = table(spark, texts)
    got = line_dedup.line_dedup(d, window)
    assert got.columns[:len(d.columns)] == d.columns
    for r in rows(got):
        i = r["doc_id"]
        assert r["text"] == want[i] and r["__n_removed"] == len(gone[i]) and r["gone"] == "g"


def test_line_dedup_compares_repeated_fingerprints_only(spark):
    """A fingerprint at one position counts once, however many windows it wins."""
    own = "\n".join(f"line {i}" for i in range(200))
    assert line_dedup.candidates(table(spark, [own])).count() == 0
    assert line_dedup.candidates(table(spark, [own, own])).count() == 2 * 198


def test_line_dedup_rows_that_share_an_id(spark):
    for i in (None, 7):
        texts = ["r1\nr2\nr3\nown a", "own b\nr1\nr2\nr3", "own c\nown d\nown e\nown f"]
        got = {r["text"]: r["__n_removed"] for r in line_dedup.line_dedup(table(spark, texts, [i] * 3)).collect()}
        assert got in ({texts[0]: 0, "own b": 3, texts[2]: 0}, {"own a": 3, texts[1]: 0, texts[2]: 0})


# ---------------------------------------------------------------- 4
def brute_spans(texts, length):
    where = defaultdict(int)
    data = [(t or "").encode() for t in texts]
    for b in data:
        for p in range(len(b) - length + 1):
            where[b[p:p + length]] += 1
    out = []
    for b in data:
        cover = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - length + 1):
            if where[b[p:p + length]] > 1:
                cover[p:p + length] = True
        n = int((cover[1:] & ~cover[:-1]).sum() + cover[0])
        out.append((len(b), int(cover.sum()), n, hashlib.sha256(bytes(x for x, c in zip(b, cover) if not c)).hexdigest()))
    return out


def brute_shared(texts, length):
    """(bytes covered by a string that also stands in a different text, longest run of them)."""
    data = [(t or "").encode() for t in texts]
    where = defaultdict(set)
    for b in set(data):
        for p in range(len(b) - length + 1):
            where[b[p:p + length]].add(b)
    out = []
    for b in data:
        cover = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - length + 1):
            if len(where[b[p:p + length]]) > 1:
                cover[p:p + length] = True
        runs = [len(x) for x in re.findall("1+", "".join("1" if x else "0" for x in cover))]
        out.append((sum(runs), max(runs, default=0)))
    return out


@pytest.mark.parametrize("hot", [50_000, 2])
def test_suffix_dedup_small_strings(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(hot)
    common = ["".join(rng.choice("abcd") for _ in range(n)) for n in (30, 45, 80)]
    texts = [None, "", "x" * 19, "x" * 20, "y" * 70, common[0], common[0], common[2]]
    for _ in range(50):
        t = ""
        for _ in range(rng.randrange(1, 5)):
            c = rng.choice(common)
            a, z = sorted(rng.randrange(len(c) + 1) for _ in range(2))
            t += rng.choice([c, c[a:z], "".join(rng.choice("abcdé") for _ in range(rng.randrange(25)))])
        texts.append(t)
    for shared in (20, 13):
        got = rows(suffix_dedup.dedup(table(spark, texts), 20, 6, shared=shared))
        assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == brute_spans(texts, 20)
        assert [(r["n_shared"], r["longest_shared"]) for r in got] == brute_shared(texts, shared)


def test_suffix_dedup_default(spark, odd, small):
    texts = odd + list(small[1].values())
    got = rows(suffix_dedup.dedup(table(spark, texts)))
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == brute_spans(texts, 400)
    assert [(r["n_shared"], r["longest_shared"]) for r in got] == brute_shared(texts, suffix_dedup.SHARED)


def test_deep_shallow_order():
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    strings += [b"prefix" * 8 + s for s in strings] + strings[:20]
    words = suffix_dedup.as_words(strings, 112)
    for shallow, small_ in ((8, 24), (1, 1), (3, 300)):
        order = suffix_dedup.deep_shallow_order(strings, words, np.arange(len(strings)), shallow, small_)
        assert [strings[i] for i in order] == sorted(strings)


def test_anchors_are_local():
    rng = random.Random(4)
    t = bytes(rng.randrange(256) for _ in range(5000))
    p, h = suffix_dedup.anchors(t)
    q, g = suffix_dedup.anchors(b"0" * 777 + t + b"1" * 50)
    assert set(zip(p + 777, h)) <= set(zip(q, g))
    step, suffix_dedup.STEP = suffix_dedup.STEP, 700
    try:
        again = suffix_dedup.anchors(t)
    finally:
        suffix_dedup.STEP = step
    assert set(zip(*again)) == set(zip(p, h))
    assert all(((p >= a) & (p <= a + 400 - suffix_dedup.GRAM)).any() for a in range(5000 - 400 + 1))


# ---------------------------------------------------------------- 5
def test_packing(spark, odd, small):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = odd + list(small[1].values())
    got = packing.pack(table(spark, texts), public_tokenizers.path("byte_bpe_50k.json")).collect()
    by, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(texts):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        parts = sorted(by[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(-(-len(ids) // 1024)))
        at = 0
        for r in parts:
            assert r["start"] == at and (r["length"] == 1024 or r["piece"] == 0)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    lengths = np.bincount([r["length"] for r in got], minlength=1025)
    assert len(seqs) <= sum(n for n, _ in packing.best_fit(lengths, 1024)) + 1


@pytest.mark.parametrize("seed", range(6))
def test_packing_plans(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(65, dtype=np.int64)
    for size in rng.choice(np.arange(1, 65), 20, replace=False):
        counts[size] = rng.integers(1, 10 ** rng.integers(1, 6))
    plan = packing.solve(counts, 64)
    got = np.zeros(65, dtype=np.int64)
    for uses, key in plan:
        assert uses > 0 and sum(key) <= 64
        np.add.at(got, list(key), uses)
    assert (got == counts).all()
    assert sum(n for n, _ in plan) <= 1.01 * sum(n for n, _ in packing.best_fit(counts, 64)) + 2
    ranks = {s: [] for s in np.flatnonzero(counts)}
    for size, (first, base, off) in packing.runs_of(plan).items():
        assert list(first) == sorted(first) and first[0] == 0


# ---------------------------------------------------------------- 6
def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(t):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    rank = ["email", "ip", "card", "phone"]
    return sorted(((m.start(), rank.index(k), k, m.end()) for k, m in out))


def pii_texts():
    rng = random.Random(9)
    parts = ["a.b@c.de", "x@y", "a@b@c.org", "@", "mail me: é.b+c%d@x-y.co.uk.", "1.2.3.4", "256.1.1.1", "001.2.3.0004", "1.2.3.4.5.6.7.8", "1..2.3.4.5", "9999999999999999999999.1.1.1",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "411111111111 1111", "1 2  3", "+1 (555) 010-9999", "+49 30 1234567890123", "+1", "+12345678 ", " ", "-", ".", "日本", "7", "\n", "a%b@c.d%e@f.g", "+1.2.3.4.5.6.7.8.9"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", "x"]) for _ in range(rng.randrange(1, 12))) for _ in range(400)]


def test_pii(spark, odd, small):
    texts = odd + pii_texts() + list(small[1].values())
    for r, t in zip(rows(pii.pii_table(table(spark, texts))), texts):
        want = brute_pii(t or "")
        listed = ",".join(f"{k}:{a}:{z}" for a, _, k, z in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), t
        counts = Counter(k for _, _, k, _ in want)
        assert [r[f"n_{k}"] for k in pii.BASE] == [counts[k] for k in pii.BASE]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def test_pii_added_kinds_and_mask(spark):
    texts = ["account DE89 3704 0044 0532 0130 00 please", "DE89 3704 0044 0532 0130 01", "SSN: 123-45-6789", "part 123-45-6789", "ssn 000-12-3456", "write to a@b.cd and 10.0.0.1!", None, "plain"]
    got = rows(pii.find_pii(table(spark, texts)).withColumn("m", pii.mask(F.coalesce("text", F.lit("")), F.col("__spans"))))
    assert [[s["kind"] for s in r["__spans"]] for r in got] == [["iban"], [], ["ssn"], [], [], ["email", "ip"], [], []]
    assert [r["m"] for r in got] == ["account [IBAN] please", texts[1], "SSN: [SSN]", texts[3], texts[4], "write to [EMAIL] and [IP]!", "", "plain"]


def test_pii_iban_before_words_and_numbers(spark):
    """What stands behind an IBAN does not belong to it, nor hides it a failed one before."""
    spaced, plain = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"
    texts = [f"IBAN {spaced} BIC COBADEFFXXX", f"IBAN {plain} Thanks", f"IBAN {plain} 2024", f"{plain} {plain}", f"AT12 {spaced}", "NO93 8601 1117 947 A1", "GB29NWBK60161331926819",
             f"{plain}1", f"X{plain}", "DE89370400440532013", "AT12 " * 2000]
    got = rows(pii.find_pii(table(spark, texts)).withColumn("m", pii.mask(F.col("text"), F.col("__spans"))))
    ibans = [re.sub(r"DE89(?: ?[0-9]){18}|NO93(?: ?[0-9]){11}|GB29.*", "[IBAN]", t) for t in texts[:7]] + texts[7:]
    assert [re.sub(r"\[CARD\]", "", r["m"]).count("[IBAN]") for r in got] == [t.count("[IBAN]") for t in ibans]
    assert [sum(s["kind"] == "iban" for s in r["__spans"]) for r in got] == [1, 1, 1, 2, 1, 1, 1, 0, 0, 0, 0]
    assert got[0]["m"] == "IBAN [IBAN] BIC COBADEFFXXX" and got[2]["m"] == "IBAN [IBAN] 2024"


# ---------------------------------------------------------------- 7
def test_warc(spark, tmp_path):
    rng = random.Random(8)
    pages = [(i, rng.choice(["http://a.example.com/x?y=1", "https://www.b.example.org", None, "", "nonsense url", "http://[bad"]),
              rng.choice([None, "", "<p>a</p>", "a\r\n\r\nb", "WARC/1.1\r\n\r\n", "é" * 50, f"page {i}", f"page {i // 3}"])) for i in range(120)] + [(200, "http://a.example.com/x", "z" * 100_000)]
    d = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id long, url string, html string, digest string, size int").repartition(4)
    got = warc.archive_pages(d).collect()
    by = defaultdict(list)
    for i, _, h in pages:
        by[h or ""].append(i)
    assert sorted(r["page_id"] for r in got) == sorted(p[0] for p in pages)
    html = {i: h or "" for i, _, h in pages}
    for r in got:
        b, owner = html[r["page_id"]].encode(), max(by[html[r["page_id"]]])
        assert r["payload_bytes"] == len(b) and r["payload_digest"] == warc.payload_digest(b)
        assert (r["record_type"], r["refers_to"]) == (("response", None) if owner == r["page_id"] else ("revisit", owner))
    order = sorted(got, key=lambda r: r["index_place"])
    assert [r["index_place"] for r in order] == list(range(len(got)))
    keys = [(r["urlkey"], r["timestamp"], r["page_id"]) for r in order]
    assert keys == sorted(keys)


def test_warc_least_bytes_repeated_rows_and_empty(spark):
    schema = "page_id long, url string, html string"
    assert warc.archive_pages(spark.createDataFrame([], schema)).collect() == []
    d = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long text"), (4, "u", "long text"), (4, "u", "long text")], schema)
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.archive_pages(d, least_bytes=3).collect())
    assert got == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None), (4, "response", None)]


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    lists = [sorted(rng.randrange(50) for _ in range(rng.randrange(0, 30))) for _ in range(k)]
    assert list(warc.LoserTree(lists)) == sorted(x for one in lists for x in one)


# ---------------------------------------------------------------- 8
def grams(t, n=5):
    w = WORD.findall(t or "")
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_near(docs):
    g = {d: grams(t) for d, t in docs}
    links, root = Counter(), {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in g:
        for b in g:
            if a < b and g[a] and g[b] and len(g[a] & g[b]) >= 0.8 * len(g[a] | g[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (find(d), links[d]) for d in g}


def near_texts(rng):
    texts = []
    for size in (6, 40, 120, 400):
        base = prose(rng, size, 5000).split()
        for edits in (0, 0, 1, 1, 2, 3, 4, 8, size // 12, size // 25):
            t = list(base)
            for _ in range(edits):
                t[rng.randrange(len(t))] = f"e{rng.randrange(10 ** 6)}"
            texts.append(" ".join(t))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates(spark, odd, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "COLUMNS", 64)
    rng = random.Random(11)
    texts = odd + near_texts(rng) + near_texts(rng) + ["  ".join(odd[5].split())]
    want = brute_near(list(enumerate(texts)))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows(ngram_join.near_duplicates(table(spark, texts)))}
    assert got == want


def test_near_duplicates_small_table(small):
    d, texts = small
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows(ngram_join.near_duplicates(d))}
    assert got == brute_near(sorted(texts.items()))


def test_near_duplicates_rows_that_share_an_id(spark):
    rng = random.Random(12)
    a, b = prose(rng, 60, 5000), prose(rng, 60, 5000)
    texts = [a, a + " one", prose(rng, 60, 5000), a + " two", b, b + " one", prose(rng, 60, 5000)]
    ids = [None, None, None, 5, None, None, 9]
    for other in (None, 7):
        d = table(spark, texts, [other if i is None else i for i in ids])
        got = {r["doc_id"]: r for r in ngram_join.near_duplicates(d).collect()}
        assert set(got) == {5, 9, other} and (got[5]["class_id"], got[5]["n_links"], got[9]["n_links"], got[other]["n_links"]) == (5, 2, 0, 6)
        by_text = {r["text"]: r for r in d.withColumn("text_hash", F.xxhash64("text")).drop("doc_id").join(ngram_join.near_duplicate_rows(d), "text_hash").collect()}
        assert [by_text[t]["class_id"] for t in texts] == [5, 5, other, 5, other, other, 9]
        assert [by_text[t]["n_links"] for t in texts] == [2, 2, 0, 2, 1, 1, 0]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(30)] + [(rng.randrange(40, 90), rng.randrange(40, 90)) for _ in range(35)]
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in ngram_join.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == r for x, r in root.items())


def test_banding_recall():
    bands, n = ngram_join.choose_bands()
    assert 1 - (1 - 0.8 ** n) ** bands >= 0.999
    rng = np.random.default_rng(0)
    found = 0
    for _ in range(300):
        both = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        a, b = ngram_join.band_hashes(both[:810], bands, n), ngram_join.band_hashes(both[90:], bands, n)
        found += (a == b).any()
    assert found >= 298


# ---------------------------------------------------------------- 9
def test_piece_codec(spark, odd, small):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(6)
    texts = odd + ["".join(rng.choice("abcdeginorst   .,;(){}=-_'\"0189éß日▁\n\t\r") for _ in range(rng.randrange(1, 80))) for _ in range(500)]
    texts += ["".join(rng.choice(["==", "---", "    ", " ", "in", "ing", "er", "ment", "</", "//"]) for _ in range(rng.randrange(1, 40))) for _ in range(300)] + list(small[1].values())
    got = rows(piece_codec.encode_table(table(spark, texts), public_tokenizers.path("piece_bpe_32k.model"), with_ids=True))
    for r, t in zip(got, texts):
        ids = sp.encode(t or "")
        text = sp.decode(ids)
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == text, t
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_long_words_are_not_kept(monkeypatch):
    """Texts without blanks are one word each: what is kept between texts must not grow with them."""
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, c, rng = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.PieceCodec(path), random.Random(9)
    monkeypatch.setattr(piece_codec, "UNITS_KEPT", 50)
    monkeypatch.setattr(piece_codec, "PAIRS_KEPT", 500)
    for i in range(200):
        t = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(500)) + (f" \u2028odd{i}\u200b." if i % 2 else "")
        ids = sp.encode(t)
        assert c.listing(t) == (len(ids), ",".join(map(str, ids)), sp.decode(ids))
        assert max(map(len, [*c.units, *c.units.old, *c.odd]), default=0) <= piece_codec.LONGEST
        assert len(c.odd) <= 60 and c.pairs <= 5000
        ngram_join.word_hashes(t)
    assert max(map(len, ngram_join._WORD_HASHES)) <= 48


def test_piece_decode_of_any_ids():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    c, rng = piece_codec.codec(public_tokenizers.path("piece_bpe_32k.model")), random.Random(3)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randrange(1, 8))]
        assert c.decode(ids) == sp.decode(ids), ids


# ---------------------------------------------------------------- 10
@pytest.mark.parametrize("range_rows", [2000, 4])
def test_fingerprints(spark, odd, small, monkeypatch, range_rows):
    monkeypatch.setattr(syncmers, "RANGE_ROWS", range_rows)
    texts = odd + list(small[1].values())
    ids = [3 * i - 40 for i in range(len(texts))]
    got = rows(syncmers.fingerprints(table(spark, texts, ids)))
    t = [x or "" for x in texts]
    by_text = defaultdict(set)
    for i, r in enumerate(got):
        half = len(t[i]) // 2
        edited = t[i][:len(t[i]) - half] + t[i - 1][:half]  # ids ascend, so the next by descending id is the one before
        assert r["doc_id"] == ids[i] and r["n_chars"] == len(t[i]) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        by_text[t[i]].add(r["fingerprint"])
        by_text[edited].add(r["edited_fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1

        def near(a, b):
            a, b = ({x[k:k + 16] for k in range(0, len(x), 16)} for x in (a, b))
            return len(a & b) / len(a | b) if a | b else 1.0
        assert r["near_edited"] == pytest.approx(near(r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(near(r["fingerprint"], got[i - 1]["fingerprint"]))
    assert all(len(f) == 1 for f in by_text.values())
    longer = [r for r in got if r["n_chars"] > 2000]
    assert sum(r["near_edited"] > r["near_next"] for r in longer) >= 0.9 * len(longer)
    assert all(r["placed_edited"] >= 0.2 for r in longer if len(r["fingerprint"]) > 1600)


def brute_anchors(spark, text, k=syncmers.K, s=syncmers.S):
    """{(k-mer's words, place)} of the closed syncmers, with the engine's hashes of the inner substrings."""
    w = WORD.findall(text)
    subs = {tuple(w[i:i + s]) for i in range(len(w) - s + 1)}
    hashed = spark.createDataFrame([(list(x),) for x in subs], "w array<string>").select("w", F.xxhash64(*[F.xxhash64(F.col("w")[j]) for j in range(s)]).alias("h")) if subs else None
    h = {tuple(r["w"]): r["h"] for r in hashed.collect()} if subs else {}
    out = set()
    for i in range(len(w) - k + 1):
        inner = [h[tuple(w[i + j:i + j + s])] for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.add((tuple(w[i:i + k]), i))
    return out


def test_fingerprints_see_one_word_in_a_long_text(spark):
    rng = random.Random(8)
    a = " ".join(f"w{rng.randrange(5000)}" for _ in range(20_000)).split(" ")
    b = a[:9000] + ["other"] + a[9001:]
    got = rows(syncmers.fingerprints(table(spark, [" ".join(a), " ".join(b)], [2, 1])))
    near = {r["doc_id"]: r for r in got}
    assert near[1]["fingerprint"] != near[2]["fingerprint"]
    x, y = ({g for g, _ in brute_anchors(spark, " ".join(t))} for t in (a, b))
    assert near[2]["near_next"] == pytest.approx(len(x & y) / len(x | y)) and near[2]["near_next"] < 1
    x, y = (brute_anchors(spark, " ".join(t)) for t in (a, b))
    assert near[2]["placed_next"] == pytest.approx(len(x & y) / len(x | y))


def test_fingerprints_of_any_ids(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_ROWS", 3)
    texts = [f"text number {i} of some {i * 7} words" for i in range(40)]
    ids = [None if i % 3 == 0 else f"id{i // 2:02d}" for i in range(40)]
    d = spark.createDataFrame(list(zip(ids, texts)), "doc_id string, text string").repartition(3)
    got = syncmers.fingerprints(d).collect()
    tie = {r["text"]: r["h"] for r in d.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(zip(ids, texts), key=lambda r: (r[0] is not None, r[0] or "", -1 - tie[r[1]]), reverse=True)
    want = Counter()
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        want[i, hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in got) == want
