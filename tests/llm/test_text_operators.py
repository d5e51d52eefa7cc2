"""Spelling variants, prefix trie and decontamination against brute force, on odd rows and on the small tables."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabloom.llm import decontam, prefix_trie, variants

SF = "/root/testdata/sf0.001"
EXTRA = ", word string, n long, form string, id string, run string, h long, leaf long, key string, `a.b` string, hits long, c long, w string, bits long, seq string, pid int"


def table(spark, rows, schema):
    """``rows`` with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "x", 1, "f", "i", "r", 2, 3, "k", "ab", 4, 5, "w", 6, "s", 7) for r in rows], schema + EXTRA).repartition(3)


# ---------------------------------------------------------------- 11
def lower(s):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in s)


def brute_words(texts, every=199):
    c = Counter()
    for i, t in texts:
        for w in map(lower, re.findall("[A-Za-zÀ-ÿ]+", t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    return {w: k for w, k in c.items() if len(w) >= 6 and k >= 5}


def brute_variants(n):
    near, cut = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            d = w[:i] + w[i + 1:]
            cut[i, len(w), d].add(w)
            if d in n and d != w:
                near[w].add(d)
                near[d].add(w)
    for s in cut.values():
        for a in s:
            near[a] |= s - {a}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= 5 * n[w]}
    out = {}
    for w in n:
        r = w
        while r in form:
            r = form[r]
        out[w] = (form.get(w), r, n[w], len(near[w]), n.get(form.get(w)))
    return out


def as_dict(df):
    got = [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]
    assert len({g[0] for g in got}) == len(got)
    return {g[0]: g[1:] for g in got}


def odd_words():
    rng = random.Random(7)
    words = ["".join(rng.choice("abç") for _ in range(rng.randrange(5, 9))) for _ in range(60)]
    texts = [None, "", " \n", "Ünï çödé 日本", "x" * 3000, "1" * 50] + ["x" * 3000, "x" * 2999 + "y"] * 5
    texts += [" ".join(rng.choices(words, [1 / (i + 1) ** 2 for i in range(60)], k=400)) for _ in range(8)]
    texts += ["chain1 " * 3 + "chainA " * 5000 + "chainB " * 900 + "chainBB " * 150 + "chainBBB " * 25 + "chainBBBB " * 5] + ["tieaaa tieaab tieaac " * 5]
    return texts


@pytest.mark.parametrize("leaf,sample", [(4096, 40_000), (8, 100), (8, 1)])
def test_variants_odd_words(spark, leaf, sample):
    texts = odd_words()
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(texts))]
    got = variants.variants(table(spark, list(zip(ids, texts)), "doc_id long, text string"), leaf=leaf, sample=sample)
    want = brute_variants(brute_words(zip(ids, texts)))
    assert as_dict(got) == want and any(v[0] and v[1] != v[0] for v in want.values())


def test_variants_small_table(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_variants(brute_words([(r["doc_id"], r["text"]) for r in d.collect()]))
    assert as_dict(variants.variants(d)) == want


def test_variants_empty(spark):
    assert variants.variants(table(spark, [], "doc_id long, text string")).collect() == []
    assert variants.variants(table(spark, [(1, "one two"), (None, None)], "doc_id long, text string")).collect() == []


def test_dealing_reaches_every_near_leaf():
    import numpy as np
    rng = np.random.default_rng(3)
    p = rng.integers(0, 4, (400, 5))
    tree = variants.dealing_tree(p, 5)
    home = np.full(400, -1)
    for leaf, rows in variants.reach(tree, p, 0, 0):
        assert (home[rows] == -1).all()
        home[rows] = leaf
    assert (home >= 0).all()
    seen = {(i, leaf) for leaf, rows in variants.reach(tree, p, 1, 1) for i in rows}
    for i in range(400):
        more, fewer = np.maximum(p - p[i], 0).sum(1), np.maximum(p[i] - p, 0).sum(1)
        assert {(i, home[j]) for j in np.nonzero((more <= 1) & (fewer <= 1))[0]} <= seen


# ---------------------------------------------------------------- 12
def brute_trie(rows, rebuild=True):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs[c].append(((t is not None, t or 0), hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    seq = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        seq[c] = tuple(own.get(c - c % 5, [])[:h] + v[h:])
    members, kids, leaves, saved = (defaultdict(list), *(defaultdict(int) for _ in range(3)))
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            kids[s[:-1]] += 1
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += (len(m) - 1) * len(s[-1][1].encode()) if s else 0
    return sorted([(min(m), len(s), min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(seq[c]) == len(s)))).encode()).hexdigest()) for s, m in members.items()], key=str)


TURNS = "conv_id long, turn long, role string, text string"


def odd_turns(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(120):
        c = None if c % 17 == 0 else c
        for t in range(rng.choice([1, 1, 2, 3, 5, 9, 12])):
            rows.append((c, None if rng.random() < .05 else t, rng.choice(["u", None, ""]), rng.choice(["a", "b", None, "ü" * 40]) if t or rng.random() < .5 else "hello"))
    rows += [(1000 + c, t, "u", f"hot{t}") for c in range(80) for t in range(4)]  # a group of copies
    rows += [(2000 + 5 * c, t, "u", f"long{t}") for c in range(6) for t in range(60 + 10 * c)]  # prefixes of each other
    rows += rows[:20]  # repeated rows
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,part_bytes", [(0, 32 << 20), (1, 400), (2, 100)])
def test_trie_odd_turns(spark, seed, part_bytes):
    rows = odd_turns(seed)
    d = table(spark, rows, TURNS)
    got = prefix_trie.trie(prefix_trie.rebuilt_sequences(d), part_bytes)
    assert got.columns == prefix_trie.RESULT
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(rows)
    if seed == 1:
        assert sorted((tuple(r) for r in prefix_trie.trie(prefix_trie.sequences(d), part_bytes).collect()), key=str) == brute_trie(rows, rebuild=False)


def test_trie_small_and_empty(spark):
    d = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in d.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in prefix_trie.trie(prefix_trie.rebuilt_sequences(d)).collect()), key=str) == brute_trie(rows)
    for none in ([], [(None, 1, "u", "x")]):
        assert prefix_trie.trie(prefix_trie.rebuilt_sequences(table(spark, none, TURNS))).collect() == []


def test_trie_hashes_ids_in_pieces(spark, monkeypatch):
    rows = [(c, 0, "u", "same") for c in range(900)]
    monkeypatch.setattr(prefix_trie, "PIECE", 200)
    got = prefix_trie.trie(prefix_trie.sequences(table(spark, rows, TURNS)), 500).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_trie(rows, rebuild=False)


# ---------------------------------------------------------------- 13
ITEM_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(t):
    return ITEM_WORD.findall(lower(t or ""))


def brute_hits(texts, items, size=10):
    grams = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1) if n else ():
            grams[tuple(w[k:k + n])].add("" if i is None else str(i))
    sizes, out = {len(g) for g in grams}, []
    for i, t in texts:
        w, hit, found = item_words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                g = grams.get(tuple(w[k:k + n]))
                if g:
                    hit |= set(range(k, k + n))
                    found |= g
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def odd_items(seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(["Ab", "c", "d1", "é", "日本", "f"]) for _ in range(n))
    items = [(1, None), (2, ""), (3, "..."), (4, "lone"), (5, "two words"), (6, say(9)), (7, say(25)), (8, say(40)), (9, say(40)), (None, say(12)), (10, say(10))]
    items += [(20 + i, items[7][1]) for i in range(15)]  # copies of an item
    texts = [None, "", " - ", "LONE", "alone lone,wolf", "two\nWORDS two words", say(3), say(4000), items[6][1] + " " + items[6][1], items[7][1].upper(), "x " * 300 + items[8][1] + " y" * 30]
    texts += [items[7][1]] * 5 + [items[9][1].replace(" ", "\t--")] + [(items[6][1] + "\n") * 200] + [say(60) + " " + items[10][1] for _ in range(5)]
    return texts, items


@pytest.mark.parametrize("options", [{}, {"piece": 7}, {"broadcast_bytes": 0, "piece": 50}])
def test_decontamination_odd(spark, options, monkeypatch):
    texts, items = odd_items(4)
    ids = [None if i % 5 == 0 else i // 2 for i in range(len(texts))]
    if options:
        monkeypatch.setattr(decontam, "LEAST_BITS", 6)
        monkeypatch.setattr(decontam, "MOST_BITS", 7)  # nearly every window passes the bit array
    d, b = table(spark, list(zip(ids, texts)), "doc_id long, text string"), table(spark, items, "item_id long, text string")
    got = decontam.report(d, b, **options)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_hits(list(zip(ids, texts)), items)
    assert sum(r[2] for r in brute_hits(list(zip(ids, texts)), items)) > 0


def test_decontamination_small_and_empty(spark):
    d, b = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    texts, items = ([tuple(r) for r in t.collect()] for t in (d.select("doc_id", "text"), b.select("item_id", "text")))
    assert sorted((tuple(r) for r in decontam.report(d, b).collect()), key=str) == brute_hits(texts, items)
    none = table(spark, [], "item_id long, text string")
    assert sorted((tuple(r) for r in decontam.report(d, none).collect()), key=str) == brute_hits(texts, [])
    assert decontam.report(table(spark, [], "doc_id long, text string"), b).collect() == []
    plan = decontam.report(d, b)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan


def brute_removed(text, items, size=10):
    """``text`` without hit words and what stands between words of one span."""
    if text is None:
        return None
    at = [m.span() for m in re.finditer("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    w, hit = item_words(text), set()
    grams = {tuple(x[k:k + min(size, len(x))]) for _, t in items for x in [item_words(t)] if x for k in range(len(x) - min(size, len(x)) + 1)}
    for n in {len(g) for g in grams}:
        for k in range(len(w) - n + 1):
            if tuple(w[k:k + n]) in grams:
                hit |= {(k + j, j > 0) for j in range(n)}
    words, joins = {k for k, _ in hit}, {k for k, inner in hit if inner}
    # neighbouring spans are one span: the gap between two hit words goes
    gone = [at[k] for k in words] + [(at[k - 1][1], at[k][0]) for k in words if k and (k in joins or k - 1 in words)]
    keep = [True] * len(text)
    for a, b in gone:
        keep[a:b] = [False] * (b - a)
    return "".join(c for c, k in zip(text, keep) if k)


def test_decontaminate_spans_and_documents(spark):
    texts, items = odd_items(9)
    d, b = table(spark, list(enumerate(texts)), "doc_id long, text string"), table(spark, items, "item_id long, text string")
    got = decontam.decontaminate(d, b)
    assert got.columns == d.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {i: brute_removed(t, items) for i, t in enumerate(texts)}
    clean = {i for i, _, n, *_ in brute_hits(list(enumerate(texts)), items) if not n}
    kept = decontam.decontaminate(d, b, spans=False)
    assert {r["doc_id"] for r in kept.collect()} == clean and kept.columns == d.columns
    assert got.where(F.col("`a.b`") == "ab").count() == len(texts)
