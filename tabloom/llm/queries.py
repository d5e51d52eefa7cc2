"""The queries of this subpackage: thin wrappers that apply an operator to its whole table.

``QUERIES`` maps names to callables ``(spark, sf_dir) -> DataFrame``,
``ORACLES`` to DuckDB SQL where SQL can express the operator.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam
from . import line_dedup as lines
from . import ngram_join, packing, piece_codec, pii, prefix_trie, quality, shards, suffix_dedup, syncmers, variants, warc

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = lines.line_dedup(_table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.col("text").alias("kept_text"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_table(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_table(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op10_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt_sequences(_table(spark, sf_dir, "conversations")))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_sharding, op3_line_dedup, op4_suffix_dedup, op5_best_fit_packing, op6_pii, op7_warc,
    op8_ngram_jaccard_join, op9_piece_codec, op10_syncmer_fingerprints, op11_spelling_variants,
    op12_prefix_trie, op13_benchmark_decontamination, pipeline)}

_SPACE = r"\x20\x09-\x0D"
_STOP = "[" + ", ".join(f"'{w}'" for w in quality.STOP_SPELLINGS) + "]"


def _rules_sql() -> str:
    out = []
    for _, metric, low, high in quality.RULES:
        out += [f"{metric} >= {low}"] if low is not None else []
        out += [f"{metric} <= {high}"] if high is not None else []
    return " AND ".join(out)


QUALITY_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)),
rep AS (
  SELECT doc_id, count(DISTINCT i + j) AS n
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win), (SELECT unnest(generate_series(0, 7)) AS j)
  WHERE c > 1 GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: list_contains({_STOP}, x))) AS n_stop,
         (length(t) - length(replace(t, '!!', ''))) // 2 AS n_shout,
         len(list_filter(l, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_ellipsis,
         len(list_filter(l, lambda x: regexp_matches(x, '^[{_SPACE}]*[\\-*•][\\x20\\x09]'))) AS n_bullet
  FROM d LEFT JOIN rep USING (doc_id)),
r AS (
  SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio,
         n_stop / greatest(n_words, 1) AS stop_ratio, n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio, n_shout / greatest(n_words, 1) AS shout_ratio,
         n_ellipsis / greatest(n_lines, 1) AS ellipsis_line_ratio, n_bullet / greatest(n_lines, 1) AS bullet_line_ratio,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND {_rules_sql()} AS kept
FROM r
"""

LINE_DEDUP_SQL = f"""
WITH a AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
x AS (
  SELECT doc_id, n, ls[n] AS line FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS n FROM a)),
k AS (
  SELECT doc_id, n, line, lead(n, 1) OVER o AS n2, lead(line, 1) OVER o AS l2, lead(n, 2) OVER o AS n3, lead(line, 2) OVER o AS l3
  FROM x WHERE regexp_matches(line, '[^{_SPACE}]') WINDOW o AS (PARTITION BY doc_id ORDER BY n)),
f AS (
  SELECT doc_id, n, n2, n3, min(struct_pack(d := doc_id, n := n)) OVER (PARTITION BY line, l2, l3) AS first FROM k WHERE n3 IS NOT NULL),
gone AS (
  SELECT DISTINCT doc_id, unnest([n, n2, n3]) AS n FROM f WHERE first.d <> doc_id OR first.n <> n),
kept AS (
  SELECT x.doc_id, string_agg(x.line, chr(10) ORDER BY x.n) AS kept_text FROM x LEFT JOIN gone USING (doc_id, n) WHERE gone.n IS NULL GROUP BY x.doc_id)
SELECT a.doc_id, coalesce(len(a.ls), 0)::BIGINT AS n_lines, coalesce(g.c, 0)::BIGINT AS n_removed,
       CASE WHEN a.text IS NULL THEN NULL ELSE coalesce(kept.kept_text, '') END AS kept_text
FROM a LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id) g USING (doc_id)
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ITEM_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
DECONTAMINATION_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), {_ITEM_WORD}) AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), {_ITEM_WORD}) AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS l, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
pos AS (
  SELECT doc_id, i, l, array_to_string(list_slice(w, i, i + l - 1), ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l)),
hit AS (
  SELECT doc_id, i, l, item FROM pos JOIN win USING (g, l)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + l - 1)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM hit)) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS s FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items,
       coalesce(f.s, sha256('')) AS items_sha256, c.n IS NOT NULL AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

# CRC-32 of a string: the table of the reflected polynomial, then one step per byte.
_CRC_TABLE = """(SELECT list(v ORDER BY i) FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) t(i)))"""


def _crc_sql(text: str) -> str:
    h = f"hex(encode({text}))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len({h}) // 2), lambda i: ('0x' || substr({h}, (2 * i + 1)::BIGINT, 2))::BIGINT)), "
            f"lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1])), 4294967295)")


VARIANTS_SQL = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS crc_table),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
each AS (
  SELECT id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY id, run),
hashed AS (
  SELECT run, c, {_crc_sql("id || ':' || run")} AS h FROM each, crc),
words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.d = b.word),
ranked AS (
  SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS r FROM near),
linked AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.r = 1),
followed(word, top) AS (
  SELECT word, word FROM linked
  UNION ALL SELECT f.word, l.form FROM followed f JOIN linked l ON l.word = f.top WHERE l.form IS NOT NULL)
SELECT l.word, l.form, f.top AS root, l.n, l.n_near::BIGINT AS n_near, l.form_n
FROM linked l JOIN followed f USING (word) JOIN linked e ON e.word = f.top AND e.form IS NULL
"""

TRIE_SQL = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS crc_table),
t AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS p FROM t),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS first, {_crc_sql("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
r AS (
  SELECT c.conv_id, o.p, o.k, o.size FROM c JOIN o ON o.conv_id = c.first AND o.p <= c.h
  UNION ALL SELECT c.conv_id, o.p + 1000000, o.k, o.size FROM c JOIN o ON o.conv_id = c.conv_id AND o.p > c.h),
s AS (
  SELECT c.conv_id, coalesce(list(k ORDER BY p) FILTER (k IS NOT NULL), []) AS ks, coalesce(list(size ORDER BY p) FILTER (k IS NOT NULL), []) AS sizes
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
x AS (
  SELECT conv_id, d, len(ks) AS l, array_to_string(list_slice(ks, 1, d), '') AS path, CASE WHEN d > 0 THEN array_to_string(list_slice(ks, 1, d - 1), '') END AS over,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(generate_series(0, len(ks))) AS d FROM s)),
n AS (
  SELECT d, path, min(over) AS over, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (l = d), '')) AS ends_sha256
  FROM x GROUP BY d, path),
kids AS (
  SELECT over AS path, count(*) AS c FROM n WHERE d > 0 GROUP BY over),
sums AS (
  SELECT x.path, sum((n.n_convs - 1) * n.size) AS saved, count(*) FILTER (kids.c IS NULL) AS leaves
  FROM n LEFT JOIN kids USING (path) JOIN x ON x.conv_id = n.conv_id AND x.d <= n.d GROUP BY x.path)
SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.c, 0)::BIGINT AS n_children, sums.leaves::BIGINT AS n_leaves,
       sums.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n LEFT JOIN n up ON up.path = n.over LEFT JOIN kids ON kids.path = n.path JOIN sums ON sums.path = n.path
"""

ORACLES = {"op1_quality_rules": QUALITY_SQL.strip(), "op3_line_dedup": LINE_DEDUP_SQL.strip(),
           "op11_spelling_variants": VARIANTS_SQL.strip(), "op12_prefix_trie": TRIE_SQL.strip(),
           "op13_benchmark_decontamination": DECONTAMINATION_SQL.strip()}
