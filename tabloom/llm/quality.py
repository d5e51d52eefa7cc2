"""Quality rules: one threshold table compiled into one Spark projection.

Every rule is a row ``(name, metric, low, high)``; a document passes a rule
when ``low <= metric <= high``.  Metrics are column expressions over the word
and line arrays of the text, so the whole table is one projection without
user functions, joins or shuffles: cost is linear in the text and a hot
source or a group of copies needs no care.

Defined results: null and empty texts have no words, all counts 0, and fail
the base rule; repeated rows get equal verdicts; empty tables give empty
tables; input columns other than id and text are never read, so their names do
not matter (``keep`` carries each row as a struct).  A very long text is one row,
in time and space linear in its length.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, split_words, text_or_empty, total

#: Function words by which running prose is told from lists and debris (English, German, French, Spanish).
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "as", "with", "be", "at", "by", "this", "have", "from",
              "der", "die", "und", "das", "von", "zu", "mit", "den", "nicht", "ein", "eine", "ist", "im", "für", "auf", "des", "dem", "sich",
              "le", "la", "les", "et", "de", "du", "un", "une", "que", "qui", "en", "pour", "par", "est", "dans", "sur", "au",
              "el", "los", "las", "y", "del", "se", "por", "con", "para", "una", "es", "lo", "no")

#: As they stand in texts: spelled small, with a capital and in capitals, so that words need no case folding.
STOP_SPELLINGS = tuple(dict.fromkeys(s for w in STOP_WORDS for s in (w, w.capitalize(), w.upper())))

#: Words (a power of two) in a window whose repetition within the text is counted.
WINDOW = 8

#: (rule, metric, lowest, highest): None means unbounded.
RULES = (
    ("mean_word_chars", "mean_word_chars", 1.5, 15.0),
    ("symbols", "symbol_ratio", None, 0.35),
    ("stop_words", "stop_ratio", 0.03, None),
    ("dup_lines", "dup_line_ratio", None, 0.5),
    ("shouting", "shout_ratio", None, 0.3),
    ("ellipsis_lines", "ellipsis_line_ratio", None, 0.5),
    ("bullet_lines", "bullet_line_ratio", None, 0.9),
)


def repeat_words(words: Column, k: int = WINDOW) -> Column:
    """Words inside k-word windows that occur at least twice in ``words``.

    Windows are compared by a 64-bit hash of their word hashes.  Texts
    without a repeated window stop after one hash set; else (hash, position)
    pairs are sorted and neighbours compared.
    """
    def covered(wins: Column) -> Column:
        pairs = F.sort_array(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            return F.transform(s, lambda x, j: F.when(
                (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"]))

        pos = F.sort_array(F.filter(let(pairs, positions), lambda p: p.isNotNull()))
        return let(pos, lambda ps: total(F.transform(ps, lambda p, j: F.least(
            F.lit(k), F.coalesce(F.get(ps, j + 1) - p, F.lit(k))))))

    def judged_windows(wins: Column) -> Column:
        return F.when(F.size(F.array_distinct(wins)) == F.size(wins), F.lit(0).cast("long")).otherwise(covered(wins))

    def doubled(hs: Column, width: int) -> Column:
        """From hashes of ``width`` words to those of ``k``: two neighbours make one twice as wide."""
        if width == k:
            return let(F.slice(hs, 1, F.size(words) - k + 1), judged_windows)
        return let(F.transform(hs, lambda h, i: F.xxhash64(h, F.get(hs, i + width))), lambda wider: doubled(wider, 2 * width))

    return F.when(F.size(words) <= k, F.lit(0).cast("long")).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), lambda hs: doubled(hs, 1)))


def measure(docs: DataFrame, row: Column, text_col: str = "text") -> DataFrame:
    """``row`` as it is, base counts and ratios of every text (one projection per step, no shuffle)."""
    d = docs.select(row, text_or_empty(text_col).alias("__t"))
    keep = d.columns[0]
    d = d.select(keep, "__t", split_words(F.col("__t")).alias("__w"),
                 F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__l"))
    w, lines, t = F.col("__w"), F.col("__l"), F.col("__t")
    long = lambda c: c.cast("long")
    d = d.select(
        keep, long(F.size(w)).alias("n_words"), long(F.length(F.array_join(w, ""))).alias("word_chars"),
        long(F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).alias("n_symbols"),
        long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        repeat_words(w).alias("n_repeat_words"), long(F.size(lines)).alias("n_lines"),
        long(F.size(F.filter(w, lambda x: x.isin(*STOP_SPELLINGS)))).alias("n_stop_words"),
        long((F.length(t) - F.length(F.replace(t, F.lit("!!"), F.lit("")))) / 2).alias("n_shouts"),
        long(F.size(F.filter(lines, lambda x: x.endswith("...") | x.endswith("…")))).alias("n_ellipsis_lines"),
        long(F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[\-\*•][\x20\x09]")))).alias("n_bullet_lines"))
    ratio = lambda a, b: (F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("double")
    return d.withColumns({
        "mean_word_chars": ratio("word_chars", "n_words"), "symbol_ratio": ratio("n_symbols", "n_words"),
        "stop_ratio": ratio("n_stop_words", "n_words"), "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "shout_ratio": ratio("n_shouts", "n_words"), "ellipsis_line_ratio": ratio("n_ellipsis_lines", "n_lines"),
        "bullet_line_ratio": ratio("n_bullet_lines", "n_lines")})


def compile_rules(rules: Sequence[tuple]) -> Column:
    """The names of the failed rules, as one array expression."""
    def broken(name, metric, low, high):
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(metric) < low)
        if high is not None:
            bad = bad | (F.col(metric) > high)
        return F.when(bad, F.lit(name))
    return F.array_compact(F.array(*[broken(*r) for r in rules]))


def quality(docs: DataFrame, rules: Sequence[tuple] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: metrics, ``base_failed``, ``failed_rules`` and ``kept``."""
    return judged(measure(docs, F.col(id_col).alias("doc_id"), text_col), rules)


def judged(d: DataFrame, rules: Sequence[tuple] = RULES) -> DataFrame:
    base = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    d = d.withColumn("base_failed", base).withColumn("failed_rules", compile_rules(rules))
    return d.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep(docs: DataFrame, rules: Sequence[tuple] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    # a filter is pushed below the projections and computes their columns anew at each use; a generated row is not
    verdict = F.explode(F.array("kept")).alias("kept")
    return judged(measure(docs, row, text_col), rules).select("__row", verdict).where("kept").select("__row.*")
