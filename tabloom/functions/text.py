"""Text column expressions: scalar features and cleaning steps.

Character classes are spelled out instead of ``\\w``/``\\s``/``\\b`` so that
the JVM regex engine follows the Unicode semantics of Python 3's ``re``
(word = letter, number or underscore) and any RE2-based SQL engine can run
the very same patterns.  Word boundaries use look-arounds.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import col_

# Character classes matching Python 3 ``re`` (Unicode) semantics.
WORD = r"\p{L}\p{N}_"
WS = (r" \t\n\r\f\x{0B}\x{1C}\x{1D}\x{1E}\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS_NOT_BLANK = WS.replace(" ", "", 1)
DIGIT = r"\p{Nd}"
# The same characters for the JVM engine, which is fast on listed ASCII characters and on
# categories and slow on ranges: Z is the blanks of WS, and ALNUM is A-Za-z0-9.
_WS = r"\p{Z}\t\n\r\f\x{0B}\x{1C}\x{1D}\x{1E}\x{1F}\x{85}"
ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
# ASCII punctuation (Python ``string.punctuation``).
PUNCT_CHARS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PUNCT = r"!-/:-@\[-`{-~"
# First words flagged by default.
FIRST_WORDS = ("What", "How", "Why", "Is", "Can", "Which", "Do", "If", "Are", "Who")


def count(c, pattern: str) -> Column:
    return F.regexp_count(col_(c), F.lit(pattern))


def tokens(c) -> Column:
    """``str.split()``: runs of Unicode whitespace, no empty tokens."""
    return F.filter(F.split(col_(c), f"[{_WS}]+"), lambda t: t != "")


def text_len(c) -> Column:
    return F.length(col_(c))


def n_pieces(c) -> Column:
    """``len(s.split(" "))`` — blanks between blanks count as pieces."""
    return F.size(F.split(col_(c), " ", -1))


def n_words(c) -> Column:
    return F.size(tokens(c))


def n_unique(c) -> Column:
    return F.size(F.array_distinct(tokens(c)))


def unique_ratio(c) -> Column:
    """distinct tokens / tokens × 100."""
    return F.try_divide(n_unique(c).cast("double"), n_words(c).cast("double")) * 100


def postclean_ratio(raw, clean) -> Column:
    """distinct tokens of the cleaned text / distinct tokens of the raw text × 100."""
    return F.try_divide(n_unique(clean).cast("double"), n_unique(raw).cast("double")) * 100


def longest_word(c) -> Column:
    """Longest piece of ``split(" ")``; 0 for texts of length ≤ 1."""
    x = col_(c)
    return F.when(F.length(x) > 1, F.array_max(F.transform(F.split(x, " ", -1), F.length))).otherwise(0)


def n_digits(c, ascii_only: bool = False) -> Column:
    return count(c, "[0-9]" if ascii_only else DIGIT)


def has_digits(c, more_than: int = 1) -> Column:
    return (n_digits(c) > more_than).cast("int")


def n_upper(c) -> Column:
    return count(c, r"\p{Lu}")


def n_caps(c, alphabet: str = "latin+cyr") -> Column:
    return count(c, "[A-ZА-Я]" if alphabet == "latin+cyr" else "[А-Я]")


def n_nonword(c) -> Column:
    return count(c, f"[^{WORD}]")


def n_word_chars(c) -> Column:
    return count(c, f"[{WORD}]")


def has_special(c, chars: str = PUNCT_CHARS + " ") -> Column:
    cls = "".join("\\" + ch if ch in "\\]^-[" else ch for ch in chars)
    return col_(c).rlike(f"[{cls}]").cast("int")


def n_punct(c) -> Column:
    return count(c, f"[{PUNCT}]")


def n_newlines(c) -> Column:
    """Whitespace characters other than the blank."""
    return count(c, f"[{WS_NOT_BLANK}]")


def pattern_flag(c, pattern: str, more_than: int = 2) -> Column:
    return (count(c, pattern) > more_than).cast("int")


def has_latin_run(c, lo: int = 2, hi: int = 15) -> Column:
    return col_(c).rlike(f"[a-zA-Z]{{{lo},{hi}}}").cast("int")


def latin_runs(c, lo: int = 2, hi: int = 15) -> Column:
    return F.array_join(F.regexp_extract_all(col_(c), F.lit(f"([a-zA-Z0-9]{{{lo},{hi}}})"), 1), " ")


def first_word_flags(c, words: Sequence[str] = FIRST_WORDS) -> dict[str, Column]:
    first = F.regexp_extract(col_(c), f"^[{WS}]*([^{WS}]+)", 1)  # reads one word, not the text
    return {w: F.coalesce(first == F.lit(w), F.lit(False)).cast("int") for w in words}


# ---------------------------------------------------------------- cleaning steps

# Contraction rules, applied in this order (specific before general).
CONTRACTIONS = (
    (r"won't", "will not"), (r"can't", "cannot"), (r"i'm", "i am"), (r"ain't", "is not"),
    (r"([\p{L}\p{N}_]+)'ll", "$1 will"), (r"([\p{L}\p{N}_]+)n't", "$1 not"),
    (r"([\p{L}\p{N}_]+)'ve", "$1 have"), (r"([\p{L}\p{N}_]+)'s", "$1 is"),
    (r"([\p{L}\p{N}_]+)'re", "$1 are"), (r"([\p{L}\p{N}_]+)'d", "$1 would"),
    (r"dont", "do not"), (r"wont", "will not"),
)


def _after_word(pat: str, rep: str) -> tuple[str, str]:
    """The rule ``(\\w+)suffix`` → ``$1 new`` as ``suffix`` behind a word → `` new``.

    The word is kept as it is, so only the suffix has to be found: its first
    character is looked for, then the word character before it, which must lie
    behind the previous match.  The JVM engine no longer starts at every word.
    """
    lead, kept = f"([{WORD}]+)", "$1"
    if not (pat.startswith(lead) and rep.startswith(kept)):
        return pat, rep
    suffix = pat[len(lead):]
    return f"(?={suffix[0]})(?<=[{WORD}])(?!\\G){suffix}", rep[len(kept):]


def expand_contractions(c, rules=CONTRACTIONS) -> Column:
    x = col_(c)
    for pat, rep in rules:
        x = F.regexp_replace(x, *_after_word(pat, rep))
    return x


# Digit masks, longest run first.
MASKS = ((r"[0-9]{5,}", "#####"), (r"[0-9]{4}", "####"), (r"[0-9]{3}", "###"), (r"[0-9]{2}", "##"))


def mask_numbers(c, masks=MASKS) -> Column:
    x = col_(c)
    for pat, rep in masks:
        x = F.regexp_replace(x, pat, rep)
    return x


def ascii_only_keep(c, keep: str = "") -> Column:
    return F.regexp_replace(col_(c), f"[^{ALNUM}{keep}]+", " ")


def strip_punct(c, repl: str = "") -> Column:
    """ASCII punctuation → ``repl``."""
    return F.regexp_replace(col_(c), f"[{PUNCT}]", repl)


def strip_nonword(c, keep: str = "") -> Column:
    """``re.sub(r'[^\\w\\s]', '', x)``; ``keep`` adds characters to keep."""
    return F.regexp_replace(col_(c), f"[^{WORD}{_WS}{keep}]+", "")


def split_digit_word(c) -> Column:
    """``\\b(\\d+)([a-z]+)\\b`` → ``\\1 \\2`` (a word made of digits then letters)."""
    return F.regexp_replace(col_(c), f"(?={DIGIT})(?<![{WORD}])({DIGIT}+)([a-z]+)(?![{WORD}])", "$1 $2")


def split_word_digit(c) -> Column:
    """``\\b([a-z]+)(\\d+)\\b`` → ``\\1 \\2``."""
    return F.regexp_replace(col_(c), f"(?<![{WORD}])([a-z]+)({DIGIT}+)(?![{WORD}])", "$1 $2")


def split_alnum(c) -> Column:
    """Both directions: ``12abc`` → ``12 abc``, ``abc12`` → ``abc 12``."""
    return split_word_digit(split_digit_word(c))


def drop_digits(c, repl: str = " ") -> Column:
    return F.regexp_replace(col_(c), "[0-9]+", repl)


def ascii_only(c) -> Column:
    return F.regexp_replace(col_(c), f"[^{ALNUM}]+", " ")


def space_digit_runs(c) -> Column:
    """``" ".join(re.split('(\\d+)', x))``: a blank on each side of every digit run."""
    return F.regexp_replace(col_(c), f"({DIGIT}+)", " $1 ")


def collapse_ws(c) -> Column:
    """``re.sub(r'\\s+', ' ', x).strip()``."""
    # afterwards an end has one blank at most
    return F.trim(F.regexp_replace(col_(c), f"[{_WS}]+", " "))


def truncate_words(c, n: int) -> Column:
    """``' '.join(x.split()[:n])``."""
    return F.array_join(F.slice(tokens(c), 1, n), " ")


def drop_stopwords(c, words: Sequence[str]) -> Column:
    """``' '.join(w for w in x.split() if w not in words)``."""
    return F.array_join(F.filter(tokens(c), lambda t: ~t.isin(*words)) if words else tokens(c), " ")


def literal_replace(c, pairs: Sequence[tuple[str, str]]) -> Column:
    x = col_(c)
    for a, b in pairs:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


# ---------------------------------------------------------------- composed cleaners
# A cleaner is a list of (step, argument) pairs; ``apply_steps`` builds the
# column expression.  The same lists drive the SQL oracles.
# Literal replacements of the Cyrillic-ads cleaner, in order.
CYR_LITERALS = (
    ("\xa0", ""), (" -", ""), ("- ", ""), (" - ", ""), ("-", ""), ("—", ""),
    (":)", "улыбка"), ("(:", "улыбка"), (":-)", "улыбка"),
    ("⇘", ""), ("⇓", ""), ("⇙", ""), ("⇒", ""), ("ﻩ", ""), ("º", ""),
    ("ᗒᗣᗕ", ""), ("ღ", ""), ("ლ", ""), ("ஜ", ""), ("/", ""), ("\n", " "), ("\n\r\f\x0b", ""),
)


def apply_steps(c, steps) -> Column:
    x = col_(c)
    for step, arg in steps:
        if step == "truncate":
            x = truncate_words(x, arg)
        elif step == "normalize_ws":
            x = F.array_join(tokens(x), " ")
        elif step == "contractions":
            x = expand_contractions(x)
        elif step == "lower":
            x = F.lower(x)
        elif step == "masks":
            x = mask_numbers(x)
        elif step == "split_digit_word":
            x = split_digit_word(x)
        elif step == "split_word_digit":
            x = split_word_digit(x)
        elif step == "strip_nonword":
            x = strip_nonword(x, arg or "")
        elif step == "stopwords":
            x = drop_stopwords(x, arg)
        elif step == "ascii_only":
            x = ascii_only_keep(x, arg or "")
        elif step == "digit_runs":
            x = space_digit_runs(x)
        elif step == "collapse":
            x = collapse_ws(x)
        elif step == "punct":
            x = strip_punct(x, arg)
        elif step == "digits":
            x = drop_digits(x, arg)
        elif step == "literals":
            x = literal_replace(x, arg)
        elif step == "remove":
            x = F.regexp_replace(x, arg, "")
        elif step == "ws_to_blank":
            x = F.regexp_replace(x, f"[{_WS}]+", " ")
        else:
            raise ValueError(step)
    return x


def full_steps(stop: Sequence[str]):
    """Contractions, lower, digit/word split, strip, stop words, ASCII, digit runs, collapse."""
    return [("contractions", None), ("lower", None), ("split_digit_word", None), ("strip_nonword", None),
            ("stopwords", list(stop)), ("ascii_only", None), ("digit_runs", None), ("collapse", None)]


def masked_steps(stop: Sequence[str], max_words: int | None = 60, keep_mask: bool = True):
    keep = "#" if keep_mask else ""
    pre = [("truncate", max_words)] if max_words else []
    return pre + [("contractions", None), ("lower", None), ("masks", None), ("split_digit_word", None),
                  ("strip_nonword", keep), ("stopwords", list(stop)), ("ascii_only", keep),
                  ("digit_runs", None), ("collapse", None)]


def letters_steps(max_words: int = 50):
    return [("truncate", max_words), ("contractions", None), ("lower", None), ("punct", " "),
            ("split_digit_word", None), ("digits", " "), ("strip_nonword", None), ("ascii_only", None),
            ("digit_runs", None), ("collapse", None)]


def corpus_steps():
    return [("normalize_ws", None), ("contractions", None), ("lower", None), ("split_digit_word", None),
            ("punct", " "), ("digits", " #"), ("digit_runs", None), ("collapse", None)]


def cyr_steps(max_words: int = 100):
    return [("lower", None), ("truncate", max_words), ("literals", list(CYR_LITERALS)), ("punct", ""),
            ("remove", "[a-z0-9]"), ("ws_to_blank", None), ("split_digit_word", None),
            ("split_word_digit", None)]
