"""Personal data: patterns propose spans, checksums confirm them, context words score them.

All work is one projection per kind in DataFrame functions.  ``split`` and
``regexp_extract_all`` of one pattern give the gaps and the matches of a
text; running sums of their lengths give code-point positions.  Patterns use
possessive repeats and a look-behind (or the end of the last match), so a
search is linear in the text also where a long run of digits or letters
matches nothing.

Kinds: email, ip, card (Luhn), phone by fixed rules; iban (mod 97) and ssn are
added by the method: a pattern match gets a base score, a passed checksum and
helpful words in the ``CONTEXT`` code points before it raise it, unhelpful
words lower it, and spans of at least ``KEEP`` stay.  Fixed kinds stay at any
score.  An iban has exactly the length of its country, whatever follows it,
and each place where one may begin is judged on its own; other country codes
have no ibans.

Defined results: null texts count as empty and have no spans; each input row
gives one row; empty tables give empty tables; other columns are not read
(``find_pii`` keeps them).  Very long texts are searched in linear time; placing
the spans of one text takes time quadratic in their number.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_or_empty

#: Code points before a span in which context words count, and the least score of an added span.
CONTEXT, KEEP = 40, 0.6

_DIGIT_START = r"(?:(?<![0-9])|\G)"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = _digits(m)
    return F.length(d).between(12, 19) & F.call_function("luhn_check", d)


def _ip_parts(m: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _mod97(m: Column) -> Column:
    """ISO 7064: the first four characters go last, letters count from 10, remainder 1."""
    s = F.regexp_replace(m, " ", "")
    moved = F.concat(F.substring(s, 5, 40), F.substring(s, 1, 4))

    def step(acc: Column, ch: Column) -> Column:
        v = F.ascii(ch)
        return F.when(v >= 65, (acc * 100 + v - 55) % 97).otherwise((acc * 10 + v - 48) % 97).cast("long")

    return F.length(s).between(15, 34) & (F.aggregate(F.split(moved, ""), F.lit(0).cast("long"), lambda a, ch: F.when(ch == "", a).otherwise(step(a, ch))) == 1)


#: Characters of an IBAN by country: the register, the territories that use another country's form, and codes in use outside the register.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "AX DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE GG IE IM JE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR", 27: "BI BL CF CG CM DJ FR GA GF GP GQ GR IT KM MC MF MG MQ MR NC PF PM RE SM TD TF WF YT",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_IBAN = "|".join(rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())


def _ssn(m: Column) -> Column:
    return ~m.rlike(r"^(?:000|666|9)|-00-|-0000$")


#: kind: (pattern, cheap test of the text, validator, checksum?, helpful words, unhelpful words); the first four are fixed.
KINDS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: t.contains("@"), None, False, "mail|contact|write", "example"),
    "ip": (_DIGIT_START + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda t: t.contains("."), _ip_parts, False, r"\bip\b|address|server|host", "version|release"),
    "card": (_DIGIT_START + r"[0-9](?:[\x20-]?[0-9])++", None, _luhn, True, "card|visa|master|credit|debit|pay", "order|invoice|isbn|serial"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.contains("+"), lambda m: F.length(_digits(m)).between(9, 15), False, "phone|call|tel|mobile|fax", "version"),
    "iban": (rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{_IBAN})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}", None, _mod97, True, "iban|account|bank|transfer|konto", "order|serial"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda t: t.contains("-"), _ssn, False, r"ssn|social|security|tax|\bid\b", "order|part|serial|phone"),
}
BASE = ("email", "ip", "card", "phone")
#: Kinds whose pattern takes only so many characters and looks ahead over the span, its first group, so that spans may overlap.
HEADS = {"iban": 4}


def spans_of(kind: str, text: Column) -> Column:
    """Confirmed spans of a kind as an array of (start, rank, kind, end, score)."""
    pattern, cheap, valid, checksum, good, bad = KINDS[kind]
    rank = list(KINDS).index(kind)
    shape = "array<struct<start:int,rank:int,kind:string,end:int,score:double>>"
    none = F.array().cast(shape)

    def placed(gaps: Column, found: Column) -> Column:
        def add(state: Column, m: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(gaps, i))
            return F.struct((start + HEADS.get(kind, F.length(m))).alias("at"), F.array_append(state["out"], F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("m"))).alias("out"))
        numbered = F.transform(found, lambda m, i: F.struct(m.alias("m"), i.alias("i")))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,m:string>>").alias("out"))
        return F.aggregate(numbered, zero, lambda s, x: add(s, x["m"], x["i"]), lambda s: s["out"])

    def scored(x: Column) -> Column:
        before = F.lower(F.substring(text, F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT))))
        points = F.lit(0.8 if checksum else 0.5) + F.when(before.rlike(good), 0.3).otherwise(0.0) - F.when(before.rlike(bad), 0.3).otherwise(0.0)
        return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end"), F.least(points, F.lit(1.0)).alias("score"))

    def confirmed(found: Column) -> Column:
        places = let(F.split(text, pattern, -1), lambda gaps: placed(gaps, found))
        if valid is not None:
            places = F.filter(places, lambda x: valid(x["m"]))
        out = F.transform(places, scored)
        if kind not in BASE:
            out = F.filter(out, lambda x: x["score"] >= KEEP)
        return F.when(F.size(found) == 0, none).otherwise(out.cast(shape))

    out = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(1 if kind in HEADS else 0)), confirmed)
    return out if cheap is None else F.when(cheap(text), out).otherwise(none)


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input rows plus ``__spans``: all spans by start, then kind as listed."""
    text = text_or_empty(text_col)
    return docs.withColumn("__spans", F.sort_array(F.concat(*[spans_of(k, text) for k in KINDS])))


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[KIND]``; overlapping spans become one, named by the first."""
    def joined(acc: Column, x: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        touch = F.coalesce(last["end"] > x["start"], F.lit(False))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when(touch, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.array_append(acc, F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def cut(flat: Column) -> Column:
        pieces = F.transform(flat, lambda x, i: F.concat(
            F.substring(text, F.when(i == 0, 0).otherwise(F.get(flat, i - 1)["end"]) + 1, x["start"] - F.when(i == 0, 0).otherwise(F.get(flat, i - 1)["end"])),
            F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.concat(F.array_join(pieces, ""), F.substring(text, F.get(flat, F.size(flat) - 1)["end"] + 1, F.length(text)))

    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    flat = F.aggregate(spans, empty, joined)
    return F.when(F.size(spans) == 0, text).otherwise(let(flat, cut))


def listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def pii_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of the fixed kinds, digest of their spans, all spans, highest score."""
    d = find_pii(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__t")), "__t").select("doc_id", "__spans")
    count = lambda k: F.size(F.filter("__spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("__spans", lambda x: x["kind"].isin(*BASE))
    return d.select("doc_id", *[count(k) for k in BASE], F.sha2(listing(base), 256).alias("base_sha256"), listing(F.col("__spans")).alias("spans"),
                    *[count(k) for k in KINDS if k not in BASE], F.array_max(F.transform("__spans", lambda x: x["score"])).alias("top_score"))
