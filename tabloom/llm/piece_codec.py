"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

For each prefix of a unit the table stores the one token that ends its
encoding.  Candidates are the vocabulary pieces that end there (matches of an
Aho-Corasick automaton); the right one is that which is compatible with the
last token of the prefix before it: merging the two tokens' characters by
rank must give back exactly these two tokens.  Compatibility is decided by
undoing merges from the border outwards.  The ids are read off backwards.

A unit is a stretch between two neighbouring characters that no vocabulary
piece holds side by side: no token can span such a border, so units are
encoded on their own and kept in a bounded table per process.  Characters
outside the vocabulary become their UTF-8 bytes' tokens, as in the library.

Decoding joins the pieces, turns byte tokens back to text and drops the space
that encoding put in front.

Defined results: null texts are empty and have no ids; each input row gives
one row; empty tables give empty tables; other columns are not read.  Very long
texts and words (a text without blanks is one) are encoded as they are, and words
of more than ``LONGEST`` characters are not kept.  The job is one pass without a
shuffle.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_MARK = "▁"
#: Words kept per process, the longest that are, and pairs of pieces kept.
UNITS_KEPT, LONGEST, PAIRS_KEPT = 600_000, 48, 4_000_000
#: Characters of a unit's beginning whose prefix table is kept.
HEAD = 7
_CODECS: dict = {}


class _Words(dict):
    """Results per word, in two generations: the older one goes when the younger is full, words in use move on.  Long words are not kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, word: str):
        got = self.old.get(word)
        if got is None:
            got = self.make(word)
        if len(word) > LONGEST:
            return got
        if len(self) >= self.most // 2:
            self.old = dict(self)
            self.clear()
        self[word] = got
        return got


class PieceCodec:
    """Encoder and decoder of one SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        model = model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = model_pb2.ModelProto.SentencePiece
        n, t = model.normalizer_spec, model.trainer_spec
        if t.model_type != 2 or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or not t.byte_fallback:
            raise ValueError("a BPE model with byte fallback and no text normalisation is needed")
        self.dummy_prefix = n.add_dummy_prefix
        self.pieces = [p.piece for p in model.pieces]
        self.types = [p.type for p in model.pieces]
        if any(x in (kinds.USER_DEFINED, kinds.UNUSED) for x in self.types):
            raise ValueError("user-defined and unused pieces are not supported")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        # merge order: higher score first, ties cannot be told apart by the library either
        order = sorted(self.ids, key=lambda p: -model.pieces[self.ids[p]].score)
        self.rank = {p: r for r, p in enumerate(order)}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.compatible: list[dict[int, bool]] = [{} for _ in self.pieces]  # by right token, then left
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if len(p) == 1 or self._split(p) is not None:  # a piece that merging never makes ends no prefix
                self.automaton.add_word(p, self.ids[p])
        self.automaton.make_automaton()
        self.chars = frozenset(p for p in self.ids if len(p) == 1)
        self.lengths = [len(p) for p in self.pieces]
        self.units = _Words(self._word, UNITS_KEPT)
        self.odd: dict[str, str] = {}
        self.odd_here: dict[str, str] = {}  # the same of words that are not kept: for the text at hand
        self.pairs = 0
        self.heads: dict[str, list[int]] = {}
        inside = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        self.inside = inside
        self.closing = "".join(c for c in ".,;:!?|" if c in self.chars and not any(b == c and a.isalpha() for a, b in inside))
        self.word = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+") if not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids) else None

    def _merge(self, text: str) -> list[str]:
        """Tokens by repeated merging of the best-ranked neighbours, leftmost first: the definition, for short strings."""
        parts = list(text)
        while len(parts) > 1:
            best = min(((self.rank.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
            if best[0] == 1 << 60:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def _split(self, token: str) -> tuple[str, str] | None:
        """The two tokens whose merge made ``token``, or None where merging never makes it."""
        if token not in self.splits:
            own = self.rank.pop(token)
            halves = self._merge(token)
            self.rank[token] = own
            self.splits[token] = tuple(halves) if len(halves) == 2 else None
        return self.splits[token]

    def _pair_fits(self, left: str, right: str) -> bool:
        """Whether merging the characters of ``left + right`` gives back these two tokens.

        Walks back in time: the later-made of the two border tokens is undone
        to its half at the border.  While a border pair stood, a merge across
        it would have happened had its rank come before the merge that ended
        the pair (at equal rank the leftmost goes first).
        """
        rank, until, known = self.rank, 1 << 60, True
        while True:
            if rank.get(left + right, 1 << 60) < until:
                known = False
                break
            when_left = rank[left] if len(left) > 1 else -1
            when_right = rank[right] if len(right) > 1 else -1
            if when_left < 0 and when_right < 0:
                break
            if when_left > when_right:  # the left one was merged last; across the border is to its right
                until, left = when_left, self._split(left)[1]
            else:  # to the left of the right one, so it wins ties
                until, right = when_right + 1, self._split(right)[0]
        return known

    def known_ids(self, unit: str) -> list[int]:
        """Encoding, by the prefix table, of a unit whose characters are all in the vocabulary."""
        n = len(unit)
        # the table of a prefix is the same in every unit that begins with it
        head = unit[:HEAD]
        last = self.heads.get(head)
        last = [-1] * n if last is None else last + [-1] * (n - len(last))
        compatible, pieces, lengths = self.compatible, self.pieces, self.lengths
        for end, piece in self.automaton.iter(unit):  # ends ascend, so every shorter prefix is known
            if last[end] < 0:
                begin = end - lengths[piece]
                if begin < 0:  # last[end] belongs to the prefix that ends with this character
                    last[end] = piece
                else:
                    before = last[begin]
                    fits = compatible[piece].get(before)
                    if fits is None:
                        fits = compatible[piece][before] = self._pair_fits(pieces[before], pieces[piece])
                        self.pairs += 1
                    if fits:
                        last[end] = piece
        if n >= HEAD and head not in self.heads:
            if len(self.heads) >= UNITS_KEPT:
                self.heads.clear()
            self.heads[head] = last[:HEAD]
        out, at = [], n - 1
        while at >= 0:
            piece = last[at]
            out.append(piece)
            at -= lengths[piece]
        out.reverse()
        return out

    def _units(self, word: str) -> list[str]:
        inside, out, begin = self.inside, [], 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in inside:
                out.append(word[begin:i])
                begin = i
        out.append(word[begin:])
        return out

    def encode_word(self, word: str) -> tuple[list[int], bool]:
        """Ids of a word, and whether all are vocabulary pieces."""
        if self.chars.issuperset(word):
            return self.known_ids(word), True
        ids: list[int] = []
        for unit in self._units(word):  # a character outside the vocabulary is a unit: no piece holds it
            ids += self.known_ids(unit) if self.chars.issuperset(unit) else [self.byte_ids[b] for b in unit.encode("utf-8", "replace")]
        return ids, False

    def decode(self, ids: list[int]) -> str:
        """Text of ids; broken byte sequences give U+FFFD per byte, as the library does."""
        out: list[str] = []
        held = bytearray()

        def flush() -> None:
            at = 0
            while at < len(held):
                for width in (4, 3, 2, 1):
                    try:
                        out.append(held[at:at + width].decode("utf-8") if at + width <= len(held) else bytes([255]).decode("utf-8"))
                        at += width
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            held.clear()

        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            flush()
            if self.types[i] != 3:  # control pieces have no text
                out.append(" ⁇ " if self.types[i] == 2 else self.pieces[i])
        flush()
        text = "".join(out)
        if self.dummy_prefix and text.startswith(SPACE_MARK):
            text = text[1:]
        return text.replace(SPACE_MARK, " ")

    def _word(self, word: str) -> str:
        """Ids, joined by commas, of a word inside a text; its text goes to ``odd`` where it is not the word's own."""
        stem = word.rstrip(self.closing)
        if stem != word and stem[-1:].isalpha():  # no piece holds a letter and what follows it: two units
            rest = word[len(stem):]
            ids = f"{self.units[stem]},{self.units[rest]}"
            text = self._decoded(stem) + self._decoded(rest)
            if text != word:
                (self.odd if len(word) <= LONGEST else self.odd_here)[word] = text
            return ids
        ids, plain = self.encode_word(word)
        if plain:
            text = "".join([self.pieces[i] for i in ids])
        else:
            text = self.decode([self.ids["a"], *ids])[1:].replace(" ", SPACE_MARK)  # inside a text no space is dropped
        if text != word:
            (self.odd if len(word) <= LONGEST else self.odd_here)[word] = text
        return ",".join(map(str, ids))

    def _decoded(self, word: str) -> str:
        return self.odd_here.get(word) or self.odd.get(word, word)

    def _make_room(self) -> None:
        """What is kept between texts stays bounded: words and their odd texts go together."""
        self.odd_here.clear()
        if len(self.odd) > UNITS_KEPT:
            self.units.clear()
            self.units.old = {}
            self.odd.clear()
        if self.pairs > PAIRS_KEPT:
            self.compatible, self.pairs = [{} for _ in self.pieces], 0

    def listing(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by commas, decoded text)."""
        if not text:
            return 0, "", ""
        self._make_room()
        marked = (SPACE_MARK if self.dummy_prefix else "") + text.replace(" ", SPACE_MARK)
        words = self.word.findall(marked) if self.word else [marked]
        ids = ",".join(map(self.units.__getitem__, words))
        # a word's ids are decoded when it is first met; what differs from the word itself is kept apart
        decoded = marked if not (self.odd or self.odd_here) else "".join([self._decoded(w) for w in words])
        decoded = decoded.replace(SPACE_MARK, " ")
        return ids.count(",") + 1, ids, decoded[1:] if self.dummy_prefix else decoded

    def encode(self, text: str) -> list[int]:
        ids = self.listing(text)[1]
        return [int(i) for i in ids.split(",")] if ids else []


def codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encode_table(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: id, n_tokens, digests of ids and decoded text; ``with_ids`` adds both themselves."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for b in batches:
            got = [c.listing(t or "") for t in b["text"]]
            out = pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": [g[0] for g in got], "ids_sha256": [sha(g[1]) for g in got], "decoded_sha256": [sha(g[2]) for g in got]})
            if with_ids:
                out["ids"], out["decoded"] = [[int(i) for i in g[1].split(",")] if g[1] else [] for g in got], [g[2] for g in got]
            yield out

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInPandas(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else ""))
