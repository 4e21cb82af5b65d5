"""Token ids of whole batches of texts.

The pieces that a tokenizer's own pattern yields are found with vectorised comparisons of neighbouring character
classes; each different piece is encoded once per worker by the tokenizers library, and the ids of a batch are
gathered from there.  The ids are those of ``encode_batch(texts, add_special_tokens=False)``.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

#: Pieces that a worker remembers, at about 45 bytes each; beyond it the memory starts anew.
REMEMBERED = 1_000_000
#: Code points that are handled at once, about 100 bytes each; longer texts are cut before white space.
AT_ONCE = 1 << 19
#: Where a text can be cut: every pattern starts a piece at white space that follows a word character.
_CUT = re.compile(r"(?<=\w)[ \n\t]")
SPACE, BLANK, LETTER, NUMBER, OTHER = 0, 1, 2, 3, 4
_MULTIPLIER = 0x9E3779B97F4A7C15
_tables: dict[str, np.ndarray] = {}
_encoders: dict[str, "Encoder"] = {}


def classes() -> np.ndarray:
    """Class of each code point; BLANK is U+0020 alone."""
    if "classes" not in _tables:
        table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
        # the planes from 4 on hold neither letters nor numbers, but that plane 14 might
        for cp in (*range(0x40000), *range(0xE0000, 0xF0000)):
            kind = unicodedata.category(chr(cp))[0]
            if kind == "L":
                table[cp] = LETTER
            elif kind == "N":
                table[cp] = NUMBER
        for cp in [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
            table[cp] = SPACE
        table[0x20] = BLANK
        _tables["classes"] = table
    return _tables["classes"]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64; tables for more than AT_ONCE aren't kept."""
    held = _tables if n <= AT_ONCE else {}
    if len(held.get("up", ())) < n:
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(max(n, AT_ONCE), np.uint64(base))
            steps[0] = 1
            held[name] = np.multiply.accumulate(steps)
    return held["up"][:n], held["down"][:n]


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int, list[str]]]:
    """(lo, hi, texts) of a column of strings, about ``most`` bytes at a time; null is an empty text."""
    import pyarrow.compute as pc

    ends = np.cumsum(np.array(pc.fill_null(pc.binary_length(column), 0)), dtype=np.int64)
    lo = 0
    while lo < len(ends):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "left")) + 1
        hi = min(hi, len(ends))
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
        lo = hi


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable ones as themselves, others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(rest)) for b in range(256)}


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        # a normaliser and a splitting pattern: white space goes, case folds, digits stand alone
        self.folded = self.tokenizer.normalizer is not None
        self.letters = byte_letters()
        self.forget()

    def forget(self) -> None:
        """Pieces by ascending hash, with the place and number of their ids in ``flat``."""
        self.known, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def piece_ids(self, piece: str) -> list[int]:
        if piece.isascii() and piece[-1:].isalnum() and piece.isprintable():
            # only a blank that comes first is spelled otherwise
            spelled = piece.replace(" ", self.letters[32])
        else:
            spelled = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(spelled)]

    def normal(self, text: str) -> str:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # lower-casing is by character: no final form of sigma
        return text.replace("Σ", "σ").lower()

    def starts(self, cps: np.ndarray, kind: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each code point; ``heads`` marks where texts start."""
        before = np.empty_like(kind)
        before[0], before[1:] = SPACE, kind[:-1]
        solid, solid_before = kind >= LETTER, before >= LETTER
        change = kind != before
        if self.folded:
            starts = change | (kind == NUMBER)
        else:
            last = np.zeros(len(kind), bool)
            last[:-1] = solid[1:] & ~heads[1:]
            starts = np.where(solid, change & (solid_before | (before == SPACE)), solid_before | last)
        starts |= heads
        marks = np.flatnonzero(starts & (cps == 0x27))
        if len(marks):
            self.contract(cps, kind, heads, starts, marks)
        return starts

    @staticmethod
    def contract(cps, kind, heads, starts, marks) -> None:
        """An apostrophe that starts a piece takes s, t, m, d, re, ve or ll with it."""
        n = len(cps)
        text_no = np.cumsum(heads)
        inside = lambda at, k: (at + k < n) & (text_no[np.minimum(at + k, n - 1)] == text_no[at])
        at = lambda k: cps[np.minimum(marks + k, n - 1)]
        one = inside(marks, 1) & np.isin(at(1), [ord(c) for c in "stmd"])
        two = inside(marks, 2) & np.logical_or.reduce([(at(1) == ord(a)) & (at(2) == ord(b)) for a, b in ("re", "ve", "ll")])
        for k, hit in ((1, one), (2, two)):
            where = marks[hit]
            starts[where + 1] = False
            after = where + k + 1
            after = after[inside(where, k + 1)]
            starts[after[kind[after] == LETTER]] = True

    def learn(self, hashes: np.ndarray, at: np.ndarray, pieces: list[str]) -> None:
        """Remember pieces that aren't known yet; ``hashes`` ascend and belong before the places ``at``."""
        found = [self.piece_ids(piece) for piece in pieces]
        count = np.fromiter(map(len, found), np.int32, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum()))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        old = np.ones(len(self.known) + len(at), bool)
        at = at + np.arange(len(at))
        old[at] = False
        for name, new in (("known", hashes), ("first", self.used + np.cumsum(count, dtype=np.int64) - count), ("count", count)):
            held = getattr(self, name)
            both = np.empty(len(old), held.dtype)
            both[at], both[old] = new, held
            setattr(self, name, both)
        self.used += len(ids)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places among the known hashes or where they belong, whether they are unknown); ``hashes`` ascend, so the search stays in the cache."""
        at = np.searchsorted(self.known, hashes)
        if not len(self.known):
            return at, np.ones(len(hashes), bool)
        return at, self.known[np.minimum(at, len(self.known) - 1)] != hashes

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        if not joined:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = classes()[cps]
        heads = np.zeros(len(cps), bool)
        heads[(ends - lengths)[lengths > 0]] = True
        at = np.flatnonzero(self.starts(cps, kind, heads))
        stop = np.append(at[1:], len(cps))
        if self.folded:
            solid = kind[at] >= LETTER
            at, stop = at[solid], stop[solid]
        if not len(at):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        up, down = powers(len(cps))
        total = np.zeros(len(cps) + 1, np.uint64)
        np.cumsum((cps.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
        hashes = (total[stop] - total[at]) * down[at]
        codes, different = pd.factorize(hashes)
        order = np.argsort(different)
        asked = different[order]
        found, new = self.find(asked)
        if len(self.known) + int(new.sum()) > REMEMBERED:
            self.forget()
            found, new = self.find(asked)
        if new.any():
            where = np.empty(len(different), np.int64)
            where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            chosen = order[new]
            self.learn(asked[new], found[new], [joined[a:b] for a, b in zip(at[where[chosen]].tolist(), stop[where[chosen]].tolist(), strict=True)])
            # the new ones before it move a place on
            found = found + np.cumsum(new) - new
        slots = np.empty_like(found)
        slots[order] = found
        counts = self.count[slots][codes]
        sums = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=sums[1:])
        ids = self.flat[np.repeat(self.first[slots][codes] - sums[:-1], counts) + np.arange(sums[-1])]
        bounds = sums[np.searchsorted(at, np.concatenate([[0], ends]), "left")]
        return ids, np.diff(bounds)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        ids, counts = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        batch, owners, size = [], [], 0
        for owner, part in [*parts(texts, self.normal if self.folded else str), (0, None)]:
            if batch and (part is None or size + len(part) > AT_ONCE):
                one, n = self._encode(batch)
                ids.append(one)
                np.add.at(counts, owners, n)
                batch, owners, size = [], [], 0
            if part is not None:
                batch.append(part)
                owners.append(owner)
                size += len(part)
        return np.concatenate(ids), counts


def parts(texts: list[str], normal) -> Iterator[tuple[int, str]]:
    """(number of the text, part): texts, or parts of long ones that are encoded alike."""
    for owner, text in enumerate(texts):
        text = normal(text)
        lo = 0
        while len(text) - lo > AT_ONCE and (cut := _CUT.search(text, lo + max(1, AT_ONCE - 256))):
            yield owner, text[lo : cut.start()]
            lo = cut.start()
        yield owner, text[lo:] if lo else text


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append an end id to each document."""
    out = np.full(len(ids) + len(counts), end, np.uint32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = ids
    return out, counts + 1
