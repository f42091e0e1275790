"""Token ids by the tokenizers library, with each distinct word of a worker encoded once.

A byte-level BPE tokenizer cuts a text into pieces by a fixed pattern and encodes every
piece on its own. The cutting is done here on whole slices of text; each new distinct
piece then goes through the library's model, and its ids are kept for the next batches.
A text with a character outside the ranges whose class is known goes to the library whole,
and so does one that holds the content of an added token, which the library cuts out first.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa

from courierlens.llm.blocks import SpanHasher, flat, slices
from courierlens.llm.wordpiece import byte_alphabet

SPACE, LETTER, NUMBER, OTHER = range(4)
# code points below this were assigned, and their classes fixed, long ago
KNOWN = 0x250
# distinct pieces kept by one worker: about 60 bytes each
KEEP = 1_000_000
# places of the table in which most of them are found by their hash
PLACES = 1 << 22
_ID = attrgetter("id")


def _classes() -> np.ndarray:
    """Class of each known code point for the pattern's space, letter and number sets."""
    table = np.full(KNOWN, OTHER, np.uint8)
    for c in range(KNOWN):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            table[c] = LETTER
        elif kind[0] == "N":
            table[c] = NUMBER
    table[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0]] = SPACE
    return table


_CLASSES = _classes()
# what the pattern splits off after an apostrophe that starts a piece
_SHORT = [b"s", b"t", b"m", b"d"]
_LONG = [b"re", b"ve", b"ll"]


def piece_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of UTF-8 rows with known code points, and n + 1 piece offsets per row."""
    kind = _CLASSES[data]
    # known code points above ASCII have two bytes, of one class
    wide = np.flatnonzero(data >= 0xC0)
    if len(wide):
        kind[wide] = kind[wide + 1] = _CLASSES[(data[wide].astype(np.int32) & 0x1F) << 6 | (data[wide + 1] & 0x3F)]
    n = len(data)
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    row_first = np.zeros(n + 1, bool)
    row_first[firsts] = True
    row_first[n] = True
    begins = row_first[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(begins)
    ends = np.append(runs[1:], n)
    space = kind[runs] == SPACE
    followed = space & ~row_first[ends]
    # a run of white space before something else leaves its last character: alone, or before the next piece
    last = ends[followed] - 1
    plain = data[last] == 0x20
    begins[last - ((data[last] & 0xC0) == 0x80)] = True
    begins[ends[followed][plain]] = False
    # an apostrophe alone that starts a piece takes the letters of a contraction with it
    marks = runs[(ends - runs == 1) & (data[runs] == 0x27)]
    marks = marks[begins[marks] & (marks + 1 < n)]
    for mark in marks[~row_first[marks + 1]].tolist():
        tail = data[mark + 1 : mark + 3]
        stop = row_first[mark + 2] if mark + 2 <= n else True
        one = bytes([tail[0]]) if tail[0] < 0x80 else b""
        two = bytes(tail.tolist()) if len(tail) == 2 and not stop and (tail < 0x80).all() else b""
        length = 1 if one in _SHORT else 2 if two in _LONG else 0
        if length:
            begins[mark + 1] = False
            if mark + 1 + length < n:
                begins[mark + 1 + length] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], n) if len(starts) else starts, np.searchsorted(starts, offsets)


def rows_with(data: np.ndarray, offsets: np.ndarray, contents: list[bytes]) -> np.ndarray:
    """Rows in which one of the contents stands whole."""
    raw, found = data.tobytes(), []
    for content in contents:
        at = raw.find(content)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            whole = at + len(content) <= offsets[row + 1]
            if whole:
                found.append(row)
            at = raw.find(content, int(offsets[row + 1]) if whole else at + 1)
    return np.unique(np.array(found, np.int64))


def with_room(values: np.ndarray, used: int, more: int) -> np.ndarray:
    """``values`` with room for ``more`` after the first ``used``; to get it they move to twice the room."""
    if used + more <= len(values):
        return values
    return np.concatenate([values[:used], np.zeros(max(used, more), values.dtype)])


class Encoder:
    """Ids of texts, with the pieces seen so far kept by two independent 64-bit hashes.

    With ``added``, the library's default, the content of an added token gives that token;
    without, it is text like any other.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not added
        tokens = self.whole.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in tokens if added or not t.special]
        self.model = self.whole.model
        self.spell = {b: c for c, b in byte_alphabet().items()}
        self.one, self.two = SpanHasher(0x1D51), SpanHasher(0x1D52)
        self._reset()

    def _reset(self) -> None:
        # pieces in the order they were learned: two hashes, and each one's run in ids; with room for more
        self.count = 0
        self.known, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.ids = np.zeros(1, np.int32), np.zeros(0, np.uint32)
        # place of a hash -> the first piece there, and the other pieces by sorted hash
        self.table = np.full(PLACES, -1, np.int32)
        self.others, self.which = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    @staticmethod
    def _place(one: np.ndarray) -> np.ndarray:
        return (one >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int32)

    def _find(self, one: np.ndarray) -> np.ndarray:
        """The number of the learned piece with each hash, or -1."""
        if not self.count:
            return np.full(len(one), -1, np.int32)
        found = self.table[self._place(one)]
        missed = np.flatnonzero((found < 0) | (self.known[found] != one))
        if not len(missed):
            return found
        found[missed] = -1
        if len(self.others):
            near = np.minimum(np.searchsorted(self.others, one[missed]), len(self.others) - 1)
            same = self.others[near] == one[missed]
            found[missed[same]] = self.which[near[same]]
        return found

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """Add new pieces; their hashes ``one`` are sorted."""
        # the new pieces one after the other, spelled at once: a byte is one character
        ends = np.cumsum(ends - starts)
        begins = np.concatenate([[0], ends[:-1]])
        at = np.arange(ends[-1]) + np.repeat(starts - begins, ends - begins)
        text = data[at].tobytes().decode("latin-1").translate(self.spell)
        tokenize, found, sizes = self.model.tokenize, [], []
        for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
            tokens = tokenize(text[a:b])
            found.extend(map(_ID, tokens))
            sizes.append(len(tokens))
        old, count, end = self.count, self.count + len(one), int(self.at[self.count])
        number = np.arange(old, count, dtype=np.int32)
        self.known, self.check = (with_room(v, old, len(one)) for v in (self.known, self.check))
        self.at, self.ids = with_room(self.at, old + 1, len(one)), with_room(self.ids, end, len(found))
        self.known[old:count], self.check[old:count] = one, two
        self.at[old + 1 : count + 1] = end + np.cumsum(np.array(sizes, np.int32))
        self.ids[end : end + len(found)] = found
        self.count = count
        place = self._place(one)
        free = self.table[place] < 0
        self.table[place[free]] = number[free]
        other = np.flatnonzero(self.table[place] != number)
        among = np.searchsorted(self.others, one[other])
        self.others, self.which = np.insert(self.others, among, one[other]), np.insert(self.which, among, number[other])

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows that hold known code points only, and how many each row has."""
        starts, ends, rows = piece_bounds(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        one, two = self.one(data, starts, ends), self.two(data, starts, ends)
        run = self._find(one)
        new = np.flatnonzero(run < 0)
        if len(new):
            distinct, first, inverse = np.unique(one[new], return_index=True, return_inverse=True)
            if self.count and self.count + len(distinct) > KEEP:
                self._reset()
                return self._slice(data, offsets)
            first = new[first]
            learned = self.count + np.arange(len(distinct), dtype=np.int32)
            self._learn(data, starts[first], ends[first], distinct, two[first])
            run[new] = learned[inverse]
        if (self.check[run] != two).any():
            return self._library(data, offsets)
        begin = self.at[run]
        sizes = self.at[run + 1] - begin
        total = np.cumsum(sizes)
        fill = np.repeat(begin - (total - sizes), sizes)
        fill += np.arange(len(fill))
        bounds = np.concatenate([[0], total])[rows]
        return self.ids[fill], np.diff(bounds)

    def _library(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The library's own cutting and encoding: for other characters, or if two pieces share a hash."""
        texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        found = [np.array(e.ids, np.uint32) for e in self.whole.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate(found), np.array([len(x) for x in found], np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts (a null is empty), and n + 1 offsets."""
        data, offsets = flat(column)
        parts, counts = [], []
        for a, b in slices(offsets):
            # leading bytes from here on start code points that are not known
            places = np.flatnonzero(data[offsets[a] : offsets[b]] >= 0xC0 + (KNOWN >> 6)) + offsets[a]
            strange = np.searchsorted(offsets, places, side="right") - 1
            holding = rows_with(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], self.added) + a
            strange = np.unique(np.concatenate([strange, holding]))
            at = a
            # runs of plain rows together, every other row through the library
            for i in [*strange.tolist(), b]:
                if i > at:
                    ids, sizes = self._slice(data[offsets[at] : offsets[i]], offsets[at : i + 1] - offsets[at])
                    parts.append(ids)
                    counts.append(sizes)
                if i < b:
                    ids, sizes = self._library(data[offsets[i] : offsets[i + 1]], offsets[i : i + 2] - offsets[i])
                    parts.append(ids)
                    counts.append(sizes)
                at = i + 1
        sizes = np.concatenate([np.zeros(1, np.int64), *counts])
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.cumsum(sizes)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added: bool = False) -> Encoder:
    """This worker's encoder; it lives as long as the worker does."""
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = Encoder(path, added)
    return _ENCODERS[path, added]


def closed(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same rows with ``end_id`` after each."""
    return np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def rows_of(ids: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield ids[a:b]
