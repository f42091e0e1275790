"""Greedy longest-match token counts by a linear automaton.

A trie of the vocabulary has, for every node, a failure link and the number of tokens that
are popped on following it: what greedy longest match emits before it goes on from the
node's remaining suffix. A word is read once, byte by byte, and no token text is built.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.blocks import SpanHasher, flat, slices, word_spans

ROOT = 0
# with no more words left than this, each is read on its own
FEW = 64


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies spell bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_pieces(path: str) -> list[bytes]:
    """The pieces of a byte-level tokenizer file; added special tokens are no pieces."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    table = byte_alphabet()
    return [bytes(map(table.__getitem__, p)) for p in spec["model"]["vocab"] if p not in special]


@dataclass(frozen=True)
class Automaton:
    """Transitions in an open-addressing table; per state its link, pops, and pops at a word's end."""

    slots: np.ndarray
    targets: np.ndarray
    link: np.ndarray
    pops: np.ndarray
    end_pops: np.ndarray

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The child of each state by its byte, or -1."""
        keys = states.astype(np.int64) << 8 | symbols
        found = np.full(len(keys), -1, np.int32)
        place, open_ = _slot(keys, len(self.slots)), np.arange(len(keys))
        while len(open_):
            held = self.slots[place]
            hit = held == keys[open_]
            found[open_[hit]] = self.targets[place[hit]]
            more = ~hit & (held >= 0)
            open_, place = open_[more], (place[more] + 1) & (len(self.slots) - 1)
        return found

    def lengths(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: bytes = b" ") -> np.ndarray:
        """Tokens of each span of ``data``, read after the bytes ``lead``."""
        order = np.argsort(ends - starts, kind="stable")[::-1]
        sizes = (ends - starts)[order]
        firsts = starts[order]
        states = np.zeros(len(order), np.int32)
        counts = np.zeros(len(order), np.int64)
        for b in lead:
            self._advance(states, counts, np.full(len(order), b, np.int64))
        for i in range(int(sizes[0]) if len(sizes) else 0):
            # longest first: the words that still have a byte at this place form a prefix
            live = int(np.searchsorted(-sizes, -i, side="left"))
            if live <= FEW:
                for k in range(live):
                    rest = data[firsts[k] + i : firsts[k] + sizes[k]].tobytes()
                    states[k], more = self._walk(int(states[k]), rest)
                    counts[k] += more
                break
            self._advance(states[:live], counts[:live], data[firsts[:live] + i].astype(np.int64))
        counts += self.end_pops[states]
        out = np.empty(len(order), np.int64)
        out[order] = counts
        return out

    @cached_property
    def _plain(self) -> tuple[dict[int, int], list[int], list[int]]:
        """Transitions, links and pops as plain numbers."""
        used = np.flatnonzero(self.slots >= 0)
        moves = dict(zip(self.slots[used].tolist(), self.targets[used].tolist(), strict=True))
        return moves, self.link.tolist(), self.pops.tolist()

    def _walk(self, state: int, word: bytes) -> tuple[int, int]:
        """The state after reading ``word`` from ``state``, and the tokens popped on the way."""
        moves, link, pops = self._plain
        popped = 0
        for b in word:
            while (to := moves.get(state << 8 | b)) is None:
                popped += pops[state]
                state = link[state]
            state = to
        return state, popped

    def _advance(self, states: np.ndarray, counts: np.ndarray, symbols: np.ndarray) -> None:
        pending = np.arange(len(states))
        while len(pending):
            nxt = self.step(states[pending], symbols[pending])
            ok = nxt >= 0
            states[pending[ok]] = nxt[ok]
            pending = pending[~ok]
            counts[pending] += self.pops[states[pending]]
            states[pending] = self.link[states[pending]]


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def build_automaton(pieces: Iterable[bytes]) -> Automaton:
    """The automaton of a vocabulary; every single byte counts as a piece, so nothing is unknown."""
    children: list[dict[int, int]] = [{}]
    final = [False]
    for piece in {*pieces, *(bytes([b]) for b in range(256))} - {b""}:
        at = ROOT
        for b in piece:
            nxt = children[at].get(b)
            if nxt is None:
                nxt = children[at][b] = len(children)
                children.append({})
                final.append(False)
            at = nxt
        final[at] = True
    link, pops, end_pops = ([0] * len(children) for _ in range(3))
    queue = [ROOT]
    for at in queue:
        for b, child in children[at].items():
            if final[child]:
                link[child], pops[child] = ROOT, 1
            else:
                # the longest piece within the node is popped; what follows it decides where to go on
                back, popped = link[at], pops[at]
                while b not in children[back]:
                    popped += pops[back]
                    back = link[back]
                link[child], pops[child] = children[back][b], popped
            end_pops[child] = pops[child] + end_pops[link[child]]
            queue.append(child)
    size = 1 << (4 * len(children)).bit_length()
    slots, targets = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    keys = np.array([at << 8 | b for at, c in enumerate(children) for b in c], np.int64)
    values = np.array([t for c in children for t in c.values()], np.int32)
    for key, value, place in zip(keys.tolist(), values.tolist(), _slot(keys, size).tolist(), strict=True):
        while slots[place] >= 0:
            place = (place + 1) & (size - 1)
        slots[place], targets[place] = key, value
    return Automaton(slots, targets, *(np.array(x, np.int32) for x in (link, pops, end_pops)))


def greedy_length(word: bytes, pieces: set[bytes]) -> int:
    """Greedy longest match by its definition, for tests."""
    at = count = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), at + 1)
        at, count = end, count + 1
    return count


_HASHER = SpanHasher(0x70C3)


def count_batch(automaton: Automaton, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words and tokens of each text. Equal words of a batch are read once."""
    data, offsets = flat(column)
    found = []
    for a, b in slices(offsets):
        at = offsets[a]
        part = data[at : offsets[b]]
        starts, ends, words = word_spans(part, offsets[a : b + 1] - at)
        found.append((starts + at, ends + at, _HASHER(part, starts, ends), np.diff(words)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends, hashes, per_row = (np.concatenate(x) for x in zip(*found, strict=True))
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    tokens = automaton.lengths(data, starts[first], ends[first])[which]
    sums = np.concatenate([[0], np.cumsum(tokens)])
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    return per_row, sums[bounds[1:]] - sums[bounds[:-1]]


def count_tokens(docs: DataFrame, pieces: Iterable[bytes]) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens.

    * Words are runs of bytes other than ASCII white space; each is read after one space,
      as byte-level vocabularies spell the start of a word, and its tokens are those of
      greedy longest match. White space itself has no token.
    * A null, empty or blank text has 0 words and 0 tokens; any length is read whole.
    * Repeated rows and null ids give a row each; other columns are ignored.
    * The automaton is as large as the vocabulary and is the only thing broadcast.
    * Words of one batch are told apart by 64-bit hashes, seeded, of their bytes.
    """
    spark = docs.sparkSession
    automaton = spark.sparkContext.broadcast(build_automaton(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, tokens = count_batch(automaton.value, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"],
            )

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
