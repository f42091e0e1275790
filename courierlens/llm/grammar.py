"""Token-id files compressed by a grammar of repeated pairs, decodable document by document.

A shard holds the ids of consecutive documents. Rounds of Re-Pair replace its frequent
neighbouring pairs by nonterminals; pairs never cross a document's end, so each document
keeps a run of symbols of its own. The shard stores the rules, the length every rule
expands to, and where each document's symbols start: a document's number of ids is known
without decoding, and its ids are decoded without the rest.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courierlens.llm.blocks import scratch_path, shuffle_partitions
from courierlens.llm.encode import closed, crc, encoder, rows_of

END_ID = 2
MAGIC = b"RPG1"
# ids of one shard, a bound on memory: a longer document is a shard of its own
SHARD_IDS = 1 << 20
# a pair must occur this often to become a rule; a rule takes twelve bytes
LEAST = 8
# one round replaces all pairs at least this fraction as frequent as the commonest one
SPAN = 0.005
# rules are written out once for decoding if together they are no longer than so many ids
WRITTEN_OUT = 1 << 23


@dataclass
class Shard:
    """Documents first .. first + n as symbols, rules and expansion lengths."""

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    starts: np.ndarray

    def sizes(self) -> np.ndarray:
        """Ids of each document, from the expansion lengths alone."""
        each = np.ones(len(self.symbols), np.int64)
        rule = self.symbols >= self.base
        each[rule] = self.lengths[self.symbols[rule] - self.base]
        sums = np.concatenate([[0], np.cumsum(each)])
        return np.diff(sums[self.starts])

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document."""
        return self.expand(self.symbols[self.starts[i] : self.starts[i + 1]])

    def written_out(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rules, one after the other, and where each begins; level by level, children first."""
        begin = np.cumsum(self.lengths) - self.lengths
        ids = np.zeros(int(self.lengths.sum()), np.uint32)
        sides = np.stack([self.left, self.right], axis=1).astype(np.int64)
        rule = sides >= self.base
        number = np.where(rule, sides - self.base, 0)
        width = np.where(rule, self.lengths[number] if len(self.lengths) else 1, 1)
        to = begin[:, None] + np.stack([np.zeros_like(begin), width[:, 0]], axis=1)
        ids[to[~rule]] = sides[~rule]
        done = np.zeros(len(begin), bool)
        while not done.all():
            ready = ~done & (done[number] | ~rule).all(axis=1)
            copied = rule & ready[:, None]
            n, source = width[copied], begin[number[copied]]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            ids[np.repeat(to[copied], n) + step] = ids[np.repeat(source, n) + step]
            done |= ready
        return ids, begin

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Terminals of a run of symbols, each copied from its rule's ids."""
        symbols = symbols.astype(np.int64)
        rule = symbols >= self.base
        if not rule.any():
            return symbols.astype(np.uint32)
        if self.lengths.sum() > WRITTEN_OUT:
            return self._opened(symbols)
        if not hasattr(self, "_ids"):
            self._ids = self.written_out()
        ids, begin = self._ids
        each = np.ones(len(symbols), np.int64)
        number = symbols[rule] - self.base
        each[rule] = self.lengths[number]
        source = np.arange(len(symbols))
        source[rule] = len(symbols) + begin[number]
        ends = np.cumsum(each)
        at = np.repeat(source - (ends - each), each)
        at += np.arange(len(at))
        return np.concatenate([symbols.astype(np.uint32), ids])[at]

    def _opened(self, symbols: np.ndarray) -> np.ndarray:
        """The same by passes that each open all nonterminals once, in memory bounded by the result."""
        while (rule := symbols >= self.base).any():
            width = 1 + rule
            at = np.cumsum(width) - width
            out = np.empty(int(width.sum()), np.int64)
            out[at[~rule]] = symbols[~rule]
            number = symbols[rule] - self.base
            out[at[rule]] = self.left[number]
            out[at[rule] + 1] = self.right[number]
            symbols = out
        return symbols.astype(np.uint32)

    def pack(self) -> bytes:
        """Header, rules, expansion lengths, document starts and symbols of 2, 3 or 4 bytes."""
        top = self.base + len(self.left)
        width = 2 if top <= 1 << 16 else 3 if top <= 1 << 24 else 4
        head = struct.pack("<4sIIIIB", MAGIC, self.base, len(self.left), len(self.starts) - 1, len(self.symbols), width)
        symbols = self.symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
        rules = np.stack([self.left, self.right, self.lengths]).astype("<u4")
        return b"".join([head, rules.tobytes(), self.starts.astype("<u4").tobytes(), symbols.tobytes()])

    @staticmethod
    def unpack(raw: bytes) -> Shard:
        magic, base, rules, documents, symbols, width = struct.unpack_from("<4sIIIIB", raw)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = struct.calcsize("<4sIIIIB")
        table = np.frombuffer(raw, "<u4", 3 * rules, at).reshape(3, rules).astype(np.int64)
        at += 12 * rules
        starts = np.frombuffer(raw, "<u4", documents + 1, at).astype(np.int64)
        at += 4 * (documents + 1)
        wide = np.zeros((symbols, 4), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8, symbols * width, at).reshape(symbols, width)
        return Shard(base, *table, wide.view("<u4").ravel().astype(np.int64), starts)


def _chosen(places: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which occurrences to replace: every other one of a run, if it beats both neighbours it overlaps."""
    taken = np.ones(len(places), bool)
    beside = np.diff(places) == 1
    taken[1:] &= ~beside | (rank[1:] >= rank[:-1])
    taken[:-1] &= ~beside | (rank[:-1] >= rank[1:])
    same = np.flatnonzero(beside & (rank[1:] == rank[:-1])) + 1
    if len(same):
        # within a run of one pair, places at an odd distance from its first overlap one that is taken
        breaks = np.concatenate([[True], np.diff(same) > 1])
        first = same[breaks][np.cumsum(breaks) - 1]
        taken[same[(same - first) % 2 == 0]] = False
    return taken


def _spread(keys: np.ndarray) -> np.ndarray:
    """Twenty bits of each pair's hash."""
    return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)


def _ranks(pairs: np.ndarray, keys: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Place of each key in ``pairs``, -1 for others: by a table of the hash, and for pairs that share one by search."""
    table = np.full(1 << 20, -1, np.int32)
    own = _spread(pairs)
    table[own] = np.arange(len(pairs), dtype=np.int32)
    rank = table[spread]
    wrong = np.flatnonzero(rank >= 0)
    wrong = wrong[pairs[rank[wrong]] != keys[wrong]]
    rank[wrong] = -1
    hidden = np.flatnonzero(table[own] != np.arange(len(pairs)))
    if len(hidden) and len(wrong):
        hidden = hidden[np.argsort(pairs[hidden])]
        at = np.minimum(np.searchsorted(pairs[hidden], keys[wrong]), len(hidden) - 1)
        same = pairs[hidden[at]] == keys[wrong]
        rank[wrong[same]] = hidden[at[same]]
    return rank


def frequent_pairs(keys: np.ndarray, rough: np.ndarray, least: int, span: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted pairs that occur at least ``least`` times and near as often as the commonest, with their counts.

    Also which of ``keys`` may be among them. ``rough`` is never below a pair's count: only
    pairs whose rough count reaches the bound are counted exactly.
    """
    floor = max(least, int(rough.max(initial=0) * span))
    while True:
        some = np.flatnonzero(rough >= floor)
        ordered = np.sort(keys[some])
        cuts = np.flatnonzero(np.concatenate([ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(cuts, len(ordered)))
        frequent = counts >= floor
        if frequent.any() or floor <= least:
            return ordered[cuts[frequent]], counts[frequent], some
        floor = max(least, floor // 4)


def compress(ids: np.ndarray, offsets: np.ndarray, least: int = LEAST, span: float = SPAN) -> Shard:
    """The shard of ``ids`` with n + 1 document ``offsets``; no pair is left that occurs ``least`` times.

    A pair of known symbols only ever gets rarer, so places whose pair was too rare once are
    looked at again only when a neighbour was replaced. Pairs are first counted by a hash of
    20 bits, which can only count too high.
    """
    symbols = ids.astype(np.int32)
    base = top = int(symbols.max(initial=0)) + 1
    starts = offsets.astype(np.int64)
    open_ = np.ones(len(symbols), bool)
    # no pair begins at a document's last symbol
    open_[starts[1:][np.diff(starts) > 0] - 1] = False
    left, right, lengths = [], [], []
    sizes = np.ones(base, np.int64)
    while len(places := np.flatnonzero(open_)):
        keys = symbols[places].astype(np.int64) << 32 | symbols[places + 1]
        spread = _spread(keys)
        rough = np.bincount(spread, minlength=1 << 20)[spread]
        open_[places] = rough >= least
        enough = np.flatnonzero(rough >= least)
        places, keys, spread = places[enough], keys[enough], spread[enough]
        pairs, often, some = frequent_pairs(keys, rough[enough], least, span)
        if not len(pairs):
            break
        # the commoner pair wins where two overlap; ties go to the smaller pair
        order = np.lexsort((-pairs, often))
        by_rank = pairs[order]
        rank = _ranks(by_rank, keys[some], spread[some])
        found = np.flatnonzero(rank >= 0)
        places, rank = places[some[found]], rank[found]
        chosen = np.flatnonzero(_chosen(places, rank))
        taken, rank = places[chosen], rank[chosen]
        used = np.bincount(rank, minlength=len(pairs)) > 0
        number = (np.cumsum(used) - 1)[rank].astype(np.int32)
        new = by_rank[used]
        a, b = new >> 32, new & 0xFFFFFFFF
        left.append(a)
        right.append(b)
        lengths.append(sizes[a] + sizes[b])
        sizes = np.concatenate([sizes, lengths[-1]])
        symbols[taken] = top + number
        keep = np.ones(len(symbols), bool)
        keep[taken + 1] = False
        keep = np.flatnonzero(keep)
        symbols, open_ = symbols[keep], open_[keep]
        starts = starts - np.searchsorted(taken + 1, starts)
        # both pairs of a new symbol are new
        now = taken - np.arange(len(taken))
        open_[now] = True
        open_[np.maximum(now - 1, 0)] = True
        open_[starts[1:][np.diff(starts) > 0] - 1] = False
        top += len(new)
    empty = np.zeros(0, np.int64)
    rules = [np.concatenate([empty, *x]) for x in (left, right, lengths)]
    return Shard(base, *rules, symbols.astype(np.int64), starts)


SHARDS = "part int, shard int, first_id long, documents int, ids long, doc_ids array<long>, payload binary"


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode documents in ascending ``doc_id`` and write their shards, one row each, as Parquet in ``folder``."""

    def flush(part: int, shard: int, ids: list, sizes: list, names: list) -> tuple:
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        whole = np.concatenate(ids)
        return part, shard, names[0], len(names), len(whole), names, compress(whole, offsets).pack()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        ids, sizes, names, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            row = flush(part, shard, ids, sizes, names)
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            columns = [pa.array([v], t) for v, t in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SHARDS.split(", ")])

        for batch in batches:
            found, offsets = closed(*encoder(path, added=True).encode(batch.column(1)), end_id)
            for name, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                if names and held + b - a > shard_ids:
                    yield out()
                    shard, ids, sizes, names, held = shard + 1, [], [], [], 0
                ids.append(found[a:b])
                sizes.append(b - a)
                names.append(name)
                held += b - a
        if names:
            yield out()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keys = ["doc_id", F.xxhash64("text")]
    ranges = texts.repartitionByRange(shuffle_partitions(docs.sparkSession), *keys)
    ranges.sortWithinPartitions(*keys, "text").mapInArrow(run, SHARDS).write.parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the shards of ``folder``."""
    shards = spark.read.schema(SHARDS).parquet(folder)
    sizes = shards.select("part", "shard", "ids")
    # running sums in two levels: over the shards of a part, and over the parts
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("ids"))
    bases = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    places = sizes.select("part", "shard", F.coalesce(F.sum("ids").over(inside), F.lit(0)).alias("own")).join(bases, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, names, payload in zip(*(batch.column(i) for i in range(4)), strict=True):
                shard = Shard.unpack(payload.as_py())
                sizes = shard.sizes()
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                checks = [crc(own) for own in rows_of(shard.expand(shard.symbols), offsets)]
                same = np.zeros(len(sizes), np.int32)
                columns = [
                    pa.array(same + part.as_py()),
                    pa.array(same + number.as_py()),
                    names.values,
                    pa.array(offsets[:-1]),
                    pa.array(sizes),
                    pa.array(checks, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["part", "shard", "doc_id", "within", "n_tokens", "ids_crc32"]
                )

    # the payloads are decoded where they are read; only the documents' rows meet their shard's place
    decoded = shards.select("part", "shard", "doc_ids", "payload").mapInArrow(
        run, "part int, shard int, doc_id long, within long, n_tokens long, ids_crc32 long"
    )
    start = (F.col("base") + F.col("own") + F.col("within")).alias("start")
    return decoded.join(places, ["part", "shard"]).select("doc_id", start, "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, path: str, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Write all documents' ids in ascending ``doc_id`` and return what the files hold of each.

    * A null or empty text is ``end_id`` alone. Null ids come first; equal ids are ordered by
      a hash of their text and the text, and each row keeps its own ids.
    * The texts move once, to ranges of ids; a task holds one shard of ids at a time.
    * Extra columns are ignored. An empty table writes no shard and gives no rows.
    * Without ``folder`` the files go to this application's part of the shared folder.
    """
    folder = folder or scratch_path(docs.sparkSession, "token-ids")
    write_shards(docs, path, folder, end_id)
    return read_shards(docs.sparkSession, folder)
