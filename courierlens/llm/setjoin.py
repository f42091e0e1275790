"""Exact Jaccard join of documents by universe partitions and the pigeonhole principle.

Sets are banded by size. A band cuts the universe of shingles, by their hash, into m
segments; two sets that link differ in at most H elements, so thresholds e[i] in -1, 0, 1
with sum(e[i] + 1) = H + 1 leave one segment where they differ in at most e[i]. The smaller
set is indexed: the hash of its part in every segment, and for large parts the hashes of
the part less one element. The larger set probes: it spends its thresholds where that is
cheapest, skipping empty and tiny parts and paying with one-deletion neighbourhoods of
large ones. Documents that share a hash are candidates, and candidates are verified on
their texts. Nothing is dropped: every candidate pair ends up verified, refuted by a bound,
or within one component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.blocks import flat, mixed, scratch_table, shuffle_partitions, slices
from courierlens.llm.components import connected_components
from courierlens.llm.shingles import Sets, linked, shingle_sets

# roles of a hash: indexed part (not probing, probing with 0, with 1), indexed deletion,
# probing deletion, probing part of a larger band (with 0, with 1)
INDEX, INDEX_PROBE, INDEX_PROBE_ONE, INDEX_LESS, PROBE_LESS, PROBE, PROBE_ONE = range(7)
_SALT = np.uint64(0xA0761D6478BD642F)
# documents of one packed block: their place and role share sixteen bits
BLOCK_DOCS = 1 << 13
BLOCK_BYTES = 1 << 23
# buckets of up to so many documents give all their pairs; larger ones a star first
SMALL = 4
# requests for one copy of a star's centre
CHUNK = 256
# up to so many requests (32 MB of ids) every task knows which texts are asked for, and only those move
KNOWN_IDS = 1 << 22


@dataclass(frozen=True)
class Join:
    """The link threshold in percent, the ratio of a band's sizes, and where deletions are indexed.

    A bucket whose centre left more than ``large`` sets open is split before they are compared,
    and blocks of ``large`` sets are compared with each other.
    """

    percent: int = 75
    ratio: float = 2.0
    tiny: int = 32
    least_part: int = 7
    large: int = 2048


@dataclass(frozen=True)
class Band:
    """Sizes low..high; m segments under each of ``seeds`` partitions; deletions of parts from ``least`` on."""

    number: int
    low: int
    high: int
    segments: int
    seeds: int
    least: int


def difference(a: int, b: int, percent: int) -> int:
    """The most elements in which linked sets of sizes a and b differ."""
    return (a + b) * (100 - percent) // (100 + percent)


def bands(j: Join, up_to: int) -> list[Band]:
    """Bands for all sizes up to ``up_to``; a larger set can always reach the band below its own."""
    out: list[Band] = []
    low = 1
    while low <= up_to:
        high = max(low, int(low * j.ratio) - 1)
        most = difference(high, high * 100 // j.percent, j.percent) + 1
        small = high <= j.tiny
        out.append(Band(len(out), low, high, most, 2 if small else 1, 1 if small else j.least_part))
        low = high + 1
    return out


def _costs(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost, in 1/16 rows, of threshold 0 on a part of c elements, and of going from 0 to 1.

    A hash costs its row, and the candidates it may meet: the more, the fewer its elements.
    """
    zero = 16 + np.right_shift(1024, np.minimum(2 * c, 30))
    one = 16 * (c + 1) + np.right_shift(1024, np.minimum(2 * np.maximum(c - 1, 0), 30))
    return zero, np.where(c == 0, 4096, one)


class Parts:
    """The parts of a slice's sets in one band's segments."""

    def __init__(self, sets: Sets, rows: np.ndarray, band: Band, seed: int) -> None:
        m = band.segments
        sizes = sets.sizes[rows]
        place = np.repeat(np.arange(len(rows)), sizes)
        begin = np.cumsum(sizes) - sizes
        value = sets.values[np.arange(len(place)) - np.repeat(begin, sizes) + np.repeat(sets.bounds[rows], sizes)]
        spread = mixed(value * _SALT + np.uint64(seed))
        segment = ((spread >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        cell = place * m + segment
        order = np.argsort(cell, kind="stable")
        self.element = mixed(value[order] + _SALT)
        self.cell = cell[order]
        self.count = np.bincount(cell, minlength=len(rows) * m)
        ends = np.cumsum(self.count)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.element)])
        self.total = sums[ends] - sums[ends - self.count]
        where = np.arange(len(self.count)) % m
        self.mark = mixed((np.uint64(band.number * 2 + seed) << np.uint64(40)) + where.astype(np.uint64) + _SALT)
        self.row = np.arange(len(self.count)) // m
        self.sizes, self.rows = sizes, rows

    def hashes(self) -> np.ndarray:
        return mixed(self.total + self.mark)

    def less_one(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the chosen cells' parts less one element each, and their rows."""
        some = cells[self.cell]
        at = self.cell[some]
        return mixed(self.total[at] - self.element[some] + self.mark[at]), self.row[at]

    def thresholds(self, needed: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """e + 1 of every cell so that each row's sum is ``needed``, by the cheapest steps, and each row's cost."""
        zero, one = _costs(self.count)
        # going to 1 must find the index's deletions: a part one larger must be among them
        able = np.flatnonzero(self.count + 1 >= least)
        cell = np.concatenate([np.arange(len(zero)), able])
        cost = np.concatenate([zero, one[able]])
        row = self.row[cell]
        order = np.lexsort((cost, row))
        rank = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        taken = order[rank < needed[row[order]]]
        spent = np.bincount(row[taken], weights=cost[taken], minlength=len(needed))
        return np.bincount(cell[taken], minlength=len(zero)), spent


def signatures(sets: Sets, j: Join) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All hashes of a slice's sets with their roles and rows."""
    sizes = sets.sizes
    out: list[tuple[np.ndarray, int | np.ndarray, np.ndarray]] = []
    for band in bands(j, int(sizes.max(initial=0))):
        own = np.flatnonzero((sizes >= band.low) & (sizes <= band.high))
        above = np.flatnonzero((sizes > band.high) & (sizes * j.percent <= band.high * 100))
        for rows, indexed in ((own, True), (above, False)):
            if not len(rows):
                continue
            n = sizes[rows]
            needed = (np.minimum(n, band.high) + n) * (100 - j.percent) // (100 + j.percent) + 1
            choices = []
            for seed in range(band.seeds):
                parts = Parts(sets, rows, band, seed)
                choices.append((parts, *parts.thresholds(needed, band.least)))
            best = np.argmin([spent for _, _, spent in choices], axis=0)
            for seed, (parts, level, _) in enumerate(choices):
                level = np.where(best[parts.row] == seed, level, 0)
                hashes = parts.hashes()
                row = rows[parts.row]
                if indexed:
                    out.append((hashes, np.array([INDEX, INDEX_PROBE, INDEX_PROBE_ONE])[level], row))
                    less, at = parts.less_one(parts.count >= band.least)
                    out.append((less, INDEX_LESS, rows[at]))
                else:
                    some = level > 0
                    out.append((hashes[some], np.array([0, PROBE, PROBE_ONE])[level[some]], row[some]))
                less, at = parts.less_one(level == 2)
                out.append((less, PROBE_LESS, rows[at]))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int32)
    hashes = np.concatenate([h for h, _, _ in out])
    roles = np.concatenate([np.broadcast_to(r, h.shape).astype(np.uint8) for h, r, _ in out])
    return hashes, roles, np.concatenate([r.astype(np.int32) for _, _, r in out])


def _planes(values: np.ndarray) -> bytes:
    """Bytes by significance, so that the codec of the shuffle sees runs of equal high bytes."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


BLOCK = "part int, docs binary, sets binary, refs binary, hashes binary"


def pack_blocks(
    ids: np.ndarray, sets: np.ndarray, hashes: np.ndarray, roles: np.ndarray, rows: np.ndarray, parts: int
) -> Iterator[tuple]:
    """One packed block per target partition.

    It holds distinct ids and the hashes of their sets, (place, role) and sorted 32-bit rests of the hashes.
    """
    high = (hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    low = hashes & np.uint64(0xFFFFFFFF)
    order = np.argsort(high << np.uint64(32) | low, kind="stable")
    high, low, roles, rows = (v[order] for v in (high.astype(np.int64), low.astype(np.uint32), roles, rows))
    cuts = np.searchsorted(high, np.arange(parts + 1))
    for part in range(parts):
        a, b = int(cuts[part]), int(cuts[part + 1])
        if a < b:
            used, place = np.unique(rows[a:b], return_inverse=True)
            refs = (place << 3 | roles[a:b]).astype(np.uint16)
            steps = np.diff(low[a:b], prepend=np.uint32(0)).astype(np.uint32)
            yield part, _planes(ids[used]), _planes(sets[used]), _planes(refs), _planes(steps)


def set_hashes(sets: Sets, salt: np.uint64 = _SALT) -> np.ndarray:
    """A 64-bit hash of each set: the sum of its elements' hashes."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(sets.values + salt))])
    return (sums[sets.bounds[1:]] - sums[sets.bounds[:-1]]).view(np.int64)


def block_batches(batches: Iterator[pa.RecordBatch], j: Join, parts: int) -> Iterator[pa.RecordBatch]:
    """Packed signatures; of equal sets in one block only the smallest id goes on."""
    for batch in batches:
        data, offsets = flat(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b in slices(offsets, BLOCK_BYTES):
            for at in range(a, b, BLOCK_DOCS):
                end = min(at + BLOCK_DOCS, b)
                found, marks = [], []
                for c, d in slices(offsets[at : end + 1]):
                    c, d = at + c, at + d
                    sets = shingle_sets(data[offsets[c] : offsets[d]], offsets[c : d + 1] - offsets[c])
                    hashes, roles, rows = signatures(sets, j)
                    found.append((hashes, roles, rows + np.int32(c - at)))
                    marks.append(set_hashes(sets))
                hashes, roles, rows = (np.concatenate(v) for v in zip(*found, strict=True))
                own, marks = ids[at:end], np.concatenate(marks)
                order = np.lexsort((own, marks))
                once = np.zeros(len(own), bool)
                once[order[np.concatenate([[True], marks[order][1:] != marks[order][:-1]])]] = True
                new = once[rows]
                blocks = list(pack_blocks(own, marks, hashes[new], roles[new], rows[new], parts))
                if blocks:
                    kinds = [pa.int32(), *[pa.binary()] * 4]
                    columns = [pa.array(c, t) for c, t in zip(zip(*blocks, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["part", "docs", "sets", "refs", "hashes"])


_INDEXED = np.isin(np.arange(8), [INDEX, INDEX_PROBE, INDEX_PROBE_ONE])
_PROBES = np.isin(np.arange(8), [INDEX_PROBE, INDEX_PROBE_ONE, PROBE, PROBE_ONE, PROBE_LESS])
_PROBES_ONE = np.isin(np.arange(8), [INDEX_PROBE_ONE, PROBE_ONE])


def meets(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether roles of a bucket make a candidate pair, either way round."""

    def way(probe: np.ndarray, index: np.ndarray) -> np.ndarray:
        return (_PROBES[probe] & _INDEXED[index]) | (_PROBES_ONE[probe] & (index == INDEX_LESS))

    return way(one, other) | way(other, one)


def buckets(docs: np.ndarray, roles: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the buckets that hold two documents and a probe that may meet: bucket, document, role, each once."""
    order = np.lexsort((roles, docs, hashes))
    docs, roles, hashes = docs[order], roles[order], hashes[order]
    once = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1]) | (roles[1:] != roles[:-1])])
    docs, roles, hashes = docs[once], roles[once], hashes[once]
    begin = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    bucket = np.cumsum(begin) - 1
    firsts = np.flatnonzero(begin)
    several = np.maximum.reduceat(docs, firsts) != np.minimum.reduceat(docs, firsts)
    whole = np.logical_or.reduceat(_INDEXED[roles], firsts) & np.logical_or.reduceat(_PROBES[roles], firsts)
    less = np.logical_or.reduceat(roles == INDEX_LESS, firsts) & np.logical_or.reduceat(_PROBES_ONE[roles], firsts)
    keep = (several & (whole | less))[bucket]
    return bucket[keep], docs[keep], roles[keep]


FOUND = "a long, b long, n int, members array<long>, roles array<int>"


def candidates(bucket: np.ndarray, docs: np.ndarray, roles: np.ndarray) -> tuple[np.ndarray, np.ndarray, list, list]:
    """Pairs a < b with the number of buckets that gave them; and the larger buckets as lists.

    A bucket of up to ``SMALL`` rows gives the pairs that meet. A larger one gives the pairs of
    its smallest document with all others, and its list, for what those pairs leave open.
    """
    if not len(docs):
        none = np.zeros(0, np.int64)
        return none.reshape(0, 2), none, [], []
    firsts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.append(firsts, len(docs)))
    pairs = []
    for step in range(1, SMALL):
        at = np.flatnonzero(np.arange(len(docs)) + step < np.repeat(firsts + sizes, sizes))
        at = at[np.repeat(sizes, sizes)[at] <= SMALL]
        at = at[meets(roles[at], roles[at + step]) & (docs[at] != docs[at + step])]
        pairs.append(np.stack([docs[at], docs[at + step]], axis=1))
    large = sizes > SMALL
    inside = np.repeat(large, sizes)
    center = np.repeat(docs[firsts], sizes)
    star = inside & (docs != center)
    pairs.append(np.stack([center[star], docs[star]], axis=1))
    both = np.concatenate(pairs)
    found, count = np.unique(both, axis=0, return_counts=True)
    seen: dict[bytes, int] = {}
    members, kinds = [], []
    for a, n in zip(firsts[large].tolist(), sizes[large].tolist(), strict=True):
        key = docs[a : a + n].tobytes() + roles[a : a + n].astype(np.uint8).tobytes()
        if key not in seen:
            seen[key] = 1
            members.append(docs[a : a + n])
            kinds.append(roles[a : a + n])
    return found, count, members, kinds


def meet_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}
    for batch in batches:
        for part, *block in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            held.setdefault(part, []).append(block)
    for part in sorted(held):
        docs, sets, places, roles, hashes = [], [], [], [], []
        at = 0
        for d, s, r, h in held.pop(part):
            ref = _from_planes(r, np.uint16)
            docs.append(_from_planes(d, np.int64))
            sets.append(_from_planes(s, np.int64))
            places.append((ref >> 3).astype(np.int64) + at)
            at += len(docs[-1])
            roles.append((ref & 7).astype(np.uint8))
            hashes.append(np.cumsum(_from_planes(h, np.uint32), dtype=np.uint64).astype(np.uint32))
        # all equal sets are here, or none: the smallest id stands for them
        _, which = np.unique(np.concatenate(sets), return_inverse=True)
        least = np.full(which.max(initial=-1) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, which, np.concatenate(docs))
        docs = [least[which][np.concatenate(places)]]
        pairs, count, members, kinds = candidates(*buckets(*(np.concatenate(v) for v in (docs, roles, hashes))))
        for a in range(0, len(pairs), 1 << 16):
            own = pairs[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own[:, 0]),
                    pa.array(own[:, 1]),
                    pa.array(count[a : a + (1 << 16)].astype(np.int32)),
                    pa.nulls(len(own), pa.list_(pa.int64())),
                    pa.nulls(len(own), pa.list_(pa.int32())),
                ],
                names=["a", "b", "n", "members", "roles"],
            )
        for a in range(0, len(members), 4096):
            own, kind = members[a : a + 4096], kinds[a : a + 4096]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(m[0]) for m in own], pa.int64()),
                    pa.nulls(len(own), pa.int64()),
                    pa.nulls(len(own), pa.int32()),
                    pa.array(own, pa.list_(pa.int64())),
                    pa.array(kind, pa.list_(pa.int32())),
                ],
                names=["a", "b", "n", "members", "roles"],
            )


def parity(values: np.ndarray, spread: int = 1) -> bytes:
    """Parities of the set's elements in a power of two of buckets, at least ``spread`` times as many as elements.

    Elements that meet in a bucket hide each other; the more buckets, the closer the number of
    different parities comes to the number of different elements.
    """
    bits = max(64, spread << int(len(values) - 1).bit_length())
    count = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(n1: int, s1: bytes, n2: int, s2: bytes, percent: int) -> bool:
    """False only if the sizes or parities prove that two sets differ in too many elements."""
    if 100 * min(n1, n2) < percent * max(n1, n2):
        return False
    a, b = np.frombuffer(s1, np.uint8), np.frombuffer(s2, np.uint8)
    width = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, width), axis=0) for v in (a, b))
    return int(np.bitwise_count(a ^ b).sum()) <= difference(n1, n2, percent)


def close_sets(n: np.ndarray, marks: list[bytes], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set, those after it that sizes and parities do not refute, each pair once.

    Sets are taken by the length of their parities; the longer ones are folded to each length.
    """
    width = np.array([len(m) for m in marks])
    for w in np.unique(width).tolist():
        rows = np.concatenate([np.flatnonzero(width == w), np.flatnonzero(width > w)])
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(marks[i], np.uint8).reshape(-1, w), axis=0) for i in rows])
        for k in range(int((width == w).sum())):
            i, others = rows[k], rows[k + 1 :]
            apart = np.bitwise_count(folded[k + 1 :] ^ folded[k]).sum(axis=1)
            small, large = np.minimum(n[i], n[others]), np.maximum(n[i], n[others])
            fits = 100 * small >= percent * large
            yield int(i), others[fits & (apart <= (n[i] + n[others]) * (100 - percent) // (100 + percent))]


INFO = "doc_id long, n_shingles long, set_hash long, set_check long, parity binary, fine binary"
# buckets per element of the parities that decide within large buckets
FINE = 2


def describe(docs: DataFrame) -> DataFrame:
    """Per document: the size of its set, two hashes of the set, and its parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for a, b in slices(offsets):
                sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[a:b],
                        pa.array(sets.sizes),
                        *(pa.array(set_hashes(sets, salt)) for salt in (_SALT, ~_SALT)),
                        pa.array([parity(sets.row(i)) for i in range(b - a)], pa.binary()),
                        pa.array([parity(sets.row(i), FINE) for i in range(b - a)], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_hash", "set_check", "parity", "fine"],
                )

    return docs.mapInArrow(run, INFO)


def asked_texts(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``doc_id`` is among the written ``ids``; while those are few, no text moves."""
    if ids.count() <= KNOWN_IDS:
        ids = F.broadcast(ids)
    return texts.join(ids, "doc_id", "left_semi")


def verify(texts: DataFrame, pairs: DataFrame, j: Join) -> DataFrame:
    """The pairs (a, b) that link, by their texts. A centre ``a`` is sent once to every ``CHUNK`` partners."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    # written, so that the join below sees a table and a centre with many partners can be split
    sizes = scratch_table(sizes, "centres")
    placed = pairs.join(sizes, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"))
    asked = placed.select(F.col("b").alias("doc_id"), "a", "chunk", F.lit(1).alias("side"))
    centres = sizes.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    asked = asked.unionByName(centres.select(F.col("a").alias("doc_id"), "a", "chunk", F.lit(0).alias("side")))
    asked = scratch_table(asked, "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []
        for batch in batches:
            data, offsets = flat(batch.column(4))
            a, chunk, side, ids = (batch.column(i).to_numpy() for i in range(4))
            hits: list[tuple[int, int]] = []
            for c, d in slices(offsets):
                sets = shingle_sets(data[offsets[c] : offsets[d]], offsets[c : d + 1] - offsets[c])
                for i in range(c, d):
                    own = sets.row(i - c)
                    if (a[i], chunk[i]) != unit:
                        unit, held = (a[i], chunk[i]), []
                    if side[i] == 0:
                        held.append(own.copy())
                    elif any(linked(own, h, j.percent) for h in held):
                        hits.append((int(a[i]), int(ids[i])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[k] for h in hits], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    if asked.count() <= KNOWN_IDS:
        texts = texts.join(F.broadcast(asked.select("doc_id").distinct()), "doc_id", "left_semi")
    both = texts.join(asked, "doc_id").select("a", "chunk", "side", "doc_id", "text")
    spread = both.repartition(shuffle_partitions(texts.sparkSession), "a", "chunk").sortWithinPartitions("a", "chunk", "side")
    return spread.mapInArrow(run, "a long, b long")


def refuted(pairs: DataFrame, info: DataFrame, j: Join) -> DataFrame:
    """The pairs that sizes and parities do not refute."""
    known = info.select("doc_id", "n_shingles", "parity")
    both = pairs
    for side in ("a", "b"):
        own = known.select(F.col("doc_id").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("parity").alias(f"p_{side}"))
        both = both.join(own, side)
    both = both.where(100 * F.least("n_a", "n_b") >= j.percent * F.greatest("n_a", "n_b"))
    names = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_a", "p_a", "n_b", "p_b")]
            keep = [may_link(*row, j.percent) for row in zip(*columns, strict=True)]
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    return both.select(*names, "n_a", "p_a", "n_b", "p_b").mapInArrow(run, pairs.schema).distinct()


def elements(texts: DataFrame) -> DataFrame:
    """One row (rep, element) per shingle of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for a, b in slices(offsets):
                sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ids = batch.column(0)[a:b].to_numpy(zero_copy_only=False)
                values = np.concatenate([sets.row(i) for i in range(b - a)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, sets.sizes)), pa.array(values.view(np.int64))], names=["rep", "element"]
                )

    return texts.select("doc_id", "text").mapInArrow(run, "rep long, element long").distinct()


def split_large(rows: DataFrame, texts: DataFrame, j: Join) -> DataFrame:
    """The rows of large buckets by the rare shingles they share, under a new ``bucket``; links stay together.

    Let a bucket's shingles be ordered by how many of its sets hold them. Two sets that link share
    one of the first n - ceil(n * percent / 100) + 1 of their n shingles; a passage that makes a
    bucket large comes last.
    """
    members = rows.groupBy("bucket", "rep").agg(F.min("n_shingles").alias("n"))
    wanted = scratch_table(members.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    held = scratch_table(members.join(elements(asked_texts(texts, wanted)), "rep"), "held")
    often = held.groupBy("bucket", "element").agg(F.count(F.lit(1)).alias("often"))
    one = Window.partitionBy("bucket", "rep")
    ranked = held.join(often, ["bucket", "element"])
    ranked = ranked.withColumn("nth", F.row_number().over(one.orderBy("often", "element")))
    ranked = ranked.withColumn("there", F.count(F.lit(1)).over(one))
    # in whole numbers; an id with several texts keeps the shingles of all
    first = F.expr(f"n - (n * {j.percent} + 99) div 100 + 1")
    early = (F.col("nth") <= first) | (F.col("there") != F.col("n"))
    shared = ranked.where(early & (F.col("often") > 1)).select("bucket", "rep", "element")
    split = rows.join(shared, ["bucket", "rep"])
    # two groups that share a name are searched as one, which only adds candidates
    return split.withColumn("bucket", F.xxhash64("bucket", "element")).select(*rows.columns)


def spanning(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component."""
    several = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return rows.join(several.where("low <> high").select("bucket"), "bucket", "left_semi")


def deal_blocks(rows: DataFrame, j: Join) -> DataFrame:
    """Rows of groups (bucket, low, high): every two blocks of a bucket, and each with itself, meet in one group."""
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / j.large).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        *rows.columns, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )


def open_groups(groups: DataFrame, info: DataFrame, joined: DataFrame, texts: DataFrame, j: Join) -> DataFrame:
    """Rows of large buckets in bounded groups (bucket, low, high), in which all pairs that may link meet."""
    # two buckets that share a name are searched as one, which only adds candidates
    rows = groups.withColumn("bucket", F.xxhash64("members", "roles"))
    rows = rows.select("bucket", F.explode(F.arrays_zip("members", "roles")).alias("m"))
    rows = rows.select("bucket", F.col("m.members").alias("rep"), F.col("m.roles").alias("role"))
    rows = rows.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    rows = rows.select("bucket", "rep", "role", F.coalesce("component", "rep").alias("component")).distinct()
    sizes = info.select(F.col("doc_id").alias("rep"), "n_shingles")
    rows = scratch_table(spanning(rows).join(sizes, "rep"), "open-rows")
    hot = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > j.large).select("bucket")
    hot = scratch_table(hot, "hot-buckets")
    if not hot.isEmpty():
        split = spanning(split_large(rows.join(hot, "bucket", "left_semi"), texts, j))
        rows = scratch_table(rows.join(hot, "bucket", "left_anti").unionByName(split), "split-rows")
    return deal_blocks(rows, j).join(info.select(F.col("doc_id").alias("rep"), "fine"), "rep")


def open_pairs(groups: DataFrame, info: DataFrame, joined: DataFrame, texts: DataFrame, j: Join) -> DataFrame:
    """Candidate pairs of large buckets that lie in different components and are not refuted."""
    rows = open_groups(groups, info, joined, texts, j)

    def run(table: pa.Table) -> pa.Table:
        rep, component, role, n = (table.column(c).to_numpy() for c in ("rep", "component", "role", "n_shingles"))
        out = [np.zeros((0, 2), np.int64)]
        for i, near in close_sets(n, table.column("fine").to_pylist(), j.percent):
            near = near[(component[near] != component[i]) & meets(np.full(len(near), role[i]), role[near])]
            one = np.full(len(near), rep[i])
            out.append(np.stack([np.minimum(one, rep[near]), np.maximum(one, rep[near])], axis=1))
        pairs = np.unique(np.concatenate(out), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return rows.groupBy("bucket", "low", "high").applyInArrow(run, "a long, b long").distinct()


def link_documents(docs: DataFrame, j: Join | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    * Links are those of the contract: 100 * intersection >= percent * union of distinct
      five-word shingles of the text, A-Z lower-cased; fewer words are one shingle.
    * A null, empty or blank text has an empty set and links with nothing.
    * Equal sets are one from the buckets on, under their smallest id, by a 64-bit hash; the other
      ids join its component at the end, by two.
    * A null id links with nothing and has a null component. Rows with one id are one node;
      each has its own ``n_shingles``.
    * Extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    j = j or Join()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    info = scratch_table(describe(texts), "set-info")
    parts = shuffle_partitions(spark)
    blocks = texts.where("doc_id IS NOT NULL").mapInArrow(lambda it: block_batches(it, j, parts), BLOCK)
    found = scratch_table(blocks.repartitionById(parts, F.col("part")).mapInArrow(meet_blocks, FOUND), "candidates")

    sets = ["n_shingles", "set_hash", "set_check"]
    named = info.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # one row per distinct set, under the smallest id that has it
    marks = [F.first(c).alias(c) for c in ("parity", "fine")]
    reps_info = named.groupBy(*sets).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), *marks)
    reps_info = scratch_table(reps_info, "rep-info")
    copied = reps_info.where("copies > 1").select(*sets, F.col("doc_id").alias("rep"))
    reps = scratch_table(named.join(copied, sets).where("doc_id <> rep").select("doc_id", "rep").distinct(), "reps")
    pairs = found.where("b IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("n"))
    pairs = scratch_table(pairs, "pairs")
    likely = scratch_table(refuted(pairs, reps_info, j), "likely")
    # first every document's pair with the centre it met most often: most components follow from these
    best = likely.groupBy("b").agg(F.max(F.struct("n", F.negative("a").alias("minus"))).alias("best"))
    first = best.select(F.negative("best.minus").alias("a"), "b")
    links = scratch_table(verify(texts, first, j), "links")
    joined = scratch_table(connected_components(links), "components")

    def component(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            own = joined.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
            pairs = pairs.join(own, side, "left")
        return pairs.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).drop("c_a", "c_b")

    # then what is still apart: other pairs, and the rest of large buckets whose centre did not link to all
    rest = component(likely).select("a", "b").join(first, ["a", "b"], "left_anti")
    stars = found.where("members IS NOT NULL").select("a", "members", "roles")
    apart = component(pairs).select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    failed = scratch_table(stars.select(F.col("a").alias("doc_id")).distinct().join(apart, "doc_id").select(F.col("doc_id").alias("a")), "failed")
    others = open_pairs(stars.join(failed, "a", "left_semi"), reps_info, joined, texts, j)
    more = scratch_table(rest.unionByName(others).distinct().join(first, ["a", "b"], "left_anti"), "more")
    late = scratch_table(verify(texts, more, j), "late-links")
    tied = links.unionByName(late).unionByName(copies_links(reps))
    final = connected_components(tied).withColumnRenamed("node", "doc_id")
    out = info.select("doc_id", "n_shingles").join(final, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def copies_links(reps: DataFrame) -> DataFrame:
    """A document and the representative of its equal set."""
    return reps.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))


def first_of_each(docs: DataFrame, j: Join | None = None) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component; null ids stay.

    Of rows with one id and one text the one with the smallest hash of all columns stays.
    Rows that have an id in common but not the text all stay: no text is lost with its id.
    """
    lost = link_documents(docs, j).where("component_id <> doc_id").select("doc_id").distinct()
    lost = scratch_table(lost, "lost")
    names = docs.columns
    kept = docs.where("doc_id IS NOT NULL").join(lost, "doc_id", "left_anti")
    # the row travels as one value, so that none of its columns can clash
    rows = kept.select(F.struct(*names).alias("kept_row"), F.xxhash64(*names).alias("kept_hash"))
    once = rows.groupBy("kept_row.doc_id", "kept_row.text").agg(F.min_by("kept_row", "kept_hash").alias("kept_row"))
    return once.select("kept_row.*").unionByName(docs.where("doc_id IS NULL"))
