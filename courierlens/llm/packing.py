"""Best-fit packing of documents into sequences, after Martello and Toth's reduction.

Sizes are whole numbers of tokens up to the capacity, so an instance is a histogram of at
most ``capacity`` counts whatever the number of documents. The plan is made on it: sets of
sizes that provably dominate every alternative are fixed with their multiplicity, and the
rest is packed best-fit, largest first. It says, for the items of one size by their number,
which sequence and offset they get; the items are numbered and placed by Spark.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.blocks import scratch_table
from courierlens.llm.encode import closed, crc, encoder

CAPACITY = 2048
END_ID = 0


class Plan:
    """Runs of items: the items ``taken`` .. ``taken + count`` of a size go to consecutive sequences."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {s: n for s, n in counts.items() if n > 0}
        self.taken: dict[int, int] = defaultdict(int)
        self.sequences = 0
        # (size, first item, items, first sequence, offset)
        self.runs: list[tuple[int, int, int, int, int]] = []

    def place(self, size: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append((size, self.taken[size], count, sequence, offset))
        self.taken[size] += count
        self.left[size] -= count
        if not self.left[size]:
            del self.left[size]

    def fix(self, sizes: list[int], count: int) -> None:
        """``count`` new sequences that hold exactly these sizes."""
        offset = 0
        for size in sizes:
            self.place(size, count, self.sequences, offset)
            offset += size
        self.sequences += count


def _largest(sizes: list[int], left: dict[int, int], most: int, used: tuple[int, ...] = ()) -> int | None:
    """The largest size up to ``most`` of which items are left beyond those used."""
    for s in reversed(sizes):
        if s <= most and left.get(s, 0) > used.count(s):
            return s
    return None


def dominating_set(left: dict[int, int], j: int, capacity: int) -> list[int] | None:
    """A set with ``j`` that dominates every other feasible set with ``j``, if one can be proved.

    ``j`` is the largest size considered. Sets of up to two further items are compared; an
    exchange argument shows for each case that some best packing holds the returned set.
    """
    sizes = sorted(s for s in left if left[s] > (s == j))
    free = capacity - j
    k = _largest(sizes, left, free, (j,))
    if k is None:
        return [j]
    if k == free:
        return [j, k]
    smallest: list[int] = []
    for s in sizes:
        smallest += [s] * min(left[s] - (s == j), 3 - len(smallest))
        if len(smallest) == 3:
            break
    if len(smallest) < 2 or smallest[0] + smallest[1] > free:
        return [j, k]
    if len(smallest) == 3 and sum(smallest) <= free:
        return None
    # at most two further items fit: every feasible pair p >= q
    pairs = []
    for p in sizes:
        q = _largest(sizes, left, min(p, free - p), (j, p))
        if q is not None:
            pairs.append((p, q))
    best = max(p + q for p, q in pairs)
    if best <= k:
        return [j, k]
    b = _largest(sizes, left, free - k, (j, k))
    if b is not None and max(q for _, q in pairs) <= b <= k:
        return [j, k, b]
    return None


def reduce_instance(plan: Plan) -> None:
    """Fix dominating sets, largest item first, until no further size can be reduced."""
    changed = True
    while changed:
        changed = False
        for j in sorted(plan.left, reverse=True):
            while plan.left.get(j, 0):
                found = dominating_set(plan.left, j, plan.capacity)
                if found is None:
                    break
                times = min(plan.left[s] // found.count(s) for s in found)
                plan.fix(found, times)
                changed = True


def best_fit(plan: Plan) -> None:
    """Best-fit decreasing: equal items and equally full sequences are handled together."""
    opened: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for size in sorted(plan.left, reverse=True):
        while plan.left.get(size, 0):
            room = min((r for r in opened if r >= size), default=None)
            if room is None:
                # as many new sequences as the rest needs, each filled before the next
                each = plan.capacity // size
                count = -(-plan.left[size] // each)
                opened[plan.capacity].append((plan.sequences, count))
                plan.sequences += count
                room = plan.capacity
            first, count = opened[room].pop()
            if not opened[room]:
                del opened[room]
            each = room // size
            full = min(count, plan.left[size] // each)
            offset = plan.capacity - room
            if full:
                for i in range(each):
                    plan.place(size, full, first, offset + i * size)
                if room - each * size:
                    opened[room - each * size].append((first, full))
            if full < count and (rest := plan.left.get(size, 0)) and rest < each:
                for i in range(rest):
                    plan.place(size, 1, first + full, offset + i * size)
                opened[room - rest * size].append((first + full, 1))
                full += 1
            if full < count:
                opened[room].append((first + full, count - full))


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan = Plan(counts, capacity)
    reduce_instance(plan)
    best_fit(plan)
    return plan


def piece_sizes(length: int, capacity: int) -> list[int]:
    """A longer document is cut into full pieces; the first may be shorter."""
    first = length % capacity
    return ([first] if first else []) + [capacity] * (length // capacity)


PIECES = "part int, doc_id long, piece int, start long, length long, ids_crc32 long, nth long"


def cut_documents(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece, numbered within its task and size; no row moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, offsets = closed(*encoder(path, added=True).encode(batch.column(1)), end_id)
            rows: list[tuple] = []
            for doc_id, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                start = 0
                for piece, size in enumerate(piece_sizes(b - a, capacity)):
                    own = ids[a + start : a + start + size]
                    rows.append((part, doc_id, piece, start, size, crc(own), int(seen[size])))
                    seen[size] += 1
                    start += size
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    * Every document gets ``end_id`` after its ids; a null or empty text is that id alone.
    * Only documents over ``capacity`` are cut; sequences are filled from offset 0 without gaps.
    * Repeated rows and null ids are packed as often as they are given; the rows of one
      document number are then told apart by their place alone.
    * Extra columns are ignored. An empty table gives no rows.
    * The driver sees a histogram of at most ``capacity`` sizes and the plan made from it;
      its runs are bounded by the number of sizes and residual capacities, not by documents.
    """
    spark = docs.sparkSession
    pieces = scratch_table(cut_documents(docs, path, capacity, end_id), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = make_plan(histogram, capacity)
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(runs)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        firsts = {s: np.flatnonzero(table[:, 0] == s) for s in np.unique(table[:, 0]).tolist()}
        for batch in batches:
            size, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.zeros(len(size), np.int64)
            for s in np.unique(size).tolist():
                own = size == s
                at[own] = firsts[s][np.searchsorted(table[firsts[s], 1], number[own], side="right") - 1]
            sequence = table[at, 3] + number - table[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(table[at, 4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    numbered = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("number")
    )
    return numbered.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
