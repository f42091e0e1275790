"""Product codes of vectors, assigned through memoised grid cells.

A vector is cut into parts; each part is coded by its codebook's nearest entry. Which
entries can be nearest anywhere in a cell of a coarse grid is worked out once per cell and
kept: an entry is dominated if another is nearer than it all over the cell, by the largest
distance of the one and the smallest of the other. Only what is left is evaluated exactly.
All arithmetic is in whole numbers, so codes do not depend on how rows are spread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.blocks import scratch_table

PARTS, ENTRIES, SCALE, ROUNDS = 4, 256, 1024, 4
# beyond this a squared distance over 4,096 components would leave 64 bits
LARGEST = 1 << 24
# cells one worker keeps for a part, and numbers in one block of bounds or distances
KEEP, BLOCK = 20_000, 1 << 19

Books = dict[int, list[np.ndarray]]


def part_bounds(width: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Where the parts of a vector lie: equal ones where ``width`` allows it."""
    cuts = [i * width // parts for i in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def cell_step(book: np.ndarray) -> int:
    """Cells about an eighth as wide as entries lie apart, so that few entries share a cell's surroundings."""
    if len(book) < 2 or not book.shape[1]:
        return 1
    apart = ((book[1:] - book[:-1]) ** 2).sum(1)
    width = int(np.sqrt(np.median(apart) / book.shape[1]) / 2)
    return 1 << max(0, width.bit_length() - 1)


class CellMemo:
    """The nearest entry of one part's codebook, through the entries each grid cell leaves open."""

    def __init__(self, book: np.ndarray) -> None:
        self.book, self.step = book, cell_step(book)
        self.open: dict[bytes, np.ndarray] = {}

    def _learn(self, cells: np.ndarray) -> None:
        """Entries that are not dominated across the boxes of new cells."""
        n = len(self.book)
        if len(self.open) + len(cells) > KEEP:
            self.open.clear()
        rows = max(1, BLOCK // n)
        for at in range(0, len(cells), rows):
            low = cells[at : at + rows] * self.step
            nearest = np.zeros((len(low), n), np.int64)
            farthest = np.zeros_like(nearest)
            for d in range(self.book.shape[1]):
                below = low[:, d, None] - self.book[None, :, d]
                # the box holds the numbers low .. low + step - 1
                above = below + (self.step - 1)
                gap = np.maximum(np.maximum(below, -above), 0)
                nearest += gap * gap
                reach = np.maximum(np.abs(below), np.abs(above))
                farthest += reach * reach
            left = nearest <= farthest.min(1, keepdims=True)
            for cell, row in zip(cells[at : at + rows], left, strict=True):
                self.open[cell.tobytes()] = np.flatnonzero(row)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each row; ties go to the lower entry."""
        if not x.shape[1]:
            return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        cells, of = np.unique(np.floor_divide(x, self.step), axis=0, return_inverse=True)
        entry, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        of = of.ravel()
        order = np.argsort(of, kind="stable")
        starts = np.searchsorted(of[order], np.arange(len(cells) + 1))
        # a run of cells at a time: its bounds stay in the memo until it has been used
        for at in range(0, len(cells), KEEP // 4):
            end = min(at + KEEP // 4, len(cells))
            names = [c.tobytes() for c in cells[at:end]]
            new = [i for i, name in enumerate(names, at) if name not in self.open]
            if new:
                self._learn(cells[new])
                if missing := [i for i, name in enumerate(names, at) if name not in self.open]:
                    self._learn(cells[missing])
            left = [self.open[name] for name in names]
            rows = order[starts[at] : starts[end]]
            sizes = np.array([len(v) for v in left], np.int64)[of[rows] - at]
            self._exact(x, rows, of[rows] - at, left, sizes, entry, error)
        return entry, error

    def _exact(self, x, rows, which, left, sizes, entry, error) -> None:
        """Exact distances of rows to what their cells leave open, in blocks of bounded size."""
        ends = np.cumsum(sizes)
        at, most = 0, max(1, BLOCK // x.shape[1])
        while at < len(rows):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            some, n = rows[at:end], sizes[at:end]
            candidates = np.concatenate([left[c] for c in which[at:end].tolist()])
            apart = x[np.repeat(some, n)] - self.book[candidates]
            found = np.einsum("ij,ij->i", apart, apart)
            firsts = np.cumsum(n) - n
            best = np.minimum.reduceat(found, firsts)
            # open entries ascend, so the first that reaches the least is the lowest
            hit = np.where(found == np.repeat(best, n), candidates, len(self.book))
            entry[some], error[some] = np.minimum.reduceat(hit, firsts), best
            at = end


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict[int, tuple[np.ndarray, np.ndarray]]]]:
    """Batches with their rows and whole-number matrices by vector length."""
    for batch in batches:
        pa.default_memory_pool().release_unused()
        column = batch.column("x")
        offsets = column.offsets.to_numpy()
        flat = column.values.to_numpy(zero_copy_only=False)
        lengths = np.diff(offsets)
        spaces = {}
        for width in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == width)
            spaces[width] = rows, flat[offsets[rows][:, None] + np.arange(width)].reshape(len(rows), width)
        yield batch, spaces


def _memos(books: Books) -> dict[int, list[CellMemo]]:
    return {width: [CellMemo(book) for book in parts] for width, parts in books.items()}


SUMS = "width int, part int, entry int, n long, total array<long>"


def _sum_entries(batches: Iterator[pa.RecordBatch], books: Books) -> Iterator[pa.RecordBatch]:
    """Counts and componentwise sums of the vectors of this task by entry."""
    memos = _memos(books)
    counts = {w: [np.zeros(len(b), np.int64) for b in parts] for w, parts in books.items()}
    totals = {w: [np.zeros(b.shape, np.int64) for b in parts] for w, parts in books.items()}
    for _, spaces in _blocks(batches):
        for width, (_, x) in spaces.items():
            for p, (a, b) in enumerate(part_bounds(width)):
                entry, _ = memos[width][p].assign(x[:, a:b])
                used, n = np.unique(entry, return_counts=True)
                counts[width][p][used] += n
                totals[width][p][used] += np.add.reduceat(x[np.argsort(entry, kind="stable"), a:b], np.cumsum(n) - n)
    for width, parts in counts.items():
        for p, n in enumerate(parts):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict(
                {
                    "width": pa.array([width] * len(used), pa.int32()),
                    "part": pa.array([p] * len(used), pa.int32()),
                    "entry": pa.array(used, pa.int32()),
                    "n": pa.array(n[used], pa.int64()),
                    "total": pa.array(totals[width][p][used].tolist(), pa.list_(pa.int64())),
                }
            )


CODES = "vec_id long, label int, code string, error long, width int"


def _encode(batches: Iterator[pa.RecordBatch], books: Books) -> Iterator[pa.RecordBatch]:
    """Codes and squared distances of vectors."""
    memos = _memos(books)
    hexes = np.array([f"{i:02x}" for i in range(ENTRIES)])
    for batch, spaces in _blocks(batches):
        code, error = np.full(len(batch), "", object), np.zeros(len(batch), np.int64)
        widths = np.zeros(len(batch), np.int32)
        for width, (rows, x) in spaces.items():
            widths[rows] = width
            for p, (a, b) in enumerate(part_bounds(width)):
                entry, apart = memos[width][p].assign(x[:, a:b])
                code[rows] = code[rows] + hexes[entry].astype(object)
                error[rows] += apart
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error), pa.array(widths)],
            names=["vec_id", "label", "code", "error", "width"],
        )


@dataclass(frozen=True)
class Codec:
    """Codebooks by vector length: what decoding needs."""

    books: Books

    def digest(self, width: int) -> str:
        """SHA-256 of all components by part, entry and position."""
        numbers = [str(v) for book in self.books[width] for v in book.ravel().tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def decode(self, width: int, code: str) -> list[int]:
        """The whole-number vector that a code stands for."""
        entries = [int(code[2 * p : 2 * p + 2], 16) for p in range(PARTS)]
        return [v for book, e in zip(self.books[width], entries, strict=True) for v in book[e].tolist()]


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x) with whole-number components, without the vectors that cannot be coded."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))

    def scaled(v: Column) -> Column:
        return F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), v.cast("double") * SCALE))).cast("long")

    kept = vectors.where(F.col("embedding").isNotNull() & ~bad)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.transform("embedding", scaled).alias("x"))


def first_books(x: DataFrame) -> Books:
    """The parts of the first vectors of each length, as many as a codebook has entries."""
    by_length = Window.partitionBy(F.size("x")).orderBy("vec_id", "x")
    # at most one codebook for each length of vectors
    firsts = x.withColumn("place", F.row_number().over(by_length)).where(F.col("place") <= ENTRIES)
    rows = sorted(firsts.select(F.size("x").alias("width"), "place", "x").collect())
    books: Books = {}
    for width in {r.width for r in rows}:
        mine = [r.x for r in rows if r.width == width]
        matrix = np.array(mine, np.int64).reshape(len(mine), width)
        books[width] = [matrix[:, a:b] for a, b in part_bounds(width)]
    return books


def learn_codec(x: DataFrame, rounds: int = ROUNDS) -> Codec:
    """Codebooks after ``rounds`` of assigning all vectors and moving the entries to their means, rounded down."""
    books = first_books(x)
    for _ in range(rounds):
        sums = x.select("x").mapInArrow(partial(_sum_entries, books=books), SUMS)
        spread = sums.select("width", "part", "entry", "n", F.posexplode_outer("total").alias("at", "value"))
        total = F.sum(F.col("value").cast("decimal(38,0)"))
        added = spread.groupBy("width", "part", "entry", "at").agg(F.sum("n").alias("n"), total.alias("total"))
        books = {w: [b.copy() for b in parts] for w, parts in books.items()}
        # as many rows as the codebooks have components
        for r in added.where("at IS NOT NULL").toLocalIterator():
            books[r.width][r.part][r.entry, r.at] = int(r.total) // r.n
    return Codec(books)


def code_vectors(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The code of every vector, its squared error, and the error of its label.

    * Each of the passes over the vectors reads the written whole-number components; of a
      pass each task sends one sum per entry. Only codebooks go through the driver. Vectors
      of another length have codebooks of their own.
    * A vector that is null or holds a null or non-finite component is dropped. An empty
      vector has the code of first entries and no error; a length that parts do not divide
      is cut as evenly as can be. Components beyond 2 ** 24 after scaling count as that.
    * Repeated ids are rows of their own, in the order of their components; null ids come
      first. Fewer vectors than entries make smaller codebooks. Null labels are one label.
    * An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    x = scratch_table(whole_vectors(vectors), "whole-vectors")
    codec = learn_codec(x, rounds)
    codes = scratch_table(x.mapInArrow(partial(_encode, books=codec.books), CODES), "codes")
    # written, so that its size decides how it is joined; a label's rows are one row by then
    labels = scratch_table(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    digests = spark.createDataFrame([(w, codec.digest(w)) for w in codec.books], "width int, codebooks_sha256 string")
    judged = codes.alias("c").join(labels.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")))
    # one row for each length of vectors
    return (
        judged.select("vec_id", "code", "error", "label_error", "c.label", "width")
        .join(F.broadcast(digests), "width")
        .select("vec_id", "code", "error", "label_error", "codebooks_sha256", "label")
    )


def codes_sql(rounds: int = ROUNDS) -> str:
    """The same by SQL for vectors of one length that the parts divide: every part against every entry."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (
    SELECT vec_id, part, arg_min(entry, (apart, entry)) AS entry, min(apart) AS apart
    FROM (
        SELECT vec_id, x.part, entry, list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) ** 2))::BIGINT AS apart
        FROM parts x JOIN book{r} b USING (part)
    ) GROUP BY ALL
)""".replace("GROUP BY ALL", "GROUP BY vec_id, part"))
        if r < rounds:
            steps.append(f"""
mean{r} AS (
    SELECT part, entry, list(v ORDER BY pos) AS v
    FROM (
        SELECT part, entry, pos, floor(sum(x.v[pos]) / count(*))::BIGINT AS v
        FROM a{r} JOIN parts x USING (vec_id, part), range(1, (SELECT max(len(v)) FROM parts) + 1) r(pos)
        GROUP BY part, entry, pos
    ) GROUP BY part, entry
),
book{r + 1} AS (
    SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m USING (part, entry)
)""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), parts AS (
    SELECT vec_id, part, x[part * len(x) // {PARTS} + 1 : (part + 1) * len(x) // {PARTS}] AS v
    FROM kept, range({PARTS}) r(part)
), firsts AS (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id NULLS FIRST) - 1 AS entry FROM kept
    QUALIFY entry < {ENTRIES}
), book0 AS (
    SELECT part, entry, v FROM firsts JOIN parts USING (vec_id)
),{",".join(steps)},
digest AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
), coded AS (
    SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(apart)::BIGINT AS error
    FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256, label
FROM coded JOIN kept USING (vec_id), digest
"""
