"""A reproducible shuffle into shards by a Feistel permutation of global row numbers.

A row's place in the shuffle is a permutation of its number, which needs no sort and no
table: shard and slot of any row, and the row at any shard and slot, are computed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.blocks import scratch_table
from courierlens.llm.numbering import numbered

PRIME = 2**31 - 1
ROUNDS = 8


@dataclass(frozen=True)
class Feistel:
    """A permutation of 0 .. total - 1, fixed by ``seed``.

    The bits of a number are cut in two halves, one of which a round changes by a function
    of the other. Numbers beyond ``total`` are walked on until they fall below it; with
    fewer than twice as many numbers as rows, that takes under two steps on average.
    """

    total: int
    seed: int = 13

    @property
    def halves(self) -> tuple[int, int]:
        """Bits of the upper and the lower half."""
        bits = max(2, (self.total - 1).bit_length())
        return bits - bits // 2, bits // 2

    def keys(self) -> list[tuple[int, int]]:
        """A factor and a summand for each round."""
        drawn = [hashlib.sha256(f"{self.seed}:{i}".encode()).digest() for i in range(ROUNDS)]
        return [(int.from_bytes(d[:8]) % (PRIME - 1) + 1, int.from_bytes(d[8:16]) % PRIME) for d in drawn]

    def _once(self, x: np.ndarray, order: range) -> np.ndarray:
        up, low = self.halves
        upper, lower = x >> low, x & ((1 << low) - 1)
        keys = self.keys()
        for i in order:
            factor, summand = keys[i]
            y = ((lower if i % 2 == 0 else upper) * factor + summand) % PRIME
            y = y * y % PRIME
            if i % 2 == 0:
                upper = upper ^ (y & ((1 << up) - 1))
            else:
                lower = lower ^ (y & ((1 << low) - 1))
        return upper << low | lower

    def _walk(self, x: np.ndarray, order: range) -> np.ndarray:
        out = np.asarray(x, np.int64).copy()
        beyond = np.arange(len(out))
        while len(beyond):
            out[beyond] = self._once(out[beyond], order)
            beyond = beyond[out[beyond] >= self.total]
        return out

    def place(self, rows: np.ndarray) -> np.ndarray:
        """Where rows lie in the shuffle."""
        return self._walk(rows, range(ROUNDS))

    def row(self, places: np.ndarray) -> np.ndarray:
        """The rows that lie at these places."""
        return self._walk(places, range(ROUNDS - 1, -1, -1))


SCHEMA = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, row long"


def _deal(total: int, shards: int, seed: int):
    """Shard and slot of numbered rows: places are dealt to the shards in turn."""
    shuffle = Feistel(total, seed)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            places = shuffle.place(rows.to_numpy(zero_copy_only=False))
            columns = {
                "doc_id": batch.column("doc_id"),
                "size": batch.column("size"),
                "text_crc32": batch.column("text_crc32"),
                "law": pa.array(["rows"] * len(rows), pa.string()),
                "shard": pa.array(places % shards, pa.int32()),
                "slot": pa.array(places // shards, pa.int64()),
                "grown_shard": pa.nulls(len(rows), pa.int32()),
                "row": rows,
            }
            yield pa.RecordBatch.from_pydict(columns)

    return deal


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 13) -> DataFrame:
    """Every document with its shard and its slot there, by the law ``rows``.

    * Rows are numbered by (``doc_id``, size, checksum); places of the shuffled numbers go
      to the shards in turn, so counts differ by one at most and slots have no gaps. Sizes
      in bytes are only near equal as far as chance makes them so.
    * Texts never move: one scan leaves the id, size and checksum of each row, and those
      are put into ranges. Equal texts are rows like others and may lie in several shards.
    * A null text has no bytes. Null ids come first. Rows that agree in id, size and
      checksum are alike in the result, so which of them has which place does not matter.
    * Fewer rows than shards leave shards empty; an empty table gives no rows; other
      columns are ignored. A null in ``grown_shard`` says that the law has none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    light = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows, total = numbered(scratch_table(light, "sizes"), ["doc_id", "size", "text_crc32", "tie"], "numbered")
    return rows.drop("tie").mapInArrow(_deal(total, shards, seed), SCHEMA)


def shard_sql(total: str = "(SELECT count(*) FROM documents)", shards: int = 16, seed: int = 13) -> str:
    """The same by SQL: a recursive walk over all rows, and CRC-32 by blocks of 64 bytes."""
    crc, width = [], 64
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        crc.append(byte)
    # what a checksum becomes after as many zero bytes as a block has, by each of its four bytes
    later = [[byte << shift for byte in range(256)] for shift in (0, 8, 16, 24)]
    for _ in range(width):
        later = [[c >> 8 ^ crc[c & 255] for c in row] for row in later]
    half = "(instr('0123456789ABCDEF', digits[2 * i + {}]) - 1)"
    moved = [f"({row}::UBIGINT[])[((c >> {8 * k}) & 255)::BIGINT + 1]" for k, row in enumerate(later)]
    source, (left, right) = "now", ("u", "l")
    for i, (factor, summand) in enumerate(Feistel(1, seed).keys()):
        changed, other, bits = (left, right, "up") if i % 2 == 0 else (right, left, "low")
        y = f"(({other} * {factor} + {summand}) % {PRIME})"
        new = f"xor({changed}, ({y} * {y} % {PRIME}) & ((1::BIGINT << {bits}) - 1))"
        columns = f"{new} AS u, l" if changed == "u" else f"u, {new} AS l"
        source = f"(SELECT n, up, low, total, {columns} FROM {source})"
    return f"""
WITH RECURSIVE sized AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS digits,
        row_number() OVER () AS r
    FROM documents
), blocks AS (
    SELECT r, k, CASE WHEN k = 0 THEN left(digits, 2 * ((size - 1) % {width}))
        ELSE substr(digits, 2 * ((size - 1) % {width} + {width} * (k - 1)) + 1, {2 * width}) END AS digits
    FROM (SELECT r, size, digits, unnest(range((size - 1) // {width} + 1)) AS k FROM sized)
), parts AS (
    SELECT r, k, list_reduce(
        list_transform(range(length(digits) // 2), lambda i: ({half.format(1)} * 16 + {half.format(2)})::UBIGINT),
        lambda c, x: xor(c >> 8, ({crc}::UBIGINT[])[(xor(c, x) & 255)::BIGINT + 1]),
        CASE WHEN k = 0 THEN 4294967295 ELSE 0 END::UBIGINT) AS part
    FROM blocks
), summed AS (
    SELECT doc_id, size, xor(4294967295::UBIGINT, list_reduce(parts,
        lambda c, x: xor(x, xor(xor({moved[0]}, {moved[1]}), xor({moved[2]}, {moved[3]})))))::BIGINT AS text_crc32
    FROM sized JOIN (SELECT r, list(part ORDER BY k) AS parts FROM parts GROUP BY r) USING (r)
), counted AS (
    SELECT {total} AS total, greatest(2, length(ltrim(bin(greatest({total} - 1, 0)), '0'))) AS bits
), numbered AS (
    SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS n FROM summed
), walk AS (
    SELECT n, n AS spot, bits - bits // 2 AS up, bits // 2 AS low, total, FALSE AS done FROM numbered, counted
    UNION ALL
    SELECT n, (u << low) + l, up, low, total, (u << low) + l < total
    FROM (WITH now AS (
        SELECT n, up, low, total, spot >> low AS u, spot & ((1::BIGINT << low) - 1) AS l FROM walk WHERE NOT done
    ) SELECT * FROM {source})
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (spot % {shards})::INT AS shard, spot // {shards} AS slot,
    NULL::INT AS grown_shard, numbered.n AS row
FROM numbered JOIN walk ON numbered.n = walk.n AND done
"""
