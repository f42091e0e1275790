"""Texts as flat byte arrays: what the numpy operators share.

An Arrow string column is one byte buffer with offsets. The operators work on slices of
whole documents of a few megabytes each, so memory does not follow the batch, and a
single longer document forms a slice of its own.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from courierlens.session import application_folder

# gives memory that was freed within the heap back to the system, where the C library can
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
# bytes of text in one slice
SLICE_BYTES = 1 << 19
SEED = 0x5EED


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; a null is empty.

    What was freed of earlier batches goes back first, by Arrow and by numpy's arrays: workers
    live on through many stages.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield at, end
        at = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer, in place on a uint64 array."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class SpanHasher:
    """64-bit hashes of many spans of one byte buffer.

    A span's hash is the difference of two prefix sums of ``table[byte] * base ** place``,
    shifted back by the inverse power of its start, so each byte is touched once.
    """

    #: odd, and 5 modulo 8; one base serves all hashers of a worker, whose byte tables differ
    BASE = 0x9E3779B97F4A7C15 >> 3 << 3 | 5
    powers = back = np.ones(1, np.uint64)

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @classmethod
    def _grow(cls, n: int) -> None:
        inverse = pow(cls.BASE, -1, 2**64)
        while len(cls.powers) < n:
            step, undo = (np.uint64(pow(b, len(cls.powers), 2**64)) for b in (cls.BASE, inverse))
            cls.powers, cls.back = np.concatenate([cls.powers, cls.powers * step]), np.concatenate([cls.back, cls.back * undo])

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        SpanHasher._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * SpanHasher.powers[: len(data)], out=sums[1:])
        span = (sums[ends] - sums[starts]) * SpanHasher.back[starts]
        return mixed(span + (ends - starts).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes kept."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and n + 1 word offsets per row."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[firsts[1:] - 1] = inside[firsts[1:] - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into this application's part of the shared folder and read it back.

    The written table cuts the lineage: what a lost executor held is read again from it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    return application_folder(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions the session deals a shuffle to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
