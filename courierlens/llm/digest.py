"""Quartile bucket digest of texts, and a bounded difference score.

Byte triplets of every four-byte window are hashed into 256 buckets. A digest holds, per
bucket, the quartile of its count among all buckets (two bits), the logarithm of the
length (one byte) and the ratios of the quartiles (two nibbles). Two digests are compared
by the distance of their quartiles, lengths and ratios, scaled into 0..1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.blocks import flat, scratch_table, shuffle_partitions

BUCKETS = 256
_RNG = np.random.default_rng(0xD16E57)
# one random byte table per place of a triplet
_FIRST, _SECOND, _THIRD = (_RNG.permutation(256).astype(np.uint8) for _ in range(3))
# what a wide quartile gap, a length step and a ratio step cost, and the cost that counts as unlike
GAP_COST = np.array([0, 1, 2, 6], np.float64)
LENGTH_COST, RATIO_COST = 4.0, 2.0
WORST = float(BUCKETS)
HEX = 2 * (BUCKETS // 4 + 2)


def bucket_counts(data: np.ndarray) -> np.ndarray:
    """Counts of the triplets (i, i+1, i+2), (i, i+1, i+3) and (i, i+2, i+3) by bucket."""
    if len(data) < 3:
        return np.zeros(BUCKETS, np.int64)
    a, b, c = _FIRST[data], _SECOND[data], _THIRD[data]
    counts = np.bincount(a[:-2] ^ b[1:-1] ^ c[2:], minlength=BUCKETS)
    if len(data) > 3:
        counts += np.bincount(a[:-3] ^ b[1:-2] ^ c[3:], minlength=BUCKETS)
        counts += np.bincount(a[:-3] ^ b[2:-1] ^ c[3:], minlength=BUCKETS)
    return counts


def fingerprint(data: np.ndarray) -> str:
    """The digest of a text's bytes as lowercase hex; an empty text has all quartiles 0."""
    counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    length = int(np.log(len(data) + 1) / np.log(1.15))
    ratios = [int(15 * q / q3) if q3 else 0 for q in (q1, q2)]
    return bytes([min(length, 255), ratios[0] << 4 | ratios[1]]).hex() + body.astype(np.uint8).tobytes().hex()


def _parts(digest: str) -> tuple[int, int, int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(digest), np.uint8)
    body = raw[2:]
    codes = np.stack([body & 3, body >> 2 & 3, body >> 4 & 3, body >> 6]).astype(np.int64)
    return int(raw[0]), int(raw[1] >> 4), int(raw[1] & 15), codes


def difference(one: str, other: str) -> float:
    """Distance of two digests; 0 for equal ones."""
    (n1, p1, r1, c1), (n2, p2, r2, c2) = _parts(one), _parts(other)
    gaps = float(GAP_COST[np.abs(c1 - c2)].sum())
    return gaps + LENGTH_COST * max(abs(n1 - n2) - 1, 0) + RATIO_COST * (abs(p1 - p2) + abs(r1 - r2))


def likeness(one: str, other: str) -> float:
    """1 for equal digests, falling with their difference, 0 from ``2 * WORST`` on."""
    return max(0.0, 1.0 - difference(one, other) / (2 * WORST))


def _place(data: np.ndarray, k: int) -> int:
    """Byte offset of code point ``k``."""
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    return int(leads[k]) if k < len(leads) else len(data)


def code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def edited(data: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last half of the code points replaced by as many of the first of ``following``."""
    n = code_points(data)
    half = n // 2
    return np.concatenate([data[: _place(data, n - half)], following[: _place(following, half)]])


FIELDS = [
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _judge(doc_id: int | None, own: np.ndarray, own_print: str, after: np.ndarray, after_print: str) -> tuple:
    changed = edited(own, after)
    changed_print = fingerprint(changed)
    return (
        doc_id,
        code_points(own),
        hashlib.sha256(changed.tobytes()).hexdigest(),
        own_print,
        changed_print,
        likeness(own_print, changed_print),
        likeness(own_print, after_print),
    )


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


EDGE_FIELDS = [*FIELDS, ("part", pa.int32()), ("head", pa.binary()), ("tail", pa.binary())]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Judge every document of a sorted partition but its last; hand on its first and last text."""
    part = TaskContext.get().partitionId()
    last = first = None
    for batch in batches:
        data, offsets = flat(batch.column(1))
        rows = []
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            own = data[offsets[i] : offsets[i + 1]]
            own_print = fingerprint(own)
            if last is None:
                first = own.tobytes()
            else:
                rows.append((*_judge(*last, own, own_print), None, None, None))
            last = (doc_id, own, own_print)
        if last is not None:
            last = (last[0], last[1].copy(), last[2])
        yield _batch(rows, EDGE_FIELDS)
    if last is not None:
        row = (last[0], *[None] * (len(FIELDS) - 1), part, first, last[1].tobytes())
        yield _batch([row], EDGE_FIELDS)


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, tail, head in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            own, after = np.frombuffer(tail, np.uint8), np.frombuffer(head, np.uint8)
            rows.append(_judge(doc_id, own, fingerprint(own), after, fingerprint(after)))
        yield _batch(rows, FIELDS)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Digests of every document, of its edited text, and their likeness to the next one.

    * The texts move once, to ranges of ascending ``doc_id``; each range is read as a stream
      that keeps one text back. Only the first and last text of a range meet again.
    * A null text is empty. Null ids come first; equal ids are ordered by a hash of
      their text and the text, so repeated rows have a defined successor and each gives a row.
    * The document after the last is the first; a single document follows itself.
    * Empty tables give no rows; other columns are ignored. Any length of text is hashed whole.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keys = ["doc_id", F.xxhash64("text")]
    ranges = texts.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "text")
    walked = scratch_table(ranges.mapInArrow(_walk, f"{SCHEMA}, part int, head binary, tail binary"), "digests")
    ends = walked.where("part IS NOT NULL")
    # numbers of ranges alone are put in order; their texts then meet by the number
    parts = ends.select("part")
    first = F.min("part").over(Window.partitionBy())
    after = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), first).alias("next"))
    heads = ends.select(F.col("part").alias("next"), F.col("head").alias("after"))
    met = ends.join(after, "part").join(heads, "next")
    stitched = met.select("doc_id", "tail", F.col("after").alias("head")).mapInArrow(_stitch, SCHEMA)
    return walked.where("part IS NULL").select(*[n for n, _ in FIELDS]).unionByName(stitched)
