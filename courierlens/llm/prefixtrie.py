"""The trie of conversation prefixes, by range minima over sorted common prefixes.

Conversations are sorted by their turns; beside each stands how many turns it shares with
the one before. The members of a prefix are then a run of rows, and a sparse table of range
minima lets every candidate prefix find the two ends of its run by binary search, each on
its own. Long conversations are cut into blocks of turns that are sorted under a hash of
all turns before them, so a row is bounded however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.blocks import scratch_table, shuffle_partitions
from courierlens.llm.numbering import numbered, range_count

# turns of a conversation in one row, and padded turns of one slice of rows
BLOCK, SLICE = 64, 1 << 18
# conversations that lend their first turns to each other, and how many turns they may lend
FAMILY, HEADS = 5, 9
NODE = ["depth", "x1", "x2"]


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level j holds the minima of all runs of 2 ** j values."""
    levels = [values]
    while (step := 1 << (len(levels) - 1)) * 2 <= len(values):
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
    return levels


def extents(table: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row around each of ``rows`` that share ``depths`` turns with it.

    ``table`` is built over what rows 1, 2, ... share with the row before: value i lies
    between rows i and i + 1.
    """
    n = len(table[0])
    left, right = rows.copy(), rows.copy()
    for j in range(len(table) - 1, -1, -1):
        step, level = 1 << j, table[j]
        fits = right + step <= n
        fits[fits] = level[right[fits]] >= depths[fits]
        right += step * fits
        fits = left - step >= 0
        fits[fits] = level[left[fits] - step] >= depths[fits]
        left -= step * fits
    return left, right


def least_rows(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minima over left .. right, from two runs that cover them."""
    level = np.frexp(right - left + 1)[1] - 1
    out = np.empty(len(left), np.int64)
    for j in np.unique(level).tolist():
        some = level == j
        out[some] = np.minimum(table[j][left[some]], table[j][right[some] - (1 << j) + 1])
    return out


FIELDS = [
    ("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("y1", pa.int64()), ("y2", pa.int64()),
    ("conv_id", pa.int64()), ("n", pa.int64()), ("last", pa.int64()), ("prev", pa.int64()), ("total", pa.int64()),
    ("fresh", pa.int64()), ("leaves", pa.int64()), ("own_total", pa.int64()), ("own_fresh", pa.int64()),
    ("edge", pa.bool_()),
]
TRIE = ", ".join(f"{name} {'boolean' if name == 'edge' else 'long'}" for name, _ in FIELDS)


def _padded(column: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(offsets) - 1, width), np.int64)
    lengths = np.diff(offsets)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], lengths)] = column[offsets[0] : offsets[-1]]
    return out


def _nodes(row: dict[str, np.ndarray], lengths: np.ndarray, f1: np.ndarray, f2: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """All prefixes of one slice of sorted rows, each once, with its members in this slice."""
    n, width = f1.shape
    same = (row["k"][1:] == row["k"][:-1]) & (row["p1"][1:] == row["p1"][:-1]) & (row["p2"][1:] == row["p2"][:-1])
    equal = (f1[1:] == f1[:-1]) & (f2[1:] == f2[:-1]) & (np.arange(width) < np.minimum(lengths[1:], lengths[:-1])[:, None])
    shared = np.where(same, np.logical_and.accumulate(equal, axis=1).sum(1), -1)
    table = sparse_table(shared) if n > 1 else [np.zeros(0, np.int64)]
    # a candidate stands at the first row that has it; the root belongs to the first block
    start = np.maximum(np.concatenate([[-1], shared]) + 1, (row["k"] > 0).astype(np.int64))
    count = np.maximum(lengths - start + 1, 0)
    at = np.repeat(np.arange(n), count)
    d = start[at] + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    left, right = extents(table, at, d)
    zero = np.zeros((n, 1), np.int64)
    x1 = row["p1"][:, None] ^ np.concatenate([zero, np.bitwise_xor.accumulate(f1, axis=1)], axis=1)
    x2 = row["p2"][:, None] ^ np.concatenate([zero, np.bitwise_xor.accumulate(f2, axis=1)], axis=1)
    before = row["before"][:, None] + np.concatenate([zero, np.cumsum(sizes, axis=1)], axis=1)
    rank = np.empty(n, np.int64)
    by_id = np.argsort(row["conv_id"], kind="stable")
    rank[by_id] = np.arange(n)
    own = by_id[least_rows(sparse_table(rank), left, right)]
    up, deep = np.maximum(d - 1, 0), d > 0

    def summed(name: str) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(row[name])])
        return sums[right + 1] - sums[left]

    return {
        "depth": row["k"][at] * BLOCK + d,
        "x1": x1[at, d],
        "x2": x2[at, d],
        "y1": x1[at, up],
        "y2": x2[at, up],
        "conv_id": row["conv_id"][own],
        "n": right - left + 1,
        "last": np.where(deep, before[at, d] - before[at, up], 0),
        "prev": np.where(deep, before[at, up], 0),
        "total": summed("total"),
        "fresh": summed("fresh"),
        "leaves": summed("leaf"),
        "own_total": row["total"][own],
        "own_fresh": row["fresh"][own],
        "edge": (left == 0) | (right == n - 1),
    }


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of sorted rows, slice by slice; runs that touch the end of a slice are marked."""
    for batch in batches:
        pa.default_memory_pool().release_unused()
        names = ["conv_id", "k", "p1", "p2", "before", "total", "fresh", "leaf"]
        columns = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in names}
        lists = {name: batch.column(name) for name in ("f1", "f2", "sizes")}
        offsets = lists["f1"].offsets.to_numpy()
        flat = {name: c.values.to_numpy(zero_copy_only=False) for name, c in lists.items()}
        starts = {name: c.offsets.to_numpy() for name, c in lists.items()}
        lengths, at = np.diff(offsets).astype(np.int64), 0
        while at < len(batch):
            widest = np.maximum.accumulate(lengths[at : at + SLICE])
            fits = int(np.searchsorted(np.arange(1, len(widest) + 1) * np.maximum(widest, 1), SLICE, side="right"))
            end = at + max(1, fits)
            width = max(1, int(widest[end - at - 1]))
            padded = [_padded(flat[name], starts[name][at : end + 1], width) for name in ("f1", "f2", "sizes")]
            found = _nodes({name: c[at:end] for name, c in columns.items()}, lengths[at:end], *padded)
            yield pa.RecordBatch.from_arrays([pa.array(found[f], t) for f, t in FIELDS], names=[f for f, _ in FIELDS])
            at = end


def trie(rows: DataFrame, name: str) -> DataFrame:
    """Every prefix once, with its members counted and added up.

    Rows are sorted in ranges that end anywhere, also within a group of copies; only the few
    prefixes on the borders of slices meet once more, by their hash.
    """
    keys = ["k", "p1", "p2", "turns", "conv_id"]
    # the order of turns is that of their hashes: place and size follow from these
    ranged = rows.repartitionByRange(range_count(rows, rows.count()), *keys).sortWithinPartitions(*keys)
    flat = ranged.select(
        "conv_id", "k", "p1", "p2", "before", "total", "fresh", "leaf",
        F.col("turns.f1").alias("f1"), F.col("turns.f2").alias("f2"), F.col("turns.bytes").alias("sizes"),
    )
    found = scratch_table(flat.mapInArrow(_tries, TRIE), name)
    same = [F.any_value(c).alias(c) for c in ("y1", "y2", "last", "prev")]
    first = F.min(F.struct("conv_id", "own_total", "own_fresh")).alias("first")
    sums = [F.sum(c).alias(c) for c in ("n", "total", "fresh", "leaves")]
    met = found.where("edge").groupBy(*NODE).agg(*same, first, *sums).select("*", "first.*").drop("first")
    return found.where("NOT edge").drop("edge").unionByName(met)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, symbol, bytes, tie): texts become 128 bits of a digest, and never move."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.substring(F.sha2(whole, 256), 1, 32).alias("symbol"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("tie"),
    )


def rebuilt_plans(turns: DataFrame) -> DataFrame:
    """Per conversation: its first row, its own turns to leave out, and those it takes from its family's first."""
    counted = turns.groupBy("conv_id").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n"))
    left_out = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = scratch_table(counted.withColumns({"h": left_out, "base": base}), "conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0))).cast("long")
    planned = convs.join(bases, "base", "left").withColumn("taken", taken).drop("base_n")
    return planned.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))


def block_rows(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Rebuilt conversations in rows of at most ``BLOCK`` turns, each with a hash of all turns before it."""
    posed = turns.join(plans.select("conv_id", "first_row", "h", "taken"), "conv_id")
    posed = scratch_table(posed.withColumn("pos", F.col("row") - F.col("first_row")), "posed")
    own = posed.where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("place"), "symbol", "bytes")
    lent = posed.where(F.col("pos") < HEADS).select(F.col("conv_id").alias("base"), "pos", "symbol", "bytes")
    given = lent.join(plans.where("taken > 0").select("base", "conv_id", "taken"), "base").where("pos < taken")
    rebuilt = own.unionByName(given.select("conv_id", F.col("pos").alias("place"), "symbol", "bytes"))
    hashed = rebuilt.withColumns(
        {"f1": F.xxhash64("place", "symbol"), "f2": F.xxhash64("symbol", "place", F.lit(1))}
    ).withColumn("k", F.floor(F.col("place") / BLOCK))
    # at most a block of turns comes together
    blocks = hashed.groupBy("conv_id", "k").agg(
        F.sort_array(F.collect_list(F.struct("place", "f1", "f2", "bytes"))).alias("turns"),
        F.bit_xor("f1").alias("s1"),
        F.bit_xor("f2").alias("s2"),
        F.sum("bytes").alias("size"),
    )
    blocks = scratch_table(blocks, "blocks")
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(total: Column) -> Column:
        return F.coalesce(total.over(earlier), F.lit(0).cast("long"))

    places = blocks.select(
        "conv_id",
        "k",
        so_far(F.bit_xor("s1")).alias("p1"),
        so_far(F.bit_xor("s2")).alias("p2"),
        so_far(F.sum("size")).alias("before"),
        F.sum("size").over(whole).alias("total"),
        F.max("k").over(whole).alias("last_k"),
    )
    joined = blocks.join(places, ["conv_id", "k"]).drop("size")
    nothing = [F.lit(0).cast("long").alias(c) for c in ("k", "s1", "s2", "p1", "p2", "before", "total", "last_k")]
    empty = F.array().cast(blocks.schema["turns"].dataType).alias("turns")
    turnless = plans.where("length = 0").select("conv_id", empty, *nothing)
    return joined.unionByName(turnless).join(plans.select("conv_id", "length"), "conv_id")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with one end, their ids joined by commas."""
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in NODE], axis=1)
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        firsts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
        texts = [",".join(map(str, run.tolist())) for run in np.split(ids, firsts[1:])]
        columns = [pa.array(keys[firsts, i]) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(ids[firsts]), pa.array(texts)], names=[*NODE, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined runs of each end, as they pass."""
    key = digest = None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*NODE, "ends_sha256"])

    for batch in batches:
        rows = []
        for *now, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"]), strict=True):
            if now == key:
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                rows.append((*key, digest.hexdigest()))
            key, digest = now, hashlib.sha256(ids.encode())
        yield out(rows)
    if key is not None:
        yield out([(*key, digest.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256): the ids of all conversations that end at a node, in order.

    A digest has to see the ids of a group one after the other, but they come to it in
    joined runs of thousands, sorted and written out by many tasks.
    """
    keys = [*NODE, "conv_id"]
    ranged = ends.repartitionByRange(range_count(ends, ends.count()), *keys).sortWithinPartitions(*keys)
    runs = ranged.mapInArrow(_chunks, "depth long, x1 long, x2 long, first long, ids string")
    met = runs.repartition(shuffle_partitions(ends.sparkSession), *NODE).sortWithinPartitions(*NODE, "first")
    return met.select(*NODE, "ids").mapInArrow(_digests, "depth long, x1 long, x2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for every distinct prefix of the rebuilt conversations.

    * Conversation c starts with the first h turns of the first of its family of five, if
      that exists, and goes on with its own after its first h; h is a checksum of its id.
    * Turns come in the order of ``turn`` (nulls first), those that agree in the order of a
      digest of role and text. Null roles and texts are empty. Rows without ``conv_id`` belong
      to no conversation and are left out. Repeated rows are turns of their own.
    * Members, leaves and bytes are sums over a prefix's run of rows. For the latter two each
      node is first given to its smallest member, in a pass of its own: a conversation then
      brings its new bytes and whether it is a leaf to all its prefixes.
    * No row holds more than ``BLOCK`` turns, whatever the length of a conversation, and no
      task more than its range of rows, whatever the number of copies. Texts never move.
    * Prefixes are told apart by 128 bits. An empty table gives no rows; other columns are
      ignored.
    """
    turns, _ = numbered(scratch_table(turn_rows(conversations), "turns"), ["conv_id", "turn", "symbol", "tie"], "ordered-turns")
    plans = scratch_table(rebuilt_plans(turns), "plans")
    rows = scratch_table(block_rows(turns, plans), "block-rows")
    none = {"fresh": F.lit(0).cast("long"), "leaf": F.lit(0).cast("long")}
    first = scratch_table(trie(rows.withColumns(none), "runs").select(*NODE, "y1", "y2", "conv_id", "last"), "nodes")
    below = first.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("y1").alias("x1"), F.col("y2").alias("x2"))
    children = scratch_table(below.agg(F.count(F.lit(1)).alias("n_children")), "children")
    owned = first.join(children, NODE, "left").groupBy("conv_id").agg(
        F.sum("last").alias("fresh"), F.count_if(F.col("n_children").isNull()).alias("leaf")
    )
    given = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("fresh", "leaf")}
    owned = scratch_table(owned, "owned")
    nodes = trie(rows.join(owned, "conv_id", "left").withColumns(given), "summed-runs")
    last_rows = rows.where("k = last_k")
    ends = last_rows.select(
        F.col("length").alias("depth"), F.col("p1").bitwiseXOR(F.col("s1")).alias("x1"), F.col("p2").bitwiseXOR(F.col("s2")).alias("x2"), "conv_id"
    )
    digests = scratch_table(end_digests(scratch_table(ends, "ends")), "end-digests")
    parents = first.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("y1"), F.col("x2").alias("y2"), F.col("conv_id").alias("parent_conv_id"))
    all_bytes = F.col("total") - F.col("n") * F.col("prev")
    once = F.col("own_total") - F.col("prev") + F.col("fresh") - F.col("own_fresh")
    return (
        nodes.join(children, NODE, "left")
        .join(digests, NODE, "left")
        .join(parents, ["depth", "y1", "y2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            F.col("n").alias("n_convs"),
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            (all_bytes - once).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def trie_sql() -> str:
    """The same by SQL: every conversation's prefixes as lists, grouped; every node added to all above it."""
    return f"""
WITH turns AS (
    SELECT conv_id, strlen(coalesce(text, '')) AS bytes, turn,
        left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS symbol
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, symbol) - 1 AS pos FROM turns
), convs AS (
    SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, xor(4294967295, list_reduce(
        list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
        lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, {0xEDB88320}) ELSE v // 2 END),
        4294967295)) % {HEADS} AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT c.conv_id, pos AS place, symbol, bytes FROM convs c JOIN placed p ON p.conv_id = base AND pos < h
    UNION ALL
    SELECT conv_id, pos, symbol, bytes FROM convs JOIN placed USING (conv_id) WHERE pos >= h
), whole AS (
    SELECT conv_id, list(symbol ORDER BY place) FILTER (symbol IS NOT NULL) AS path, list(bytes ORDER BY place) AS sizes
    FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
), prefixes AS (
    SELECT conv_id, d AS depth, coalesce(path, [])[1:d] AS path, len(coalesce(path, [])) = d AS ends,
        coalesce(sizes[d], 0) AS bytes
    FROM (SELECT *, unnest(range(len(coalesce(path, [])) + 1)) AS d FROM whole)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY path, depth
), kids AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), judged AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)
), above AS (
    SELECT path[1:d] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM judged) GROUP BY 1
)
SELECT j.conv_id, j.depth, p.conv_id AS parent_conv_id, j.n_convs, j.n_children, n_leaves, saved_tokens, j.ends_sha256
FROM judged j JOIN above USING (path) LEFT JOIN nodes p ON j.depth > 0 AND p.path = j.path[1:j.depth - 1]
"""
