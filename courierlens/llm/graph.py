"""Near-duplicate vectors by a robust-pruned flat graph over overlapping cluster shards.

Every vector belongs to the shards of its two nearest centroids. Each shard builds pruned
neighbour lists; the lists of a vector from all its shards are united. Every vector then
searches the shards that can hold a vector in its range: greedily from the nearest medoids,
then expanding all that lies in range. A vector counts in its nearest cell only, so each link
is met once a side. Links are verified by their cosine in double precision, and the recall of
the whole is audited against brute force for a bounded set of queries.

A vector in range of a query lies within d = sqrt(2 - 2 * threshold) of it; so its nearest
cell is one whose border with the query's own nearest cell is at most d away. Queries visit
cells up to a share of d first, and farther ones until the audit is satisfied or d is reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.blocks import scratch_table
from courierlens.llm.components import connected_components


@dataclass(frozen=True)
class Graph:
    """Bounds and widths of the index.

    ``sample`` vectors at most fit the centroids; a shard holds ``shard`` index vectors at
    most on average, and larger cells are split by hash. The queries of a cell are split by
    hash into blocks of ``block``; every block meets every part. ``reaches`` are the shares of
    the range to which queries leave their cell; the next one follows while the audit is
    below ``recall``. The last one, the whole range, leaves out no cell that can hold a link.
    """

    threshold: float = 0.93
    sample: int = 20_000
    cell: int = 1_000
    shard: int = 2_000
    block: int = 4_000
    reaches: tuple[float, ...] = (0.25, 0.5, 1.0)
    recall: float = 0.95
    near: int = 16
    far: int = 8
    pool: int = 40
    alpha: float = 1.2
    beam: int = 8
    medoids: int = 32
    slack: float = 0.04
    audit: int = 200
    seed: int = 5


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct vectors of a label with their smallest id and number of copies."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.cast("array<double>").alias("embedding"))
    given = given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull())
    given = given.where(~bad & F.exists("embedding", lambda x: x != 0))
    group = F.concat_ws("|", F.col("label").cast("string"), F.size("embedding"))
    return given.groupBy(group.alias("space"), "embedding").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")
    )


def fit_cells(nodes: DataFrame, g: Graph) -> dict[str, np.ndarray]:
    """Centroids of each space, from a bounded sample by hash; spaces not in it form one cell."""
    total = nodes.count()
    share = min(1.0, g.sample / max(total, 1))
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    rows = nodes.where(draw < share).select("space", "vec_id", "embedding").limit(2 * g.sample).collect()
    rng = np.random.default_rng(g.seed)
    cells: dict[str, np.ndarray] = {}
    by_space: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r.vec_id):
        by_space.setdefault(r.space, []).append(r.embedding)
    for space, vectors in sorted(by_space.items()):
        x = unit_rows(np.array(vectors))
        k = min(int(np.ceil(len(x) / share / g.cell)), max(1, len(x) // 8))
        centers = x[rng.choice(len(x), k, replace=False)]
        for _ in range(6):
            own = (x @ centers.T).argmax(axis=1)
            for c in range(k):
                if (own == c).any():
                    mean = x[own == c].sum(axis=0)
                    norm = np.sqrt((mean * mean).sum())
                    centers[c] = mean / norm if norm else centers[c]
        cells[space] = centers
    return cells


def near_cells(centers: np.ndarray | None, x: np.ndarray, range_: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per unit vector: the cells that can hold a vector within ``range_``, and how far their borders are.

    The nearest cell comes first and the second nearest next, both at no distance.
    """
    if centers is None or len(centers) < 2:
        return [(np.zeros(1, np.int64), np.zeros(1))] * len(x)
    out = []
    squares = (centers * centers).sum(axis=1)
    between = centers @ centers.T
    for a in range(0, len(x), 1024):
        sims = x[a : a + 1024] @ centers.T
        for row in sims:
            first, second = np.argsort(-row, kind="stable")[:2].tolist()
            apart = np.sqrt(np.maximum(squares + squares[first] - 2 * between[first], 1e-18))
            border = np.maximum((row[first] - row) / apart, 0.0)
            border[[first, second]] = 0.0
            # a little wider than the range, for rounding
            able = np.flatnonzero(border <= range_ + 1e-6)
            able = able[(able != first) & (able != second)]
            cells = np.concatenate([[first, second], able])
            out.append((cells, border[cells]))
    return out


def place_vectors(nodes: DataFrame, cells: dict[str, np.ndarray], g: Graph) -> DataFrame:
    """Rows (space, vec_id, copies, unit, cells, borders): the cells of each vector, as ``near_cells`` gives them."""
    shared = nodes.sparkSession.sparkContext.broadcast(cells)
    range_ = float(np.sqrt(2 - 2 * g.threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spaces = np.array(batch.column("space").to_pylist(), object)
            units = [unit_rows(np.array([v]))[0] for v in batch.column("embedding").to_pylist()]
            found: list = [None] * len(units)
            for space in set(spaces.tolist()):
                own = np.flatnonzero(spaces == space).tolist()
                near = near_cells(shared.value.get(space), np.stack([units[i] for i in own]), range_)
                for i, cell in zip(own, near, strict=True):
                    found[i] = cell
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("space"),
                    batch.column("vec_id"),
                    batch.column("copies"),
                    pa.array(units, pa.list_(pa.float64())),
                    pa.array([c.astype(np.int32) for c, _ in found], pa.list_(pa.int32())),
                    pa.array([d / range_ for _, d in found], pa.list_(pa.float64())),
                ],
                names=["space", "vec_id", "copies", "unit", "cells", "borders"],
            )

    return nodes.select("space", "vec_id", "copies", "embedding").mapInArrow(
        run, "space string, vec_id long, copies long, unit array<double>, cells array<int>, borders array<double>"
    )


def shard_members(placed: DataFrame, g: Graph) -> DataFrame:
    """Rows (space, cell, part, vec_id, copies, unit, home): each vector in one shard of its two nearest cells."""
    near = placed.select("space", "vec_id", "copies", "unit", F.posexplode(F.slice("cells", 1, 2)).alias("nth", "cell"))
    parts = near.groupBy("space", "cell").agg(F.ceil(F.count(F.lit(1)) / g.shard).cast("int").alias("parts"))
    members = near.join(parts, ["space", "cell"])
    return members.select(
        "space",
        "cell",
        F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
        "vec_id",
        "copies",
        "unit",
        (F.col("nth") == 0).alias("home"),
    )


def search_tasks(placed: DataFrame, listed: DataFrame, g: Graph, above: float, reach: float) -> DataFrame:
    """Rows of groups (space, cell, part, block): a part's members, and a block of the queries that visit its cell.

    Queries are those whose border with the cell lies in (above, reach]; ``around`` is null for them.
    """
    routes = placed.select("space", "vec_id", "unit", F.explode(F.arrays_zip("cells", "borders")).alias("c"))
    border = F.col("c.borders")
    # the last reach takes what near_cells lets through for rounding
    far = border <= (reach if reach < 1 else 2.0)
    routes = routes.where((border > above) & far).select("space", F.col("c.cells").alias("cell"), "vec_id", "unit")
    blocks = routes.groupBy("space", "cell").agg(F.ceil(F.count(F.lit(1)) / g.block).cast("int").alias("blocks"))
    parts = listed.groupBy("space", "cell").agg((F.max("part") + 1).alias("parts"))
    sizes = parts.join(blocks, ["space", "cell"])
    asked = routes.join(sizes, ["space", "cell"]).select(
        "space",
        "cell",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).cast("int").alias("block"),
        "vec_id",
        F.lit(0).cast("long").alias("copies"),
        "unit",
        F.lit(None).cast("array<bigint>").alias("around"),
    )
    members = listed.join(sizes, ["space", "cell"]).select(
        "space",
        "cell",
        "part",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "vec_id",
        # a vector counts in its nearest cell; in the other one it only leads on
        F.when(F.col("home"), F.col("copies")).otherwise(0).alias("copies"),
        "unit",
        "around",
    )
    return asked.unionByName(members)


def prune(x: np.ndarray, pool: np.ndarray, width: int, alpha: float) -> np.ndarray:
    """Robust pruning of each row's candidates (nearest kept first); -1 fills short lists."""
    rows = np.arange(len(pool))
    away = 2 - 2 * np.einsum("nd,nkd->nk", x, x[pool])
    open_ = (pool != rows[:, None]) & (pool >= 0)
    out = np.full((len(pool), width), -1, np.int64)
    for step in range(width):
        away_open = np.where(open_, away, np.inf)
        pick = away_open.argmin(axis=1)
        some = open_[rows, pick]
        if not some.any():
            break
        chosen = pool[rows, pick]
        out[some, step] = chosen[some]
        between = 2 - 2 * np.einsum("nd,nkd->nk", x[chosen], x[pool])
        open_ &= ~(some[:, None] & (alpha * between <= away))
        open_[rows, pick] = False
    return out


def build_lists(x: np.ndarray, g: Graph) -> np.ndarray:
    """Pruned neighbours of each vector of a shard: near ones, and far ones that keep it connected."""
    n = len(x)
    rng = np.random.default_rng(g.seed)
    pool = np.empty((n, min(g.pool, n)), np.int64)
    for a in range(0, n, 512):
        sims = x[a : a + 512] @ x.T
        pool[a : a + 512] = np.argpartition(-sims, pool.shape[1] - 1, axis=1)[:, : pool.shape[1]]
    near = prune(x, pool, g.near, g.alpha)
    far = prune(x, rng.integers(0, n, (n, g.pool)), g.far, g.alpha)
    return np.concatenate([near, far], axis=1)


def find_medoids(x: np.ndarray, count: int) -> np.ndarray:
    """The vector nearest the mean, then each time the one farthest from those chosen."""
    chosen = [int((x @ x.mean(axis=0)).argmax())]
    best = x @ x[chosen[0]]
    while len(chosen) < min(count, len(x)):
        nxt = int(best.argmin())
        chosen.append(nxt)
        best = np.maximum(best, x @ x[nxt])
    return np.array(sorted(set(chosen)))


def search(queries: np.ndarray, x: np.ndarray, lists: np.ndarray, g: Graph) -> np.ndarray:
    """Booleans (query x indexed vector): those found in range, all verified by their cosine."""
    nq, n = len(queries), len(x)
    seen = np.zeros((nq, n), bool)
    hits = np.zeros((nq, n), bool)
    entry = find_medoids(x, g.medoids)
    sims = queries @ x[entry].T
    top = np.argsort(-sims, axis=1, kind="stable")[:, : g.beam]
    ids = np.full((nq, g.beam), -1, np.int64)
    score = np.full((nq, g.beam), -2.0)
    done = np.zeros((nq, g.beam), bool)
    ids[:, : top.shape[1]] = entry[top]
    score[:, : top.shape[1]] = np.take_along_axis(sims, top, axis=1)
    np.put_along_axis(seen, ids[:, : top.shape[1]], True, axis=1)

    def expand(q: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New (query, neighbour, cosine) of the given pairs, each pair once."""
        near = lists[node]
        pairs = np.repeat(q, near.shape[1])[near.ravel() >= 0] * n + near.ravel()[near.ravel() >= 0]
        pairs = np.unique(pairs)
        pairs = pairs[~seen.ravel()[pairs]]
        seen.ravel()[pairs] = True
        q, node = pairs // n, pairs % n
        cosine = np.concatenate(
            [np.einsum("nd,nd->n", queries[q[a : a + 65536]], x[node[a : a + 65536]]) for a in range(0, len(q), 65536)]
            or [np.zeros(0)]
        )
        hits[q, node] = cosine >= g.threshold
        return q, node, cosine

    rows = np.arange(nq)
    first = ids[:, : top.shape[1]]
    np.put_along_axis(hits, first, score[:, : top.shape[1]] >= g.threshold, axis=1)
    while True:
        waiting = np.where(done | (ids < 0), -3.0, score)
        pick = waiting.argmax(axis=1)
        live = rows[waiting[rows, pick] > -3]
        if not len(live):
            break
        done[live, pick[live]] = True
        q, node, cosine = expand(live, ids[live, pick[live]])
        # at most as many newcomers as the beam holds enter it, the best first
        order = np.lexsort((-cosine, q))
        q, node, cosine = q[order], node[order], cosine[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < g.beam
        new_ids, new_score = np.full((nq, g.beam), -1, np.int64), np.full((nq, g.beam), -2.0)
        new_ids[q[keep], rank[keep]], new_score[q[keep], rank[keep]] = node[keep], cosine[keep]
        ids, score = np.concatenate([ids, new_ids], axis=1), np.concatenate([score, new_score], axis=1)
        done = np.concatenate([done, np.zeros_like(new_ids, bool)], axis=1)
        best = np.argsort(-score, axis=1, kind="stable")[:, : g.beam]
        ids, score, done = (np.take_along_axis(v, best, axis=1) for v in (ids, score, done))
    # a query whose whole beam is in range reads the shard at once: its links may be most of it
    hot = (score >= g.threshold).all(axis=1) & (ids >= 0).all(axis=1)
    for a in range(0, nq, 512):
        own = a + np.flatnonzero(hot[a : a + 512])
        hits[own] = queries[own] @ x.T >= g.threshold
    # widen: everything found within the range and a little beyond opens its neighbours
    close = (score >= g.threshold - g.slack) & (ids >= 0) & ~hot[:, None]
    q, node = rows.repeat(close.sum(axis=1)), ids[close]
    while len(q):
        q, node, cosine = expand(q, node)
        more = cosine >= g.threshold - g.slack
        q, node = q[more], node[more]
    return hits


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of n nodes' components, by the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


LINKS = "vec_id long, links long, root long"


def search_shard(table: pa.Table, g: Graph) -> pa.Table:
    """Per vector here: the copies it links with in this part, and the smallest member of its component here."""
    # the smallest id first, so that a component's smallest place is its smallest id
    table = table.sort_by("vec_id")
    indexed = table.column("around").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
    every, units = table.column("vec_id").to_numpy(), matrix(table.column("unit"))
    inside, asking = np.flatnonzero(indexed), np.flatnonzero(~indexed)
    ids = np.unique(every)
    links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    if len(inside) and len(asking):
        place = {int(v): i for i, v in enumerate(every[inside].tolist())}
        around = table.column("around").to_pylist()
        own = [[place[v] for v in around[i] if v in place] for i in inside.tolist()]
        lists = np.full((len(inside), max(1, max(map(len, own)))), -1, np.int64)
        for i, near in enumerate(own):
            lists[i, : len(near)] = near
        hits = search(units[asking], units[inside], lists, g)
        q_at, x_at = np.searchsorted(ids, every[asking]), np.searchsorted(ids, every[inside])
        copies = table.column("copies").to_numpy()[inside]
        nodes = np.arange(len(ids))
        for a in range(0, len(asking), 256):
            q, x = np.nonzero(hits[a : a + 256])
            q, weight, x = q_at[a + q], copies[x], x_at[x]
            apart = q != x
            np.add.at(links, q[apart], weight[apart])
            label = local_components(len(ids), np.concatenate([q, nodes]), np.concatenate([x, label]))
    return pa.table({"vec_id": ids, "links": links, "root": ids[label]})


def audit_recall(nodes: DataFrame, found: DataFrame, g: Graph) -> float:
    """Links found over links there are, for the ``audit`` first vectors by hash against all, in blocks."""
    asked = nodes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(g.audit).select("space", "vec_id", "embedding").collect()
    if not asked:
        return 1.0
    by_space: dict[str, tuple] = {}
    for space in {r.space for r in asked}:
        own = [r for r in asked if r.space == space]
        by_space[space] = ([r.vec_id for r in own], unit_rows(np.array([r.embedding for r in own])))
    shared = nodes.sparkSession.sparkContext.broadcast(by_space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, int] = {}
        for batch in batches:
            spaces = np.array(batch.column(0).to_pylist(), object)
            copies, ids = (batch.column(i).to_numpy() for i in (2, 3))
            for space, (queries, x) in shared.value.items():
                rows = np.flatnonzero(spaces == space)
                if not len(rows):
                    continue
                y = unit_rows(matrix(batch.column(1).take(pa.array(rows))))
                near = (x @ y.T >= g.threshold) & (np.array(queries)[:, None] != ids[rows])
                for v, n in zip(queries, (near * copies[rows]).sum(axis=1).tolist(), strict=True):
                    sums[v] = sums.get(v, 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["vec_id", "there"]
        )

    there = nodes.select("space", "embedding", "copies", "vec_id").mapInArrow(run, "vec_id long, there long")
    there = there.groupBy("vec_id").agg(F.sum("there").alias("there"))
    both = there.join(found, "vec_id", "left").agg(
        F.sum("there").alias("there"), F.sum(F.least("there", F.coalesce("links", F.lit(0)))).alias("got")
    )
    row = both.first()
    return (row.got or 0) / row.there if row.there else 1.0


def link_vectors(vectors: DataFrame, g: Graph | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, audited_recall.

    * Only vectors of equal, non-null label and equal length are compared. Null, zero or
      non-finite vectors, and rows with a null id or label, link with nothing.
    * Exactly equal vectors are one node; its copies count as links and share its component.
    * Repeated ids are one node of the component; each row counts its own vector's links.
    * A cell of any size is split into bounded shards, and its queries into bounded blocks;
      every query visits all parts of its cells. A group may spread over any number of cells.
    * Extra columns are ignored; an empty table gives no rows.
    """
    g = g or Graph()
    nodes = scratch_table(usable(vectors), "nodes")
    placed = scratch_table(place_vectors(nodes, fit_cells(nodes, g), g), "placed")
    members = scratch_table(shard_members(placed, g), "members")
    shard = ["space", "cell", "part"]

    def build(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        lists = build_lists(unit_rows(matrix(table.column("unit"))), g)
        i, k = np.nonzero(lists >= 0)
        # neighbours know each other both ways
        a, b = ids[i], ids[lists[i, k]]
        pairs = np.unique(np.concatenate([np.stack([a, b], axis=1), np.stack([b, a], axis=1)]), axis=0)
        cuts = np.flatnonzero(np.diff(pairs[:, 0])) + 1
        groups = np.split(pairs, cuts) if len(pairs) else []
        return pa.table(
            {
                "vec_id": pa.array([int(p[0, 0]) for p in groups], pa.int64()),
                "around": pa.array([p[:, 1] for p in groups], pa.list_(pa.int64())),
            }
        )

    lists = members.groupBy(*shard).applyInArrow(build, "vec_id long, around array<long>")
    # one vector is in two shards, so its united list is at most twice as long
    united = lists.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("around"))).alias("around"))
    around = F.coalesce("around", F.array().cast("array<bigint>"))
    listed = scratch_table(members.join(united, "vec_id", "left").withColumn("around", around), "listed")
    found, above, recall = None, -1.0, 0.0
    for reach in g.reaches:
        tasks = search_tasks(placed, listed, g, above, reach).groupBy(*shard, "block")
        more = scratch_table(tasks.applyInArrow(lambda t: search_shard(t, g), LINKS), "links")
        found, above = more if found is None else found.unionByName(more), reach
        links = scratch_table(found.groupBy("vec_id").agg(F.sum("links").alias("links")), "link-counts")
        recall = audit_recall(nodes, links, g)
        if recall >= g.recall:
            break
    roots = connected_components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    group = F.concat_ws("|", F.col("label").cast("string"), F.size("embedding"))
    known = nodes.withColumnsRenamed({"vec_id": "rep"}).select("space", "embedding", "rep", "copies")
    known = known.join(links.withColumnRenamed("vec_id", "rep"), "rep", "left")
    known = known.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select(
        "space",
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id").isNotNull() & F.col("label").isNotNull(), group).alias("space"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    out = rows.join(known, ["space", "embedding"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        F.lit(recall).alias("audited_recall"),
    )
