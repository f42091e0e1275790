"""Spark ML's boosted classifier grown from blocks of binned rows, for many rows.

The trees are those of ``GBTClassifier``: the same thresholds between the same bins, the same
splits by variance, codes ordered by their mean, logistic residuals, a share of the rows drawn
for each round. What differs is where the rows lie: a block holds the bins of some hundred
thousand rows, a byte each, and a level of a tree is one pass of numpy over all blocks, which
hands back sums per node and bin. The result is a ``GBTClassificationModel`` like any other.

Residuals and weights are rounded to multiples of a power of two so small that all their sums
are exact. So a tree depends neither on the order of the sums nor on the tasks they come
from, and the bins of one side of a split are those of the node less those of the other side.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property, partial, reduce
from math import ceil, log2, prod

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from courierlens.session import application_folder, delete_folder, ensure_checkpointing
from courierlens.sources.working_copy import materialize

# rows of a block: a column of eight bytes each stays in a core's cache while it is counted
BLOCK = 1 << 16
# values that stand for a block's column while thresholds are sought; fewer distinct ones stand for themselves
POINTS = 1_024
# bits that exact sums of doubles may fill, and bits of one residual
SUM_BITS, PULL_BITS = 52, 30
# codes of a byte
CODES = 256
# stands in for the residual of a row that is not drawn
NOT_DRAWN = np.iinfo(np.int32).min
KEPT = StorageLevel.MEMORY_AND_DISK

# per level of a tree: by place the bundle asked for, and by place and code the place on the next level
Levels = list[tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Bins:
    """Per feature its ordered thresholds, or None for codes, and its number of bins.

    Features of few bins share a byte, their bundle: one count of the bundle's codes holds the
    counts of each of them.
    """

    cuts: list[np.ndarray | None]
    sizes: list[int]

    @cached_property
    def bundles(self) -> list[list[int]]:
        """Features of which all combinations of bins fit a byte, the largest ones first."""
        found: list[list[int]] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            fitting = next((b for b in found if prod(self.sizes[g] for g in b) * self.sizes[f] <= CODES), None)
            if fitting is None:
                found.append(fitting := [])
            fitting.append(f)
        return found

    @cached_property
    def width(self) -> int:
        """Codes of the largest bundle."""
        return max(prod(self.sizes[f] for f in bundle) for bundle in self.bundles)

    def of(self, values: np.ndarray) -> np.ndarray:
        """The codes of rows of feature values, by bundle; a value on a threshold lies left of it."""
        found = np.empty((len(self.bundles), len(values)), np.uint8)
        for place, bundle in zip(found, self.bundles, strict=True):
            code = np.zeros(len(values), np.intp)
            for f in bundle:
                column, cuts = values[:, f], self.cuts[f]
                code *= self.sizes[f]
                code += column.astype(np.intp) if cuts is None else np.searchsorted(cuts, column)
            place[:] = code
        return found

    def sides(self, feature: int, left: np.ndarray) -> tuple[int, np.ndarray]:
        """The bundle of ``feature``, and which of its codes go right if the bins ``left`` go left."""
        at = next(i for i, bundle in enumerate(self.bundles) if feature in bundle)
        bundle = self.bundles[at]
        after = prod(self.sizes[f] for f in bundle[bundle.index(feature) + 1 :])
        right = np.zeros(self.width, bool)
        codes = np.arange(prod(self.sizes[f] for f in bundle))
        right[: len(codes)] = ~left[codes // after % self.sizes[feature]]
        return at, right

    def by_feature(self, sums: np.ndarray) -> np.ndarray:
        """Sums (kind, bundle, slot, code) as sums (kind, feature, slot, bin)."""
        kinds, _, slots, _ = sums.shape
        found = np.zeros((kinds, len(self.sizes), slots, max(self.sizes)))
        for at, bundle in enumerate(self.bundles):
            sizes = [self.sizes[f] for f in bundle]
            whole = sums[:, at, :, : prod(sizes)].reshape(kinds, slots, *sizes)
            for i, f in enumerate(bundle):
                others = tuple(2 + k for k in range(len(bundle)) if k != i)
                found[:, f, :, : sizes[i]] = whole.sum(axis=others)
        return found


@dataclass(frozen=True)
class Steps:
    """The steps whose multiples weights and weighted residuals are; each a power of two."""

    weight: float
    pull: float

    @staticmethod
    def of(total: float, heaviest: float) -> Steps:
        # a logistic residual is at most four
        whole, most = ceil(log2(total)), ceil(log2(heaviest))
        return Steps(2.0 ** (whole - SUM_BITS), 2.0 ** (2 + max(whole - SUM_BITS, most - PULL_BITS)))


@dataclass(frozen=True)
class Block:
    """Rows by columns, as they are in one round."""

    name: int
    codes: np.ndarray  # by bundle
    kinds: np.ndarray  # weights with the label's sign: those that occur, or where they are many each row's
    kind: np.ndarray | None  # which of them a row has
    margin: np.ndarray
    pull: np.ndarray  # weighted residuals in steps, or NOT_DRAWN
    leaves: np.ndarray  # of the round before: squares and rows of each leaf

    @property
    def signed(self) -> np.ndarray:
        return self.kinds if self.kind is None else self.kinds.take(self.kind)


@dataclass
class Node:
    """A node with its sums: weights, weighted residuals, their weighted squares, rows."""

    weight: float
    total: float
    squares: float = 0.0
    rows: int = 0
    feature: int | None = None
    left: np.ndarray | None = None  # bins that go left
    gain: float = -1.0

    @property
    def value(self) -> float:
        return self.total / self.weight


@dataclass
class Tree:
    """Nodes by number: the root is 1, the sides of node n are 2n and 2n + 1."""

    nodes: dict[int, Node] = field(default_factory=dict)

    def levels(self, bins: Bins) -> Levels:
        """What each level asks; rows of a leaf go left from there on."""
        found, level = [], 0
        while inner := [n for n, r in self.nodes.items() if r.feature is not None and n.bit_length() == level + 1]:
            asked, following = np.zeros(1 << level, np.intp), np.repeat(2 * np.arange(1 << level), bins.width).reshape(-1, bins.width)
            for n in inner:
                at, right = bins.sides(self.nodes[n].feature, self.nodes[n].left)
                asked[n - (1 << level)] = at
                following[n - (1 << level)] += right
            found.append((asked, following))
            level += 1
        return found

    @property
    def depth(self) -> int:
        return max(n.bit_length() for n in self.nodes) - 1

    def leaf_places(self) -> dict[int, int]:
        """Per leaf its place on the last level."""
        leaves = [n for n, r in self.nodes.items() if r.feature is None]
        return {n: (n << self.depth - n.bit_length() + 1) - (1 << self.depth) for n in leaves}

    def complete(self, leaves: np.ndarray) -> None:
        """Give the leaves their squares and rows, and every other node those of its sides."""
        for n, place in self.leaf_places().items():
            self.nodes[n].squares, self.nodes[n].rows = float(leaves[0, place]), int(leaves[1, place])
        for n in sorted(self.nodes, reverse=True):
            if self.nodes[n].feature is not None:
                sides = self.nodes[2 * n], self.nodes[2 * n + 1]
                self.nodes[n].squares, self.nodes[n].rows = sum(s.squares for s in sides), sum(s.rows for s in sides)


def supported(learner: object) -> bool:
    """Whether blocks grow what this learner grows; the rest is the learner's own."""
    if not isinstance(learner, GBTClassifier) or learner.isDefined(learner.validationIndicatorCol):
        return False
    plain = learner.getMinInstancesPerNode() == 1 and not learner.getMinInfoGain() and not learner.getMinWeightFractionPerNode()
    return plain and learner.getFeatureSubsetStrategy() in ("all", "1.0") and learner.getMaxBins() <= CODES


def boost(learner: GBTClassifier, rows: DataFrame, tasks: int) -> GBTClassificationModel:
    """What ``learner`` fits to ``rows``, with ``tasks`` tasks in each pass."""
    ensure_checkpointing(rows.sparkSession)
    weight = F.col(learner.getWeightCol()).cast("double") if learner.isDefined(learner.weightCol) else F.lit(1.0)
    values = vector_to_array(learner.getFeaturesCol()).alias("values")
    plain = rows.select(F.col(learner.getLabelCol()).cast("double").alias("label"), weight.alias("weight"), values)
    attributes = rows.schema[learner.getFeaturesCol()].metadata.get("ml_attr", {})
    features = attributes.get("num_attrs") or len(plain.first()["values"])
    codes = {a["idx"]: a["num_vals"] for a in attributes.get("attrs", {}).get("nominal", [])}
    bins = find_bins(plain, features, codes, learner.getMaxBins())
    steps = Steps.of(*plain.agg(F.sum("weight"), F.max("weight")).first())
    rounds = Rounds(learner.getSeed(), learner.getSubsamplingRate(), steps)
    trees = grow_all(blocks(plain, bins, rounds, tasks), learner, bins, rounds)
    return stored(learner, trees, bins)


# from rows to blocks


def gathered(batches: Iterable[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Labels, weights and values of up to a block of rows that weigh something."""
    held: list[tuple[np.ndarray, ...]] = []

    def joined() -> tuple[np.ndarray, ...]:
        label, weight, values = (np.concatenate(parts) for parts in zip(*held, strict=True))
        if not np.isin(label, (0, 1)).all() or not (weight >= 0).all():
            raise ValueError("labels must be 0 or 1, weights at least 0")
        return label[weight > 0], weight[weight > 0], values[weight > 0]

    for batch in batches:
        label, weight = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        held.append((label, weight, batch.column(2).flatten().to_numpy().reshape(-1, features)))
        if sum(len(part[0]) for part in held) >= BLOCK:
            yield joined()
            held = []
    if held:
        yield joined()


def points(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``POINTS`` values that stand for all, each with the weight from the point before up to it."""
    found, place = np.unique(values, return_inverse=True)
    upto = np.cumsum(np.bincount(place, weights, len(found)))
    if len(found) > POINTS:
        last = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, POINTS + 1) / POINTS).clip(max=len(found) - 1))
        found, upto = found[last], upto[last]
    return found, np.diff(upto, prepend=0.0)


def find_bins(plain: DataFrame, features: int, codes: dict[int, int], most: int) -> Bins:
    """Thresholds that cut each number into at most ``most`` bins of like weight, from all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, weight, values in gathered(batches, features):
            for f in range(features):
                if f not in codes:
                    found, parts = points(values[:, f], weight)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), f)), pa.array(found), pa.array(parts)], ["feature", "value", "weight"])

    # bounded per block and feature; equal values of all blocks meet
    met = plain.mapInArrow(run, "feature long, value double, weight double").groupBy("feature", "value").agg(F.sum("weight").alias("weight"))
    by_feature: dict[int, list[tuple[float, float]]] = {}
    for r in met.collect():
        by_feature.setdefault(r.feature, []).append((r.value, r.weight))
    cuts = [None if f in codes else thresholds(sorted(by_feature[f]), most) for f in range(features)]
    return Bins(cuts, [codes[f] if c is None else len(c) + 1 for f, c in enumerate(cuts)])


def thresholds(weighed: list[tuple[float, float]], most: int) -> np.ndarray:
    """The learner's rule: halfway between all values if they are few, else where a stride of weight is nearest its end."""
    values = np.array([v for v, _ in weighed])
    halfway = (values[:-1] + values[1:]) / 2
    if len(values) <= most:
        return halfway
    upto = np.cumsum([w for _, w in weighed])
    stride = target = upto[-1] / most
    cuts = []
    for before, now, cut in zip(upto, upto[1:], halfway):
        if abs(before - target) < abs(now - target):
            cuts.append(cut)
            target += stride
    return np.array(cuts)


def blocks(plain: DataFrame, bins: Bins, rounds: Rounds, tasks: int) -> RDD[Block]:
    """The rows block by block, ready for the first round; all margins are 0.

    Blocks are written before they are dealt, so that whoever reads one again finds the same
    rows in the same order, of which the same are drawn.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for at, (label, weight, values) in enumerate(gathered(batches, len(bins.sizes))):
            weight = np.maximum(np.rint(weight / rounds.steps.weight), 1) * rounds.steps.weight
            signed = (2 * label - 1) * weight
            columns = [pa.array([part << 32 | at]), pa.array([bins.of(values).tobytes()]), pa.array([signed.tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, ["block", "codes", "signed"])

    def opened(row: Row) -> Block:
        signed = np.frombuffer(row.signed)
        kinds, kind = np.unique(signed, return_inverse=True)
        kinds, kind = (kinds, kind.astype(np.uint8)) if len(kinds) <= CODES else (signed, None)
        margin, codes = np.zeros(len(signed)), np.frombuffer(row.codes, np.uint8).reshape(len(bins.bundles), -1)
        return Block(row.block, codes, kinds, kind, margin, rounds.pull(row.block, 0, signed, margin), np.zeros((2, 1)))

    written = materialize(plain.mapInArrow(run, "block long, codes binary, signed binary"), "blocks")
    # one name per block
    turn = {r.block: i for i, r in enumerate(written.select("block").orderBy("block").collect())}
    return written.rdd.map(lambda row: (turn[row.block], opened(row))).partitionBy(tasks, lambda i: i % tasks).values()


# passes over blocks


def places(codes: np.ndarray, levels: Levels) -> np.ndarray:
    """The place of each row on the level below ``levels``."""
    n = codes.shape[1]
    if not levels:
        return np.zeros(n, np.intp)
    flat, rows = codes.reshape(-1), np.arange(n)
    (first, following), *rest = levels
    at = following[0].take(codes[first[0]])
    for asked, following in rest:
        found = (asked * n).take(at)
        found += rows
        at *= following.shape[1]
        at += flat.take(found)
        at = following.reshape(-1).take(at)
    return at


def residuals(label: np.ndarray, margin: np.ndarray, number: int) -> np.ndarray:
    """What a round learns: the labels (-1 or 1) first, then minus the slope of the logistic loss."""
    if number == 0:
        return label
    with np.errstate(over="ignore"):
        return 4 * label / (1 + np.exp(2 * label * margin))


@dataclass(frozen=True)
class Rounds:
    """How a round's rows are drawn and weighed."""

    seed: int
    share: float
    steps: Steps

    def pull(self, name: int, number: int, signed: np.ndarray, margin: np.ndarray) -> np.ndarray:
        """The weighted residuals of the rows that round ``number`` draws, the same whenever they are asked for."""
        found = residuals(np.sign(signed), margin, number) * np.abs(signed)
        found = np.rint(found / self.steps.pull).astype(np.int32)
        if self.share < 1:
            draws = np.random.default_rng([self.seed + number & (1 << 64) - 1, name])
            found[draws.random(len(signed)) >= self.share] = NOT_DRAWN
        return found

    def leaves(self, block: Block, at: np.ndarray, size: int) -> np.ndarray:
        """Squares and rows of each leaf, of the rows that were drawn."""
        kept = np.flatnonzero(block.pull != NOT_DRAWN)
        at, pull = at.take(kept), block.pull.take(kept) * self.steps.pull
        squares = pull * pull / np.abs(block.signed.take(kept))
        return np.stack([np.bincount(at, squares, size), np.bincount(at, None, size)])

    def moved(self, block: Block, number: int, levels: Levels, values: np.ndarray) -> Block:
        """The block ready for round ``number``, after a tree with these ``values`` of its leaves."""
        at = places(block.codes, levels)
        margin = block.margin + values.take(at)
        pull = self.pull(block.name, number, block.signed, margin)
        return replace(block, margin=margin, pull=pull, leaves=self.leaves(block, at, len(values)))

    def ended(self, block: Block, levels: Levels, size: int) -> np.ndarray:
        return self.leaves(block, places(block.codes, levels), size)


def counted(parts: Iterator[Block], levels: Levels, slots: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One pass of a task: weights and weighted residuals per bundle, slot and code, and what blocks hold of the last leaves.

    ``slots`` numbers the places of a level that are counted.
    """
    total, size = None, (slots.max() + 1) * width
    for block in parts:
        wanted = block.pull != NOT_DRAWN
        slot = None
        if levels:
            slot = slots.take(places(block.codes, levels))
            wanted &= slot >= 0
        kept = np.flatnonzero(wanted)
        base = np.zeros(len(kept), np.intp) if slot is None else slot.take(kept) * width
        weight, pull = np.abs(block.signed).take(kept), block.pull.take(kept).astype(float)
        sums = np.empty((2, len(block.codes), size))
        for f, column in enumerate(block.codes):
            place = base + column.take(kept)
            sums[0, f], sums[1, f] = np.bincount(place, weight, size), np.bincount(place, pull, size)
        total = (sums, block.leaves) if total is None else (total[0] + sums, total[1] + block.leaves)
    if total is not None:
        yield total[0].reshape(2, -1, slots.max() + 1, width), total[1]


# splits and trees


def best_split(node: Node, sums: np.ndarray, bins: Bins) -> tuple[Node, Node] | None:
    """Choose the split of ``node`` that gains most, the first of equals; its sides, or None where nothing gains.

    ``sums`` holds weights and weighted residuals per feature and bin.
    """
    weight, pull = sums
    width, codes = weight.shape[1], np.array([c is None for c in bins.cuts])
    # numbers keep the order of their bins; codes go by their mean, those without rows last
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(weight > 0, pull / weight, np.inf)
    order = np.where(codes[:, None], np.argsort(mean, axis=1, kind="stable"), np.arange(width))
    left_weight = np.cumsum(np.take_along_axis(weight, order, 1), axis=1)
    left_pull = np.cumsum(np.take_along_axis(pull, order, 1), axis=1)
    right_weight, right_pull = node.weight - left_weight, node.total - left_pull
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = (left_pull**2 / left_weight + right_pull**2 / right_weight - node.total**2 / node.weight) / node.weight
    ends = np.array(bins.sizes)[:, None] - 1
    allowed = (np.arange(width) < ends) & (left_weight > 0) & (right_weight > 0)
    gain = np.where(allowed, gain, -np.inf)
    f, cut = np.unravel_index(np.argmax(gain), gain.shape)
    # all residuals alike leave rounding errors only
    if not gain[f, cut] > np.finfo(float).eps * (node.total / node.weight) ** 2:
        return None
    node.feature, node.gain = int(f), float(gain[f, cut])
    node.left = np.isin(np.arange(bins.sizes[f]), order[f, : cut + 1])
    return (
        Node(float(left_weight[f, cut]), float(left_pull[f, cut])),
        Node(float(right_weight[f, cut]), float(right_pull[f, cut])),
    )


def grow(state: RDD[Block], bins: Bins, depth: int, steps: Steps) -> tuple[Tree, np.ndarray]:
    """A tree by one pass per level, and what the blocks hold of the last tree's leaves.

    Of the two sides of a split only the lighter one is counted. What comes back from a task
    is bounded by the nodes of a level, not by rows.
    """
    tree, known, last = Tree(), {}, None
    for level in range(max(1, depth)):
        at_level = [n for n in tree.nodes if n.bit_length() == level + 1] if level else [1]
        if not at_level:
            break
        # nodes come in pairs below the root
        light = [min(n, n + 1, key=lambda m: tree.nodes[m].weight) for n in at_level if n % 2 == 0] or [1]
        slots = np.full(1 << level, -1, np.intp)
        slots[np.array(light) - (1 << level)] = np.arange(len(light))
        count = partial(counted, levels=tree.levels(bins), slots=slots, width=bins.width)
        # one element per task
        found = state.mapPartitions(count).collect()
        sums = bins.by_feature(reduce(np.add, (sums for sums, _ in found))) * np.array([1.0, steps.pull]).reshape(2, 1, 1, 1)
        if level == 0:
            last = reduce(np.add, (leaves for _, leaves in found))
            tree.nodes[1] = Node(*sums[:, 0, 0].sum(axis=1).tolist())
        by_node = {n: sums[:, :, i] for i, n in enumerate(light)}
        by_node |= {n ^ 1: known[n // 2] - by_node[n] for n in light if n > 1}
        for n in at_level if depth else []:
            if sides := best_split(tree.nodes[n], by_node[n], bins):
                tree.nodes[2 * n], tree.nodes[2 * n + 1] = sides
        known = by_node
    return tree, last


def grow_all(state: RDD[Block], learner: GBTClassifier, bins: Bins, rounds: Rounds) -> list[tuple[Tree, float]]:
    """All rounds; each tree with its weight.

    The blocks of a round come from those of the round before. Every few rounds they are written to
    the shared folder, which cuts their lineage; of these copies at most two are kept.
    """
    spark, interval = SparkSession.active(), learner.getCheckpointInterval()
    trees: list[tuple[Tree, float]] = []
    written: list[RDD[Block]] = []
    state, before, ended = state.persist(KEPT), None, None

    def release(rdds: list[RDD[Block]]) -> None:
        for rdd in rdds:
            if rdd.getCheckpointFile():
                delete_folder(spark, rdd.getCheckpointFile())

    for number in range(learner.getMaxIter()):
        tree, leaves = grow(state, bins, learner.getMaxDepth(), rounds.steps)
        # the first pass of the round has moved the blocks on
        if before is not None:
            before.unpersist()
            trees[-1][0].complete(leaves)
            release(written[:-1])
            written = written[-1:]
        trees.append((tree, learner.getStepSize() if trees else 1.0))
        levels = tree.levels(bins)
        values = np.zeros(1 << len(levels))
        for n, place in tree.leaf_places().items():
            values[place] = tree.nodes[n].value * trees[-1][1]
        ended = partial(rounds.ended, levels=levels, size=len(values))
        before, move = state, partial(rounds.moved, number=number + 1, levels=levels, values=values)
        state = before.map(move).persist(KEPT)
        if interval > 0 and (number + 1) % interval == 0:
            state.checkpoint()
            written.append(state)
    trees[-1][0].complete(before.map(ended).reduce(np.add))
    state.unpersist()
    before.unpersist()
    release(written)
    return trees


# the model


def node_rows(tree: Tree, bins: Bins) -> list[tuple]:
    """The nodes as the model's files have them: numbered from the root, left sides first."""
    rows: list[tuple] = []

    def add(n: int) -> int:
        r, at = tree.nodes[n], len(rows)
        rows.append(())
        left, right, split = -1, -1, (-1, [], -1)
        if r.feature is not None:
            left, right = add(2 * n), add(2 * n + 1)
            cuts, listed = bins.cuts[r.feature], np.flatnonzero(r.left)
            split = (r.feature, listed.astype(float).tolist(), len(r.left)) if cuts is None else (r.feature, [float(cuts[listed[-1]])], -1)
        impurity = max(0.0, r.squares / r.weight - r.value**2)
        rows[at] = (at, r.value, impurity, [r.weight, r.total, r.squares], r.rows, r.gain, left, right, split)
        return at

    add(1)
    return rows


def stored(learner: GBTClassifier, trees: list[tuple[Tree, float]], bins: Bins) -> GBTClassificationModel:
    """The trees as the model that ``learner`` makes.

    Spark makes no model from given trees but reads one from its files. Their descriptions are
    taken from a model of two rows.
    """
    spark = SparkSession.active()
    names = [learner.getLabelCol(), learner.getFeaturesCol()]
    two = spark.createDataFrame([(float(y), Vectors.dense([float(y)] * len(bins.sizes))) for y in (0, 1)], names).withColumn("_weight", F.lit(1.0))
    sample = learner.copy({learner.maxIter: 1, learner.weightCol: "_weight"}).fit(two)
    folder = application_folder(spark, "steps", f"grown-{uuid.uuid4().hex[:12]}")
    sample.write().save(f"{folder}/sample")
    about = json.loads(spark.read.text(f"{folder}/sample/metadata").first()[0])
    about["numTrees"] = about["paramMap"]["maxIter"] = len(trees)
    about["paramMap"].pop("weightCol")
    if learner.isDefined(learner.weightCol):
        about["paramMap"]["weightCol"] = learner.getWeightCol()
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{folder}/model/metadata")
    described = spark.read.parquet(f"{folder}/sample/treesMetadata")
    text = json.loads(described.first()[1])
    texts = [(i, json.dumps({**text, "uid": f"{text['uid']}_{i}"}), weight) for i, (_, weight) in enumerate(trees)]
    spark.createDataFrame(texts, described.schema).coalesce(1).write.parquet(f"{folder}/model/treesMetadata")
    nodes = [(i, row) for i, (tree, _) in enumerate(trees) for row in node_rows(tree, bins)]
    schema = spark.read.parquet(f"{folder}/sample/data").schema
    spark.createDataFrame(nodes, schema).coalesce(1).write.parquet(f"{folder}/model/data")
    return GBTClassificationModel.load(f"{folder}/model")
