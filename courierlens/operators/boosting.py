"""Boosted trees over label columns, kept as tables.

A fitted model is three things: a table of labels and codes per label column, the learner,
and the names of its features. Labels never pass through the driver: they are numbered,
stored and joined as tables, however many there are. The learner's trees can be read as one
table of nodes, from which rows are scored by a single native expression.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce
from math import ceil

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from courierlens.operators import blockwise
from courierlens.operators.encode import attach_codes, code_table
from courierlens.session import application_folder, delete_folder
from courierlens.sources.working_copy import materialize

# a column with more labels is a plain number to the trees, as all codes are in the usual libraries
CATEGORIES = 256
# rows one task of a boosting round answers for: at least so many before rows are dealt to more
# tasks, and at most so many however few cores there are (some 200 bytes each are kept in memory)
ROWS_PER_TASK, MOST_PER_TASK = 20_000, 1_000_000
# up to so many rows Spark's own learner boosts, beyond them its trees are grown from blocks of rows
LEARNER_ROWS = 1_000_000
# trees up to this depth are looked up as tables, which grow with its power of two
DEEPEST = 12
# bits of a whole number that hold leaves; its sign is left out
WORD_BITS = 63
NODES = (
    "tree int, node long, feature string, threshold double, left_codes array<double>, "
    "gain double, weighted_rows double, value double, tree_weight double"
)
_KINDS = {kind.__name__: kind for kind in (GBTClassificationModel, GBTRegressionModel)}


def label_tables(rows: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """A written table (label, code) for each label column of ``rows``."""
    return {c: materialize(code_table(rows, c), "labels") for c in columns}


@dataclass(frozen=True)
class Encoding:
    """How rows become numbers: label tables, the names of their codes, the order of features."""

    labels: dict[str, DataFrame]
    sizes: dict[str, int]
    codes: dict[str, str]
    features: tuple[str, ...]

    @staticmethod
    def of(labels: dict[str, DataFrame], codes: dict[str, str], features: list[str]) -> Encoding:
        return Encoding(labels, {c: t.count() for c, t in labels.items()}, codes, tuple(features))

    def wide(self) -> list[str]:
        """Label columns whose codes are numbers to the trees."""
        return [c for c, n in self.sizes.items() if n > CATEGORIES]

    def bins(self) -> int:
        """Enough bins for every categorical column, and for the numbers at least the learner's default."""
        return max(32, *[n for n in self.sizes.values() if n <= CATEGORIES])

    def coded(self, rows: DataFrame, strict: bool = True) -> DataFrame:
        """``rows`` with their codes, joined from the label tables.

        A label that was never seen, and a NULL, is an error, or else a NULL code.
        """
        return attach_codes(rows, self.labels, self.codes, strict)

    def assembled(self, coded: DataFrame) -> DataFrame:
        """``coded`` with its feature vector, whose narrow label columns are marked as categories."""
        named = {code: label for label, code in self.codes.items()}
        inputs, wide = {}, self.wide()
        for name in self.features:
            value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
            narrow = name in named and named[name] not in wide
            kind = {"type": "nominal", "num_vals": self.sizes[named[name]]} if narrow else {"type": "numeric"}
            inputs[f"{name}_input"] = value.alias(f"{name}_input", metadata={"ml_attr": {**kind, "name": name}})
        with_inputs = coded.select("*", *inputs.values())
        return VectorAssembler(inputCols=list(inputs), outputCol="features").transform(with_inputs).drop(*inputs)


def boosting_tasks(rows: int, cores: int) -> int:
    """How many tasks each step of a boosting round has.

    A round takes a shuffle per level, from every task to every task. Tasks beyond the
    cores add nothing but its blocks, whose number is the square of theirs; where rows are
    too many for one task per core, every core gets equally many.
    """
    few = max(1, min(ceil(rows / ROWS_PER_TASK), cores))
    waves = ceil(rows / (few * MOST_PER_TASK))
    return few * max(1, waves)


@dataclass(frozen=True)
class BoostedTrees:
    encoding: Encoding
    learner: GBTClassificationModel | GBTRegressionModel
    # learned from many rows, so that many are to be scored as well
    many: bool = False

    @staticmethod
    def fit(learner: GBTClassifier | GBTRegressor, rows: DataFrame, encoding: Encoding) -> BoostedTrees:
        """Boost from coded rows that are written once; their tasks follow their number.

        Every round runs all tasks several times, and a label that holds a large share of
        the rows has no say in how they are dealt. Many rows are boosted in blocks, by the same rules.
        """
        coded = materialize(encoding.coded(rows), "coded-rows")
        cores, n = rows.sparkSession.sparkContext.defaultParallelism, coded.count()
        learner = learner.copy({learner.maxBins: encoding.bins()})
        if n > LEARNER_ROWS and blockwise.supported(learner):
            tasks = min(ceil(n / ROWS_PER_TASK), cores)
            return BoostedTrees(encoding, blockwise.boost(learner, encoding.assembled(coded), tasks), many=True)
        dealt = coded.repartition(boosting_tasks(n, cores))
        return BoostedTrees(encoding, learner.fit(encoding.assembled(dealt)))

    def transform(self, rows: DataFrame, strict: bool = True) -> DataFrame:
        """``rows`` with the learner's columns; unless ``strict``, a row with an unknown label has a NULL prediction."""
        coded = self.encoding.coded(rows, strict)
        if not strict:
            coded = coded.withColumn("known", known_codes(self.encoding))
        scored = self._predicted(self.encoding.assembled(coded))
        if strict:
            return scored
        return scored.withColumn("prediction", F.when(F.col("known"), F.col("prediction"))).drop("known")

    def _predicted(self, assembled: DataFrame) -> DataFrame:
        """The columns that the learner adds; for many rows its trees are looked up for a batch at once.

        The learner walks every row through every tree and looks each code up in a set of objects.
        """
        if not self.many or max(r.node for r in self._node_rows) >> DEEPEST:
            return self.learner.transform(assembled)
        names, nodes = self.encoding.features, self._node_rows
        inputs = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in names]
        margin = pandas_udf(Lookup.of(nodes, names).margins, "double")(*inputs)
        if isinstance(self.learner, GBTRegressionModel):
            return assembled.withColumn("prediction", margin)
        with_margin = assembled.withColumn("_margin", margin)
        late = 1 / (1 + F.exp(-2 * F.col("_margin")))
        raw = array_to_vector(F.array(-F.col("_margin"), F.col("_margin")))
        columns = {"rawPrediction": raw, "probability": array_to_vector(F.array(1 - late, late))}
        prediction = (F.col("_margin") > 0).cast("double")
        return with_margin.withColumns({**columns, "prediction": prediction}).drop("_margin")

    @cached_property
    def _node_rows(self) -> list[Row]:
        return self.nodes().collect()

    def save(self, path: str) -> None:
        """Label tables, learner and feature list below ``path``; the list goes first and comes last."""
        spark = SparkSession.active()
        delete_folder(spark, f"{path}/about")
        for column, table in self.encoding.labels.items():
            table.write.mode("overwrite").parquet(f"{path}/labels/{column}")
        self.learner.write().overwrite().save(f"{path}/learner")
        about = {
            "learner": type(self.learner).__name__,
            "features": self.encoding.features,
            "codes": self.encoding.codes,
            "sizes": self.encoding.sizes,
            "many": self.many,
        }
        spark.createDataFrame([(json.dumps(about),)], "about string").write.text(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        labels = {c: spark.read.parquet(f"{path}/labels/{c}") for c in about["codes"]}
        encoding = Encoding(labels, about["sizes"], about["codes"], tuple(about["features"]))
        return BoostedTrees(encoding, _KINDS[about["learner"]].load(f"{path}/learner"), about.get("many", False))

    def nodes(self) -> DataFrame:
        """All nodes of all trees; node 1 is a root, and the sides of node n are 2n and 2n + 1.

        A row goes left if its number is at most ``threshold``, or its code one of ``left_codes``.
        The rows are bounded by the learner's settings (rounds and depth), not by any data.
        """
        spark = SparkSession.active()
        path = application_folder(spark, "steps", f"learner-{uuid.uuid4().hex[:12]}")
        self.learner.write().overwrite().save(path)
        raw = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*").collect()
        names, weights = self.encoding.features, self.learner.treeWeights
        inner = {(r.tree, r.id): r for r in raw}
        rows, open_nodes = [], [(r.tree, r.id, 1) for r in raw if r.id == 0]
        while open_nodes:
            tree, at, node = open_nodes.pop()
            r = inner[tree, at]
            split, feature, threshold, codes = r.split, None, None, None
            if r.leftChild >= 0:
                feature = names[split.featureIndex]
                if split.numCategories < 0:
                    threshold = split.leftCategoriesOrThreshold[0]
                else:
                    codes = sorted(split.leftCategoriesOrThreshold)
                open_nodes += [(tree, r.leftChild, 2 * node), (tree, r.rightChild, 2 * node + 1)]
            gain = r.gain if feature else None
            rows.append((tree, node, feature, threshold, codes, gain, r.impurityStats[0], r.prediction, weights[tree]))
        return spark.createDataFrame(sorted(rows, key=lambda r: r[:2]), NODES)

    def score(self, rows: DataFrame, strict: bool = True) -> DataFrame:
        """``rows`` with ``score`` and ``prediction`` from the stored tables alone, without the learner."""
        coded = self.encoding.coded(rows, strict)
        margin = margin_column(self._node_rows)
        value = F.when(known_codes(self.encoding), margin)
        if isinstance(self.learner, GBTClassificationModel):
            score, prediction = 1 / (1 + F.exp(-2 * F.col("margin"))), (F.col("margin") > 0).cast("double")
        else:
            score = prediction = F.col("margin")
        scored = coded.withColumn("margin", value).withColumns({"score": score, "prediction": prediction})
        return scored.drop("margin", *[c for c in self.encoding.codes.values() if c not in rows.columns])


@dataclass(frozen=True)
class Lookup:
    """Trees as tables: per level, place and bin of the feature asked for the place on the next level."""

    bins: list[np.ndarray | int]  # per feature its thresholds in order, or the highest code that a tree lists
    trees: list[tuple[blockwise.Levels, np.ndarray]]  # with the weighted values of the last level's places

    @staticmethod
    def of(nodes: list[Row], features: tuple[str, ...]) -> Lookup:
        cuts, codes = split_values(nodes)
        bins = [np.array(cuts[f]) if f in cuts else codes.get(f, 0) for f in features]
        width = max(len(b) + 1 if isinstance(b, np.ndarray) else b + 2 for b in bins)
        trees: dict[int, dict[int, Row]] = {}
        for r in nodes:
            trees.setdefault(r.tree, {})[r.node] = r

        def table(tree: dict[int, Row]) -> tuple[blockwise.Levels, np.ndarray]:
            depth = max(tree).bit_length() - 1
            levels = [
                (np.zeros(1 << level, np.intp), np.repeat(2 * np.arange(1 << level), width).reshape(-1, width))
                for level in range(depth)
            ]
            values = np.zeros(1 << depth)
            for n, r in tree.items():
                level = n.bit_length() - 1
                place = n - (1 << level)
                if r.feature is None:
                    # rows of a leaf go left from there on
                    values[place << depth - level] = r.value * r.tree_weight
                    continue
                left = np.zeros(width, bool)
                if r.threshold is not None:
                    left[: cuts[r.feature].index(r.threshold) + 1] = True
                else:
                    left[np.array(r.left_codes, int)] = True
                levels[level][0][place] = features.index(r.feature)
                levels[level][1][place] += ~left
            return levels, values

        return Lookup(bins, [table(trees[t]) for t in sorted(trees)])

    def margins(self, *columns: pd.Series) -> pd.Series:
        """The weighted sum of all trees' values, tree by tree."""
        found = np.empty((len(columns), len(columns[0])), np.int32)
        for place, column, bins in zip(found, columns, self.bins, strict=True):
            values = column.to_numpy()
            if np.isnan(values).any():
                raise ValueError("a feature is not a number")
            if isinstance(bins, np.ndarray):
                place[:] = np.searchsorted(bins, values)
            else:
                # codes that no tree lists go right everywhere
                place[:] = np.where((values >= 0) & (values <= bins), values, bins + 1)
        total = np.zeros(found.shape[1])
        for levels, values in self.trees:
            total += values.take(blockwise.places(found, levels))
        return pd.Series(total)


def known_codes(encoding: Encoding) -> Column:
    known = F.lit(True)
    for code in encoding.codes.values():
        known = known & F.col(code).isNotNull()
    return known


def margin_column(nodes: list[Row]) -> Column:
    """The weighted sum of all trees as one expression over feature columns.

    Every test of a tree rules out the leaves on one side of it. So a value of a feature leaves
    a set of leaves open in each tree, and the sets of all features meet in the one leaf that
    the row falls into. The sets are bits of whole numbers, looked up by feature and value:
    the expression grows with the features, not with the trees.
    """
    trees: dict[int, dict[int, Row]] = {}
    for r in nodes:
        trees.setdefault(r.tree, {})[r.node] = r
    ordered = [trees[t] for t in sorted(trees)]
    cuts, codes = split_values(nodes)
    leaves, tests = zip(*[leaves_and_tests(tree) for tree in ordered], strict=True)

    def open_leaves(feature: str, goes_left: Callable[[Row], bool]) -> Column:
        words = []
        for values, by_feature in zip(leaves, tests, strict=True):
            kept = (1 << len(values)) - 1
            for r, left, right in by_feature.get(feature, ()):
                kept &= ~(right if goes_left(r) else left)
            words += leaf_words(kept, len(values))
        return numbers(words, "bigint")

    sets = []
    for feature, at in cuts.items():
        table = F.array(*[open_leaves(feature, lambda r, cut=cut: cut <= r.threshold) for cut in [*at, float("inf")]])
        sets.append(F.get(table, place(F.col(f"`{feature}`").cast("double"), at)))
    for feature, listed in codes.items():
        table = F.array(*[open_leaves(feature, lambda r, code=code: code in r.left_codes) for code in range(listed + 1)])
        # a code that no tree lists goes right everywhere, as a NULL does
        rest = open_leaves(feature, lambda r: False)
        sets.append(F.coalesce(F.get(table, F.col(f"`{feature}`").cast("int")), rest))
    whole = numbers([w for values in leaves for w in leaf_words((1 << len(values)) - 1, len(values))], "bigint")
    met = reduce(lambda one, other: F.zip_with(one, other, lambda x, y: x.bitwiseAND(y)), sets or [whole])
    worth = F.array(*[numbers(w, "double") for values in leaves for w in leaf_values(values)])
    # one bit is set, or none: the bits below it are its place, or 64
    found = F.zip_with(met, worth, lambda word, values: F.get(values, F.bit_count(word - 1)))
    return F.aggregate(found, F.lit(0.0), lambda total, one: total + one)


def split_values(nodes: list[Row]) -> tuple[dict[str, list[float]], dict[str, int]]:
    """Per feature that splits by size its thresholds in order, per feature that splits by codes the highest one listed."""
    cuts: dict[str, set[float]] = {}
    codes: dict[str, int] = {}
    for r in nodes:
        if r.feature is None:
            continue
        if r.threshold is not None:
            cuts.setdefault(r.feature, set()).add(r.threshold)
        else:
            codes[r.feature] = int(max([codes.get(r.feature, 0), *r.left_codes]))
    return {f: sorted(at) for f, at in cuts.items()}, codes


def leaves_and_tests(tree: dict[int, Row]) -> tuple[list[float], dict[str, list[tuple[Row, int, int]]]]:
    """The leaves' weighted values from left to right, and per feature its tests with the leaves on either side as bits."""
    values: list[float] = []
    tests: dict[str, list[tuple[Row, int, int]]] = {}

    def walk(node: int) -> int:
        r = tree[node]
        if r.feature is None:
            values.append(r.value * r.tree_weight)
            return 1 << (len(values) - 1)
        left, right = walk(2 * node), walk(2 * node + 1)
        tests.setdefault(r.feature, []).append((r, left, right))
        return left | right

    walk(1)
    return values, tests


def leaf_words(kept: int, leaves: int) -> list[int]:
    """Bits of leaves, cut into whole numbers; up to 64 leaves fit one, as no bit is left for the first."""
    if leaves <= WORD_BITS + 1:
        return [kept >> 1]
    return [kept >> at & (1 << WORD_BITS) - 1 for at in range(0, leaves, WORD_BITS)]


def leaf_values(values: list[float]) -> list[list[float]]:
    """What each word of ``leaf_words`` adds by the place of its bit; at place 64, what it adds without one."""
    if len(values) <= WORD_BITS + 1:
        words, none = [values[1:]], values[0]
    else:
        words, none = [values[at : at + WORD_BITS] for at in range(0, len(values), WORD_BITS)], 0.0
    return [[*word, *[0.0] * (64 - len(word)), none] for word in words]


def place(value: Column, cuts: list[float]) -> Column:
    """How many of the ordered ``cuts`` lie below ``value``; all for NULL and NaN."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(cuts[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(cuts))


def numbers(values: list[int] | list[float], kind: str) -> Column:
    """A constant array, handed over as one text, which is read once when the query is planned."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def importances_of(nodes: DataFrame) -> DataFrame:
    """(feature, importance) of the features that split: their shares of all gains, weighted by rows."""
    gains = nodes.where("feature IS NOT NULL").groupBy("feature").agg(F.sum(F.col("gain") * F.col("weighted_rows")).alias("gain"))
    # one row per feature
    total = F.sum("gain").over(Window.partitionBy(F.lit(1)))
    return gains.select("feature", (F.col("gain") / total).alias("importance"))


def described(nodes: DataFrame, encoding: Encoding) -> DataFrame:
    """The nodes with the labels that go left in place of their codes, one text per node."""
    named = [
        table.select(F.lit(encoding.codes[c]).alias("feature"), F.col("code").cast("double").alias("code"), "label")
        for c, table in encoding.labels.items()
        if c not in encoding.wide()
    ]
    rest = nodes.drop("left_codes")
    if not named:
        return rest.withColumn("left_labels", F.lit(None).cast("string"))
    labels = named[0]
    for table in named[1:]:
        labels = labels.unionByName(table)
    sides = nodes.select("tree", "node", "feature", F.explode("left_codes").alias("code")).join(labels, ["feature", "code"])
    # at most as many labels as a tree takes as categories
    texts = sides.groupBy("tree", "node").agg(F.array_join(F.sort_array(F.collect_list("label")), "|").alias("left_labels"))
    return rest.join(texts, ["tree", "node"], "left")
