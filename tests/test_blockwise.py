from __future__ import annotations

import os
import random

import numpy as np
import pytest
from conftest import values
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from courierlens.operators import blockwise, boosting
from courierlens.operators.blockwise import Bins, Block, Node, Rounds, Steps, Tree, counted, places, points, thresholds
from courierlens.operators.boosting import BoostedTrees, Encoding, label_tables
from test_learning import made_nodes, walked

CODES = {"town": "town_enc", "sky": "sky_enc"}
FEATURES = ["hour", "price", "town_enc", "sky_enc"]


def coded_rows(spark, n, kinds=2):
    draw = random.Random(3)
    rows = []
    for i in range(n):
        hour, price, town, sky = draw.randrange(17), draw.randrange(30) / 4, draw.randrange(12), draw.randrange(4)
        late = draw.random() < 0.1 + 0.04 * (hour % 6) + 0.1 * (town in (2, 3, 7)) + 0.15 * (sky == 1) * (price > 3)
        weight = 1.25 if late else 1.0
        rows.append((i, hour, price, f"t{town:02}", f"s{sky}", int(late), weight if kinds == 2 else draw.uniform(0.5, 2)))
    return spark.createDataFrame(rows, "id long, hour long, price double, town string, sky string, late int, weight double")


def encoding_of(rows):
    return Encoding.of(label_tables(rows, list(CODES)), CODES, FEATURES)


def classifier(**settings):
    named = {"maxIter": 4, "maxDepth": 4, "stepSize": 0.1, "seed": 42, "checkpointInterval": 2, **settings}
    return GBTClassifier(labelCol="late", featuresCol="features", weightCol="weight", **named)


def shape(model):
    return [(r.tree, r.node, r.feature, r.threshold, r.left_codes) for r in model.nodes().collect()]


def amounts(model):
    return [v for r in model.nodes().collect() for v in (r.gain or 0, r.weighted_rows, r.value, r.tree_weight)]


@pytest.mark.parametrize("kinds", [2, 1000])
def test_many_rows_are_boosted_in_blocks_to_the_trees_of_the_learner(spark, monkeypatch, kinds):
    rows = coded_rows(spark, 4000, kinds)
    encoding = encoding_of(rows)
    wanted = BoostedTrees.fit(classifier(), rows, encoding)
    asked = []
    boost = blockwise.boost
    monkeypatch.setattr(blockwise, "boost", lambda *a: asked.append(a) or boost(*a))
    monkeypatch.setattr(blockwise, "BLOCK", 700)
    monkeypatch.setattr(boosting, "LEARNER_ROWS", 3999)
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 1500)
    found = BoostedTrees.fit(classifier(), rows, encoding)
    assert [tasks for _, _, tasks in asked] == [min(3, spark.sparkContext.defaultParallelism)]
    assert found.many and not wanted.many
    assert shape(found) == shape(wanted) and len(shape(found)) > 60
    assert np.allclose(amounts(found), amounts(wanted), rtol=1e-6, atol=1e-8)
    assert found.learner.getMaxIter() == 4 and found.learner.getWeightCol() == "weight"
    assert np.allclose(found.learner.featureImportances.toArray(), wanted.learner.featureImportances.toArray(), atol=1e-6)


def test_rows_up_to_the_bound_are_the_learners(spark, monkeypatch):
    rows = coded_rows(spark, 300)
    monkeypatch.setattr(boosting, "LEARNER_ROWS", 300)
    monkeypatch.setattr(blockwise, "boost", None)
    assert BoostedTrees.fit(classifier(maxIter=1), rows, encoding_of(rows)).learner.getNumTrees == 1


def test_trees_of_drawn_rows_do_not_depend_on_tasks_and_leave_no_copies(spark):
    rows = coded_rows(spark, 3000)
    encoding = encoding_of(rows)
    coded = encoding.assembled(encoding.coded(rows).repartition(3, "id"))
    learner = classifier(subsamplingRate=0.8, maxIter=5)

    def folders():
        found = spark.sparkContext.getCheckpointDir()
        path = found.removeprefix("file:") if found else None
        return set(os.listdir(path)) if path and os.path.isdir(path) else set()

    models = [BoostedTrees(encoding, blockwise.boost(learner, coded, 1))]
    before = folders()
    models.append(BoostedTrees(encoding, blockwise.boost(learner, coded, 3)))
    assert folders() == before
    assert shape(models[0]) == shape(models[1]) and amounts(models[0]) == amounts(models[1])
    drawn = [r.weighted_rows for r in models[0].nodes().where("node = 1").collect()]
    whole = rows.agg(F.sum("weight")).first()[0]
    assert len(set(drawn)) == 5 and all(0.75 < d / whole < 0.85 for d in drawn)


def test_one_value_everywhere_gives_single_leaves(spark):
    rows = coded_rows(spark, 200).withColumns({"hour": F.lit(1), "price": F.lit(2.0), "town": F.lit("t"), "sky": F.lit("s")})
    encoding = encoding_of(rows)
    model = BoostedTrees(encoding, blockwise.boost(classifier(maxIter=2), encoding.assembled(encoding.coded(rows)), 2))
    assert [(r.tree, r.node, r.feature) for r in model.nodes().collect()] == [(0, 1, None), (1, 1, None)]


def test_other_learners_and_settings_stay_with_spark(spark):
    assert blockwise.supported(classifier())
    assert not blockwise.supported(GBTRegressor())
    for settings in ({"minInstancesPerNode": 5}, {"minInfoGain": 0.1}, {"featureSubsetStrategy": "sqrt"}, {"maxBins": 300}):
        assert not blockwise.supported(classifier(**settings))


def test_labels_and_weights_are_checked(spark):
    rows = coded_rows(spark, 50)
    encoding = encoding_of(rows)
    for bad in (rows.withColumn("late", F.lit(2)), rows.withColumn("weight", F.col("weight") - 1.1)):
        with pytest.raises(Exception, match="labels must be 0 or 1"):
            blockwise.boost(classifier(), encoding.assembled(encoding.coded(bad)), 1)


def test_thresholds_cut_like_weights():
    assert thresholds([(0.0, 1.0), (1.0, 5.0), (4.0, 1.0)], 3).tolist() == [0.5, 2.5]
    assert thresholds([(7.0, 1.0)], 32).tolist() == []
    assert thresholds([(float(v), 1.0) for v in range(100)], 4).tolist() == [24.5, 49.5, 74.5]
    # a value that holds nearly all weight is cut off on both sides, and all cuts lie there
    assert thresholds([(float(v), 1000.0 if v == 50 else 1.0) for v in range(100)], 4).tolist() == [49.5, 50.5, 51.5]


def test_points_stand_for_all_values():
    draw = np.random.default_rng(1)
    column, weights = draw.normal(size=20_000), draw.uniform(1, 2, 20_000)
    found, parts = points(column, weights)
    assert len(found) <= blockwise.POINTS and abs(parts.sum() - weights.sum()) < 1e-6
    upto = np.cumsum(parts)
    for at in (10, 300, 900):
        assert abs(weights[column <= found[at]].sum() - upto[at]) < 1e-6
    few, parts = points(np.array([2.0, 1.0, 2.0]), np.array([1.0, 1.0, 3.0]))
    assert (few.tolist(), parts.tolist()) == ([1.0, 2.0], [1.0, 4.0])


def test_features_share_bytes_and_are_counted_apart():
    draw = np.random.default_rng(2)
    sizes, n = [32, 2, 25, 6, 256, 7, 31], 5000
    cuts = [None] * 6 + [np.arange(30) + 0.5]
    bins = Bins(cuts, sizes)
    columns = np.stack([draw.integers(0, size, n) for size in sizes], axis=1).astype(float)
    assert sorted(f for bundle in bins.bundles for f in bundle) == list(range(7)) and 4 <= len(bins.bundles) < 7
    codes = bins.of(columns)
    pull = draw.integers(-1000, 1000, n).astype(np.int32)
    pull[::7] = blockwise.NOT_DRAWN
    kept = pull != blockwise.NOT_DRAWN
    signs = np.array([-1.0, 1.25])
    block = Block(0, codes, signs, draw.integers(0, 2, n).astype(np.uint8), np.zeros(n), pull, np.zeros((2, 1)))
    # a tree that asks feature 2, then features 6 and 5
    tree = Tree({m: Node(1.0, 1.0) for m in range(1, 8)})
    left = {1: (2, draw.random(25) < 0.5), 2: (6, np.arange(31) < 9), 3: (5, draw.random(7) < 0.5)}
    for m, (f, sides) in left.items():
        tree.nodes[m].feature, tree.nodes[m].left = f, sides
    at = np.zeros(n, int) + 1
    for _ in range(2):
        at = np.array([2 * m + (not left[m][1][int(row[left[m][0]])]) for m, row in zip(at, columns)])
    assert (places(codes, tree.levels(bins)) == at - 4).all()
    slots = np.array([0, -1, -1, 1])
    sums, _ = next(counted(iter([block]), tree.levels(bins), slots, bins.width))
    by_feature = bins.by_feature(sums)
    for f, size in enumerate(sizes):
        for slot, m in enumerate((4, 7)):
            rows = kept & (at == m)
            weight = np.bincount(columns[rows, f].astype(int), np.abs(block.signed)[rows], size)
            assert (by_feature[0, f, slot, :size] == weight).all()
            assert (by_feature[1, f, slot, :size] == np.bincount(columns[rows, f].astype(int), pull[rows], size)).all()


def test_steps_keep_sums_exact_and_residuals_in_a_whole_number():
    for total, heaviest in ((10.0, 1.0), (5e7, 1.3), (3e5, 2e5), (0.3, 0.1)):
        steps = Steps.of(total, heaviest)
        assert total / steps.weight <= 2**53 and 4 * total / steps.pull <= 2**53
        assert 4 * heaviest / steps.pull < 2**31
        rounds = Rounds(1, 1.0, steps)
        pull = rounds.pull(0, 1, np.array([heaviest, -heaviest]), np.array([-1e6, 1e6]))
        assert np.allclose(pull * steps.pull, [4 * heaviest, -4 * heaviest])


# scoring


def test_models_of_many_rows_score_by_tables_as_the_learner_does(spark, tmp_path):
    rows = coded_rows(spark, 1500)
    encoding = encoding_of(rows)
    for learner in (classifier(), GBTRegressor(labelCol="late", maxIter=3, maxDepth=3, seed=1)):
        few = BoostedTrees.fit(learner, rows, encoding)
        assert not few.many and "margins" not in few.transform(rows)._jdf.queryExecution().executedPlan().toString()
        model = BoostedTrees(encoding, few.learner, many=True)
        model.save(str(tmp_path / "model"))
        assert BoostedTrees.load(spark, str(tmp_path / "model")).many
        found, wanted = model.transform(rows), model.learner.transform(encoding.assembled(encoding.coded(rows)))
        assert found.columns == wanted.columns
        # one pass over arrays of rows, not the learner's walk of each row
        plan = found.select("prediction")._jdf.queryExecution().executedPlan().toString()
        assert "margins" in plan and "UDF(features" not in plan
        vectors = [c for c in ("rawPrediction", "probability") if c in found.columns]
        shown = ["id", "prediction", *[vector_to_array(c).alias(c) for c in vectors]]
        for one, other in zip(sorted(values(found.select(*shown))), sorted(values(wanted.select(*shown))), strict=True):
            assert one[0] == other[0]
            assert np.allclose(np.hstack(one[1:]), np.hstack(other[1:]), rtol=1e-12, atol=1e-14)


@pytest.mark.parametrize("depths", [[0], [1, 0, 3], [6, 5, 6, 2]])
def test_tables_of_trees_equal_a_walk(depths):
    import pandas as pd

    nodes = made_nodes(depths)
    draw = random.Random(1)
    rows = [{"size": draw.choice([-2, 0, 2, 7, 8]), "price": draw.choice([-1.5, 0.0, 1.9, 7.25, 1e300]), "code": draw.choice([-1, 0, 1, 2, 3, 4, 5, 99])} for _ in range(300)]
    lookup = boosting.Lookup.of(nodes, ("size", "price", "code"))
    columns = [pd.Series([float(r[c]) for r in rows]) for c in ("size", "price", "code")]
    assert lookup.margins(*columns).tolist() == [walked(nodes, r) for r in rows]
    with pytest.raises(ValueError, match="not a number"):
        lookup.margins(pd.Series([float("nan")]), pd.Series([0.0]), pd.Series([0.0]))
