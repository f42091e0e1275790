from __future__ import annotations

import hashlib
import math
import random
from itertools import product

import pytest
from conftest import values
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Row
from pyspark.sql import functions as F

import __spark_entry__ as contract
from courierlens.operators import boosting
from courierlens.operators.boosting import BoostedTrees, Encoding, boosting_tasks, described, importances_of, label_tables, margin_column
from courierlens.operators.encode import attach_codes, encode_columns, known_labels
from courierlens.operators.metrics import class_profile, classification_metrics, confusion, regression_metrics
from courierlens.operators.permutation import moved, permutation_importance
from courierlens.operators.split import hash_split, stratified_split
from courierlens.plans import delay_model, demand_model
from courierlens.registry import LEARNED, QUERIES
from courierlens.sources.builder import TRAFFIC, WEATHER


def table_scores(run, model):
    scored = model.score(run.rows.filter("split = 'test'"))
    return {i: (round(s, 9), p) for i, s, p in values(scored, "order_id", "score", "prediction")}


def transformed_scores(run):
    scored = run.scored.select("order_id", vector_to_array("probability")[1].alias("p"), "prediction")
    return {i: (round(s, 9), p) for i, s, p in values(scored)}


def test_codes_follow_code_point_order(spark):
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    rows = spark.createDataFrame([(WEATHER[i % 5], TRAFFIC[i % 4], days[i % 7]) for i in range(140)], "w string, t string, d string")
    tables = label_tables(rows, ["w", "t", "d"])
    labels = {c: [r.label for r in t.orderBy("code").collect()] for c, t in tables.items()}
    cold, very_hot, clear, stormy, cloudy = "بارد", "حار جداً", "صافي", "عاصف", "غائم"
    assert labels["w"] == [cold, very_hot, clear, stormy, cloudy]
    light, severe, heavy, medium = "خفيف", "شديد الكثافة", "كثيف", "متوسط"
    assert labels["t"] == [light, severe, heavy, medium]
    assert labels["d"] == sorted(days)
    coded = attach_codes(rows, tables, {"w": "wc", "d": "dc"})
    assert dict(values(coded.select("w", "wc").distinct()))[stormy] == 3


def test_unseen_and_missing_labels_are_errors_or_unknown(spark):
    tables = label_tables(spark.createDataFrame([("a",), ("b",)], "w string"), ["w"])
    for bad, message in (("c", "Unseen label in w: c"), (None, "NULL value in w")):
        rows = spark.createDataFrame([(bad,)], "w string")
        with pytest.raises(Exception, match=message):
            attach_codes(rows, tables, {"w": "wc"}).collect()
        assert values(attach_codes(rows, tables, {"w": "wc"}, strict=False), "wc") == [(None,)]
        assert known_labels(rows, "w", tables["w"]).count() == 0


def test_ten_thousand_labels(spark):
    names = sorted(f"{'äzb'[i % 3]}{i}" for i in range(10_000))
    rows = spark.createDataFrame([(n, "x") for n in names], "w string, v string")
    tables = label_tables(rows, ["w", "v"])
    assert [r.label for r in tables["w"].orderBy("code").collect()] == names
    coded = encode_columns(rows, {"w": "wc", "v": "vc"}).collect()
    assert {r.w: r.wc for r in coded} == {n: i for i, n in enumerate(names)}
    assert {r.vc for r in coded} == {0}


def test_a_missing_label_is_an_error_in_the_joined_codes(spark):
    with pytest.raises(Exception, match="NULL value"):
        encode_columns(spark.createDataFrame([("a",), (None,)], "w string"), {"w": "wc"}).collect()


def test_codes_come_from_the_joined_rows(make):
    star = make([{"district": "a", "captain_id": "nobody"}, {"district": "b"}, {"district": "c"}])
    coded = delay_model.encoded_features(delay_model.training_rows(star)).collect()
    assert sorted(r.district_enc for r in coded) == [0, 1]


def test_columns_of_many_labels_become_numbers(spark, make):
    orders = [{"district": f"d{i % 400}", "is_delayed": int(i % 400 < 200), "delivery_time_min": 10 + i % 7} for i in range(800)]
    run = delay_model.train(make(orders), rounds=2, depth=2)
    assert run.model.encoding.wide() == ["district"]
    assert run.scored.count() == 160
    # as numbers, the sides of a split are runs of labels
    cuts = values(run.model.nodes().where("feature = 'district_enc'"), "threshold", "left_codes")
    assert cuts and all(t is not None and c is None for t, c in cuts)
    assert table_scores(run, run.model) == transformed_scores(run)


def test_importances_are_ranked_before_they_are_rounded(spark):
    class Learner:
        featureImportances = type("V", (), {"toArray": lambda self: [0.1001, 0.1004, 0.7995]})()

    model = type("M", (), {"encoding": type("E", (), {"features": ("a", "b", "c")}), "learner": Learner()})()
    assert [n for n, _ in values(delay_model.importances(spark, model))] == ["c", "b", "a"]


def test_hash_split(spark):
    split = spark.range(5000).select("id", hash_split(F.col("id")).alias("s"))
    expected = {i: "train" if hashlib.md5(f"{i}:42".encode()).hexdigest()[:4] < "cccd" else "test" for i in range(5000)}
    assert dict(values(split)) == expected
    assert abs(sum(v == "train" for v in expected.values()) / 5000 - 0.8) < 0.02


@pytest.mark.parametrize("n", [1, 4, 5, 6, 1000, 4321])
def test_stratified_split_is_exact_per_class(spark, n):
    rows = spark.range(n).select("id", F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("y"))
    split = values(stratified_split(rows, "id", "y"))
    for y in (0, 1):
        ids = [i for i in range(n) if (i % 7 == 0) == bool(y)]
        ranked = sorted(ids, key=lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest())
        train = set(ranked[: len(ids) - math.ceil(len(ids) / 5)])
        assert {i for i, c, s in split if c == y and s == "train"} == train
        assert sum(c == y for _, c, _ in split) == len(ids)


def test_a_thousand_classes(spark):
    split = stratified_split(spark.range(12_000).withColumn("y", F.col("id") % 1000), "id", "y")
    sizes = values(split.where("split = 'test'").groupBy("y").count().select("count").distinct())
    assert sizes == [(3,)]
    unknown = spark.range(10).withColumn("y", F.lit(None).cast("int"))
    assert stratified_split(unknown, "id", "y").filter("split = 'test'").count() == 2


def test_a_slot_without_training_slots_gets_the_overall_mean(spark):
    slots = spark.createDataFrame([("a", "train", 4), ("a", "test", 1), ("b", "test", 2), ("c", "train", 8)], "district string, split string, order_count long")
    scored = demand_model.mean_predictor(slots, ["district"])
    assert sorted(values(scored, "district", "prediction")) == [("a", 4.0), ("b", 6.0)]


def test_a_repeated_id_stays_on_one_side(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"), F.lit(1).alias("y")
    )
    split = stratified_split(rows, "id", "y")
    assert split.filter("id = -1").select("split").distinct().count() == 1
    assert split.count() == 3000


def labelled(spark, cells):
    rows = [(y, p) for (y, p), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(rows, "y int, p double")


def test_classification_metrics(spark):
    df = labelled(spark, {(0, 0.0): 3, (0, 1.0): 1, (1, 0.0): 2, (1, 1.0): 4})
    assert values(confusion(df, "y", "p")) == [(3, 1, 2, 4)]
    row = classification_metrics(df, "y", "p", digits=6).first()
    assert (row["accuracy"], row["precision_1"]) == (0.7, 0.8)
    assert (row["recall_1"], row["f1_1"]) == (round(2 / 3, 6), round(8 / 11, 6))


def test_ratios_over_nothing_are_zero(spark):
    row = classification_metrics(labelled(spark, {(0, 0.0): 2}), "y", "p").first()
    assert (row["accuracy"], row["precision_1"], row["recall_1"], row["f1_1"]) == (1.0, 0.0, 0.0, 0.0)


def test_regression_metrics_mask_zero_labels_in_mape_only(spark):
    df = spark.createDataFrame([(0, 2.0), (4, 5.0), (10, 5.0)], "y int, p double")
    row = regression_metrics(df, "y", "p").first()
    assert (row["n"], row["mae"], row["rmse"], row["mape_pct"]) == (3, round(8 / 3, 4), round(math.sqrt(10), 4), 37.5)


def test_class_profile(spark):
    df = labelled(spark, {(0, 0.0): 6, (1, 0.0): 2})
    assert values(class_profile(df, "y")) == [(8, 2, 25.0, 3.0)]
    assert class_profile(df.filter("y = 0"), "y").first()["class_ratio"] is None


@pytest.fixture(scope="module")
def delay_run(built):
    return delay_model.train(built, rounds=5, depth=4)


def test_delay_model_beats_the_majority(delay_run):
    row = delay_run.metrics().first()
    positives, n = row["fn"] + row["tp"], row["tn"] + row["fp"] + row["fn"] + row["tp"]
    assert n == delay_run.scored.count()
    assert row["accuracy"] > max(positives, n - positives) / n + 0.05


def test_delay_rows_cover_every_known_order_once(built, delay_run):
    assert delay_run.rows.count() == built.orders.count()
    assert delay_run.rows.select("order_id").distinct().count() == built.orders.count()


def test_importances_are_ranked(spark, delay_run):
    ranked = values(delay_model.importances(spark, delay_run.model))
    assert {name for name, _ in ranked} == set(delay_model.FEATURES)
    assert [s for _, s in ranked] == sorted((s for _, s in ranked), reverse=True)
    assert abs(sum(s for _, s in ranked) - 1) < 0.01
    assert len(values(delay_model.importances(spark, delay_run.model, k=5))) == 5


def test_a_reloaded_model_predicts_the_same(spark, delay_run, tmp_path):
    path = str(tmp_path / "delay")
    delay_model.save_model(delay_run.model, path)
    delay_model.save_model(delay_run.model, path)
    again = delay_model.load_model(spark, path).transform(delay_run.rows.filter("split = 'test'"))
    assert sorted(values(again, "order_id", "prediction")) == sorted(values(delay_run.scored, "order_id", "prediction"))


def test_prep_time_is_the_strongest_extra_feature(spark, built, delay_run):
    run = delay_model.train(built, rounds=5, depth=4, extra_features=("prep_time_min",))
    assert run.metrics().first()["accuracy"] > delay_run.metrics().first()["accuracy"]
    assert delay_model.importances(spark, run.model, k=1).first()["feature"] == "prep_time_min"


def test_training_needs_late_orders(make):
    with pytest.raises(ValueError, match="late"):
        delay_model.train(make([{}] * 20), rounds=1)
    with pytest.raises(ValueError, match="timely"):
        delay_model.train(make([{"is_delayed": 1}] * 20), rounds=1)


def test_demand_model_and_scenarios(spark, built):
    run = demand_model.train(built.orders, rounds=3, depth=3)
    row = run.metrics().first()
    assert row["n"] == run.scored.count() > 0 and row["mae"] > 0
    scenarios = demand_model.sample_scenarios(spark, ["العليا", "nowhere", "الملقا"])
    scored = {r["district"]: r["predicted_orders"] for r in demand_model.score_scenarios(run.model, scenarios).collect()}
    assert scored["nowhere"] is None
    assert scored["العليا"] >= 0 and scored["الملقا"] >= 0
    assert demand_model.score_scenarios(run.model, demand_model.sample_scenarios(spark)).count() == 5
    assert demand_model.sample_scenarios(spark, list("abcdefg")).count() == 7


def test_features_in_order(built):
    rows = delay_model.encoded_features(delay_model.training_rows(built))
    assert rows.columns == ["order_id", *delay_model.FEATURES, "is_delayed"]


def test_scores_from_the_node_table_equal_the_learner(spark, delay_run, tmp_path):
    delay_run.model.save(str(tmp_path / "model"))
    reloaded = BoostedTrees.load(spark, str(tmp_path / "model"))
    wanted = transformed_scores(delay_run)
    assert len(wanted) == delay_run.scored.count() > 500
    assert table_scores(delay_run, delay_run.model) == table_scores(delay_run, reloaded) == wanted


def test_a_column_in_scoring_is_one_native_expression(delay_run):
    plan = delay_run.model.score(delay_run.rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan and "CASE WHEN" in plan


def made_nodes(depths, seed=5):
    """Made-up whole trees over a number, a price and a code."""
    draw, nodes = random.Random(seed), []

    def grow(tree, node, depth):
        feature = draw.choice(["size", "price", "code"]) if depth else None
        threshold = draw.choice([-1.5, 0.0, 2.0, 7.25]) if feature in ("size", "price") else None
        codes = sorted(map(float, draw.sample(range(5), draw.randint(1, 4)))) if feature == "code" else None
        split = {"feature": feature, "threshold": threshold, "left_codes": codes}
        nodes.append(Row(tree=tree, node=node, **split, value=draw.uniform(-1, 1), tree_weight=0.1 if tree else 1.0))
        if depth:
            grow(tree, 2 * node, depth - 1)
            grow(tree, 2 * node + 1, depth - 1)

    for tree, depth in enumerate(depths):
        grow(tree, 1, depth)
    return nodes


def walked(nodes, row):
    at, total = {(r.tree, r.node): r for r in nodes}, 0.0
    for tree in range(1 + max(r.tree for r in nodes)):
        r = at[tree, 1]
        while r.feature is not None:
            value = row[r.feature]
            # NULL and NaN go right
            left = value is not None and (value <= r.threshold if r.left_codes is None else value in r.left_codes)
            r = at[tree, 2 * r.node + (not left)]
        total += r.value * r.tree_weight
    return total


@pytest.mark.parametrize("depths", [[0], [1, 0, 3], [6, 5, 6, 2], [7, 8, 6]])
def test_margins_equal_a_walk_through_every_tree(spark, depths):
    """Up to 64 leaves, more than 64, single leaves; values on a threshold, NULL, NaN, infinite; codes that no tree lists."""
    nodes = made_nodes(depths)
    sizes, prices = [None, -2, 0, 2, 7, 8], [None, math.nan, -math.inf, math.inf, -1.5, -0.0, 1.9, 7.25]
    codes = [None, -1, 0, 1, 2, 3, 4, 5, 99]
    rows = [(i, *row) for i, row in enumerate(product(sizes, prices, codes))]
    df = spark.createDataFrame(rows, "id int, size long, price double, code long")
    found = dict(values(df.select("id", margin_column(nodes).alias("margin"))))
    assert found == {r["id"]: walked(nodes, r) for r in df.collect()}


def test_the_scoring_expression_grows_with_features_and_not_with_trees(spark):
    df = spark.createDataFrame([(1, 1.0, 1)], "size long, price double, code long")

    def cases(trees):
        text = df.select(margin_column(made_nodes([6] * trees)))._jdf.queryExecution().optimizedPlan().toString()
        return text.count("CASE WHEN")

    assert cases(2) == cases(20) > 0


def test_nodes_form_whole_trees(delay_run):
    nodes = {(r.tree, r.node): r for r in delay_run.model.nodes().collect()}
    assert {t for t, n in nodes if n == 1} == set(range(5))
    for (tree, node), r in nodes.items():
        sides = [nodes.get((tree, 2 * node)), nodes.get((tree, 2 * node + 1))]
        if r.feature is None:
            assert sides == [None, None]
        else:
            assert abs(sum(s.weighted_rows for s in sides) - r.weighted_rows) < 1e-6 * r.weighted_rows
            assert (r.threshold is None) != (r.left_codes is None) and r.gain > 0


def test_importances_from_the_node_table_equal_the_learner(delay_run):
    found = dict(values(importances_of(delay_run.model.nodes())))
    wanted = dict(zip(delay_run.model.encoding.features, delay_run.model.learner.featureImportances.toArray()))
    assert all(abs(found.get(f, 0) - w) < 1e-9 for f, w in wanted.items()) and set(found) <= set(wanted)


def test_nodes_are_described_by_their_labels(delay_run):
    shown = described(delay_run.model.nodes(), delay_run.model.encoding)
    weather = {r.left_labels for r in shown.where("feature = 'weather_enc'").collect()}
    assert weather and all(set(text.split("|")) < set(WEATHER) for text in weather)
    assert shown.where("feature IS NULL AND left_labels IS NOT NULL").count() == 0


def test_unknown_labels_have_no_score(spark, built, delay_run):
    rows = delay_run.rows.limit(3).withColumn("weather", F.lit("hail"))
    assert values(delay_run.model.score(rows, strict=False), "score", "prediction") == [(None, None)] * 3
    assert values(delay_run.model.transform(rows, strict=False), "prediction") == [(None,)] * 3
    with pytest.raises(Exception, match="Unseen label in weather: hail"):
        delay_run.model.score(rows).collect()


def test_a_model_being_saved_cannot_be_read(spark, delay_run, tmp_path):
    path = str(tmp_path / "model")
    delay_run.model.save(path)

    def fail(*_):
        raise OSError("no room")

    broken = BoostedTrees(delay_run.model.encoding, type("L", (), {"write": fail})())
    with pytest.raises(OSError):
        broken.save(path)
    with pytest.raises(Exception, match="about"):
        BoostedTrees.load(spark, path)


def test_rounds_have_no_more_tasks_than_cores(spark, monkeypatch):
    seen = []

    class Learner:
        maxBins = "maxBins"

        def copy(self, extra):
            return self

        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))

    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 10)
    rows = spark.range(1000).selectExpr("id", "string(id % 3) AS w")
    encoding = Encoding.of(label_tables(rows, ["w"]), {"w": "wc"}, ["wc"])
    BoostedTrees.fit(Learner(), rows, encoding)
    assert seen == [(spark.sparkContext.defaultParallelism, 1000)]


def test_tasks_of_a_round_follow_cores_and_memory():
    assert [boosting_tasks(n, 12) for n in (0, 11_800, 20_001, 120_000, 7_100_000, 12_000_001)] == [1, 1, 2, 6, 12, 24]
    # many rows on few cores
    assert boosting_tasks(43_000_000, 2) == 44


# permutation importance


def moved_by_definition(rows, features, buckets):
    """Each value a few ranks on in its bucket, by plain lists."""
    found = {}
    keyed = sorted((hashlib.md5(f"{r['id']}:42".encode()).hexdigest(), r["id"], r) for r in rows)
    for b in range(buckets):
        mine = [r for h, _, r in keyed if int(h[:8], 16) % buckets == b]
        for i, r in enumerate(mine):
            found[r["id"]] = tuple(mine[(i + j + 1) % len(mine)][f] for j, f in enumerate(features))
    return found


@pytest.mark.parametrize("n, buckets", [(1, 1), (2, 1), (7, 3), (500, 4)])
def test_moved_values_equal_their_definition(spark, n, buckets):
    data = [{"id": i, "a": i * 3, "b": f"x{i}", "c": None if i % 5 == 0 else i} for i in range(n)]
    rows = spark.createDataFrame([tuple(r.values()) for r in data], "id long, a long, b string, c long").repartition(3)
    found = {r.id: tuple(r.moved) for r in moved(rows, "id", ["a", "b", "c"], buckets).collect()}
    assert found == moved_by_definition(data, ["a", "b", "c"], buckets)
    for j, f in enumerate("abc"):
        assert sorted(map(str, (v[j] for v in found.values()))) == sorted(str(r[f]) for r in data)


def test_only_features_that_matter_cost_something(spark):
    rows = spark.range(4000).selectExpr("id", "id % 2 AS y", "id % 2 AS x", "id % 7 AS noise")
    wrong = (F.col("y") != F.col("x")).cast("long")
    found = {r.feature: r for r in permutation_importance(rows, "id", ["x", "noise"], lambda d: d, wrong, per_bucket=500).collect()}
    assert found["noise"].permuted_loss == found["x"].base_loss == 0
    assert 1700 < found["x"].permuted_loss < 2300 and found["x"].n_rows == 4000


def test_sums_meet_their_rows_without_a_join(spark, delay_run):
    rows = spark.range(100).selectExpr("id", "id % 2 AS x")
    wrong = (F.col("x") != 1).cast("long")
    for df in (permutation_importance(rows, "id", ["x"], lambda d: d, wrong), importances_of(delay_run.model.nodes())):
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_learned_queries_are_registered():
    assert set(LEARNED) <= set(contract.queries()) and not set(LEARNED) & set(QUERIES)


def test_permutation_has_one_exchange_of_rows(spark):
    plan = moved(spark.range(100).selectExpr("id", "id AS a", "id AS b"), "id", ["a", "b"], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" not in plan
