"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from conftest import values
from pyspark.sql import functions as F

import __spark_entry__ as contract
from courierlens.plans import delay_model, reports
from courierlens.plans.gold import FROM_GOLD, captain_parts, gold_cube, restaurant_parts
from courierlens.plans.marts import captain_performance
from courierlens.plans.staging import stg_captains
from courierlens.registry import QUERIES
from courierlens.sources.adapter import fact_orders, restaurants

SMALL = "/root/testdata/sf0.001"
# their plans end after the training, which their own tests run
LEARNERS = {"ml_delay_model", "ml_delay_importance", "ml_demand_model", "ml_demand_importance", "ml_demand_scenarios"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LEARNERS))
def test_no_slow_operators(spark, name):
    text = plan(contract.queries()[name](spark, SMALL))
    for forbidden in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


@pytest.mark.parametrize(
    "name",
    [n for n in contract.queries() if n.startswith("report_") and n not in ("report_overview", "report_weather_impact")]
    + ["check_districts", "check_sample", "dash_top_captains", "dash_attention_captains", "dash_alerts"],
)
def test_limits_are_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan(contract.queries()[name](spark, SMALL))


def test_scan_reads_only_what_a_report_needs(spark):
    text = plan(contract.queries()["dash_districts"](spark, SMALL))
    assert re.findall(r"ReadSchema: struct<(.*?)>", text) == ["order_id:bigint,district:string"]
    alerts = plan(contract.queries()["dash_alerts"](spark, SMALL))
    assert "EqualTo(is_delayed,1)" in alerts


def test_captain_reports_shuffle_the_fact_once(spark):
    """Partial aggregation, one exchange, and the second grouping reuses its partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(contract.queries()["dash_captain_scatter"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    # one exchange for the fact's parts, one for the dimension, none after the join
    assert text.count("Exchange hashpartitioning(captain_id") == 2
    assert text.count("Exchange") == 2


def test_gold_cube_answers_every_single_table_report(built):
    from courierlens.plans.dashboard import alerts

    cube = gold_cube(built.orders).cache()
    assert cube.count() < built.orders.count()
    for name, report in FROM_GOLD.items():
        direct = alerts if name == "dash_alerts" else report
        assert values(report(cube)) == values(direct(built.orders)), name
    cube.unpersist()


def test_parts_per_key_answer_the_dimension_reports(built):
    captains, restaurant_dim = stg_captains(built.captains), built.restaurants
    by_captain, by_restaurant = captain_parts(built.orders), restaurant_parts(built.orders)
    assert values(captain_performance(by_captain, captains)) == values(captain_performance(built.orders, captains))
    assert values(reports.worst_captains(by_captain, captains)) == values(
        reports.worst_captains(built.orders, captains)
    )
    assert values(reports.slowest_restaurants(by_restaurant, restaurant_dim)) == values(
        reports.slowest_restaurants(built.orders, restaurant_dim)
    )


# a third of all rows on one key


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=60_000):
    """Orders and line items in which one part and one supplier hold a third of the rows."""
    ids = spark.range(1, n + 1)
    is_hot = F.col("id") % 3 == 0
    orders = ids.select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 500).alias("o_custkey"),
        (F.col("id") * 1.5).alias("o_totalprice"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("3-MEDIUM").alias("o_orderpriority"),
    )
    lineitem = ids.select(
        F.col("id").alias("l_orderkey"),
        F.when(is_hot, 7).otherwise(F.col("id") % 2000).cast("long").alias("l_partkey"),
        F.when(is_hot, 11).otherwise(F.col("id") % 1000).cast("long").alias("l_suppkey"),
    )
    part = spark.range(2000).select(
        F.col("id").alias("p_partkey"),
        F.concat(F.lit("p"), "id").alias("p_name"),
        F.concat(F.lit("b"), (F.col("id") % 25).cast("string")).alias("p_brand"),
        F.lit("t").alias("p_type"),
        (F.col("id") % 50 + 1).cast("int").alias("p_size"),
    )
    return orders, lineitem, part


def test_a_hot_restaurant_is_split_in_the_adapter_join(spark, small_partitions):
    orders, lineitem, part = hot(spark)
    fact = fact_orders(orders, lineitem, restaurants(part))
    text = final_plan(fact)
    assert "skew=true" in text
    assert fact.count() == 60_000
    assert fact.filter("restaurant_id = 7").count() >= 20_000


def test_a_hot_captain_is_folded_before_the_join(spark, small_partitions, tmp_path):
    orders, lineitem, part = hot(spark)
    fact_orders(orders, lineitem, restaurants(part)).write.parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    captains = spark.range(1000).select(
        F.col("id").alias("captain_id"),
        F.lit("x").alias("name"),
        (F.col("id") % 26 / 10 + 2.5).alias("rating"),
        F.lit(30).cast("long").alias("avg_speed_kmh"),
        F.lit(8).cast("long").alias("active_hours"),
        F.lit("d").alias("district"),
        F.lit(1).cast("long").alias("total_deliveries"),
        F.lit(0.9).alias("on_time_rate"),
    )
    mart = captain_performance(fact, stg_captains(captains))
    plain = dict(values(fact.groupBy("captain_id").count()))
    assert dict(values(mart, "captain_id", "total_orders")) == plain
    assert plain[11] >= 20_000
    worst = reports.worst_captains(fact, captains)
    text = plan(worst)
    # the join's fact side is already one row per captain
    assert text.index("SortMergeJoin") < text.index("partial_count(order_id")


def test_model_rows_survive_a_hot_captain(spark, small_partitions, tmp_path):
    from courierlens.sources.tables import Star

    orders, lineitem, part = hot(spark)
    kitchens = restaurants(part)
    fact_orders(orders, lineitem, kitchens).write.parquet(f"{tmp_path}/fact")
    captains = spark.range(1000).select(
        F.col("id").alias("captain_id"), F.lit(4.0).alias("rating"), F.lit(30).cast("long").alias("avg_speed_kmh")
    )
    rows = delay_model.training_rows(Star(spark.read.parquet(f"{tmp_path}/fact"), captains, kitchens))
    text = final_plan(rows)
    assert "skew=true" in text
    assert rows.count() == 60_000
