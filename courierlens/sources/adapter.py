"""Derive the delivery star from TPC-H-like tables.

Whole-number and text arithmetic only, so any SQL engine gives the same rows.
The fact's grain is the order; orders without line items drop out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.functions import rules
from courierlens.schemas import FACT_ORDERS, star_schemas
from courierlens.sources.tables import Star

SOURCE_TABLES = ["orders", "lineitem", "part", "supplier", "nation"]
LABELS = rules.Conditions(stormy="stormy", very_hot="very_hot", severe="severe", heavy="heavy")


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}.parquet"


def _long(value: Column) -> Column:
    return value.cast("long")


def _rating(supplier: Column) -> Column:
    return (25 + (supplier * 7) % 26) / F.lit(10.0)


def captains(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select(
        key.alias("captain_id"),
        F.col("s_name").alias("name"),
        _rating(key).alias("rating"),
        _long(20 + key % 41).alias("avg_speed_kmh"),
        _long(4 + key % 9).alias("active_hours"),
        F.col("n_name").alias("district"),
        _long(50 + (key * 37) % 4951).alias("total_deliveries"),
        ((60 + key % 40) / F.lit(100.0)).alias("on_time_rate"),
    )


def restaurants(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        key.alias("restaurant_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("cuisine_type"),
        _long(5 + (F.col("p_size") - 1) % 31).alias("avg_prep_time_min"),
        ((25 + key % 26) / F.lit(10.0)).alias("rating"),
        F.col("p_brand").alias("district"),
        _long(100 + (key * 13) % 9901).alias("total_orders"),
    )


def _weather(priority: Column) -> Column:
    digit = F.substring(priority, 1, 1)
    return (
        F.when(digit == "1", "stormy")
        .when(digit == "2", "very_hot")
        .when(digit == "3", "cloudy")
        .when(digit == "4", "cold")
        .otherwise("clear")
    )


def _traffic(lines: Column) -> Column:
    return (
        F.when(lines <= 2, "light").when(lines <= 4, "medium").when(lines <= 6, "heavy").otherwise("severe")
    )


def fact_orders(orders: DataFrame, lineitem: DataFrame, restaurant_dim: DataFrame) -> DataFrame:
    """Order facts.

    Line items are folded per order on the map side before they are shuffled. The
    two joins are left to Catalyst: a small restaurant dimension is broadcast by its
    measured size, a large one is sort-merged, and adaptive skew handling splits the
    partition of a restaurant that holds a large share of all orders.
    """
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("captain_id"),
        F.max("l_partkey").alias("restaurant_id"),
        F.count(F.lit(1)).alias("lines"),
    )
    kitchens = restaurant_dim.select("restaurant_id", "district", "avg_prep_time_min")
    key = F.col("o_orderkey")

    base = (
        orders.join(per_order, key == F.col("l_orderkey"))
        .join(kitchens, "restaurant_id")
        .select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            "captain_id",
            "restaurant_id",
            "district",
            rules.order_moment(
                F.col("o_orderdate"), (7 + key % 17).cast("int"), (key % 60).cast("int")
            ).alias("order_time"),
            rules.prep_minutes(F.col("avg_prep_time_min"), key % 9 - 3).alias("prep_time_min"),
            _weather(F.col("o_orderpriority")).alias("weather"),
            _traffic(F.col("lines")).alias("traffic_level"),
            # round before the cast: engines differ in how a cast treats fractions
            (
                (1500 + F.round(F.col("o_totalprice") * 100).cast("long") % 33501) / F.lit(100.0)
            ).alias("order_value_sar"),
            _long(7 + key % 17).alias("hour_of_day"),
        )
    )
    timed = base.withColumns(
        {
            "day_of_week": rules.day_of_week(F.col("order_time")),
            "is_peak_hour": rules.peak_flag(F.col("hour_of_day")),
        }
    ).withColumn(
        "delivery_time_min",
        rules.delivery_minutes(
            F.col("prep_time_min"),
            10 + F.col("customer_id") % 26,
            F.col("weather"),
            F.col("traffic_level"),
            F.col("is_peak_hour"),
            _rating(F.col("captain_id")),
            LABELS,
            spread=lambda name, width: F.col("order_id") % width,
        ),
    )
    minutes = F.col("delivery_time_min")
    rated = timed.withColumns(
        {
            "status": rules.order_status(
                minutes, F.col("weather"), F.col("traffic_level"), LABELS, F.col("order_id") % 100
            ),
            "is_delayed": rules.delayed_flag(minutes),
        }
    )
    return rated.select(*star_schemas()[FACT_ORDERS].fieldNames())


def star_from_tables(spark: SparkSession, root: str) -> Star:
    """The star as a lazy plan over the source tables."""
    source = {name: spark.read.parquet(table_path(root, name)) for name in SOURCE_TABLES}
    restaurant_dim = restaurants(source["part"])
    return Star(
        orders=fact_orders(source["orders"], source["lineitem"], restaurant_dim),
        captains=captains(source["supplier"], source["nation"]),
        restaurants=restaurant_dim,
    )
