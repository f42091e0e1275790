"""Staging views: the declared columns plus their tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.functions import tiers
from courierlens.operators.quality import accepted_values, not_null, unique
from courierlens.schemas import DIM_CAPTAINS, DIM_RESTAURANTS, FACT_ORDERS, STATUSES, star_schemas
from courierlens.sources.tables import Star

STG_ORDERS, STG_CAPTAINS, STG_RESTAURANTS = "stg_orders", "stg_captains", "stg_restaurants"
_COLUMNS = {name: schema.fieldNames() for name, schema in star_schemas().items()}


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        *_COLUMNS[FACT_ORDERS],
        tiers.delivery_speed(F.col("delivery_time_min")).alias("delivery_speed"),
        tiers.order_value_segment(F.col("order_value_sar")).alias("order_value_segment"),
    )


def stg_captains(captains: DataFrame) -> DataFrame:
    return captains.select(
        *_COLUMNS[DIM_CAPTAINS], tiers.performance_tier(F.col("rating")).alias("performance_tier")
    )


def stg_restaurants(restaurants: DataFrame) -> DataFrame:
    return restaurants.select(
        *_COLUMNS[DIM_RESTAURANTS],
        tiers.prep_speed_tier(F.col("avg_prep_time_min")).alias("prep_speed_tier"),
    )


def staged(star: Star) -> dict[str, DataFrame]:
    return {
        STG_ORDERS: stg_orders(star.orders),
        STG_CAPTAINS: stg_captains(star.captains),
        STG_RESTAURANTS: stg_restaurants(star.restaurants),
    }


DATA_TESTS = [
    unique(STG_ORDERS, "order_id"),
    not_null(STG_ORDERS, "order_id"),
    accepted_values(STG_ORDERS, "status", STATUSES),
    not_null(STG_ORDERS, "delivery_time_min"),
    unique(STG_CAPTAINS, "captain_id"),
    not_null(STG_CAPTAINS, "captain_id"),
    unique(STG_RESTAURANTS, "restaurant_id"),
    not_null(STG_RESTAURANTS, "restaurant_id"),
]
