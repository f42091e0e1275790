"""Operational reports.

Each takes the fact, or any frame of parts that still holds the report's keys
(the gold cube). Ties of a top-k report are broken by the group key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.operators import measures as m
from courierlens.operators.summarize import summarize, summarize_through

MIN_ORDERS = 50


def overview(orders: DataFrame) -> DataFrame:
    """Global figures; a status that never occurs counts as NULL."""
    return summarize(
        orders,
        [],
        [
            m.row_count("total_orders"),
            m.avg_minutes("avg_delivery_min"),
            m.revenue("total_revenue_sar"),
            m.avg_value("avg_order_value"),
            m.delivered_rows("delivered"),
            m.delayed_rows("delayed"),
            m.cancelled_rows("cancelled"),
        ],
    )


def busiest_districts(orders: DataFrame, k: int = 5) -> DataFrame:
    return summarize(
        orders,
        ["district"],
        [
            m.row_count("total_orders"),
            m.avg_minutes("avg_time"),
            m.flagged_count("delayed_orders"),
            m.flagged_rate("delay_rate_pct"),
        ],
        order=("total_orders desc", "district"),
        limit=k,
    )


def weather_impact(orders: DataFrame) -> DataFrame:
    return summarize(
        orders,
        ["weather"],
        [m.row_count("orders"), m.avg_minutes("avg_time"), m.flagged_rate("delay_rate_pct")],
        order=("avg_time desc", "weather"),
    )


def busiest_hours(orders: DataFrame, k: int = 8) -> DataFrame:
    return summarize(
        orders,
        ["hour_of_day"],
        [m.row_count("orders"), m.avg_minutes("avg_time"), m.flagged_rate("delay_rate_pct")],
        order=("orders desc", "hour_of_day"),
        limit=k,
    )


def worst_captains(orders: DataFrame, captains: DataFrame, k: int = 5, min_orders: int = MIN_ORDERS) -> DataFrame:
    return summarize_through(
        orders,
        captains,
        on="captain_id",
        how="inner",
        keys=["captain_id", "rating"],
        measures=[
            m.order_count("total_orders"),
            m.avg_minutes("avg_time"),
            m.flagged_rate("delay_rate_pct"),
        ],
        having=F.col("total_orders") >= min_orders,
        order=("delay_rate_pct desc", "captain_id", "rating"),
        limit=k,
    )


def _restaurant_report(orders: DataFrame, restaurants: DataFrame, keys: list[str], k: int) -> DataFrame:
    return summarize_through(
        orders,
        restaurants,
        on="restaurant_id",
        how="inner",
        keys=keys,
        measures=[
            m.order_count("total_orders"),
            m.avg_prep("avg_prep_min"),
            m.avg_minutes("avg_total_min"),
            m.flagged_rate("delay_rate_pct"),
        ],
        order=("avg_prep_min desc", *keys),
        limit=k,
    )


def slowest_restaurants(orders: DataFrame, restaurants: DataFrame, k: int = 5) -> DataFrame:
    """By name and cuisine: restaurants that share both are one row."""
    return _restaurant_report(orders, restaurants, ["name", "cuisine_type"], k)


def slowest_restaurants_by_id(orders: DataFrame, restaurants: DataFrame, k: int = 5) -> DataFrame:
    """The same report with namesakes kept apart."""
    return _restaurant_report(orders, restaurants, ["restaurant_id", "name", "cuisine_type"], k)
