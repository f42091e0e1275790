"""Marts over the staging views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from courierlens.operators import measures as m
from courierlens.operators.summarize import summarize, summarize_through


def captain_performance(orders: DataFrame, staged_captains: DataFrame) -> DataFrame:
    """One row per captain; orders of an unknown captain keep their id, with no attributes.

    The tier comes from the staged dimension, so it stays NULL for an unknown captain.
    """
    return summarize_through(
        orders,
        staged_captains,
        on="captain_id",
        how="left",
        keys=["captain_id", "name", "rating", "performance_tier", "district", "total_deliveries"],
        measures=[
            m.order_count("total_orders"),
            m.avg_minutes("avg_delivery_min"),
            m.delayed_sum("total_delayed"),
            m.mart_delay_rate("delay_rate_pct"),
            m.revenue("total_revenue_sar"),
            m.avg_value("avg_order_value"),
            m.peak_sum("peak_hour_orders"),
        ],
        order=("delay_rate_pct desc", "captain_id"),
    )


def zone_analysis(orders: DataFrame) -> DataFrame:
    """One row per district."""
    return summarize(
        orders,
        ["district"],
        [
            m.order_count("total_orders"),
            m.avg_minutes("avg_delivery_min"),
            m.delayed_sum("total_delayed"),
            m.mart_delay_rate("delay_rate_pct"),
            m.revenue("total_revenue_sar"),
            m.peak_sum("peak_hour_orders"),
            m.peak_share("peak_hour_pct"),
        ],
        order=("total_orders desc", "district"),
    )
