"""Validation report: table sizes, a sample, status and district counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.operators import measures as m
from courierlens.operators.summarize import finish, summarize
from courierlens.sources.tables import Star

SAMPLE_COLUMNS = ["order_id", "district", "delivery_time_min", "weather", "traffic_level", "status"]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def order_sample(orders: DataFrame, k: int = 5) -> DataFrame:
    """The first orders by id, so that the preview is the same on every run."""
    return finish(orders.select(*SAMPLE_COLUMNS), order=("order_id",), limit=k)


def by_status(orders: DataFrame) -> DataFrame:
    return summarize(
        orders,
        ["status"],
        [m.row_count("total"), m.avg_minutes("avg_time")],
        order=("total desc", "status"),
    )


def top_districts(orders: DataFrame, k: int = 5) -> DataFrame:
    return summarize(
        orders,
        ["district"],
        [m.row_count("orders"), m.avg_minutes("avg_delivery_min")],
        order=("orders desc", "district"),
        limit=k,
    )


def validation_report(star: Star) -> dict[str, DataFrame]:
    """The four parts of the validation report."""
    return {
        "check_row_counts": row_counts(star.tables()),
        "check_sample": order_sample(star.orders),
        "check_status": by_status(star.orders),
        "check_districts": top_districts(star.orders),
    }


def build_summary(orders: DataFrame) -> DataFrame:
    """Counts and shares by status with mean minutes and value, for a finished build."""
    return summarize(
        orders,
        [],
        [
            m.row_count("total_orders"),
            m.count_or_zero(m.delivered_rows("delivered")),
            m.share_of_rows("delivered_pct", "rows_delivered"),
            m.count_or_zero(m.delayed_rows("delayed")),
            m.share_of_rows("delayed_pct", "rows_delayed"),
            m.count_or_zero(m.cancelled_rows("cancelled")),
            m.share_of_rows("cancelled_pct", "rows_cancelled"),
            m.avg_minutes("avg_delivery_min", law=m.half_even),
            m.avg_value("avg_order_value", law=m.half_even),
        ],
    )
