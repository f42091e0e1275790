"""Datasets behind the dashboard pages.

They follow DataFrame conventions: rows with an unknown group key are left out
and halves round to even.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.functions.rounding import half_even
from courierlens.functions.rules import alert_text
from courierlens.operators import measures as m
from courierlens.operators.summarize import finish, summarize, summarize_through
from courierlens.plans.reports import MIN_ORDERS
from courierlens.sources.working_copy import materialize

_EVEN = m.half_even


def kpis(orders: DataFrame) -> DataFrame:
    return summarize(
        orders,
        [],
        [
            m.row_count("total_orders"),
            m.revenue_millions("revenue_m"),
            m.avg_minutes("avg_delivery_min", law=_EVEN),
            m.count_or_zero(m.delivered_rows("delivered")),
            m.count_or_zero(m.cancelled_rows("cancelled")),
            m.mean_delay_rate("delay_rate", law=_EVEN),
        ],
    )


def status_share(orders: DataFrame) -> DataFrame:
    """Counts per status, largest first, with each one's share of the total."""
    counted = summarize(orders, ["status"], [m.row_count("count")], known_keys_only=True)
    # one row per status by now, so the unpartitioned total adds up a handful of rows
    total = F.sum("count").over(Window.partitionBy())
    shared = counted.withColumn("share_pct", half_even(F.col("count") * 100, total, 1))
    return finish(shared, order=("count desc", "status"))


def weather_delay(orders: DataFrame) -> DataFrame:
    return summarize(
        orders,
        ["weather"],
        [
            m.order_count("total"),
            m.delayed_sum("delayed"),
            m.mart_delay_rate("delay_rate", law=_EVEN),
        ],
        order=("weather",),
        known_keys_only=True,
    )


def district_orders(orders: DataFrame) -> DataFrame:
    return summarize(
        orders,
        ["district"],
        [m.order_count("total")],
        order=("total desc", "district"),
        known_keys_only=True,
    )


def hourly_orders(orders: DataFrame) -> DataFrame:
    return summarize(
        orders,
        ["hour_of_day"],
        [m.order_count("total")],
        order=("hour_of_day",),
        known_keys_only=True,
    )


def traffic_impact(orders: DataFrame) -> DataFrame:
    return summarize(
        orders,
        ["traffic_level"],
        [
            m.order_count("total_orders"),
            m.avg_minutes("avg_delivery_min", law=_EVEN),
            m.mean_delay_rate("delay_rate_pct", law=_EVEN),
        ],
        order=("traffic_level",),
        known_keys_only=True,
    )


def captain_scatter(orders: DataFrame, captains: DataFrame) -> DataFrame:
    """Orders, mean minutes and delay rate of every known captain."""
    return summarize_through(
        orders,
        captains,
        on="captain_id",
        how="inner",
        keys=["captain_id", "rating"],
        measures=[
            m.order_count("total_orders"),
            m.avg_minutes("avg_time", law=_EVEN),
            m.mean_delay_rate("delay_rate", law=_EVEN),
        ],
        known_keys_only=True,
    )


def best_of(scatter: DataFrame, k: int = 10) -> DataFrame:
    """Lowest delay rates of a captain scatter; ties go to the lower captain id."""
    best = finish(scatter, order=("delay_rate", "captain_id", "rating"), limit=k)
    return best.select("captain_id", "rating", "total_orders", "delay_rate")


def worst_of(scatter: DataFrame, k: int = 10, min_orders: int = MIN_ORDERS) -> DataFrame:
    """Highest delay rates among captains with enough orders; ties go to the lower id."""
    return finish(
        scatter,
        having=F.col("total_orders") >= min_orders,
        order=("delay_rate desc", "captain_id", "rating"),
        limit=k,
    )


def top_captains(orders: DataFrame, captains: DataFrame, k: int = 10) -> DataFrame:
    return best_of(captain_scatter(orders, captains), k)


def attention_captains(
    orders: DataFrame, captains: DataFrame, k: int = 10, min_orders: int = MIN_ORDERS
) -> DataFrame:
    return worst_of(captain_scatter(orders, captains), k, min_orders)


def ranked_captains(orders: DataFrame, captains: DataFrame) -> DataFrame:
    """Every captain's place by delay rate; equal rates share a place.

    A place is one more than the number of captains with a lower rate. Rates have one
    decimal, so at most 1,001 distinct rates enter the running sum, however many
    captains there are.
    """
    rated = captain_scatter(orders, captains)
    per_rate = rated.groupBy("delay_rate").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy(F.asc_nulls_last("delay_rate"))
    places = per_rate.select("delay_rate", (F.sum("_n").over(running) - F.col("_n") + 1).alias("place"))
    places = places.withColumnRenamed("delay_rate", "_rate")
    joined = rated.join(F.broadcast(places), F.col("delay_rate").eqNullSafe(F.col("_rate")))
    return finish(joined.drop("_rate"), order=("place", "captain_id", "rating"))


def district_weather(orders: DataFrame) -> DataFrame:
    return summarize(
        orders,
        ["district", "weather"],
        [m.mean_delay_rate("delay_rate", law=_EVEN)],
        order=("district", "weather"),
        known_keys_only=True,
    )


def district_weather_wide(orders: DataFrame, districts: list[str] | None = None) -> DataFrame:
    """The heat map as a matrix: one row per weather, one column per district.

    Without a list of districts the pivot has to look them up first; the long form is
    written before, so that the fact is still scanned once.
    """
    long_form = summarize(
        orders, ["district", "weather"], [m.mean_delay_rate("delay_rate", law=_EVEN)], known_keys_only=True
    )
    if districts is None:
        long_form = materialize(long_form, "district-weather")
    grid = long_form.groupBy("weather").pivot("district", districts).agg(F.first("delay_rate"))
    return finish(grid, order=("weather",))


def district_weather_map(orders: DataFrame) -> DataFrame:
    """The heat map with one row per weather: a sorted map of district to rate.

    Nothing is looked up on the driver and no column is made per district, so there may be
    as many districts as fit a row. ``map_columns`` spreads a few of them over columns.
    """
    long_form = summarize(
        orders, ["district", "weather"], [m.mean_delay_rate("delay_rate", law=_EVEN)], known_keys_only=True
    )
    rates = F.sort_array(F.collect_list(F.struct("district", "delay_rate")))
    grid = long_form.groupBy("weather").agg(F.map_from_entries(rates).alias("rates"))
    return finish(grid, order=("weather",))


def map_columns(grid: DataFrame, districts: list[str]) -> DataFrame:
    """Declared districts of ``district_weather_map`` as columns; one without orders is NULL."""
    return grid.select("weather", *[F.try_element_at("rates", F.lit(d)).alias(d) for d in districts])


def hour_district(orders: DataFrame) -> DataFrame:
    return summarize(
        orders,
        ["hour_of_day", "district"],
        [m.row_count("orders")],
        order=("hour_of_day", "district"),
        known_keys_only=True,
    )


def alerts(orders: DataFrame, k: int = 5) -> DataFrame:
    """Districts with most delayed orders, with the wording of their alert.

    Takes the fact: the filter on the flag is pushed into the scan.
    """
    late = summarize(
        orders.filter(F.col("is_delayed") == 1),
        ["district"],
        [m.row_count("delayed_orders")],
        order=("delayed_orders desc", "district"),
        limit=k,
        known_keys_only=True,
    )
    return late.withColumn("alert", alert_text(F.col("district"), F.col("delayed_orders")))


def alerts_from_gold(cube: DataFrame, k: int = 5) -> DataFrame:
    """The same alerts from pre-aggregated parts."""
    late = summarize(
        cube,
        ["district"],
        [m.flagged_count("delayed_orders")],
        having=F.col("delayed_orders") > 0,
        order=("delayed_orders desc", "district"),
        limit=k,
        known_keys_only=True,
    )
    return late.withColumn("alert", alert_text(F.col("district"), F.col("delayed_orders")))
