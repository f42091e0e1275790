"""Gold tables: additive parts of the fact, from which the reports are answered without it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from courierlens.operators.measures import PARTS, roll_up
from courierlens.plans import dashboard, marts, reports, validation

GRAIN = [
    "district",
    "hour_of_day",
    "day_of_week",
    "is_peak_hour",
    "weather",
    "traffic_level",
    "status",
]


def gold_cube(orders: DataFrame) -> DataFrame:
    """All parts at the grain of the reports' group keys.

    Its size is bounded by the product of the key domains, not by the fact.
    """
    return roll_up(orders, GRAIN, PARTS)


def captain_parts(orders: DataFrame) -> DataFrame:
    """All parts per captain id; takes the fact's place in every captain report and mart."""
    return roll_up(orders, ["captain_id"], PARTS)


def restaurant_parts(orders: DataFrame) -> DataFrame:
    """All parts per restaurant id; takes the fact's place in the restaurant reports."""
    return roll_up(orders, ["restaurant_id"], PARTS)


# every report that needs no dimension; each accepts the cube in place of the fact
FROM_GOLD: dict[str, Callable[[DataFrame], DataFrame]] = {
    "report_overview": reports.overview,
    "report_busiest_districts": reports.busiest_districts,
    "report_weather_impact": reports.weather_impact,
    "report_hours": reports.busiest_hours,
    "check_status": validation.by_status,
    "check_districts": validation.top_districts,
    "build_summary": validation.build_summary,
    "mart_zone_analysis": marts.zone_analysis,
    "dash_kpis": dashboard.kpis,
    "dash_status_share": dashboard.status_share,
    "dash_weather_delay": dashboard.weather_delay,
    "dash_districts": dashboard.district_orders,
    "dash_hourly": dashboard.hourly_orders,
    "dash_traffic": dashboard.traffic_impact,
    "dash_district_weather": dashboard.district_weather,
    "dash_hour_district": dashboard.hour_district,
    "dash_alerts": dashboard.alerts_from_gold,
}
