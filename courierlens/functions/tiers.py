"""CASE tiers of the staging layer. A NULL input falls to the last tier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _tier(steps: list[tuple[Column, str]], otherwise: str) -> Column:
    first_test, first_label = steps[0]
    chain = reduce(lambda c, s: c.when(s[0], s[1]), steps[1:], F.when(first_test, first_label))
    return chain.otherwise(otherwise)


def at_most(value: Column, limits: dict[str, float], otherwise: str) -> Column:
    """First label whose limit is not exceeded."""
    return _tier([(value <= limit, label) for label, limit in limits.items()], otherwise)


def at_least(value: Column, floors: dict[str, float], otherwise: str) -> Column:
    """First label whose floor is reached."""
    return _tier([(value >= floor, label) for label, floor in floors.items()], otherwise)


# fixed tier limits
DELIVERY_SPEED_MINUTES = {"fast": 30, "normal": 50}
ORDER_VALUE_FLOORS = {"high": 200, "medium": 100}
PERFORMANCE_FLOORS = {"excellent": 4.5, "good": 3.5, "average": 2.5}
PREP_SPEED_MINUTES = {"fast": 10, "normal": 20}


def delivery_speed(minutes: Column) -> Column:
    return at_most(minutes, DELIVERY_SPEED_MINUTES, "slow")


def order_value_segment(value: Column) -> Column:
    return at_least(value, ORDER_VALUE_FLOORS, "low")


def performance_tier(rating: Column) -> Column:
    return at_least(rating, PERFORMANCE_FLOORS, "poor")


def prep_speed_tier(minutes: Column) -> Column:
    return at_most(minutes, PREP_SPEED_MINUTES, "slow")
