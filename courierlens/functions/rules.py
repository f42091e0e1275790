"""Business rules of an order: time columns, delay model, status, alert text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from courierlens.schemas import TIMESTAMP_FORMAT

# fixed rule values
OPEN_HOURS = range(7, 24)
PEAK_HOURS = [12, 13, 19, 20, 21]
DELAY_LIMIT_MINUTES = 50
MIN_PREP_MINUTES = 5
LOW_RATING = 3.5
LONG_ORDER_MINUTES = 60
# extra minutes, both ends inclusive
EXTRA_MINUTES = {
    "stormy": (5, 10),
    "very_hot": (2, 5),
    "severe": (8, 12),
    "heavy": (3, 7),
    "peak": (3, 8),
    "low_rating": (2, 5),
}
# cancellation chance in percent
CANCEL_BASE = 5
CANCEL_STORMY = 4
CANCEL_SEVERE = 3
CANCEL_LONG = 5


@dataclass(frozen=True)
class Conditions:
    """The labels a dataset uses for the conditions that cost time."""

    stormy: str
    very_hot: str
    severe: str
    heavy: str


def flag(condition: Column) -> Column:
    """0/1 as a long; a NULL condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def peak_flag(hour: Column) -> Column:
    return flag(hour.isin(PEAK_HOURS))


def delayed_flag(minutes: Column) -> Column:
    return flag(minutes > DELAY_LIMIT_MINUTES)


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment).cast("long")


def day_of_week(moment: Column) -> Column:
    return F.date_format(moment.cast("date"), "EEEE")


def order_moment(day: Column, hour: Column, minute: Column) -> Column:
    """Day plus hour plus minute as a timestamp without time zone."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour, mins=minute)


def moment_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, read off the timestamp without passing a time zone."""
    return F.substring(moment.cast("string"), 1, len(TIMESTAMP_FORMAT))


def prep_minutes(average: Column, jitter: Column) -> Column:
    return F.greatest(F.lit(MIN_PREP_MINUTES).cast("long"), average + jitter)


def delivery_minutes(
    prep: Column,
    leg: Column,
    weather: Column,
    traffic: Column,
    is_peak: Column,
    rating: Column,
    labels: Conditions,
    spread: Callable[[str, int], Column],
) -> Column:
    """Total minutes: preparation, road leg and every surcharge that applies.

    ``spread(name, width)`` gives the jitter 0..width-1 of one surcharge, so the
    caller decides whether it is drawn at random or derived from the order key.
    """
    applies = {
        "stormy": weather == labels.stormy,
        "very_hot": weather == labels.very_hot,
        "severe": traffic == labels.severe,
        "heavy": traffic == labels.heavy,
        "peak": is_peak == 1,
        "low_rating": rating < LOW_RATING,
    }
    total = prep + leg
    for name, condition in applies.items():
        low, high = EXTRA_MINUTES[name]
        surcharge = F.lit(low) + spread(name, high - low + 1)
        total = total + F.when(condition, surcharge).otherwise(F.lit(0))
    return total.cast("long")


def order_status(
    minutes: Column, weather: Column, traffic: Column, labels: Conditions, percentile: Column
) -> Column:
    """Cancelled when the 0..99 ``percentile`` falls under the order's cancel chance."""
    chance = (
        F.lit(CANCEL_BASE)
        + CANCEL_STORMY * flag(weather == labels.stormy)
        + CANCEL_SEVERE * flag(traffic == labels.severe)
        + CANCEL_LONG * flag(minutes > LONG_ORDER_MINUTES)
    )
    return (
        F.when(percentile < chance, "cancelled")
        .when(minutes > DELAY_LIMIT_MINUTES, "delayed")
        .otherwise("delivered")
    )


def numbered_key(prefix: str, number: Column, digits: int) -> Column:
    """``PREFIX`` plus a zero-padded number that may outgrow its padding."""
    return F.format_string(f"{prefix}%0{digits}d", number)


def alert_text(district: Column, delayed_orders: Column) -> Column:
    """Fixed wording of an operational alert."""
    return F.concat(
        district, F.lit(" — "), F.format_number(delayed_orders, 0), F.lit(" delayed orders detected")
    )
