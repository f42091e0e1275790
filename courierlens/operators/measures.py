"""The measure library.

Every report is built from a handful of *parts* that can be added up again
(counts and sums). A measure is an expression over parts. So one definition
serves a raw fact table, a fact pre-aggregated per join key, and the gold cube,
and an average is never taken over averages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.functions.rounding import half_even, half_up

Rounding = Callable[[Column, Column, int], Column]


@dataclass(frozen=True)
class Part:
    """An additive aggregate of the fact. A count of nothing is 0, a sum of nothing NULL."""

    name: str
    over_fact: Callable[[], Column]
    is_count: bool = False

    def merged(self) -> Column:
        total = F.sum(self.name)
        return F.coalesce(total, F.lit(0).cast("long")) if self.is_count else total


def _count(column: str) -> Callable[[], Column]:
    return lambda: F.count(column)


def _sum(column: str) -> Callable[[], Column]:
    return lambda: F.sum(column)


def _hundredths(column: str) -> Callable[[], Column]:
    # money is added up in whole hundredths: a double sum depends on its order
    return lambda: F.sum(F.round(F.col(column) * 100).cast("long"))


def _status_rows(status: str) -> Callable[[], Column]:
    return lambda: F.sum(F.when(F.col("status") == status, F.lit(1)))


PARTS = {
    part.name: part
    for part in [
        Part("n_rows", lambda: F.count(F.lit(1)), is_count=True),
        Part("n_orders", _count("order_id"), is_count=True),
        Part("sum_minutes", _sum("delivery_time_min")),
        Part("n_minutes", _count("delivery_time_min"), is_count=True),
        Part("sum_prep", _sum("prep_time_min")),
        Part("n_prep", _count("prep_time_min"), is_count=True),
        Part("sum_hundredths", _hundredths("order_value_sar")),
        Part("n_value", _count("order_value_sar"), is_count=True),
        Part("sum_delayed", _sum("is_delayed")),
        Part("n_delayed", _count("is_delayed"), is_count=True),
        Part("n_flagged", lambda: F.sum(F.when(F.col("is_delayed") == 1, 1).otherwise(0))),
        Part("sum_peak", _sum("is_peak_hour")),
        Part("rows_delivered", _status_rows("delivered")),
        Part("rows_delayed", _status_rows("delayed")),
        Part("rows_cancelled", _status_rows("cancelled")),
    ]
}


@dataclass(frozen=True)
class Measure:
    alias: str
    needs: tuple[str, ...]
    value: Callable[..., Column]

    def column(self) -> Column:
        return self.value(*[F.col(name) for name in self.needs]).alias(self.alias)


def _plain(part: str) -> Callable[[str], Measure]:
    return lambda alias: Measure(alias, (part,), lambda c: c)


def _average(total: str, known: str, unit: int = 1):
    def build(alias: str, digits: int = 1, law: Rounding = half_up) -> Measure:
        return Measure(alias, (total, known), lambda s, n: law(s, n * unit, digits))

    return build


def _rate(hits: str, base: str):
    def build(alias: str, digits: int = 1, law: Rounding = half_up) -> Measure:
        return Measure(alias, (hits, base), lambda h, n: law(h * 100, n, digits))

    return build


row_count = _plain("n_rows")
order_count = _plain("n_orders")
delayed_sum = _plain("sum_delayed")
flagged_count = _plain("n_flagged")
peak_sum = _plain("sum_peak")
delivered_rows = _plain("rows_delivered")
delayed_rows = _plain("rows_delayed")
cancelled_rows = _plain("rows_cancelled")

avg_minutes = _average("sum_minutes", "n_minutes")
avg_prep = _average("sum_prep", "n_prep")
avg_value = _average("sum_hundredths", "n_value", unit=100)

flagged_rate = _rate("n_flagged", "n_rows")      # delayed flag per row, as the reports define it
mart_delay_rate = _rate("sum_delayed", "n_orders")  # delayed flag per counted order id
mean_delay_rate = _rate("sum_delayed", "n_delayed")  # mean of the flag over known flags
peak_share = _rate("sum_peak", "n_orders")


def count_or_zero(measure: Measure) -> Measure:
    """A count that reads 0 where the conditional sum found no row."""
    return Measure(
        measure.alias,
        measure.needs,
        lambda *c: F.coalesce(measure.value(*c), F.lit(0).cast("long")),
    )


def revenue(alias: str, digits: int = 0) -> Measure:
    return Measure(alias, ("sum_hundredths",), lambda s: half_up(s, F.lit(100), digits))


def revenue_millions(alias: str) -> Measure:
    return Measure(alias, ("sum_hundredths",), lambda s: half_even(s, F.lit(100 * 10**6), 2))


def share_of_rows(alias: str, part: str) -> Measure:
    return Measure(
        alias,
        (part, "n_rows"),
        lambda hits, n: half_even(F.coalesce(hits, F.lit(0)) * 100, n, 1),
    )


def parts_of(measures: Iterable[Measure]) -> list[str]:
    """The distinct parts a list of measures needs, in first-use order."""
    return list(dict.fromkeys(name for m in measures for name in m.needs))


def roll_up(df: DataFrame, keys: list[str], parts: Iterable[str]) -> DataFrame:
    """Group to ``keys``; parts already present are added up, the others are computed."""
    present = set(df.columns)
    columns = []
    for name in parts:
        part = PARTS[name]
        columns.append((part.merged() if name in present else part.over_fact()).alias(name))
    return df.groupBy(*keys).agg(*columns)
