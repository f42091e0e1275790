"""Group, measure, filter, order, cut: the one shape behind all reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.operators.measures import Measure, parts_of, roll_up


def ordering(spec: str) -> Column:
    """``"rate desc"`` -> a sort column; NULLs go last in both directions."""
    name, _, direction = spec.partition(" ")
    return F.desc_nulls_last(name) if direction == "desc" else F.asc_nulls_last(name)


def finish(
    df: DataFrame,
    having: Column | None = None,
    order: tuple[str, ...] = (),
    limit: int | None = None,
) -> DataFrame:
    """Filter groups, then sort. With a limit Spark plans a top-k, not a full sort."""
    if having is not None:
        df = df.filter(having)
    if order:
        df = df.orderBy(*[ordering(spec) for spec in order])
    return df if limit is None else df.limit(limit)


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """DataFrame-style grouping leaves rows with an unknown key out; SQL keeps them."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def summarize(
    fact: DataFrame,
    keys: list[str],
    measures: list[Measure],
    *,
    having: Column | None = None,
    order: tuple[str, ...] = (),
    limit: int | None = None,
    known_keys_only: bool = False,
) -> DataFrame:
    """One pass over ``fact`` (or over a frame of parts), partial aggregation first."""
    source = drop_null_keys(fact, keys) if known_keys_only else fact
    grouped = roll_up(source, keys, parts_of(measures))
    result = grouped.select(*keys, *[m.column() for m in measures])
    return finish(result, having, order, limit)


def summarize_through(
    fact: DataFrame,
    dimension: DataFrame,
    on: str,
    how: str,
    keys: list[str],
    measures: list[Measure],
    *,
    having: Column | None = None,
    order: tuple[str, ...] = (),
    limit: int | None = None,
    known_keys_only: bool = False,
) -> DataFrame:
    """Report over fact joined with a dimension, without joining the fact.

    The fact is reduced to one row of parts per join key first. A hot key is
    folded on the map side, so the join sees each key once, whatever its share of
    the fact, and neither side has to be broadcast. The parts are then added up to
    the report's keys, which also keeps repeated dimension keys and merged names right.
    """
    parts = parts_of(measures)
    per_key = roll_up(fact, [on], parts)
    attributes = list(dict.fromkeys([on, *[k for k in keys if k in dimension.columns]]))
    joined = per_key.join(dimension.select(*attributes), on, how)
    return summarize(
        joined,
        keys,
        measures,
        having=having,
        order=order,
        limit=limit,
        known_keys_only=known_keys_only,
    )
