"""Random draws that depend on a row id and a seed only.

``rand(seed)`` depends on how rows fall into partitions, so a retried or
re-partitioned task would draw other values. Here each draw is one 32-bit
slice of ``md5(id:seed:block)``: stable on any cluster and portable to any
engine that has md5.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLICES = 4
_HEX_DIGITS = 8


def with_draws(df: DataFrame, row_id: str, names: list[str], seed: int) -> DataFrame:
    """Add one uniform 32-bit integer column per name, four of them per hash."""
    blocks = {}
    for block in range((len(names) + _SLICES - 1) // _SLICES):
        text = F.concat_ws(":", F.col(row_id).cast("string"), F.lit(str(seed)), F.lit(str(block)))
        blocks[f"_block{block}"] = F.md5(text)
    hashed = df.withColumns(blocks)
    slices = {}
    for i, name in enumerate(names):
        start = 1 + _HEX_DIGITS * (i % _SLICES)
        digits = F.substring(F.col(f"_block{i // _SLICES}"), start, _HEX_DIGITS)
        # never NULL; saying so spares joins on a draw a null check that hashes again
        slices[name] = F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0).cast("long"))
    return hashed.withColumns(slices).drop(*blocks)


def below(draw: Column, n: int | Column) -> Column:
    """Uniform integer 0..n-1 (n below 2**31)."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.shiftright(draw * n.cast("long"), 32)


def between(draw: Column, low: int, high: int) -> Column:
    """Uniform integer low..high, both ends included."""
    return F.lit(low).cast("long") + below(draw, high - low + 1)


def uniform_rounded(draw: Column, low: float, high: float, digits: int) -> Column:
    """Uniform real in [low, high) rounded to ``digits`` places, in integer arithmetic."""
    fine = 10 ** (digits + 2)
    ticks = F.lit(round(low * fine)).cast("long") + below(draw, round((high - low) * fine))
    return F.floor((ticks + 50) / F.lit(100)).cast("double") / F.lit(float(10**digits))


def choice(draw: Column, values: list[str]) -> Column:
    """Uniform pick from a short list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (below(draw, len(values)) + 1).cast("int"))


def weighted_choice(draw: Column, weights: dict) -> Column:
    """Pick a key with probability proportional to its whole-number weight."""
    edges = list(accumulate(weights.values()))
    tick = below(draw, edges[-1])
    picked = F.when(F.lit(False), F.lit(None))
    for value, edge in zip(weights, edges):
        picked = picked.when(tick < edge, F.lit(value))
    return picked
