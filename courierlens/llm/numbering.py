"""Dense global row numbers without a single sorted task."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.blocks import scratch_table, shuffle_partitions

# rows one range answers for, however few partitions the session names
ROWS_PER_RANGE = 1_000_000


def range_count(rows: DataFrame, n: int, per_range: int = ROWS_PER_RANGE) -> int:
    return max(shuffle_partitions(rows.sparkSession), ceil(n / per_range))


def numbered(rows: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, int]:
    """``rows`` with ``row``, their number from 0 by ascending ``keys`` (nulls first), and how many there are.

    ``rows`` is a written table. Each range numbers its own rows as they pass; only the
    sizes of ranges are added up in one place. The keys should end with something that
    tells repeated rows apart, so that a hot key is spread over several ranges.
    """
    total = rows.count()
    ranged = rows.repartitionByRange(range_count(rows, total), *keys).sortWithinPartitions(*keys)
    placed = scratch_table(ranged.withColumn("at", F.monotonically_increasing_id()), name)
    # the number holds the range above its 33 low bits
    part = F.shiftright("at", 33).alias("part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = sizes.select("part", before.alias("before"))
    row = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per range
    joined = placed.withColumn("part", part).join(F.broadcast(offsets), "part")
    return joined.withColumn("row", row).drop("part", "at", "before"), total
