"""Invariants over generated inputs."""

from __future__ import annotations

from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courierlens.functions.rounding import half_even, half_up
from courierlens.operators import measures as m
from courierlens.operators.measures import PARTS, roll_up
from courierlens.operators.summarize import summarize

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
pairs = st.lists(
    st.tuples(st.integers(-(10**13), 10**13), st.integers(1, 10**9)) | st.tuples(st.integers(0, 10**6), st.integers(1, 400)),
    min_size=1,
    max_size=60,
)


def exact(total, n, law, digits):
    with localcontext() as context:
        context.prec = 60
        # far more places than a half could hide behind: a half itself ends after digits + 1 places times n
        top, base = abs(total) * 10**digits, n
        whole, rest = divmod(top, base)
        if 2 * rest > base or (2 * rest == base and (law == ROUND_HALF_UP or whole % 2)):
            whole += 1
        return float(Decimal(whole) / 10**digits) * (-1 if total < 0 else 1)


@few
@given(pairs)
def test_rounding_of_quotients_is_exact(spark, data):
    rows = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(data)], "i int, s bigint, n bigint")
    s, n = F.col("s"), F.col("n")
    found = rows.orderBy("i").select(half_up(s, n, 1), half_even(s, n, 1), half_up(s, n, 0), half_even(s, n, 2)).collect()
    for (total, count), row in zip(data, found):
        wanted = [(ROUND_HALF_UP, 1), (ROUND_HALF_EVEN, 1), (ROUND_HALF_UP, 0), (ROUND_HALF_EVEN, 2)]
        assert list(row) == pytest.approx([exact(total, count, law, digits) for law, digits in wanted], rel=1e-15)


def test_large_groups_one_unit_beside_a_half(spark):
    n = 3_000_000
    rows = [(40 * n + n * 45 // 100 + d, n) for d in (-1, 0, 1)]
    found = spark.createDataFrame(rows, "s bigint, n bigint").select(half_up(F.col("s"), F.col("n"), 1).alias("r"))
    assert [r.r for r in found.collect()] == [40.4, 40.5, 40.5]
    over = spark.range(n).select(F.when(F.col("id") < n * 45 // 100 - 1, 41).otherwise(40).cast("long").alias("delivery_time_min"))
    for parts in (3, 11):
        row = summarize(over.repartition(parts), [], [m.avg_minutes("minutes")]).first()
        assert row["minutes"] == 40.4


def test_money_does_not_depend_on_the_order_of_its_sum(spark):
    values = spark.range(400_000).select((F.lit(0.1) + F.col("id") % 7).alias("order_value_sar"), "id")
    found = {
        str(summarize(df, [], [m.revenue("r", 2), m.avg_value("a")]).first())
        for df in (values, values.repartition(7, "id"), values.orderBy(F.desc("id")).coalesce(1))
    }
    assert len(found) == 1


orders = st.lists(
    st.fixed_dictionaries(
        {
            "district": st.sampled_from(["n", "s", None]),
            "weather": st.sampled_from(["a", "b"]),
            "captain_id": st.sampled_from(["CAP001", "CAP002", "CAP404", None]),
            "delivery_time_min": st.one_of(st.none(), st.integers(15, 99)),
            "order_value_sar": st.one_of(st.none(), st.integers(1500, 35000).map(lambda c: c / 100)),
            "is_delayed": st.sampled_from([0, 1, None]),
            "status": st.sampled_from(["delivered", "delayed", "cancelled", None]),
        }
    ),
    max_size=30,
)
MEASURES = [
    m.row_count("rows"),
    m.order_count("orders"),
    m.avg_minutes("minutes"),
    m.avg_value("value"),
    m.revenue("revenue"),
    m.flagged_rate("flagged"),
    m.mean_delay_rate("mean"),
    m.mart_delay_rate("mart"),
    m.delivered_rows("delivered"),
]


@few
@given(orders)
def test_parts_can_be_rolled_up_in_steps(spark, make, data):
    fact = make(data).orders
    fine = roll_up(fact, ["district", "weather", "captain_id"], PARTS)
    for keys in ([], ["district"], ["weather", "district"], ["captain_id"]):
        direct = sorted(map(str, summarize(fact, keys, MEASURES).collect()))
        stepped = sorted(map(str, summarize(fine, keys, MEASURES).collect()))
        assert direct == stepped
