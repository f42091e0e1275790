from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from courierlens.functions import draws, rules, tiers
from courierlens.functions.rounding import half_even, half_up, ratio, settled


def column(spark, values, kind):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return lambda expression: [r[0] for r in rows.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    ("tier", "kind", "given", "expected"),
    [
        (tiers.delivery_speed, "bigint", [30, 31, 50, 51, None], ["fast", "normal", "normal", "slow", "slow"]),
        (
            tiers.order_value_segment,
            "double",
            [99.99, 100.0, 199.99, 200.0, None],
            ["low", "medium", "medium", "high", "low"],
        ),
        (
            tiers.performance_tier,
            "double",
            [2.4, 2.5, 3.4, 3.5, 4.4, 4.5],
            ["poor", "average", "average", "good", "good", "excellent"],
        ),
        (tiers.prep_speed_tier, "bigint", [10, 11, 20, 21], ["fast", "normal", "normal", "slow"]),
    ],
)
def test_tier_edges(spark, tier, kind, given, expected):
    assert column(spark, given, kind)(tier(F.col("v"))) == expected


def test_the_two_rounding_laws(spark):
    thousandths = [250, 350, 450, 2650, 2675, -250, 449, None]
    run = column(spark, thousandths, "bigint")
    n = F.lit(1000)
    assert run(half_up(F.col("v"), n, 1)) == [0.3, 0.4, 0.5, 2.7, 2.7, -0.3, 0.4, None]
    assert run(half_even(F.col("v"), n, 1)) == [0.2, 0.4, 0.4, 2.6, 2.7, -0.2, 0.4, None]
    assert run(half_up(F.col("v"), F.lit(0), 1)) == [None] * 8


def test_real_values_settle_at_nine_places(spark):
    just_below = 116289.49999999999
    assert column(spark, [just_below], "double")(settled(F.col("v"), 0)) == [116290.0]


def test_ratio_over_nothing_is_null(spark):
    run = column(spark, [0, 4], "bigint")
    assert run(ratio(F.lit(3), F.col("v"))) == [None, 0.75]


def test_flags(spark):
    run = column(spark, [50, 51, None], "bigint")
    assert run(rules.delayed_flag(F.col("v"))) == [0, 1, 0]
    hours = list(range(7, 24))
    flags = column(spark, hours, "bigint")(rules.peak_flag(F.col("v")))
    assert [h for h, f in zip(hours, flags) if f] == [12, 13, 19, 20, 21]


def test_time_columns(spark):
    row = (
        spark.createDataFrame([(dt.date(2025, 1, 2), 19, 5)], "d date, h int, m int")
        .select(rules.order_moment(F.col("d"), F.col("h"), F.col("m")).alias("t"))
        .select(
            "t",
            rules.moment_text(F.col("t")),
            rules.hour_of_day(F.col("t")),
            rules.day_of_week(F.col("t")),
        )
        .first()
    )
    assert tuple(row) == (dt.datetime(2025, 1, 2, 19, 5), "2025-01-02 19:05:00", 19, "Thursday")


LABELS = rules.Conditions("storm", "heat", "jam", "dense")


@pytest.mark.parametrize(
    ("weather", "traffic", "peak", "rating", "low", "high"),
    [
        ("calm", "free", 0, 4.0, 30, 30),
        ("storm", "free", 0, 4.0, 35, 40),
        ("heat", "free", 0, 4.0, 32, 35),
        ("calm", "jam", 0, 4.0, 38, 42),
        ("calm", "dense", 0, 4.0, 33, 37),
        ("calm", "free", 1, 4.0, 33, 38),
        ("calm", "free", 0, 3.4, 32, 35),
        ("calm", "free", 0, 3.5, 30, 30),
        ("storm", "jam", 1, 2.5, 48, 65),
    ],
)
def test_delay_model_bounds(spark, weather, traffic, peak, rating, low, high):
    def total(spread):
        expression = rules.delivery_minutes(
            F.lit(10), F.lit(20), F.lit(weather), F.lit(traffic), F.lit(peak), F.lit(rating), LABELS, spread
        )
        return spark.range(1).select(expression).first()[0]

    assert total(lambda name, width: F.lit(0)) == low
    assert total(lambda name, width: F.lit(width - 1)) == high


@pytest.mark.parametrize(
    ("minutes", "weather", "traffic", "chance"),
    [(50, "calm", "free", 5), (50, "storm", "free", 9), (50, "calm", "jam", 8), (60, "calm", "free", 5),
     (61, "calm", "free", 10), (61, "storm", "jam", 17)],
)
def test_cancel_chance(spark, minutes, weather, traffic, chance):
    status = rules.order_status(F.lit(minutes), F.lit(weather), F.lit(traffic), LABELS, F.col("id"))
    found = [r[0] for r in spark.range(100).orderBy("id").select(status).collect()]
    assert found == ["cancelled"] * chance + ["delayed" if minutes > 50 else "delivered"] * (100 - chance)


def test_prep_has_a_floor(spark):
    run = column(spark, [5, 8, 35], "bigint")
    assert run(rules.prep_minutes(F.col("v"), F.lit(-3))) == [5, 5, 32]


def test_keys_may_outgrow_their_padding(spark):
    run = column(spark, [7, 999_999, 1_234_567], "bigint")
    assert run(rules.numbered_key("ORD", F.col("v"), 6)) == ["ORD000007", "ORD999999", "ORD1234567"]


def test_alert_text(spark):
    run = column(spark, [1234567], "bigint")
    assert run(rules.alert_text(F.lit("north"), F.col("v"))) == ["north — 1,234,567 delayed orders detected"]


def test_draws_do_not_depend_on_partitions(spark):
    def drawn(parts):
        ids = spark.range(0, 500, 1, parts)
        return sorted(map(tuple, draws.with_draws(ids, "id", list("abcde"), 7).collect()))

    assert drawn(1) == drawn(13)
    others = draws.with_draws(spark.range(0, 500), "id", list("abcde"), 8)
    assert sorted(map(tuple, others.collect())) != drawn(1)


def test_draws_are_uniform(spark):
    drawn = draws.with_draws(spark.range(20_000), "id", ["a", "b"], 7)
    row = drawn.select(
        F.min(draws.between(F.col("a"), -3, 5)),
        F.max(draws.between(F.col("a"), -3, 5)),
        F.avg(draws.between(F.col("a"), -3, 5)),
        F.corr("a", "b"),
        F.min(draws.uniform_rounded(F.col("b"), 15, 350, 2)),
        F.max(draws.uniform_rounded(F.col("b"), 15, 350, 2)),
        F.avg(draws.uniform_rounded(F.col("b"), 15, 350, 2)),
    ).first()
    assert (row[0], row[1]) == (-3, 5)
    assert abs(row[2] - 1) < 0.1
    assert abs(row[3]) < 0.03
    assert 15 <= row[4] < 15.2 and 349.8 < row[5] <= 350
    assert abs(row[6] - 182.5) < 3


def test_weighted_choice(spark):
    drawn = draws.with_draws(spark.range(20_000), "id", ["a"], 7)
    picked = drawn.groupBy(draws.weighted_choice(F.col("a"), {"x": 70, "y": 30}).alias("k")).count()
    share = {r["k"]: r["count"] / 20_000 for r in picked.collect()}
    assert abs(share["x"] - 0.7) < 0.02 and abs(share["y"] - 0.3) < 0.02
