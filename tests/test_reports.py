from __future__ import annotations

from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from courierlens.plans import dashboard, demand_model, marts, reports, staging, validation


def test_overview_of_absent_statuses_is_null(make):
    row = reports.overview(make([{}, {"order_value_sar": 50.5}]).orders).first()
    assert row["total_orders"] == 2 and row["delivered"] == 2
    assert row["delayed"] is None and row["cancelled"] is None
    assert row["total_revenue_sar"] == 151.0 and row["avg_order_value"] == 75.3


def test_overview_of_nothing(make):
    row = reports.overview(make([]).orders).first()
    assert row["total_orders"] == 0
    assert all(row[c] is None for c in row.asDict() if c != "total_orders")


def test_kpis_of_nothing(make):
    row = dashboard.kpis(make([]).orders).first()
    assert (row["total_orders"], row["delivered"], row["delay_rate"]) == (0, 0, None)


def test_rates_use_the_flag_and_counts_use_the_status(make):
    late_but_cancelled = {"delivery_time_min": 60, "is_delayed": 1, "status": "cancelled"}
    orders = make([late_but_cancelled, {}]).orders
    assert reports.overview(orders).first()["delayed"] is None
    assert values(reports.busiest_districts(orders), "delayed_orders", "delay_rate_pct") == [(1, 50.0)]


def test_captains_need_fifty_orders(make):
    orders = [{"captain_id": "CAP001"}] * 49 + [{"captain_id": "CAP002"}] * 50
    star = make(orders, captains=[{}, {"captain_id": "CAP002"}])
    assert values(reports.worst_captains(star.orders, star.captains), "captain_id") == [("CAP002",)]
    assert values(dashboard.attention_captains(star.orders, star.captains), "captain_id") == [("CAP002",)]
    assert len(values(dashboard.top_captains(star.orders, star.captains))) == 2


def test_ties_go_to_the_lower_key(make):
    orders = [{"captain_id": f"CAP{c:03d}"} for c in range(7, 0, -1) for _ in range(2)]
    star = make(orders, captains=[{"captain_id": f"CAP{c:03d}"} for c in range(1, 8)])
    worst = reports.worst_captains(star.orders, star.captains, min_orders=1)
    assert values(worst, "captain_id") == [(f"CAP{c:03d}",) for c in range(1, 6)]
    ranked = dashboard.ranked_captains(star.orders, star.captains)
    assert values(ranked, "place") == [(1,)] * 7


def test_ranking_skips_places_after_ties(make):
    flags = {"CAP001": [1, 1], "CAP002": [0, 0], "CAP003": [0, 0], "CAP004": [0, 1]}
    orders = [{"captain_id": c, "is_delayed": f} for c, fs in flags.items() for f in fs]
    star = make(orders, captains=[{"captain_id": c} for c in flags])
    ranked = values(dashboard.ranked_captains(star.orders, star.captains), "captain_id", "place")
    assert ranked == [("CAP002", 1), ("CAP003", 1), ("CAP004", 3), ("CAP001", 4)]


def test_namesakes_are_merged_by_sums(make):
    orders = [{"restaurant_id": "REST001", "prep_time_min": 10}] * 3 + [
        {"restaurant_id": "REST002", "prep_time_min": 30}
    ]
    star = make(orders, restaurants=[{}, {"restaurant_id": "REST002"}])
    merged = reports.slowest_restaurants(star.orders, star.restaurants)
    assert values(merged, "name", "total_orders", "avg_prep_min") == [("grill", 4, 15.0)]
    apart = reports.slowest_restaurants_by_id(star.orders, star.restaurants)
    assert values(apart, "restaurant_id", "avg_prep_min") == [("REST002", 30.0), ("REST001", 10.0)]


def test_unknown_captain_survives_the_left_join_only(make):
    star = make([{}, {"captain_id": "CAP999"}])
    mart = marts.captain_performance(star.orders, staging.stg_captains(star.captains))
    assert values(mart.orderBy("captain_id"), "captain_id", "name", "performance_tier", "total_orders") == [
        ("CAP001", "a", "good", 1),
        ("CAP999", None, None, 1),
    ]
    assert values(dashboard.captain_scatter(star.orders, star.captains), "captain_id") == [("CAP001",)]


def test_orders_without_a_captain(make):
    star = make([{}, {"captain_id": None}, {"captain_id": None}])
    mart = marts.captain_performance(star.orders, staging.stg_captains(star.captains))
    assert sorted(values(mart, "captain_id", "total_orders"), key=str) == [("CAP001", 1), (None, 2)]
    assert values(dashboard.captain_scatter(star.orders, star.captains), "captain_id") == [("CAP001",)]


def test_repeated_dimension_keys_multiply_like_a_plain_join(make):
    star = make([{}, {}], captains=[{}, {}, {"rating": 2.0}])
    joined = star.orders.join(star.captains.select("captain_id", "rating"), "captain_id")
    plain = joined.groupBy("captain_id", "rating").agg(F.count("order_id").alias("n"))
    ours = dashboard.captain_scatter(star.orders, star.captains)
    assert sorted(values(ours, "captain_id", "rating", "total_orders")) == sorted(values(plain))


def test_null_district_stays_in_sql_reports_and_leaves_dashboards(make):
    orders = make([{}, {"district": None}, {"district": None}]).orders
    assert values(reports.busiest_districts(orders), "district") == [(None,), ("north",)]
    assert values(validation.top_districts(orders), "district") == [(None,), ("north",)]
    assert values(dashboard.district_orders(orders)) == [("north", 1)]
    assert values(dashboard.hour_district(orders)) == [(12, "north", 1)]
    assert demand_model.demand_slots(orders).count() == 1


def test_null_measures_are_left_out_of_averages(make):
    orders = make([{"delivery_time_min": None}, {"delivery_time_min": 31}, {"is_delayed": None}]).orders
    row = dashboard.traffic_impact(orders).first()
    assert (row["total_orders"], row["avg_delivery_min"], row["delay_rate_pct"]) == (3, 35.5, 0.0)


def test_half_values_round_up_in_reports_and_to_even_on_dashboards(make):
    orders = make([{"delivery_time_min": m} for m in (40, 40, 40, 41)]).orders
    assert reports.overview(orders).first()["avg_delivery_min"] == 40.3
    assert dashboard.kpis(orders).first()["avg_delivery_min"] == 40.2


def test_shares_and_summary(make):
    orders = make([{}, {}, {"status": "delayed"}, {"status": None}]).orders
    assert values(dashboard.status_share(orders)) == [("delivered", 2, 66.7), ("delayed", 1, 33.3)]
    summary = validation.build_summary(orders).first()
    assert (summary["delivered_pct"], summary["delayed_pct"], summary["cancelled_pct"]) == (50.0, 25.0, 0.0)
    assert summary["cancelled"] == 0


def test_alerts(make):
    late = {"is_delayed": 1}
    orders = make([late, late, {**late, "district": "east"}, {"district": "west"}]).orders
    assert values(dashboard.alerts(orders)) == [
        ("north", 2, "north — 2 delayed orders detected"),
        ("east", 1, "east — 1 delayed orders detected"),
    ]


def test_heat_map_forms_agree(built):
    long_form = {(r["district"], r["weather"]): r["delay_rate"] for r in dashboard.district_weather(built.orders).collect()}
    districts = sorted({d for d, _ in long_form})
    for wide in (
        dashboard.district_weather_wide(built.orders),
        dashboard.district_weather_wide(built.orders, districts),
    ):
        assert set(wide.columns) == {"weather", *districts}
        cells = {(d, r["weather"]): r[d] for r in wide.collect() for d in districts if r[d] is not None}
        assert cells == long_form


def test_sample_is_ordered(built):
    ids = [v[0] for v in values(validation.order_sample(built.orders), "order_id")]
    assert ids == ["ORD000001", "ORD000002", "ORD000003", "ORD000004", "ORD000005"]


def test_group_counts_add_up(built):
    total = built.orders.count()
    for report, column in (
        (validation.by_status(built.orders), "total"),
        (dashboard.hourly_orders(built.orders), "total"),
        (dashboard.hour_district(built.orders), "orders"),
        (demand_model.demand_slots(built.orders), "order_count"),
        (dashboard.captain_scatter(built.orders, built.captains), "total_orders"),
    ):
        assert report.agg(F.sum(column)).first()[0] == total


@pytest.mark.parametrize("name", ["weather", "hour_of_day", "traffic_level"])
def test_dashboards_match_pandas(built, name):
    orders = built.orders.select(name, "order_id", "delivery_time_min", "is_delayed").toPandas()
    grouped = orders.groupby(name)

    def exact(total, n):
        """Halves to even on the exact quotient; a mean kept as a binary float may miss a half by an ulp."""
        return float((Decimal(int(total)) / n).quantize(Decimal("0.1"), ROUND_HALF_EVEN))

    expected = {
        key: (len(g), exact(g["delivery_time_min"].sum(), len(g)), exact(g["is_delayed"].sum() * 100, len(g)))
        for key, g in grouped
    }
    from courierlens.operators import measures as m
    from courierlens.operators.summarize import summarize

    found = summarize(
        built.orders,
        [name],
        [m.order_count("n"), m.avg_minutes("t", law=m.half_even), m.mean_delay_rate("r", law=m.half_even)],
    )
    assert {r[0]: (r[1], r[2], r[3]) for r in found.collect()} == expected
