from __future__ import annotations

from conftest import values

from courierlens.operators.quality import (
    accepted_values,
    broken_tests,
    not_null,
    quarantine,
    run_tests,
    unique,
    violations,
)
from courierlens.plans.staging import DATA_TESTS, STG_ORDERS, staged


def failures(star):
    found = run_tests(staged(star), DATA_TESTS)
    return {(r.table_name, r.column_name, r.test): r.failures for r in found.collect()}


def test_clean_data_passes(built):
    found = failures(built)
    assert len(found) == 8 and set(found.values()) == {0}


def test_every_kind_fails_on_bad_rows(make):
    star = make(
        [
            {"order_id": "ORD1"},
            {"order_id": "ORD1"},
            {"order_id": "ORD2", "status": "lost"},
            {"order_id": "ORD3", "status": "lost"},
            {"order_id": "ORD4", "status": "stolen"},
            {"order_id": None, "status": None},
            {"order_id": None, "delivery_time_min": None},
        ],
        captains=[{}, {}, {"captain_id": None}],
        restaurants=[{"restaurant_id": None}],
    )
    assert failures(star) == {
        ("stg_orders", "order_id", "unique"): 1,
        ("stg_orders", "order_id", "not_null"): 2,
        ("stg_orders", "status", "accepted_values"): 2,
        ("stg_orders", "delivery_time_min", "not_null"): 1,
        ("stg_captains", "captain_id", "unique"): 1,
        ("stg_captains", "captain_id", "not_null"): 1,
        ("stg_restaurants", "restaurant_id", "unique"): 0,
        ("stg_restaurants", "restaurant_id", "not_null"): 1,
    }
    orders = staged(star)[STG_ORDERS]
    tests = {(t.column, t.kind): t for t in DATA_TESTS if t.table == STG_ORDERS}
    assert values(violations(orders, tests["order_id", "unique"])) == [("ORD1", 2)]
    assert sorted(values(violations(orders, tests["status", "accepted_values"]))) == [("lost", 2), ("stolen", 1)]
    assert values(violations(orders, tests["order_id", "not_null"])) == [(None, 2)]


def test_empty_tables_pass(make):
    assert set(failures(make([], captains=[], restaurants=[])).values()) == {0}


def test_rows_are_quarantined_with_the_tests_they_break(spark, tmp_path):
    data = [(1, "a", "x"), (1, "b", "x"), (2, None, "x"), (None, "a", "z"), (None, None, None), (3, "c", "y")]
    rows = spark.createDataFrame(data, "k long, v string, broken_by string")
    tests = [unique("t", "k"), not_null("t", "k"), not_null("t", "v"), accepted_values("t", "broken_by", ["x", "y"])]
    accepted, rejected = quarantine(rows, tests, str(tmp_path / "q"))
    assert values(accepted) == [(3, "c", "y")]
    found = sorted(((*row[:3], list(row[3])) for row in values(rejected)), key=str)
    assert found == sorted(
        [
            (1, "a", "x", ["k unique"]),
            (1, "b", "x", ["k unique"]),
            (2, None, "x", ["v not_null"]),
            (None, "a", "z", ["k not_null", "broken_by accepted_values"]),
            (None, None, None, ["k not_null", "v not_null"]),
        ],
        key=str,
    )
    # violations by value and broken rows tell the same story
    assert values(violations(rows, tests[0])) == [("1", 2)]


def test_clean_and_empty_tables_reject_nothing(spark, make, tmp_path):
    orders = make([{}, {}]).orders
    tests = [t for t in DATA_TESTS if t.table == STG_ORDERS]
    accepted, rejected = quarantine(orders, tests, str(tmp_path / "clean"))
    assert accepted.count() == 2 and rejected.count() == 0
    assert broken_tests(orders, []).where("size(broken) > 0").count() == 0
