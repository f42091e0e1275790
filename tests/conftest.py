from __future__ import annotations

import datetime as dt

import pytest

from courierlens.schemas import DIM_CAPTAINS, DIM_RESTAURANTS, FACT_ORDERS, star_schemas
from courierlens.session import local_session, release_application_folder
from courierlens.sources import builder
from courierlens.sources.tables import Star

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4",
        app="tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    release_application_folder(session)
    session.stop()


@pytest.fixture(scope="session")
def built(spark, tmp_path_factory):
    """A built dataset, written once."""
    from courierlens.sources.tables import load_star, parquet_reader, save_star

    root = str(tmp_path_factory.mktemp("built"))
    save_star(builder.build_star(spark, orders=6000, captains=60, restaurants=40), root)
    return load_star(parquet_reader(spark, root))


ORDER = {
    "order_id": "ORD000001",
    "customer_id": "CUST00001",
    "captain_id": "CAP001",
    "restaurant_id": "REST001",
    "district": "north",
    "order_time": dt.datetime(2025, 1, 2, 12, 30),
    "delivery_time_min": 40,
    "prep_time_min": 10,
    "weather": "clear",
    "traffic_level": "light",
    "order_value_sar": 100.0,
    "status": "delivered",
    "hour_of_day": 12,
    "day_of_week": "Thursday",
    "is_peak_hour": 1,
    "is_delayed": 0,
}
CAPTAIN = {
    "captain_id": "CAP001",
    "name": "a",
    "rating": 4.0,
    "avg_speed_kmh": 30,
    "active_hours": 8,
    "district": "south",
    "total_deliveries": 100,
    "on_time_rate": 0.9,
}
RESTAURANT = {
    "restaurant_id": "REST001",
    "name": "grill",
    "cuisine_type": "kebab",
    "avg_prep_time_min": 10,
    "rating": 4.0,
    "district": "north",
    "total_orders": 100,
}


@pytest.fixture(scope="session")
def make(spark):
    """Hand-built tables: each row is the default row with some values replaced."""
    schemas = star_schemas()

    def table(name, default, rows):
        fields = schemas[name].fieldNames()
        data = []
        for i, row in enumerate(rows, 1):
            full = {**default, **row}
            if name == FACT_ORDERS and "order_id" not in row:
                full["order_id"] = f"ORD{i:06d}"
            data.append(tuple(full[f] for f in fields))
        return spark.createDataFrame(data, schemas[name])

    def star(orders=(), captains=({},), restaurants=({},)) -> Star:
        return Star(
            table(FACT_ORDERS, ORDER, orders),
            table(DIM_CAPTAINS, CAPTAIN, captains),
            table(DIM_RESTAURANTS, RESTAURANT, restaurants),
        )

    return star


def values(df, *columns):
    """Rows as plain tuples, in order."""
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
