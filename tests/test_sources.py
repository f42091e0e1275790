from __future__ import annotations

import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from courierlens import session
from courierlens.functions import draws, rules
from courierlens.schemas import DIM_CAPTAINS, FACT_ORDERS, star_schemas
from courierlens.sources import builder, files, tables, working_copy
from courierlens.sources.adapter import star_from_tables
from courierlens.sources.working_copy import materialize, release_star, working_star

SMALL = "/root/testdata/sf0.001"
BAD_FILE = "FAILED_READ_FILE|MALFORMED"


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_landing_zone_round_trip(spark, built, tmp_path):
    paths = files.land(built.tables(), str(tmp_path))
    assert paths[FACT_ORDERS].endswith("/raw/orders")
    back = files.read_raw(spark, str(tmp_path))
    for name, df in built.tables().items():
        assert back[name].dtypes == df.dtypes
        assert same(back[name], df)


def test_malformed_rows_fail(spark, tmp_path):
    header = "captain_id,name,rating,avg_speed_kmh,active_hours,district,total_deliveries,on_time_rate"
    good = "CAP001,a,3.5,32,6,d,1141,0.9"
    schema = star_schemas()[DIM_CAPTAINS]
    (tmp_path / "good.csv").write_text(f"{header}\n{good}\n", encoding="utf-8")
    assert files.read_csv(spark, str(tmp_path / "good.csv"), schema).count() == 1
    (tmp_path / "bad.csv").write_text(f"{header}\n{good}\nCAP002,b,high,1,1,d,1,0.9\n", encoding="utf-8")
    with pytest.raises(Exception, match=BAD_FILE):
        files.read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()
    other = header.replace("rating", "stars")
    (tmp_path / "header.csv").write_text(f"{other}\n{good}\n", encoding="utf-8")
    with pytest.raises(Exception, match=BAD_FILE):
        files.read_csv(spark, str(tmp_path / "header.csv"), schema).collect()


def test_catalog_tables_are_replaced(spark, built):
    for _ in range(2):
        for name, df in built.tables().items():
            tables.save_table(df, name)
    star = tables.load_star(tables.catalog_reader(spark, "default"))
    assert same(star.orders, built.orders) and same(star.captains, built.captains)
    tables.save_table(built.captains, DIM_CAPTAINS, partition_by=["district"])
    assert same(tables.load_star(tables.catalog_reader(spark)).captains, built.captains)


def test_capital_column_names_are_lowered(spark, built, tmp_path):
    loud = tables.Star.of({n: t.toDF(*[c.upper() for c in t.columns]) for n, t in built.tables().items()})
    tables.save_star(loud, str(tmp_path))
    star = tables.load_star(tables.parquet_reader(spark, str(tmp_path)))
    assert star.orders.columns == built.orders.columns
    assert same(star.restaurants, built.restaurants)


def test_text_times_and_decimals_are_conformed(spark, built):
    loose = built.orders.withColumns(
        {
            "order_time": rules.moment_text(F.col("order_time")),
            "delivery_time_min": F.col("delivery_time_min").cast("decimal(38,0)"),
            "is_delayed": F.col("is_delayed").cast("int"),
        }
    )
    star = tables.load_star(lambda name: loose if name == FACT_ORDERS else built.tables()[name])
    assert star.orders.dtypes == built.orders.dtypes and same(star.orders, built.orders)
    broken = loose.withColumn("order_time", F.lit("yesterday"))
    star = tables.load_star(lambda name: broken if name == FACT_ORDERS else built.tables()[name])
    with pytest.raises(Exception, match="does not fit"):
        star.orders.collect()


def test_flat_folder_of_csv_files(spark, built, tmp_path):
    for name, df in built.tables().items():
        files.write_raw(df, files.entity_path(str(tmp_path), name, flat=True))
    assert (tmp_path / "captains.csv").exists()
    back = files.read_raw(spark, str(tmp_path), flat=True)
    assert same(back[DIM_CAPTAINS], built.captains)


def test_csv_that_other_writers_quote(spark, tmp_path, built):
    """Doubled quotes, commas, line breaks and an empty text beside a missing one."""
    names = ['Ali ""Abu, Sami"" K', "plain", "two\nlines", "a, b", ""]
    base = built.captains.limit(1).first().asDict()
    header = list(base)
    lines = [",".join(header)]
    for i, name in enumerate(names):
        row = {**base, "captain_id": f"CAP{i}", "name": f'"{name}"'}
        lines.append(",".join(str(row[c]) for c in header))
    lines.append(",".join("" if c == "name" else "CAP9" if c == "captain_id" else str(base[c]) for c in header))
    (tmp_path / "captains.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    schema = star_schemas()[DIM_CAPTAINS]
    read = files.read_csv(spark, str(tmp_path / "captains.csv"), schema, multi_line=True)
    found = dict(values(read, "captain_id", "name"))
    wanted = [n.replace('""', '"') for n in names]
    assert [found[f"CAP{i}"] for i in range(4)] == wanted[:4]
    assert found["CAP9"] is None
    files.write_raw(read, str(tmp_path / "again"))
    assert same(files.read_csv(spark, str(tmp_path / "again"), schema, multi_line=True), read)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_fit_fail_in_either_mode(spark, built, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    schema = star_schemas()[FACT_ORDERS]
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        for column, bad in (("order_time", "2025-01-02"), ("delivery_time_min", "ten")):
            broken = built.orders.limit(2).withColumn(column, F.lit(bad))
            with pytest.raises(Exception, match="does not fit"):
                tables.conform(broken, schema).collect()
        empty = built.orders.limit(2).withColumn("order_time", F.lit(None).cast("string"))
        assert tables.conform(empty, schema).where("order_time IS NULL").count() == 2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_the_fact_is_not_read_through_one_jdbc_task(spark):
    with pytest.raises(ValueError, match="split"):
        tables.jdbc_reader(spark, "jdbc:x:y")
    tables.jdbc_reader(spark, "jdbc:x:y", splits={FACT_ORDERS: ("hour_of_day", "7", "24", 17)})


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:x:y", "FACT_ORDERS")
    assert plain == {"url": "jdbc:x:y", "dbtable": "FACT_ORDERS", "fetchsize": "10000"}
    split = tables.jdbc_options("jdbc:x:y", "T", {"user": "u"}, ("id", "0", "1000", 8))
    assert split["numPartitions"] == "8" and split["partitionColumn"] == "id" and split["user"] == "u"


def test_adapter_profile(spark):
    star = star_from_tables(spark, SMALL)
    status = dict(values(star.orders.groupBy("status").count()))
    assert status == {"delivered": 790, "delayed": 590, "cancelled": 93}
    assert star.orders.filter("is_delayed = 1").count() == 638
    assert star.orders.filter("is_delayed = 1 and status = 'cancelled'").count() == 48
    assert star.orders.join(star.captains, "captain_id", "left_anti").count() == 0
    for name, schema in star_schemas("long").items():
        assert star.tables()[name].dtypes == [(f.name, f.dataType.simpleString()) for f in schema]


def test_working_copy_equals_the_lazy_star(spark):
    lazy = star_from_tables(spark, SMALL)
    copy = working_star(spark, SMALL)
    assert working_star(spark, SMALL).orders is copy.orders
    here = working_copy.star_folder(spark, SMALL).removeprefix("file:").lstrip("/")
    assert here in copy.orders.inputFiles()[0]
    for name, df in lazy.tables().items():
        assert same(copy.tables()[name], df)


def copied_sources(spark, root):
    for name in ("lineitem", "part", "supplier", "nation", "orders"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_working_copy_follows_named_versions_and_released_sources(spark, tmp_path):
    root = copied_sources(spark, tmp_path)
    before = working_star(spark, root, version="one").orders.count()
    seen = working_star(spark, root).orders.count()
    spark.read.parquet(f"{SMALL}/orders.parquet").limit(100).write.mode("overwrite").parquet(f"{root}/orders.parquet")
    assert before == seen == working_star(spark, root, version="one").orders.count()
    assert working_star(spark, root, version="two").orders.count() < before
    assert working_star(spark, root).orders.count() == before
    release_star(spark, root)
    assert working_star(spark, root).orders.count() < before


def test_sources_are_listed_once(spark, tmp_path, monkeypatch):
    root, listed = copied_sources(spark, tmp_path), []
    state = working_copy._source_state
    monkeypatch.setattr(working_copy, "_source_state", lambda *a: listed.append(a) or state(*a))
    for _ in range(3):
        working_star(spark, root).orders.count()
    assert len(listed) == 1
    working_star(spark, root, version="named")
    assert len(listed) == 1


def test_an_unfinished_copy_is_written_again(spark, tmp_path):
    root = copied_sources(spark, tmp_path)
    before = working_star(spark, root).orders
    count, folder = before.count(), working_copy.star_folder(spark, root)
    session.delete_folder(spark, f"{folder}/versions")
    spark.range(1).write.mode("overwrite").parquet(f"{folder}/v-00000001-torn/fact_orders")
    assert working_star(spark, root).orders.count() == count


def test_materialize_keeps_rows_and_types(spark, built):
    df = built.captains.withColumn("x", F.array(F.lit(1)))
    copy = materialize(df, "test")
    assert copy.dtypes == df.dtypes and same(copy, df)


# builders


def test_builder_is_deterministic(spark):
    def rows(partitions, shuffles):
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        try:
            captains = builder.build_captains(spark.range(1, 31, 1, partitions))
            restaurants = builder.build_restaurants(spark.range(1, 21, 1, partitions))
            ids = spark.range(1, 401, 1, partitions)
            return sorted(map(str, builder.build_orders(ids, captains, restaurants).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")

    assert rows(1, 3) == rows(9, 7)


def test_small_and_large_dimensions_give_the_same_orders(spark):
    captains = builder.build_captains(spark.range(1, 31))
    restaurants = builder.build_restaurants(spark.range(1, 21))
    broadcast = builder.build_orders(spark.range(1, 401), captains, restaurants)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = builder.build_orders(spark.range(1, 401), captains, restaurants)
        assert sorted(map(str, merged.collect())) == sorted(map(str, broadcast.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_ids_come_in_small_tasks(spark):
    ids = builder.fresh_ids(spark, 12)
    assert [r["id"] for r in ids.orderBy("id").collect()] == list(range(1, 13))
    assert builder.fresh_ids(spark, 10**9).rdd.getNumPartitions() == 200


def test_builder_refuses_empty_dimensions(spark, built):
    with pytest.raises(ValueError, match="captain"):
        builder.build_orders(spark.range(5), built.captains.limit(0), built.restaurants)


def test_dense_index_is_a_permutation(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    numbers = [r["i"] for r in builder.dense_index(df, "k", "i").collect()]
    assert sorted(numbers) == list(range(5000))


def test_built_orders_follow_the_rules(built):
    orders = built.orders.join(
        built.restaurants.select("restaurant_id", F.col("district").alias("zone"), "avg_prep_time_min"), "restaurant_id"
    )
    n = built.orders.count()
    assert n == 6000
    broken = {
        "zone": F.col("district") != F.col("zone"),
        "hour": F.col("hour_of_day") != F.hour("order_time"),
        "hours": ~F.col("hour_of_day").between(7, 23),
        "day": F.col("day_of_week") != F.date_format("order_time", "EEEE"),
        "range": ~F.to_date("order_time").between(builder.FIRST_DAY, builder.LAST_DAY),
        "seconds": F.second("order_time") != 0,
        "peak": F.col("is_peak_hour") != F.col("hour_of_day").isin(rules.PEAK_HOURS).cast("int"),
        "late": F.col("is_delayed") != (F.col("delivery_time_min") > 50).cast("int"),
        "status": (F.col("status") != "cancelled") & ((F.col("status") == "delayed") != (F.col("is_delayed") == 1)),
        "prep": (F.col("prep_time_min") < 5) | (F.col("prep_time_min") > F.col("avg_prep_time_min") + 5),
        "minutes": F.col("delivery_time_min") < F.col("prep_time_min") + 10,
        "value": ~F.col("order_value_sar").between(15, 350),
        "cents": F.round(F.col("order_value_sar"), 2) != F.col("order_value_sar"),
    }
    found = orders.agg(*[F.count_if(c).alias(k) for k, c in broken.items()]).first().asDict()
    assert found == dict.fromkeys(broken, 0)


def test_built_shares(built):
    n = built.orders.count()
    row = built.orders.agg(
        F.avg("is_peak_hour"), F.count_if(F.col("status") == "cancelled") / n, F.avg("is_delayed")
    ).first()
    assert abs(row[0] - 0.40) < 0.03
    assert 0.05 < row[1] < 0.12
    assert 0.40 < row[2] < 0.70
    days = dict(values(built.orders.groupBy("day_of_week").count()))
    weights = {"Monday": 50, "Tuesday": 50, "Wednesday": 55, "Thursday": 100, "Friday": 100, "Saturday": 75, "Sunday": 60}
    for day, weight in weights.items():
        assert abs(days[day] / n - weight / 490) < 0.03


def test_days_cover_the_range_evenly(spark):
    drawn = draws.with_draws(spark.range(60_000), "id", ["d"], 3)
    days = dict(values(drawn.groupBy(builder.order_day(F.col("d")).alias("day")).count()))
    assert min(days) == builder.FIRST_DAY and max(days) == builder.LAST_DAY
    assert len(days) == 508
    short = drawn.select(builder.order_day(F.col("d"), dt.date(2025, 1, 1), dt.date(2025, 1, 3)).alias("day"))
    assert {v[0].day for v in values(short.distinct())} == {1, 2, 3}
