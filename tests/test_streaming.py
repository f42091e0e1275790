from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from courierlens.functions.rules import day_of_week, moment_text
from courierlens.streaming import raised
from courierlens.streaming.alerts import late_orders, order_stream, write_alerts


def test_stream_of_files_equals_the_batch(spark, make, tmp_path):
    def orders(day, prefix):
        base = dt.datetime(2025, 1, day, 10, 0)
        late = [
            {"order_id": f"{prefix}{i}", "is_delayed": 1, "order_time": base + dt.timedelta(minutes=17 * i)}
            for i in range(12)
        ]
        return make([*late, {"order_id": f"{prefix}x", "order_time": base}]).orders

    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for day in (1, 2):
        orders(day, f"d{day}-").write.mode("append").parquet(source)
        write_alerts(late_orders(order_stream(spark, source)), sink, checkpoint, once=True).awaitTermination()
    # one order far ahead moves the watermark past every window above
    orders(9, "d9-").write.mode("append").parquet(source)
    write_alerts(late_orders(order_stream(spark, source)), sink, checkpoint, once=True).awaitTermination()

    columns = ("window_start", "district", "delayed_orders", "alert")
    final = values(spark.read.parquet(sink).filter("window_start < '2025-01-05'"), *columns)
    batch = late_orders(spark.read.parquet(source)).filter("window_start < '2025-01-05'")
    assert sorted(final) == sorted(values(batch, *columns))
    assert sum(v[2] for v in final) == 24


def test_windows_do_not_depend_on_the_session_zone(spark, make):
    # 02:30 on this day does not exist in the first zone; the second is off by half an hour
    orders = make([{"is_delayed": 1, "order_time": dt.datetime(2025, 3, 9, 2, 30)}]).orders
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Kolkata", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert values(late_orders(orders), "window_start", "window_end") == [
                (dt.datetime(2025, 3, 9, 2), dt.datetime(2025, 3, 9, 3))
            ]
            text = orders.select(moment_text(F.col("order_time")), day_of_week(F.col("order_time")))
            assert values(text) == [("2025-03-09 02:30:00", "Sunday")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


WATCH = raised.Watch(bound=3, every=3_600, lateness=7_200)


def hours(make, counts, prefix):
    """Delayed orders by (hour, district), with an order in time now and then."""
    base = dt.datetime(2025, 1, 1)
    rows = []
    for (hour, district), n in counts.items():
        for i in range(n):
            moment = base + dt.timedelta(hours=hour, minutes=(7 * i) % 60)
            rows.append({"order_id": f"{prefix}{hour}{district}{i}", "is_delayed": 1, "district": district, "order_time": moment})
        rows.append({"order_id": f"{prefix}{hour}{district}x", "district": district, "order_time": base + dt.timedelta(hours=hour)})
    return rows


ALERTS = ("window_start", "district", "raised_at", "alert")


def test_alerts_are_raised_at_the_bound_and_its_doublings(make):
    counts = {(0, "a"): 2, (0, "b"): 3, (1, "a"): 5, (1, "b"): 6, (2, "a"): 24, (2, None): 12}
    found = values(raised.raised_alerts(make(hours(make, counts, "o")).orders, WATCH), "window_start", "district", "raised_at")
    wanted = [
        (dt.datetime(2025, 1, 1, hour), district, 3 << k)
        for (hour, district), n in counts.items()
        for k in range(10)
        if 3 << k <= n
    ]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_a_shuffled_and_restarted_stream_raises_what_the_table_does(spark, make, tmp_path, monkeypatch):
    counts = {(h, d): (5 * h + 3 * i) % 14 for h in range(6) for i, d in enumerate("abc")}
    rows = hours(make, counts, "s")
    random.Random(1).shuffle(rows)
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "alerts", "check"))
    watch = raised.Watch(bound=3, every=3_600, lateness=10 * 3_600)

    def run():
        raised.raise_alerts(order_stream(spark, source), root, checkpoint, watch, once=True).awaitTermination()

    publish = raised.publish
    for n, at in enumerate(range(0, len(rows), 40)):
        make(rows[at : at + 40]).orders.write.mode("append").parquet(source)
        if n == 1:
            # the batch is lost after all was written, before it became visible
            def lost(spark, where, write):
                write(f"{where}/v-00000001-lost")
                raise OSError("lost")

            monkeypatch.setattr(raised, "publish", lost)
            with pytest.raises(Exception, match="lost"):
                run()
            monkeypatch.setattr(raised, "publish", publish)
        run()
    table = raised.raised_alerts(spark.read.parquet(source), watch)
    assert sorted(values(raised.stored_alerts(spark, root), *ALERTS)) == sorted(values(table, *ALERTS))
    assert raised.late_counts(spark, root).count() == 0


def test_a_batch_is_folded_once_and_late_orders_are_counted(spark, make, tmp_path):
    root = str(tmp_path / "alerts")
    batches = [
        hours(make, {(0, "a"): 2, (1, "a"): 4}, "x"),
        hours(make, {(5, "a"): 3}, "y"),  # closes the first two windows for the next batch
        hours(make, {(0, "a"): 7, (5, "a"): 4, (1, "b"): 2}, "z"),
    ]
    for number, rows in enumerate(batches):
        for _ in range(2):
            raised.fold_batch(make(rows).orders, number, root, WATCH)
    day = dt.datetime(2025, 1, 1)
    found = values(raised.stored_alerts(spark, root), "window_start", "district", "raised_at")
    assert sorted(found) == [(day + dt.timedelta(hours=1), "a", 3), (day + dt.timedelta(hours=5), "a", 3), (day + dt.timedelta(hours=5), "a", 6)]
    late = values(raised.late_counts(spark, root))
    assert sorted(late) == [(day, "a", 7), (day + dt.timedelta(hours=1), "b", 2)]


def test_a_stream_without_delayed_orders_raises_nothing(spark, make, tmp_path):
    root = str(tmp_path / "alerts")
    raised.fold_batch(make([{}, {"order_time": None, "is_delayed": 1}]).orders, 0, root, WATCH)
    raised.fold_batch(make([]).orders, 1, root, WATCH)
    assert raised.stored_alerts(spark, root).count() == raised.late_counts(spark, root).count() == 0
