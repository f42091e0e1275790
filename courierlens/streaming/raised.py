"""Alerts that are raised once: when the delayed orders of a district and window reach a bound, and at each doubling.

Which alerts there are depends on the final counts alone, so a table and a stream of the
same orders give the same rows, whatever the order of arrival. The stream keeps its counts
of open windows in a versioned folder together with the number of the last batch, so a
batch that is run again after a failure changes nothing. Orders that come when their window
is closed raise nothing, but are counted per window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courierlens.functions.rules import alert_text
from courierlens.sources.versions import current, publish
from courierlens.streaming.alerts import as_instant, as_moment

_COUNTS = "start long, district string, n long"


@dataclass(frozen=True)
class Watch:
    """Windows of ``every`` seconds, the first ``bound``, and how late an order may come."""

    bound: int = 10
    every: int = 3_600
    lateness: int = 3_600


def _levels(n: Column, bound: int) -> Column:
    """How often ``n`` has doubled since the bound; -1 below it."""
    return F.when(n >= bound, F.length(F.bin(F.floor(n / bound))) - 1).otherwise(-1).cast("int")


def _window_counts(orders: DataFrame, watch: Watch) -> DataFrame:
    seconds = F.unix_seconds(as_instant(F.col("order_time")))
    start = (F.floor(seconds / watch.every) * watch.every).cast("long")
    delayed = orders.where((F.col("is_delayed") == 1) & F.col("order_time").isNotNull())
    return delayed.groupBy(start.alias("start"), "district").agg(F.count(F.lit(1)).alias("n"))


def _raised(counts: DataFrame, before: Column, watch: Watch) -> DataFrame:
    """One row for each level above that of ``before`` that a count has reached."""
    first, last = _levels(before, watch.bound) + 1, _levels(F.col("n"), watch.bound)
    reached = counts.where(last >= first).withColumn("level", F.explode(F.sequence(first, last)))
    raised_at = F.lit(watch.bound).cast("long") * F.pow(F.lit(2.0), F.col("level")).cast("long")
    return reached.select(
        as_moment(F.timestamp_seconds("start")).alias("window_start"),
        "district",
        raised_at.alias("raised_at"),
        alert_text(F.col("district"), raised_at).alias("alert"),
    )


def raised_alerts(orders: DataFrame, watch: Watch = Watch()) -> DataFrame:
    """All alerts of a table of orders."""
    return _raised(_window_counts(orders, watch), F.lit(0), watch)


def fold_batch(orders: DataFrame, batch_id: int, root: str, watch: Watch) -> None:
    """Add one batch of arriving orders to the counts below ``root`` and write the alerts it raises.

    A window closes once the latest order of earlier batches lies ``lateness`` beyond its
    end; it then leaves the state. A batch that was folded in already is left out.
    """
    spark = orders.sparkSession
    last = current(spark, root)
    mark = spark.read.parquet(f"{last}/mark").first() if last else None
    if mark and mark.batch_id >= batch_id:
        return
    seen = mark.seen if mark else None
    closed = F.lit(None if seen is None else seen - watch.lateness).cast("long")
    ends = F.col("start") + watch.every

    def write(folder: str) -> None:
        _window_counts(orders, watch).write.parquet(f"{folder}/batch")
        counted = spark.read.schema(_COUNTS).parquet(f"{folder}/batch")
        missed = F.coalesce(ends <= closed, F.lit(False))
        counted.where(missed).select(
            as_moment(F.timestamp_seconds("start")).alias("window_start"), "district", F.col("n").alias("late_orders")
        ).write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
        before = spark.read.schema(_COUNTS).parquet(f"{last}/open") if last else spark.createDataFrame([], _COUNTS)
        both = before.withColumn("old", F.col("n")).unionByName(counted.where(~missed).withColumn("old", F.lit(0).cast("long")))
        both.groupBy("start", "district").agg(F.sum("n").alias("n"), F.sum("old").alias("old")).write.parquet(f"{folder}/merged")
        merged = spark.read.schema(f"{_COUNTS}, old long").parquet(f"{folder}/merged")
        _raised(merged, F.col("old"), watch).write.mode("overwrite").parquet(f"{root}/alerts/batch={batch_id}")
        latest = orders.agg(F.max(F.unix_seconds(as_instant(F.col("order_time"))))).first()[0]
        now = max((t for t in (seen, latest) if t is not None), default=None)
        # what the next batch will find closed leaves the state
        still = merged if now is None else merged.where(ends > now - watch.lateness)
        still.drop("old").write.parquet(f"{folder}/open")
        spark.createDataFrame([(batch_id, now)], "batch_id long, seen long").write.parquet(f"{folder}/mark")

    publish(spark, root, write)


def raise_alerts(
    orders: DataFrame, root: str, checkpoint: str, watch: Watch = Watch(), once: bool = False
) -> StreamingQuery:
    """Fold a stream of orders batch by batch; ``root`` and ``checkpoint`` are on shared storage."""
    trigger = {"availableNow": True} if once else {"processingTime": "1 minute"}
    folded = orders.writeStream.foreachBatch(lambda batch, number: fold_batch(batch, number, root, watch))
    return folded.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _up_to_mark(spark: SparkSession, root: str, name: str) -> DataFrame:
    last = spark.read.parquet(f"{current(spark, root)}/mark").first().batch_id
    return spark.read.parquet(f"{root}/{name}").where(F.col("batch") <= last)


def stored_alerts(spark: SparkSession, root: str) -> DataFrame:
    """The alerts that the stream has raised so far; a batch that did not end has none."""
    return _up_to_mark(spark, root, "alerts").drop("batch")


def late_counts(spark: SparkSession, root: str) -> DataFrame:
    """Delayed orders per window and district that came after it was closed."""
    late = _up_to_mark(spark, root, "late")
    return late.groupBy("window_start", "district").agg(F.sum("late_orders").alias("late_orders"))
