"""Late orders per district and hour, for a table or a stream of orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courierlens.functions.rules import alert_text
from courierlens.schemas import FACT_ORDERS, star_schemas


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def as_instant(moment: Column) -> Column:
    """A zone-free time as an instant; a watermark accepts nothing else."""
    days = F.unix_date(moment.cast("date")).cast("long")
    return F.timestamp_seconds(
        days * 86_400 + F.hour(moment) * 3_600 + F.minute(moment) * 60 + F.second(moment)
    )


def as_moment(instant: Column) -> Column:
    """Back from the instant, whatever the session's time zone."""
    return _epoch() + F.make_dt_interval(secs=F.unix_seconds(instant).cast("decimal(18,6)"))


def late_orders(orders: DataFrame, every: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Delayed orders per tumbling window and district, with their alert line.

    On a stream the watermark bounds the state: a window is final, and leaves the
    state, once ``lateness`` has passed.
    """
    late = orders.filter(F.col("is_delayed") == 1).withColumn("seen", as_instant(F.col("order_time")))
    if orders.isStreaming:
        late = late.withWatermark("seen", lateness)
    counted = late.groupBy(F.window("seen", every).alias("slot"), "district").agg(
        F.count(F.lit(1)).alias("delayed_orders")
    )
    return counted.select(
        as_moment(F.col("slot.start")).alias("window_start"),
        as_moment(F.col("slot.end")).alias("window_end"),
        "district",
        "delayed_orders",
        alert_text(F.col("district"), F.col("delayed_orders")).alias("alert"),
    )


def order_stream(spark: SparkSession, path: str, ids: str = "string") -> DataFrame:
    """New Parquet files of orders as they arrive."""
    return spark.readStream.schema(star_schemas(ids)[FACT_ORDERS]).parquet(path)


def write_alerts(alerts: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append final windows to ``path``; ``checkpoint`` must be on shared storage."""
    writer = alerts.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).format("parquet").start(path)
