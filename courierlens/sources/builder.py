"""Order datasets of any size, drawn from declared distributions.

All three builders start from a frame of ids (``fresh_ids`` for a new dataset) and use only draws tied to the id, so the same seed gives the same
rows on any cluster and after any retry.
"""

from __future__ import annotations

from datetime import date
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courierlens.functions import draws, rules
from courierlens.schemas import DIM_CAPTAINS, DIM_RESTAURANTS, FACT_ORDERS, star_schemas
from courierlens.sources.tables import Star

# fixed domain values
DISTRICT_WEIGHTS = {
    "العليا": 18,
    "النخيل": 15,
    "الملقا": 14,
    "حطين": 12,
    "الياسمين": 11,
    "الورود": 9,
    "السليمانية": 8,
    "المروج": 7,
    "الربوة": 4,
    "الشهداء": 2,
}
WEATHER = ["صافي", "غائم", "عاصف", "حار جداً", "بارد"]
TRAFFIC = ["خفيف", "متوسط", "كثيف", "شديد الكثافة"]
CUISINES = ["برغر", "مندي", "بيتزا", "سوشي", "مشاوي", "فراخ", "حلويات"]
RESTAURANT_PREFIX = "مطعم "
LABELS = rules.Conditions(stormy="عاصف", very_hot="حار جداً", severe="شديد الكثافة", heavy="كثيف")
OFF_PEAK_HOURS = [h for h in rules.OPEN_HOURS if h not in rules.PEAK_HOURS]
PEAK_ORDERS_PERCENT = 40
FIRST_DAY = date(2025, 1, 1)
LAST_DAY = date(2026, 5, 23)
# demand weight per weekday in percent, Monday first
WEEKDAY_WEIGHTS = [10, 10, 11, 20, 22, 15, 12]
CUSTOMERS = 5000
DEFAULT_SIZES = {FACT_ORDERS: 50_000, DIM_CAPTAINS: 200, DIM_RESTAURANTS: 80}
DEFAULT_SEED = 99
ROWS_PER_TASK = 5_000_000
RESTAURANT_NAMES = 40

_INDEX_DIGITS = 3


def _tenths(draw: Column) -> Column:
    return draws.uniform_rounded(draw, 2.5, 5.0, 1)


def build_captains(ids: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """Captains for the ids in column ``id``; names are plain labels."""
    d = draws.with_draws(ids, "id", ["rating", "speed", "hours", "zone", "done", "on_time"], seed + 1)
    return d.select(
        rules.numbered_key("CAP", F.col("id"), 3).alias("captain_id"),
        F.concat(F.lit("captain "), F.col("id").cast("string")).alias("name"),
        _tenths(F.col("rating")).alias("rating"),
        draws.between(F.col("speed"), 20, 60).alias("avg_speed_kmh"),
        draws.between(F.col("hours"), 4, 12).alias("active_hours"),
        draws.weighted_choice(F.col("zone"), DISTRICT_WEIGHTS).alias("district"),
        draws.between(F.col("done"), 50, 5000).alias("total_deliveries"),
        draws.uniform_rounded(F.col("on_time"), 0.60, 0.99, 2).alias("on_time_rate"),
    )


def build_restaurants(ids: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """Restaurants for the ids in column ``id``; names repeat on purpose."""
    d = draws.with_draws(ids, "id", ["label", "kitchen", "prep", "rating", "zone", "done"], seed + 2)
    return d.select(
        rules.numbered_key("REST", F.col("id"), 3).alias("restaurant_id"),
        F.concat(
            F.lit(RESTAURANT_PREFIX), (1 + draws.below(F.col("label"), RESTAURANT_NAMES)).cast("string")
        ).alias("name"),
        draws.choice(F.col("kitchen"), CUISINES).alias("cuisine_type"),
        draws.between(F.col("prep"), 5, 35).alias("avg_prep_time_min"),
        _tenths(F.col("rating")).alias("rating"),
        draws.weighted_choice(F.col("zone"), DISTRICT_WEIGHTS).alias("district"),
        draws.between(F.col("done"), 100, 10_000).alias("total_orders"),
    )


def order_day(draw: Column, first: date = FIRST_DAY, last: date = LAST_DAY) -> Column:
    """A day from ``first`` to ``last``, favoured by weekday.

    Closed form of "draw a day, keep it with chance min(1, 5 * weight)": the kept
    days have chances in proportion to that clipped weight, and the weights repeat
    weekly, so a draw splits into a whole week and a place within the week.
    """
    week = [min(100, 5 * WEEKDAY_WEIGHTS[(first.weekday() + i) % 7]) for i in range(7)]
    days = (last - first).days + 1
    total = (days // 7) * sum(week) + sum(week[: days % 7])
    tick = draws.below(draw, total)
    place = tick % sum(week)
    offset = F.lit(0)
    for i in range(1, 7):
        offset = F.when(place >= sum(week[:i]), F.lit(i)).otherwise(offset)
    whole_weeks = ((tick - place) / F.lit(sum(week))).cast("int")
    return F.date_add(F.lit(first), whole_weeks * 7 + offset)


def dense_index(df: DataFrame, key: str, index: str) -> DataFrame:
    """Number the rows 0..n-1 without sorting them all in one task.

    Rows are numbered inside 4,096 hash buckets of their key; the bucket offsets are
    a running sum over at most 4,096 rows.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(key).cast("string")), 1, _INDEX_DIGITS))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_offset")
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_place", place)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(index, (F.col("_offset") + F.col("_place") - 1).cast("long"))
        .drop("_bucket", "_place", "_offset")
    )


_ORDER_DRAWS = [
    "captain", "restaurant", "day", "peak",
    "hour", "minute", "prep", "leg",
    "weather", "traffic", "customer", "value",
    "cancel", "weather_extra", "traffic_extra", "peak_extra",
    "rating_extra",
]
_EXTRA_DRAW = {
    "stormy": "weather_extra",
    "very_hot": "weather_extra",
    "severe": "traffic_extra",
    "heavy": "traffic_extra",
    "peak": "peak_extra",
    "low_rating": "rating_extra",
}


def build_orders(
    ids: DataFrame,
    captains: DataFrame,
    restaurants: DataFrame,
    seed: int = DEFAULT_SEED,
    partitions: int | None = None,
) -> DataFrame:
    """Orders for the ids in column ``id``, each with a drawn captain and restaurant.

    The dimensions should be stored tables: their file sizes tell Catalyst whether to
    broadcast them. ``partitions`` spreads the ids first; drawing a row costs far more than
    moving its id, so it pays where the source has fewer splits than the cluster has cores.
    """
    riders = captains.select("captain_id", "rating")
    kitchens = restaurants.select("restaurant_id", "district", "avg_prep_time_min")
    n_captains, n_restaurants = riders.count(), kitchens.count()
    if not n_captains or not n_restaurants:
        raise ValueError("orders need at least one captain and one restaurant")
    riders = dense_index(riders, "captain_id", "captain_no")
    kitchens = dense_index(kitchens, "restaurant_id", "restaurant_no")
    ids = ids.select("id") if partitions is None else ids.select("id").repartition(partitions)
    drawn = draws.with_draws(ids, "id", _ORDER_DRAWS, seed).withColumns(
        {
            "captain_no": draws.below(F.col("captain"), n_captains),
            "restaurant_no": draws.below(F.col("restaurant"), n_restaurants),
        }
    )
    joined = drawn.join(riders, "captain_no").join(kitchens, "restaurant_no")

    def hours(values: list[int]) -> Column:
        picks = F.array(*[F.lit(h) for h in values])
        return F.element_at(picks, (draws.below(F.col("hour"), len(values)) + 1).cast("int"))

    conditions = joined.withColumns(
        {
            "hour_of_day": F.when(
                draws.below(F.col("peak"), 100) < PEAK_ORDERS_PERCENT, hours(rules.PEAK_HOURS)
            ).otherwise(hours(OFF_PEAK_HOURS)),
            "weather_label": draws.choice(F.col("weather"), WEATHER),
            "traffic_level": draws.choice(F.col("traffic"), TRAFFIC),
            "prep_time_min": rules.prep_minutes(
                F.col("avg_prep_time_min"), draws.between(F.col("prep"), -3, 5)
            ),
        }
    ).withColumns(
        {
            "order_time": rules.order_moment(
                order_day(F.col("day")), F.col("hour_of_day"), draws.between(F.col("minute"), 0, 59).cast("int")
            ),
            "is_peak_hour": rules.peak_flag(F.col("hour_of_day")),
        }
    )
    timed = conditions.withColumn(
        "delivery_time_min",
        rules.delivery_minutes(
            F.col("prep_time_min"),
            draws.between(F.col("leg"), 10, 35),
            F.col("weather_label"),
            F.col("traffic_level"),
            F.col("is_peak_hour"),
            F.col("rating"),
            LABELS,
            spread=lambda name, width: draws.below(F.col(_EXTRA_DRAW[name]), width),
        ),
    )
    minutes = F.col("delivery_time_min")
    return timed.select(
        rules.numbered_key("ORD", F.col("id"), 6).alias("order_id"),
        rules.numbered_key("CUST", draws.between(F.col("customer"), 1, CUSTOMERS), 5).alias("customer_id"),
        "captain_id",
        "restaurant_id",
        "district",
        "order_time",
        "delivery_time_min",
        "prep_time_min",
        F.col("weather_label").alias("weather"),
        "traffic_level",
        draws.uniform_rounded(F.col("value"), 15, 350, 2).alias("order_value_sar"),
        rules.order_status(
            minutes, F.col("weather_label"), F.col("traffic_level"), LABELS, draws.below(F.col("cancel"), 100)
        ).alias("status"),
        F.col("hour_of_day").cast("long").alias("hour_of_day"),
        rules.day_of_week(F.col("order_time")).alias("day_of_week"),
        "is_peak_hour",
        rules.delayed_flag(minutes).alias("is_delayed"),
    ).select(*star_schemas()[FACT_ORDERS].fieldNames())


def fresh_ids(spark: SparkSession, n: int) -> DataFrame:
    """Ids 1..n in tasks of at most five million rows, so that a lost task costs little."""
    parts = max(spark.sparkContext.defaultParallelism, ceil(n / ROWS_PER_TASK))
    return spark.range(1, n + 1, numPartitions=parts)


def build_star(
    spark: SparkSession,
    orders: int = DEFAULT_SIZES[FACT_ORDERS],
    captains: int = DEFAULT_SIZES[DIM_CAPTAINS],
    restaurants: int = DEFAULT_SIZES[DIM_RESTAURANTS],
    seed: int = DEFAULT_SEED,
) -> Star:
    """A fresh dataset of the given sizes."""
    riders = build_captains(fresh_ids(spark, captains), seed)
    kitchens = build_restaurants(fresh_ids(spark, restaurants), seed)
    return Star(build_orders(fresh_ids(spark, orders), riders, kitchens, seed), riders, kitchens)
