"""Will an order be late? Features, class weight, boosted trees, metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.functions.rounding import settled
from courierlens.operators.boosting import BoostedTrees, Encoding, label_tables
from courierlens.operators.encode import encode_columns
from courierlens.operators.metrics import classification_metrics
from courierlens.operators.split import stratified_split
from courierlens.session import ensure_checkpointing
from courierlens.sources.tables import Star
from courierlens.sources.working_copy import materialize

LABEL = "is_delayed"
# fixed values: label columns and the names of their codes
CODES = {
    "weather": "weather_enc",
    "traffic_level": "traffic_enc",
    "day_of_week": "day_enc",
    "district": "district_enc",
    "cuisine_type": "cuisine_enc",
}
# fixed feature order
FEATURES = [
    "hour_of_day",
    "is_peak_hour",
    "order_value_sar",
    "captain_rating",
    "captain_speed",
    "weather_enc",
    "traffic_enc",
    "day_enc",
    "district_enc",
    "cuisine_enc",
]
# fixed learner settings
ROUNDS, DEPTH, STEP, ROW_SHARE, SEED = 200, 6, 0.1, 0.8, 42


def training_rows(star: Star, extra: tuple[str, ...] = ()) -> DataFrame:
    """The order joined with its captain and restaurant, only the columns the model uses.

    Plain joins: Catalyst broadcasts a dimension whose measured size allows it;
    beyond that it sorts and merges, and adaptive skew handling splits hot ids.
    """
    captains = star.captains.select(
        "captain_id",
        F.col("rating").alias("captain_rating"),
        F.col("avg_speed_kmh").alias("captain_speed"),
    )
    restaurants = star.restaurants.select("restaurant_id", "cuisine_type")
    return (
        star.orders.join(captains, "captain_id")
        .join(restaurants, "restaurant_id")
        .select(
            "order_id",
            "hour_of_day",
            "is_peak_hour",
            "order_value_sar",
            "weather",
            "traffic_level",
            "day_of_week",
            "district",
            "captain_rating",
            "captain_speed",
            "cuisine_type",
            *extra,
            LABEL,
        )
    )


def encoded_features(rows: DataFrame) -> DataFrame:
    """Ten numeric features and the label; codes are whole numbers from the rows' own labels."""
    return encode_columns(rows, CODES).select("order_id", *FEATURES, LABEL)


@dataclass(frozen=True)
class DelayRun:
    model: BoostedTrees
    rows: DataFrame  # all rows with their split
    scored: DataFrame  # test rows with predictions

    def added(self) -> list[str]:
        """Columns that scoring added."""
        return [c for c in self.scored.columns if c not in self.rows.columns]

    def metrics(self) -> DataFrame:
        return classification_metrics(self.scored, LABEL, "prediction")


def train(
    star: Star, rounds: int = ROUNDS, depth: int = DEPTH, extra_features: tuple[str, ...] = ()
) -> DelayRun:
    """Weight the classes, hold out a fifth of each, boost trees on the rest.

    The class ratio and the label tables come from all joined rows. ``extra_features`` are
    numeric order columns to learn from as well; ``prep_time_min`` is known once the
    kitchen is done and is the strongest of them.
    """
    spark = star.orders.sparkSession
    ensure_checkpointing(spark)
    rows = materialize(training_rows(star, extra_features), "delay-rows")
    features = [*FEATURES, *extra_features]
    encoding = Encoding.of(label_tables(rows, list(CODES)), CODES, features)
    late, timely = rows.agg(F.count_if(F.col(LABEL) == 1), F.count_if(F.col(LABEL) == 0)).first()
    if not late or not timely:
        raise ValueError("the delay model needs both late and timely orders to learn from")
    rows = materialize(stratified_split(rows, "order_id", LABEL, SEED), "delay-split")
    weight = F.when(F.col(LABEL) == 1, F.lit(timely / late)).otherwise(F.lit(1.0))
    training = rows.filter("split = 'train'").withColumn("weight", weight)
    learner = GBTClassifier(
        labelCol=LABEL,
        featuresCol="features",
        weightCol="weight",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=STEP,
        subsamplingRate=ROW_SHARE,
        seed=SEED,
        checkpointInterval=10,
    )
    model = BoostedTrees.fit(learner, training, encoding)
    return DelayRun(model, rows, model.transform(rows.filter("split = 'test'")))


def importances(
    spark: SparkSession, model: BoostedTrees, k: int | None = None, digits: int | None = 3
) -> DataFrame:
    """Features by importance, highest first; at most one row per feature.

    The order is that of the scores themselves; they are rounded for display after it.
    """
    names = model.encoding.features
    scores = model.learner.featureImportances.toArray()
    rows = spark.createDataFrame(
        [(n, float(s)) for n, s in zip(names, scores)], "feature string, importance double"
    )
    ranked = rows.orderBy(F.desc("importance"), "feature")
    ranked = ranked if k is None else ranked.limit(k)
    return ranked if digits is None else ranked.withColumn("importance", settled(F.col("importance"), digits))


def save_model(model: BoostedTrees, path: str) -> None:
    """Label tables, feature list and trees in one folder, replacing what is there."""
    model.save(path)


def load_model(spark: SparkSession, path: str) -> BoostedTrees:
    return BoostedTrees.load(spark, path)
