"""How many orders will a slot bring? Slots, boosted trees, scenarios."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import cycle

from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.functions.rounding import half_even
from courierlens.operators import measures as m
from courierlens.operators.boosting import BoostedTrees, Encoding, label_tables
from courierlens.operators.encode import encode_columns
from courierlens.operators.metrics import regression_metrics
from courierlens.operators.split import hash_split
from courierlens.operators.summarize import summarize
from courierlens.plans.delay_model import DEPTH, ROUNDS, ROW_SHARE, SEED, STEP
from courierlens.session import ensure_checkpointing
from courierlens.sources.working_copy import materialize

LABEL = "order_count"
# fixed values: what makes a slot, and the names of its codes
SLOT_KEYS = ["district", "hour_of_day", "day_of_week", "is_peak_hour", "weather", "traffic_level"]
CODES = {
    "district": "district_enc",
    "day_of_week": "day_enc",
    "weather": "weather_enc",
    "traffic_level": "traffic_enc",
}
# fixed feature order; the peak flag is part of the slot but not a feature
FEATURES = ["district_enc", "hour_of_day", "day_enc", "weather_enc", "traffic_enc"]

# fixed sample forecast: five districts in coming peak hours
FORECAST_DISTRICTS = ["العليا", "النخيل", "الملقا", "حطين", "الياسمين"]
FORECAST_HOURS = [20, 20, 13, 13, 21]
SCENARIO_SCHEMA = (
    "district string, hour_of_day bigint, day_of_week string, weather string, traffic_level string"
)


def demand_slots(orders: DataFrame) -> DataFrame:
    """Orders per observed slot; takes the fact or the gold cube."""
    return summarize(orders, SLOT_KEYS, [m.row_count(LABEL)], known_keys_only=True)


def slot_stats(slots: DataFrame) -> DataFrame:
    return slots.agg(
        F.count(F.lit(1)).alias("slots"),
        half_even(F.sum(LABEL), F.count(LABEL), 1).alias("avg_orders"),
        F.max(LABEL).alias("max_orders"),
    )


def slot_id() -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in SLOT_KEYS])


def split_slots(slots: DataFrame) -> DataFrame:
    return slots.withColumn("split", hash_split(slot_id(), SEED))


def mean_predictor(split: DataFrame, by: list[str]) -> DataFrame:
    """Test slots scored with the training mean of their group: the bar a model must clear.

    A group without training slots gets the mean of all training slots.
    """
    training = split.filter("split = 'train'")
    means = training.groupBy(*by).agg(F.avg(LABEL).alias("of_group"))
    overall = training.agg(F.avg(LABEL)).first()[0]
    scored = split.filter("split = 'test'").join(means, by, "left")
    return scored.withColumn("prediction", F.coalesce("of_group", F.lit(overall).cast("double"))).drop("of_group")


def encoded_slots(slots: DataFrame) -> DataFrame:
    """The slots with their codes, split and label, as the learner sees them."""
    coded = encode_columns(split_slots(slots), CODES)
    return coded.select(*SLOT_KEYS, *[c for c in FEATURES if c not in SLOT_KEYS], "split", LABEL)


@dataclass(frozen=True)
class DemandRun:
    model: BoostedTrees
    slots: DataFrame
    scored: DataFrame

    def added(self) -> list[str]:
        """Columns that scoring added."""
        return [c for c in self.scored.columns if c not in self.slots.columns]

    def metrics(self) -> DataFrame:
        return regression_metrics(self.scored, LABEL, "prediction")


def train(
    orders: DataFrame, rounds: int = ROUNDS, depth: int = DEPTH, row_share: float = ROW_SHARE, least_rows: int = 1
) -> DemandRun:
    """Aggregate to slots first; the learner never sees the fact.

    Each round learns from a share of the rows, and no side of a split has fewer than
    ``least_rows``. With all rows in every round the trees follow from the slots alone.
    """
    ensure_checkpointing(orders.sparkSession)
    slots = materialize(split_slots(demand_slots(orders)), "demand-slots")
    encoding = Encoding.of(label_tables(slots, list(CODES)), CODES, FEATURES)
    learner = GBTRegressor(
        labelCol=LABEL,
        featuresCol="features",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=STEP,
        subsamplingRate=row_share,
        minInstancesPerNode=least_rows,
        seed=SEED,
        lossType="squared",
        checkpointInterval=10,
    )
    model = BoostedTrees.fit(learner, slots.filter("split = 'train'"), encoding)
    return DemandRun(model, slots, model.transform(slots.filter("split = 'test'")))


def sample_scenarios(
    spark: SparkSession, districts: list[str] | None = None, weather: str = "صافي", traffic: str = "كثيف"
) -> DataFrame:
    """One coming Thursday peak hour per district, given by name, not by code."""
    rows = [
        (district, hour, "Thursday", weather, traffic)
        for district, hour in zip(districts or FORECAST_DISTRICTS, cycle(FORECAST_HOURS))
    ]
    return spark.createDataFrame(rows, SCENARIO_SCHEMA)


def score_scenarios(model: BoostedTrees, scenarios: DataFrame) -> DataFrame:
    """Expected orders per scenario; a label the model never saw gives NULL."""
    scored = model.transform(scenarios, strict=False)
    return scored.select(*scenarios.columns, F.bround("prediction", 0).alias("predicted_orders"))
