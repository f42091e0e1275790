"""Train/test splits that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.sources.working_copy import materialize

_BUCKET_DIGITS = 4
# ceil(0.8 * 16**4) as hex: rows whose hash starts below it are training rows
_TRAIN_BELOW = "cccd"
# a cut is narrowed down by this many hex digits at a time
_STEP_DIGITS = 3
_STEPS = 2


def row_hash(row_id: Column, seed: int) -> Column:
    # the hash is never NULL, which spares joins on it a null check that hashes again
    return F.md5(F.concat(F.coalesce(row_id.cast("string"), F.lit("")), F.lit(f":{seed}")))


def hash_split(row_id: Column, seed: int = 42) -> Column:
    """'train' for four fifths of all ids, 'test' for the rest; no shuffle, no state."""
    bucket = F.substring(row_hash(row_id, seed), 1, _BUCKET_DIGITS)
    return F.when(bucket < _TRAIN_BELOW, "train").otherwise("test")


def stratified_cuts(df: DataFrame, row_id: str, label: str, seed: int = 42) -> DataFrame:
    """Per class, the highest id hash of a training row: (class, cut); ceil(n/5) rows lie above it.

    No class is sorted or gathered: histograms of hash prefixes (at most 4,096 per class and
    step) narrow the cut down to one prefix of six digits, and only that prefix's distinct
    ids are ordered. Rows that repeat an id stay on one side of the cut.
    """
    ids = df.select(F.col(label).alias("class"), row_hash(F.col(row_id), seed).alias("hash"))
    sizes = ids.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    # rows that are still to be taken below the cut, within the prefix found so far
    cut = sizes.select("class", F.lit("").alias("prefix"), (F.col("n") - F.ceil(F.col("n") / 5)).alias("take"))

    def narrowed(rows: DataFrame, cut: DataFrame, key: Column) -> DataFrame:
        """The key that holds the cut, and the rows to take within it."""
        inside = rows.join(cut.withColumnRenamed("class", "of"), F.col("class").eqNullSafe(F.col("of")))
        inside = inside.where(F.startswith("hash", "prefix"))
        counts = inside.groupBy("class", "take", key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("class").orderBy("key"))
        found = counts.withColumn("upto", upto).where((F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("n") < F.col("take")))
        return found.select("class", F.col("key").alias("prefix"), (F.col("take") - F.col("upto") + F.col("n")).alias("take"))

    # each step is written: one row per class, whose size Spark then knows for the join
    for step in range(1, _STEPS + 1):
        cut = narrowed(ids, materialize(cut, "cuts"), F.substring("hash", 1, step * _STEP_DIGITS))
    found = narrowed(ids, materialize(cut, "cuts"), F.col("hash"))
    return materialize(found.select("class", F.col("prefix").alias("cut")), "cuts")


def stratified_split(df: DataFrame, row_id: str, label: str, seed: int = 42) -> DataFrame:
    """Add ``split`` so that exactly ceil(n/5) rows of each class are test rows.

    The cuts are one row per class; a class without one has test rows only.
    """
    names = df.columns
    cuts = stratified_cuts(df, row_id, label, seed).withColumnRenamed("class", "_class")
    marked = df.join(cuts, F.col(label).eqNullSafe(F.col("_class")), "left")
    below = row_hash(F.col(row_id), seed) <= F.col("cut")
    return marked.select(*names, F.when(below, "train").otherwise("test").alias("split"))
