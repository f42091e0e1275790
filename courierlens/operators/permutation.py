"""Permutation importance: how much a loss grows when one feature's values change places.

Rows are dealt to buckets by a hash of their id and ranked there by that hash; a feature's
value moves a few ranks on, round the end of the bucket. That permutes each feature on its
own with one shuffle of moderate buckets and no global sort. All features are scored in one
pass: a row is repeated once per feature, with that feature replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.operators.split import row_hash
from courierlens.sources.working_copy import materialize

# rows of a bucket on average
PER_BUCKET = 4_096


def moved(rows: DataFrame, row_id: str, features: list[str], buckets: int, seed: int = 42) -> DataFrame:
    """``rows`` with ``moved``: for feature j its value j + 1 ranks on in the bucket, round its end.

    Rows that agree in everything are alike; a bucket's sort and its buffer can spill.
    """
    key = row_hash(F.col(row_id), seed)
    bucket = F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % buckets
    values = F.struct(*features)
    whole = Window.partitionBy("_bucket")
    ranked = whole.orderBy("_key", row_id, *features)
    everything = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = rows.withColumns({"_key": key, "_bucket": bucket})
    heads = F.array(*[F.nth_value(values, i + 1).over(everything) for i in range(len(features))])
    placed = marked.withColumns(
        {
            "_rank": F.row_number().over(ranked) - 1,
            "_size": F.count(F.lit(1)).over(whole),
            "_heads": heads,
            **{f"_next{j}": F.lead(f, j + 1).over(ranked) for j, f in enumerate(features)},
        }
    )
    columns = []
    for j, feature in enumerate(features):
        to = F.col("_rank") + j + 1
        wrapped = F.element_at("_heads", (to % F.col("_size") + 1).cast("int")).getField(feature)
        columns.append(F.when(to < F.col("_size"), F.col(f"_next{j}")).otherwise(wrapped).alias(feature))
    return placed.select(*rows.columns, F.struct(*columns).alias("moved"))


def permutation_importance(
    rows: DataFrame,
    row_id: str,
    features: list[str],
    score: Callable[[DataFrame], DataFrame],
    loss: Column,
    seed: int = 42,
    per_bucket: int = PER_BUCKET,
) -> DataFrame:
    """(feature, n_rows, base_loss, permuted_loss) with the sums of ``loss`` over all scored rows.

    ``score`` adds what ``loss`` needs and must neither drop rows nor look at others.
    """
    # written once: the number of buckets follows from it
    rows = materialize(rows, "permuted-rows")
    placed = moved(rows, row_id, features, max(1, ceil(rows.count() / per_bucket)), seed)
    kept = [c for c in rows.columns if c not in features]

    def variant(replaced: str | None) -> Column:
        taken = [F.col(f"moved.{f}").alias(f) if f == replaced else F.col(f) for f in features]
        return F.struct(F.lit(replaced).cast("string").alias("replaced"), *kept, *taken)

    variants = placed.select(F.inline(F.array(*[variant(f) for f in [None, *features]])))
    sums = score(variants).groupBy("replaced").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(loss).alias("loss"))
    # one row per feature and one without
    sums = materialize(sums, "losses")
    base = F.max(F.when(F.col("replaced").isNull(), F.col("loss"))).over(Window.partitionBy(F.lit(1)))
    return sums.withColumn("base_loss", base).where("replaced IS NOT NULL").select(
        F.col("replaced").alias("feature"), "n_rows", "base_loss", F.col("loss").alias("permuted_loss")
    )
