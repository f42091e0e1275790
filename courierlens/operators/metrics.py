"""Model metrics as single aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.functions.rounding import half_even, half_up, settled


def _cell(label: str, prediction: str, y: int, p: int) -> Column:
    return F.count_if((F.col(label) == y) & (F.col(prediction) == p))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    return df.agg(
        _cell(label, prediction, 0, 0).alias("tn"),
        _cell(label, prediction, 0, 1).alias("fp"),
        _cell(label, prediction, 1, 0).alias("fn"),
        _cell(label, prediction, 1, 1).alias("tp"),
    )


def classification_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """Confusion cells with accuracy, and precision, recall and F1 of class 1.

    A ratio over nothing is 0, as in the usual classification report.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def share(top: Column, base: Column) -> Column:
        return F.coalesce(half_up(top, base, digits), F.lit(0.0))

    return confusion(df, label, prediction).select(
        "tn",
        "fp",
        "fn",
        "tp",
        share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision_1"),
        share(tp, tp + fn).alias("recall_1"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_1"),
    )


def regression_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """MAE, RMSE and MAPE in percent; only rows with a positive label enter MAPE."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        settled(F.avg(F.abs(error)), digits).alias("mae"),
        settled(F.sqrt(F.avg(error * error)), digits).alias("rmse"),
        settled(F.avg(F.when(y > 0, F.abs(error) / y)) * F.lit(100.0), digits).alias("mape_pct"),
    )


def class_profile(df: DataFrame, label: str) -> DataFrame:
    """Rows, positives, positive share in percent and the negative/positive ratio."""
    positives = F.count_if(F.col(label) == 1)
    negatives = F.count_if(F.col(label) == 0)
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_rows"),
        positives.alias("positives"),
        half_even(positives * 100, n, 1).alias("positive_pct"),
        half_up(negatives, positives, 6).alias("class_ratio"),
    )
