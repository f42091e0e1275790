"""Label encoding: 0..n-1 in code-point order, unseen values are errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def code_table(df: DataFrame, column: str) -> DataFrame:
    """(label, code) of a column's distinct labels.

    Labels are numbered within their first character, and characters are offset by a
    running sum over at most as many rows as there are first characters.
    """
    first = F.substring("label", 1, 1)
    labels = df.select(F.col(column).alias("label")).where(F.col("label").isNotNull()).distinct()
    labels = labels.withColumn("first", first)
    sizes = labels.groupBy("first").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("first", (F.sum("n").over(Window.orderBy("first")) - F.col("n")).alias("offset"))
    place = F.row_number().over(Window.partitionBy("first").orderBy("label"))
    placed = labels.withColumn("place", place).join(offsets, "first")
    return placed.select("label", (F.col("offset") + F.col("place") - 1).cast("long").alias("code"))


def attach_codes(
    df: DataFrame, tables: dict[str, DataFrame], outputs: dict[str, str], strict: bool = True
) -> DataFrame:
    """``df`` with a code column per label column, joined from tables (label, code).

    A NULL and a label that its table does not hold are errors, or else have a NULL code.
    """

    def add(rows: DataFrame, names: tuple[str, str]) -> DataFrame:
        column, output = names
        codes = tables[column].select(F.col("label").alias(column), F.col("code").alias(output))
        joined = rows.join(codes, column, "left")
        if not strict:
            return joined
        missing = F.when(F.col(column).isNull(), F.lit(f"NULL value in {column}")).otherwise(
            F.concat(F.lit(f"Unseen label in {column}: "), F.col(column).cast("string"))
        )
        found = F.when(F.col(output).isNotNull(), F.col(output)).otherwise(F.raise_error(missing).cast("long"))
        return joined.withColumn(output, found)

    return reduce(add, outputs.items(), df)


def encode_columns(df: DataFrame, outputs: dict[str, str]) -> DataFrame:
    """``df`` with a code column per label column, by joins with the code tables of its own rows.

    A NULL label is an error, as it is for the learner's encoder.
    """
    return attach_codes(df, {c: code_table(df, c) for c in outputs}, outputs)


def known_labels(wanted: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Keep the rows whose label is in a table (label, code)."""
    return wanted.join(table.select(F.col("label").alias(column)), column, "left_semi")
