"""Saved tables: Parquet folders, catalog tables, a JDBC warehouse."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType, TimestampNTZType

from courierlens.schemas import (
    DIM_CAPTAINS,
    DIM_RESTAURANTS,
    FACT_ORDERS,
    TIMESTAMP_FORMAT,
    star_schemas,
)
from courierlens.sources.versions import current, publish

Reader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Star:
    """One fact and two dimensions."""

    orders: DataFrame
    captains: DataFrame
    restaurants: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            FACT_ORDERS: self.orders,
            DIM_CAPTAINS: self.captains,
            DIM_RESTAURANTS: self.restaurants,
        }

    @staticmethod
    def of(tables: dict[str, DataFrame]) -> Star:
        return Star(tables[FACT_ORDERS], tables[DIM_CAPTAINS], tables[DIM_RESTAURANTS])


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names; warehouses tend to hand them out in capitals."""
    return df.toDF(*[c.lower() for c in df.columns])


def save_table(
    df: DataFrame, name: str, partition_by: list[str] | None = None, path: str | None = None
) -> None:
    """Replace the catalog table ``name``; with ``path`` its files lie there."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def save_star(star: Star, root: str) -> None:
    """Replace the star below ``root``: all three tables become visible together, or none does.

    They are written to a new version folder; a writer that dies leaves the last whole star,
    and a star may be read from the very folder it is saved to.
    """

    def write(folder: str) -> None:
        for name, df in star.tables().items():
            df.write.parquet(f"{folder}/{name}")

    publish(star.orders.sparkSession, root, write)


def parquet_reader(spark: SparkSession, root: str) -> Reader:
    """Tables of the newest star below ``root``, found once, or plain Parquet folders there."""
    folder = current(spark, root) or root.rstrip("/")
    return lambda table: spark.read.parquet(f"{folder}/{table}")


def catalog_reader(spark: SparkSession, database: str | None = None) -> Reader:
    prefix = f"{database}." if database else ""
    return lambda table: spark.table(prefix + table)


def jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split: tuple[str, str, str, int] | None = None,
) -> dict[str, str]:
    """Options of a warehouse scan.

    ``split`` is (numeric or date column, lower, upper, partitions). Without it JDBC
    reads through a single task, which only suits a small dimension.
    """
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **(properties or {})}
    if split:
        column, lower, upper, partitions = split
        options |= {
            "partitionColumn": column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(partitions),
        }
    return options


def jdbc_reader(
    spark: SparkSession,
    url: str,
    properties: dict[str, str] | None = None,
    splits: dict[str, tuple[str, str, str, int]] | None = None,
) -> Reader:
    """Tables of a warehouse; projections and filters are pushed to it by Spark.

    The fact must come with a split, or one task would read all of it.
    """
    if FACT_ORDERS not in (splits or {}):
        raise ValueError(f"reading {FACT_ORDERS} over JDBC needs a split")

    def read(table: str) -> DataFrame:
        options = jdbc_options(url, table.upper(), properties, (splits or {}).get(table))
        return spark.read.format("jdbc").options(**options).load()

    return read


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns in declared order and type; keys keep the type they have.

    Warehouses store times as text and whole numbers as decimals. A value that does
    not fit its declared type fails the job, whether the session is in ANSI mode or not.
    Columns already in type stay untouched, so pruning and push-down still reach the scan.
    """

    def strictly(column: Column, name: str, kind: DataType) -> Column:
        value = column.try_cast(kind)
        message = F.concat(F.lit(f"{name} does not fit {kind.simpleString()}: "), column.cast("string"))
        return F.when(column.isNull() | value.isNotNull(), value).otherwise(F.raise_error(message).cast(kind))

    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        column, kind = F.col(field.name), have[field.name]
        if kind == field.dataType or field.name.endswith("_id"):
            columns.append(column)
        elif isinstance(kind, StringType) and isinstance(field.dataType, TimestampNTZType):
            known = F.when(F.length(column) == len(TIMESTAMP_FORMAT), column).otherwise(F.concat(column, F.lit("?")))
            columns.append(strictly(known, field.name, field.dataType).alias(field.name))
        else:
            columns.append(strictly(column, field.name, field.dataType).alias(field.name))
    return df.select(*columns)


def load_star(read: Reader) -> Star:
    """The star from any reader, with lower-case names and declared types."""
    schemas = star_schemas().items()
    return Star.of({name: conform(normalize_columns(read(name)), schema) for name, schema in schemas})
