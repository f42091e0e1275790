"""Raw CSV files: one folder per entity, header row, declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from courierlens.schemas import DIM_CAPTAINS, DIM_RESTAURANTS, ENTITIES, TIMESTAMP_FORMAT, star_schemas


# tables whose names may hold line breaks; their files are not split, so the fact is not among them
MULTI_LINE = {DIM_CAPTAINS, DIM_RESTAURANTS}


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Read with a fixed schema; a malformed row or another header fails the job.

    Quotes inside a field are doubled, as most writers do.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_raw(df: DataFrame, path: str) -> None:
    """Write CSV with a header row and no index column, replacing what is there."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def entity_path(base_uri: str, table: str, flat: bool = False) -> str:
    """``<base>/raw/<entity>`` in a landing zone, ``<base>/<entity>.csv`` when flat."""
    base = base_uri.rstrip("/")
    return f"{base}/{ENTITIES[table]}.csv" if flat else f"{base}/raw/{ENTITIES[table]}"


def land(tables: dict[str, DataFrame], base_uri: str) -> dict[str, str]:
    """Write each table to ``<base>/raw/<entity>`` on any file system Spark can reach."""
    paths = {name: entity_path(base_uri, name) for name in tables}
    for name, df in tables.items():
        write_raw(df, paths[name])
    return paths


def read_raw(spark: SparkSession, base_uri: str, ids: str = "string", flat: bool = False) -> dict[str, DataFrame]:
    """The three tables of a landing zone, or of a folder with one CSV file per entity."""
    return {
        name: read_csv(spark, entity_path(base_uri, name, flat), schema, name in MULTI_LINE)
        for name, schema in star_schemas(ids).items()
    }
