"""Gold tables that follow their source file by file.

The parts of the gold tables can be added up again, so new files of the fact are folded
into the stored parts and older files are never read again. The list of files folded in is
a table of the same version as the parts: both become visible together, or neither does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.operators.measures import PARTS, roll_up
from courierlens.plans.gold import GRAIN
from courierlens.schemas import FACT_ORDERS, star_schemas
from courierlens.sources.versions import current, publish

TABLES = {"gold_cube": GRAIN, "captain_parts": ["captain_id"], "restaurant_parts": ["restaurant_id"]}
_FILES = "files"
_FILE = ["path", "length", "modified"]


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the version it left, the files it read, and whether it began anew."""

    folder: str
    scanned: list[str]
    rebuilt: bool


def source_files(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """(path, length, modified) of the Parquet files below ``source``; no file is opened."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(source)
    )
    return listed.select("path", "length", F.unix_millis("modificationTime").alias("modified"))


def refresh_gold(spark: SparkSession, source: str, store: str, ids: str = "string") -> Refresh:
    """Fold the files of ``source`` that are not yet in ``store`` into its parts.

    * Only new files are scanned. If a file that was folded in has changed or gone, its share
      cannot be taken out again, and all files are folded anew.
    * The new version becomes visible in one step, parts and file list together. A refresh
      that fails before leaves the last version; the next one folds the same files once.
    * Without new files nothing is written.
    """
    last = current(spark, store)
    files = source_files(spark, source)
    known = spark.read.parquet(f"{last}/{_FILES}") if last else None
    rebuilt = known is None or not known.join(files, _FILE, "left_anti").isEmpty()
    fresh = files if rebuilt else files.join(known, _FILE, "left_anti")
    # paths of new files, which the scan needs on the driver anyway
    listed = sorted(tuple(row) for row in fresh.select(*_FILE).collect())
    if not listed and last:
        return Refresh(last, [], False)
    schema = star_schemas(ids)[FACT_ORDERS]
    rows = spark.read.schema(schema)
    orders = rows.parquet(*[path for path, _, _ in listed]) if listed else spark.createDataFrame([], schema)
    folded = spark.createDataFrame(listed, files.schema)

    def write(folder: str) -> None:
        for name, grain in TABLES.items():
            parts = roll_up(orders, grain, PARTS)
            if not rebuilt:
                parts = roll_up(spark.read.parquet(f"{last}/{name}").unionByName(parts), grain, PARTS)
            parts.write.parquet(f"{folder}/{name}")
        (folded if rebuilt else known.unionByName(folded)).write.parquet(f"{folder}/{_FILES}")

    return Refresh(publish(spark, store, write), sorted(orders.inputFiles()), rebuilt)


def stored_gold(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """The gold tables of the newest version, all of the same one."""
    folder = current(spark, store)
    if folder is None:
        raise FileNotFoundError(f"no gold tables below {store}: refresh them first")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in TABLES}
