"""The star written once to the shared folder and read back as Parquet.

Many reports read the same fact. Deriving it costs a shuffle of the largest tables, so
the first use writes it below the shared folder, at an address made from the source and
its version; later uses, also of other applications, scan that copy with column pruning,
filter push-down and exact file sizes for Catalyst's broadcast decision. A lost executor
costs no recomputation.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from courierlens.schemas import star_schemas
from courierlens.session import application_folder, delete_folder, shared_folder
from courierlens.sources.adapter import SOURCE_TABLES, star_from_tables, table_path
from courierlens.sources.tables import Star, save_star
from courierlens.sources.versions import current

_LOCK = threading.Lock()
# versions found by listing, once per application and source
_VERSIONS: dict[tuple[str, str], str] = {}
# open copies by folder and session; each holds its session, so the id stays taken
_OPEN: dict[tuple[str, int], Star] = {}


def _source_state(spark: SparkSession, root: str) -> list[tuple[str, int, int, int]]:
    """Files, bytes and time of each source table."""
    state = []
    for table in SOURCE_TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, table))
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        summary = fs.getContentSummary(path)
        modified = fs.getFileStatus(path).getModificationTime()
        state.append((table, summary.getFileCount(), summary.getLength(), modified))
    return state


def source_version(spark: SparkSession, root: str) -> str:
    """A version from the source's file lists, which are read once per application."""
    key = (spark.sparkContext.applicationId, root)
    if key not in _VERSIONS:
        _VERSIONS[key] = hashlib.sha256(repr(_source_state(spark, root)).encode()).hexdigest()[:16]
    return _VERSIONS[key]


def star_folder(spark: SparkSession, root: str, version: str | None = None) -> str:
    """Where the copy of ``root`` in this version lies.

    A caller that knows the source's version, say a table snapshot, names it and nothing is
    listed. Otherwise the file lists stand for it, as they were at the first use.
    """
    version = version or source_version(spark, root)
    name = hashlib.sha256(repr((root, version)).encode()).hexdigest()[:16]
    return f"{shared_folder(spark)}/courierlens/stars/{name}"


def working_star(spark: SparkSession, root: str, version: str | None = None) -> Star:
    """The star of ``root`` from its working copy, which the first use writes."""
    folder = star_folder(spark, root, version)
    key = (folder, id(spark))
    with _LOCK:
        if current(spark, folder) is None:
            save_star(star_from_tables(spark, root), folder)
            _OPEN.pop(key, None)
        if key not in _OPEN:
            whole, schemas = current(spark, folder), star_schemas("long")
            _OPEN[key] = Star.of(
                {t: spark.read.schema(s).parquet(f"{whole}/{t}") for t, s in schemas.items()}
            )
        return _OPEN[key]


def release_star(spark: SparkSession, root: str, version: str | None = None) -> None:
    """Delete the working copy, and look at the source again at the next use."""
    folder = star_folder(spark, root, version)
    with _LOCK:
        _OPEN.pop((folder, id(spark)), None)
        _VERSIONS.pop((spark.sparkContext.applicationId, root), None)
        delete_folder(spark, folder)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to this application's folder and continue from there.

    Iterative jobs start from the written rows, so neither their lineage nor a lost
    executor reaches back to the joins. The rows go with ``release_application_folder``.
    """
    spark = df.sparkSession
    folder = application_folder(spark, "steps", f"{label}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
