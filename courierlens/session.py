"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from math import ceil

from pyspark.sql import DataFrame, SparkSession

# source bytes one shuffle partition should answer for
BYTES_PER_PARTITION = 256 * 1024 * 1024
_PARTITIONS = "spark.sql.shuffle.partitions"

_LOCAL_SCRATCH: list[tempfile.TemporaryDirectory] = []
# the shared folder of each application, found once: a later checkpoint folder does not move it
_FOLDERS: dict[str, str] = {}


class NoSharedFolder(RuntimeError):
    """The cluster names no folder that driver and executors share."""


def local_session(cores: str = "*", app: str = "courierlens", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def _named_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach; an error when the cluster names none.

    The cluster's ``spark.checkpoint.dir`` always wins. A temporary folder is
    made only for a local master, where driver and executors share one disk.
    """
    application = spark.sparkContext.applicationId
    if application not in _FOLDERS:
        _FOLDERS[application] = _find_shared_folder(spark)
    return _FOLDERS[application]


def _find_shared_folder(spark: SparkSession) -> str:
    named = _named_folder(spark)
    if named:
        return named.rstrip("/")
    if not is_local(spark):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _LOCAL_SCRATCH:
        _LOCAL_SCRATCH.append(tempfile.TemporaryDirectory(prefix="courierlens-"))
    return "file://" + _LOCAL_SCRATCH[0].name


def application_folder(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder that belongs to this application."""
    return "/".join([shared_folder(spark), "courierlens", spark.sparkContext.applicationId, *parts])


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_application_folder(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames that read them end with it."""
    delete_folder(spark, application_folder(spark))


def scan_bytes(df: DataFrame) -> int:
    """File size behind a plain scan, as Catalyst sees it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def size_shuffles(spark: SparkSession, source_bytes: int, per_partition: int = BYTES_PER_PARTITION) -> None:
    """Raise the session's shuffle partitions when the source would overfill them.

    A step of session set-up for whoever owns the session; no query calls it. An
    aggregation's partitions cannot be split at run time, but adaptive execution merges
    those that turn out small; so the number is only ever raised.
    """
    wanted = ceil(source_bytes / per_partition)
    if wanted > int(spark.conf.get(_PARTITIONS)):
        spark.conf.set(_PARTITIONS, str(wanted))


def ensure_checkpointing(spark: SparkSession) -> None:
    """Let iterative learners cut their lineage in the shared folder."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{folder}/courierlens/checkpoints")
