"""Folders that change whole or not at all.

A writer puts everything into a new folder and then adds one empty file, whose name says
which folder is the newest; that file is the only thing that makes the folder visible.
Readers look the name up once and read that folder, whatever is written meanwhile. A writer
that dies before its last step leaves nothing that a reader would see. There is one writer
at a time: of two, the one whose name is the last wins whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from courierlens.session import delete_folder

_LIST = "versions"


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, root: str) -> list[str]:
    path, fs = _path(spark, f"{root.rstrip('/')}/{_LIST}")
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest whole version, if there is one."""
    names = _names(spark, root)
    return _folder(root, names[-1]) if names else None


def publish(spark: SparkSession, root: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Let ``write`` fill a new folder, make it the newest version and return it.

    The ``keep`` newest versions stay, for readers that began before.
    """
    names = _names(spark, root)
    number = int(names[-1].split("-")[1]) + 1 if names else 1
    name = f"v-{number:08d}-{uuid.uuid4().hex[:12]}"
    write(_folder(root, name))
    path, fs = _path(spark, f"{root.rstrip('/')}/{_LIST}/{name}")
    fs.mkdirs(path.getParent())
    fs.createNewFile(path)
    for old in _names(spark, root)[:-keep]:
        # first the name, then the rows: a name never points to half a folder
        delete_folder(spark, f"{root.rstrip('/')}/{_LIST}/{old}")
        delete_folder(spark, _folder(root, old))
    return _folder(root, name)


def marked(spark: SparkSession, root: str, name: str, state: str) -> bool:
    """Whether ``name`` below ``root`` was finished in this state."""
    path, fs = _path(spark, f"{root.rstrip('/')}/marks/{name}.{state}")
    return fs.exists(path)


def mark(spark: SparkSession, root: str, name: str, state: str) -> None:
    """Say that ``name`` below ``root`` is whole in this state, and in no other."""
    path, fs = _path(spark, f"{root.rstrip('/')}/marks/{name}.{state}")
    fs.mkdirs(path.getParent())
    for status in fs.listStatus(path.getParent()):
        if status.getPath().getName().rpartition(".")[0] == name:
            fs.delete(status.getPath(), False)
    fs.createNewFile(path)
