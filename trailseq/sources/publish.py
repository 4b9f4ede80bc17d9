"""Tables that are replaced or grow in whole steps: written aside first, then made current by one small file.

A published path holds

    _versions/<name>/       data as Spark writes it; never changed afterwards
    _manifest/<number>      name of the version that is current from this number on (the highest counts)
    _ledger/<key>           for tables that grow: name of the version that holds the rows of this key

Readers resolve the path first (``data_paths``), so that they see a whole old version or a whole new one. A job that
dies leaves an unnamed version behind, which nobody reads and ``remove_unused`` deletes. Names appear by renaming a
finished file, which file systems and object stores do for one small file at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

VERSIONS, MANIFEST, LEDGER = "_versions", "_manifest", "_ledger"


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its path class."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, make = _fs(spark, folder)
    if not fs.exists(make(folder)):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(make(folder)))
    return sorted(name for name in found if name[0] not in "._")


def _content(spark: SparkSession, file: str) -> str:
    fs, make = _fs(spark, file)
    stream = fs.open(make(file))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def _name_once(spark: SparkSession, file: str, content: str) -> bool:
    """Let ``file`` appear with this content; False if it is there already."""
    fs, make = _fs(spark, file)
    if fs.exists(make(file)):
        return False
    folder, name = file.rsplit("/", 1)
    aside = make(f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    stream.write(bytearray(content.encode("utf-8")))
    stream.close()
    if fs.rename(aside, make(file)):
        return True
    fs.delete(aside, False)
    return False


def _version(df: DataFrame, path: str, write: Callable, label: str) -> str:
    name = f"{label}-{uuid.uuid4().hex}"
    write(df.write.mode("errorifexists"), f"{path}/{VERSIONS}/{name}")
    return name


def publish(df: DataFrame, path: str, write: Callable, keep: int = 2) -> None:
    """Replace the table at ``path``; what was current stays so until the new version is whole.

    ``write(writer, target)`` saves with a DataFrameWriter, e.g. ``lambda w, p: w.json(p)``. The ``keep`` newest versions
    stay for readers that have begun. Two jobs that publish at once make one version after the other current.
    """
    path, spark = path.rstrip("/"), df.sparkSession
    name = _version(df, path, write, "table")
    while True:
        numbers = _names(spark, f"{path}/{MANIFEST}")
        following = f"{int(numbers[-1]) + 1 if numbers else 0:012d}"
        if _name_once(spark, f"{path}/{MANIFEST}/{following}", name):
            break
    old = [n for n in _names(spark, f"{path}/{MANIFEST}")][:-keep]
    fs, make = _fs(spark, path)
    for number in old:
        gone = _content(spark, f"{path}/{MANIFEST}/{number}")
        fs.delete(make(f"{path}/{MANIFEST}/{number}"), False)
        fs.delete(make(f"{path}/{VERSIONS}/{gone}"), True)


def append_once(df: DataFrame, path: str, key: str, write: Callable) -> bool:
    """Add the rows of ``key`` (a batch) to the table at ``path``, once; False if they are there already.

    A replayed batch finds its name in the ledger and writes nothing; a batch that died before its name
    was there is written again as a whole, and what it had written is never read.
    """
    path, spark = path.rstrip("/"), df.sparkSession
    entry = f"{path}/{LEDGER}/{key}"
    fs, make = _fs(spark, entry)
    if fs.exists(make(entry)):
        return False
    return _name_once(spark, entry, _version(df, path, write, f"batch-{key}"))


def _current(spark: SparkSession, path: str) -> list[str] | None:
    numbers = _names(spark, f"{path}/{MANIFEST}")
    if numbers:
        return [f"{path}/{VERSIONS}/{_content(spark, f'{path}/{MANIFEST}/{numbers[-1]}')}"]
    keys = _names(spark, f"{path}/{LEDGER}")
    if keys:
        return [f"{path}/{VERSIONS}/{_content(spark, f'{path}/{LEDGER}/{key}')}" for key in keys]
    return None


def data_paths(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold the rows of ``path`` now; ``path`` itself if nothing was published there.

    A folder inside a published table (``table/split=train``) is found in its current version.
    """
    path = path.rstrip("/")
    if (found := _current(spark, path)) is not None:
        return found
    parent, _, name = path.rpartition("/")
    if parent and "=" in name and (found := _current(spark, parent)) is not None:
        return [f"{folder}/{name}" for folder in found]
    return [path]


def remove_unused(spark: SparkSession, path: str) -> int:
    """Delete versions that no manifest and no ledger entry names; only when no job writes to ``path``."""
    path = path.rstrip("/")
    named = {_content(spark, f"{path}/{kind}/{n}") for kind in (MANIFEST, LEDGER) for n in _names(spark, f"{path}/{kind}")}
    fs, make = _fs(spark, path)
    unused = [v for v in _names(spark, f"{path}/{VERSIONS}") if v not in named]
    for version in unused:
        fs.delete(make(f"{path}/{VERSIONS}/{version}"), True)
    return len(unused)
