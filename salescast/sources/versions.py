"""Published tables: numbered versions, commits that detect each other, and retention.

A table is a folder with one subfolder a version and a log. An entry of the log is a file named by its version
number that holds the subfolder's name. It is created only if no file of that number exists, which HDFS and object stores with conditional
writes decide atomically, as local files do, so two writers never get the same number and one of them learns of the other.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from pathlib import Path
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"
#: Seconds that a reader waits for an entry that is created but not written yet.
PATIENCE = 10.0


class Conflict(RuntimeError):
    """Another writer has published since the version that this one started from."""


class _Files:
    """The folder of a table, in whatever file system its path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.root = root.rstrip("/")
        self.fs = self.path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def at(self, name: str) -> Any:
        return self.path(f"{self.root}/{name}")

    def names(self, name: str = "") -> list[str]:
        place = self.at(name) if name else self.path(self.root)
        return [s.getPath().getName() for s in self.fs.listStatus(place)] if self.fs.exists(place) else []

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if there is one of this name."""
        if self.fs.getUri().getScheme() == "file":  # Hadoop's local file system looks first and creates then
            place = Path(self.at(name).toUri().getPath())
            place.parent.mkdir(parents=True, exist_ok=True)
            try:
                with place.open("x") as out:
                    out.write(text)
            except FileExistsError:
                return False
            return True
        try:
            out = self.fs.create(self.at(name), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName() or self.fs.exists(self.at(name)):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def text(self, name: str) -> str:
        size = self.fs.getFileStatus(self.at(name)).getLen()
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readNBytes(size)).decode()
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _log(files: _Files) -> list[int]:
    return sorted(int(n) for n in files.names(VERSIONS) if n.isdigit())


def _entry(version: int) -> str:
    return f"{VERSIONS}/{version:020d}"


def current_version(spark: SparkSession, root: str) -> int:
    """The number of the last commit; 0 before the first one."""
    return max(_log(_Files(spark, root)), default=0)


def _commit(files: _Files, version: int, folder: str) -> None:
    if not files.create(_entry(version), folder):
        files.remove(folder)
        raise Conflict(f"version {version} of {files.root} was published by another writer")


def publish(df: DataFrame, root: str, partition_by: tuple[str, ...] = (), expected: int | None = None) -> str:
    """Write ``df`` as the next version of the table ``root`` and return its path.

    Readers of an earlier version are not disturbed, and a failed write leaves no entry. With ``expected``, the number of
    the version that ``df`` was made from, a commit that came in between raises :class:`Conflict` and the written
    data are removed; without it the table is replaced whatever came before.
    """
    spark = df.sparkSession
    files = _Files(spark, root)
    if expected is not None and (now := current_version(spark, root)) != expected:
        raise Conflict(f"{root} is at version {now}, not at {expected}")
    folder = f"v-{uuid.uuid4().hex}"
    path = f"{files.root}/{folder}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    if expected is not None:
        _commit(files, expected + 1, folder)
        return path
    while not files.create(_entry(max(_log(files), default=0) + 1), folder):
        pass  # another writer took the number; this one replaces what it wrote
    return path


def version_path(spark: SparkSession, root: str, version: int | None = None) -> str:
    """The folder of a version, by default of the last one."""
    files = _Files(spark, root)
    numbers = _log(files)
    if not numbers or version is not None and version not in numbers:
        raise FileNotFoundError(root if version is None else f"version {version} of {root}")
    name, until = _entry(numbers[-1] if version is None else version), time.monotonic() + PATIENCE
    while not (folder := files.text(name)):
        if time.monotonic() > until:
            raise TimeoutError(f"{root}/{name} is empty: its writer has not finished the commit")
        time.sleep(0.1)
    return f"{files.root}/{folder}"


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of the table, by default the last one."""
    return spark.read.parquet(version_path(spark, root, version))


def update(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame], partition_by: tuple[str, ...] = ()) -> str:
    """Read the table, change it and publish the result, or raise :class:`Conflict` if someone else has published meanwhile."""
    version = current_version(spark, root)
    return publish(change(read_published(spark, root, version or None)), root, partition_by, expected=version)


def expire(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Remove all versions but the last ``keep``, entries first, and return their numbers.

    Numbers are never given again. Data without an entry stay, as a writer may be about to commit them.
    """
    if keep < 1:
        raise ValueError("the last version is not removed")
    files = _Files(spark, root)
    old = _log(files)[:-keep]
    for version in old:
        folder = files.text(_entry(version))
        files.remove(_entry(version))
        if folder:
            files.remove(folder)
    return old
