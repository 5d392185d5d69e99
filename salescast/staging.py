"""Durable intermediate tables, and their removal."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

#: Folders that stand, by the scope they were written in; the last scope is the innermost.
_SCOPES: list[list[tuple[SparkSession, str]]] = [[]]
#: Whether the shuffle files of a finished execution are removed; Spark 4.1 has the setting, earlier versions ignore it.
_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    chosen = tempfile.mkdtemp(prefix="salescast-")
    spark.conf.set("spark.checkpoint.dir", chosen)
    return chosen


def materialize(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several branches: it is computed once, its lineage
    is cut, and a lost executor costs a re-read instead of a recomputation. The table
    stands until the innermost :func:`scope` ends, or else until the program does. ``codec`` compresses the files.
    """
    spark = df.sparkSession
    path = scoped_folder(spark, label)
    with _swept(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Like :func:`materialize` for what ``make`` returns; the tables that ``make`` stores on the way are removed then."""
    path = scoped_folder(spark, label)
    with scope(), _swept(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, label: str, key: str, buckets: int | None = None, codec: str = "snappy") -> DataFrame:
    """Like :func:`materialize`, stored in buckets of ``key``: windows, groups and joins by it then need no exchange.

    There are as many buckets as shuffle partitions unless ``buckets`` says otherwise, one file each.
    """
    count = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bucketed(df.repartition(count, key), label, key, count, codec)


def bucketed(df: DataFrame, label: str, key: str, count: int, codec: str = "snappy") -> DataFrame:
    """Like :func:`clustered` for rows that are dealt already; a task writes a file for each bucket it has rows of."""
    spark = df.sparkSession
    path = scoped_folder(spark, label)
    name = f"{label}_{path.rsplit('-', 1)[1]}".replace("-", "_")
    with _swept(spark):
        df.write.bucketBy(count, key).option("path", path).option("compression", codec).format("parquet").saveAsTable(name)
    return spark.table(name)


@contextmanager
def _swept(spark: SparkSession) -> Iterator[None]:
    """Let the shuffle files of the writes inside go when these end, instead of when the driver collects its garbage.

    Later reads are of the written table, so the disk holds one step's shuffles at a time.
    """
    before = spark.conf.get(_SWEEP, "false")
    spark.conf.set(_SWEEP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SWEEP, before)


def scoped_folder(spark: SparkSession, label: str) -> str:
    """A folder of the shared one that goes with the innermost :func:`scope`."""
    path = f"{shared_dir(spark)}/salescast/{label}-{uuid.uuid4().hex}"
    _SCOPES[-1].append((spark, path))
    return path


def _remove(tables: list[tuple[SparkSession, str]]) -> None:
    while tables:
        spark, path = tables.pop()
        gateway = spark.sparkContext._jvm
        place = gateway.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def removed(stored: DataFrame) -> None:
    """Remove a table that was stored here before its scope ends; nothing may read it any more."""
    files = stored.inputFiles()
    for tables in _SCOPES:
        for table in [t for t in tables if files and f"/{t[1].rsplit('/', 1)[1]}/" in files[0]]:
            tables.remove(table)
            _remove([table])


@contextmanager
def scope() -> Iterator[None]:
    """Remove the tables that :func:`materialize` writes inside, at its end.

    A query's result may read such tables until it is written, so its action belongs inside too.
    """
    tables: list[tuple[SparkSession, str]] = []
    _SCOPES.append(tables)
    try:
        yield
    finally:
        _SCOPES.remove(tables)
        _remove(tables)


@atexit.register
def _remove_rest() -> None:
    with suppress(Exception):  # the session may be gone; its folder then stays
        _remove(_SCOPES[0])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition by ``keys`` when the input has fewer splits than there are cores.

    A large table has far more splits than cores and is returned untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
