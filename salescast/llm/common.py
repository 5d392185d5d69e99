"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: What separates words, namely the space and the characters 9 to 13. ``bytes.split()`` and
#: Arrow's ASCII split use the same set.
WORD = r"[^\x20\x09-\x0D]+"

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def text_of(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows with the largest values of the long ``column``, at most ``most``; rows with equal values stay or go together.

    The least value that still fits comes from the number of rows of each value, so no rows are sorted or gathered.
    """
    kinds = counts.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    down = Window.orderBy(F.col(column).desc())
    least = kinds.withColumn("until", F.sum("rows").over(down)).where(F.col("until") <= most).agg(F.min(column)).first()[0]
    return counts.where(F.col(column) >= least) if least is not None else counts.limit(0)


def short_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of 2,000 rows where the session has Spark's default of 10,000.

    A batch of long texts is held by the executor and by its worker at the same time; another setting is left alone.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "2000")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; the fold of a null id is that of empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def uniform(key: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 that depends on nothing but ``key`` and ``seed``."""
    return (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)


def repeats(rows: DataFrame, *columns: str) -> bool:
    """Whether any value of ``columns`` stands in several rows; one aggregated row comes back."""
    return not rows.groupBy(*columns).count().where("count > 1").isEmpty()


def keep_rows(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose key stands in ``dropped``; a null key equals a null key.

    The narrow side becomes the hash table of a partition, so that the texts are shuffled at most once
    and never sorted.
    """
    name = "gone"
    while name in map(str.lower, docs.columns):
        name += "_"
    gone = dropped.select(F.col(key).alias(name)).distinct().hint("shuffle_hash")
    return docs.join(gone, F.col(key).eqNullSafe(F.col(name)), "left_anti")


def one_row(rows: DataFrame, *keys: str) -> DataFrame:
    """Of the rows with equal ``keys``, the whole ``row`` with the least hash, whatever order they come in."""
    return rows.groupBy(*keys).agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def words_of(texts: pa.Array, lower: bool = True) -> pa.ListArray:
    """The words of each text, with A-Z lowered."""
    if texts.offset:  # the cast to large strings misreads slices
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    # The split leaves an empty word before leading and after trailing space.
    flat, parents = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.not_equal(flat, "")
    flat, parents = flat.filter(full), parents.filter(full)
    counts = np.bincount(parents.to_numpy(zero_copy_only=False), minlength=len(texts))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), flat)


def batches_by_size(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Regroup into batches of about ``most`` bytes of ``column``, so that memory follows bytes, not rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start, run = np.cumsum(lengths), 0, 0
        while start < batch.num_rows:
            stop = max(int(np.searchsorted(ends, run + most - size, side="right")), start + (not held))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1] - run)
                run, start = int(ends[stop - 1]), stop
            if start < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
