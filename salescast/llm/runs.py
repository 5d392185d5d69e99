"""Rows that meet in cells: visitors against the rows at home there, with crowded cells cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Visitors of a part for each of its homes.
VISITORS = 4


def split_homes(placed: DataFrame, homes: int, *columns: str) -> DataFrame:
    """(part, ``columns``, home, visit) from (cell, id, ``columns``, home): cells as parts with about ``homes`` homes each.

    A crowded cell is a grid of parts: its homes are dealt to slices, all of its rows to slices of about ``VISITORS * homes``
    visitors, and each slice of homes meets each slice of visitors in a part. So a part is bounded whatever the cell holds,
    and a home meets a visitor of its cell in one part.
    """
    full = (
        placed.groupBy("cell").agg(F.count_if(F.col("home")).alias("h"), F.count(F.lit(1)).alias("v"))
        .where((F.col("h") > homes) | (F.col("v") > VISITORS * homes))
        .select(F.col("cell").alias("full"), F.greatest(F.ceil(F.col("h") / homes), F.lit(1)).alias("down"),
                F.ceil(F.col("v") / (VISITORS * homes)).alias("across")))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    down, across = F.coalesce("down", one), F.coalesce("across", one)
    own = placed.join(full, F.col("cell") == F.col("full"), "left").select(
        "*", F.pmod(F.xxhash64("id"), down).alias("h_own"), F.pmod(F.xxhash64("id", F.lit(1)), across).alias("v_own"))
    at_home = F.when(F.col("home"), F.transform(F.sequence(zero, across - 1), lambda j: F.col("h_own") * across + j))
    visiting = F.transform(F.sequence(zero, down - 1), lambda i: i * across + F.col("v_own"))
    parts = F.when(F.col("full").isNull(), F.array(zero)).otherwise(
        F.array_union(F.coalesce(at_home, F.array().cast("array<bigint>")), visiting))
    return own.select("*", F.explode(parts).alias("nth")).select(
        F.xxhash64("cell", "nth").alias("part"), *columns,
        (F.col("home") & (F.floor(F.col("nth") / across) == F.col("h_own"))).alias("home"),
        (F.pmod(F.col("nth"), across) == F.col("v_own")).alias("visit"))


def whole_keys(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows, regrouped so that all rows of a key are in one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and (cut or held[-1].column(key)[-1].as_py() != keys[0]):
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        elif cut:
            yield batch.slice(0, cut)
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def home_pairs(part: np.ndarray, home: np.ndarray, visit: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (home, visitor of the same part), about ``most`` at a time, of rows sorted by part."""
    homes, visitors = np.flatnonzero(home), np.flatnonzero(visit)
    first, last = (np.searchsorted(part[visitors], part[homes], side=s) for s in ("left", "right"))
    ends, at = np.cumsum(last - first), 0
    while at < len(homes):
        until = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")), at + 1)
        count = (last - first)[at:until]
        left = np.repeat(homes[at:until], count)
        yield left, visitors[np.arange(len(left)) + np.repeat(first[at:until] - (np.cumsum(count) - count), count)]
        at = until
