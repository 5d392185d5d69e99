"""Connected components of links too many for one machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.staging import materialize


def forest(left: np.ndarray, right: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that connect what the given links connect."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while not np.array_equal(jump := label[label], label):
            label = jump
        if np.array_equal(label[left], label[right]):
            nodes = np.flatnonzero(label != np.arange(size))
            return nodes, label[nodes]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node but the smallest of each component, from links (a, b) of longs.

    Large-star and small-star steps in turn: every node's larger neighbours, then its smaller ones, are linked
    to its smallest neighbour, until nothing changes. Links never grow in number, a component of n nodes takes
    about log n rounds, and a node with very many links is a skewed join of two stored tables. Each round is
    written to the shared folder, which cuts the lineage.
    """
    def tidy(rows: DataFrame, name: str) -> DataFrame:
        return materialize(rows.where("u > v").distinct(), name)

    now = tidy(links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v"), "links")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
        both = now.union(now.select("v", "u")).toDF("x", "y")
        least = materialize(both.groupBy("x").agg(F.min("y").alias("m")).selectExpr("x AS k", "least(x, m) AS m"), "least")
        large = tidy(both.where("y > x").join(least, F.col("x") == F.col("k")).selectExpr("y AS u", "m AS v"), "large")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k"), "least")
        joined = large.join(least, F.col("u") == F.col("k"))
        now = tidy(joined.selectExpr("v AS u", "m AS v").union(least.selectExpr("k AS u", "m AS v")), "small")
