"""Embedding near-dedup by lattice hashing: projections decoded to E8 points, with neighbouring cells probed."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.components import components, forest
from salescast.llm.runs import home_pairs, split_homes, whole_keys
from salescast.staging import materialize

COSINE = 0.98
#: Tables, size of a lattice unit on the scale of a random projection of a unit vector, distance to a neighbouring cell
#: (in units) up to which it is probed, seed. A pair at cosine 0.98 lies a tenth of a unit apart on each axis, whatever the
#: number of dimensions.
TABLES, UNIT, REACH, SEED = 3, 2.0, 0.1, 29
#: Pairs compared at a time, and homes of one cell that share a task.
PAIRS, HOMES = 1 << 16, 2048


@lru_cache(maxsize=1)
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: from a cell to each neighbour it shares a face with."""
    pairs = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            pairs.append(v)
    halves = [np.array(s) / 2 for s in product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(pairs + halves)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum: where the sum is odd, the worst rounding goes the other way."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] < 0, -1, 1)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by one half in every direction; the nearer of the two candidates."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


@lru_cache(maxsize=64)
def _projection(dim: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, table, dim])
    return rng.standard_normal((dim, 8)) / UNIT, rng.random(8)


def place(unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Lattice point of each unit vector, and what is left from it.

    The projection is rounded, so that batches of any shape give the same point.
    """
    matrix, offset = _projection(unit.shape[1], table)
    at = np.round((unit @ matrix + offset) * (1 << 20)) / (1 << 20)
    point = nearest_e8(at)
    return point, at - point


def cell_code(points: np.ndarray) -> np.ndarray:
    """A long for each lattice point; the doubled coordinates fit a byte each."""
    return np.ascontiguousarray((2 * points + 128).astype(np.uint8)).view(np.int64).ravel()


def _face() -> float:
    """What a residual times a root must reach for the shared face to lie within REACH."""
    return 1 - REACH * np.sqrt(2)


def visits(point_a: np.ndarray, point_b: np.ndarray, left_b: np.ndarray) -> np.ndarray:
    """Whether each row of b visits the cell of the row of a."""
    way = point_a - point_b
    far = (way ** 2).sum(axis=1)
    return (far == 0) | ((far == 2) & ((left_b * way).sum(axis=1) >= _face()))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    values = batch.column(column)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(values), -1)
    # Scaled first: squares of very large or small components would leave the range of doubles.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _by_dim(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    dims = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        rows = pa.array(np.flatnonzero(dims == dim))
        yield batch.take(rows)


def in_cells(classes: DataFrame, tables: int = TABLES) -> DataFrame:
    """(cell, id, n, vector, home): each vector in the cell of its lattice point and in cells near enough, in all tables."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = roots()
        for whole in batches:
            for batch in (b for lo in range(0, whole.num_rows, 1024) for b in _by_dim(whole.slice(lo, 1024), "vector")):
                unit = _matrix(batch, "vector")
                for table in range(tables):
                    point, left = place(unit, table)
                    row, way = np.nonzero(left @ root.T >= _face())
                    rows = np.concatenate([np.arange(len(unit)), row])
                    points = np.concatenate([point, point[row] + root[way]])
                    taken = batch.take(pa.array(rows))
                    yield pa.record_batch(
                        [taken.column("scope"), pa.array(np.full(len(rows), table, dtype=np.int32)), pa.array(cell_code(points)),
                         taken.column("id"), taken.column("n"), taken.column("vector"),
                         pa.array(np.arange(len(rows)) < len(unit))],
                        names=["scope", "tab", "point", "id", "n", "vector", "home"])

    placed = classes.select("scope", "id", "n", "vector").mapInArrow(
        each, "scope long, tab int, point long, id long, n long, vector array<float>, home boolean")
    return placed.select(F.xxhash64("scope", "tab", "point").alias("cell"), "scope", "tab", "id", "n", "vector", "home")


def _found(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """(a, b, links): links of a to other classes counted in this part, or a link a, b of a connecting forest."""
    for whole in whole_keys(batches, "part"):
        for batch in _by_dim(whole, "vector") if whole.num_rows else ():
            part, ids, n, scope, tab = (batch.column(c).to_numpy() for c in ("part", "id", "n", "scope", "tab"))
            home, visit = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("home", "visit"))
            unit = _matrix(batch, "vector")
            places = {}
            for x, y in home_pairs(part, home, visit, PAIRS):
                same = (scope[x] == scope[y]) & (tab[x] == tab[y]) & (ids[x] != ids[y])
                x, y = x[same], y[same]
                near = (unit[x] * unit[y]).sum(axis=1) >= cosine
                x, y = x[near], y[near]
                if not len(x):
                    continue
                # A pair may meet in several tables, and in a table from both sides: the first meeting counts.
                first = np.ones(len(x), dtype=bool)
                for t in range(int(tab[x].max()) + 1):
                    if t not in places:
                        places[t] = place(unit, t)
                    point, left = places[t]
                    forth = visits(point[x], point[y], left[y])
                    back = visits(point[y], point[x], left[x])
                    first &= ~((tab[x] > t) & (forth | back)) & ~((tab[x] == t) & back & (ids[x] > ids[y]))
                x, y = x[first], y[first]
                if not len(x):
                    continue
                nodes, both = np.unique(np.concatenate([ids[x], ids[y]]), return_inverse=True)
                links = np.zeros(len(nodes), dtype=np.int64)
                np.add.at(links, both, np.concatenate([n[y], n[x]]))
                a, b = forest(both[:len(x)], both[len(x):], len(nodes))
                yield pa.record_batch([
                    pa.array(np.concatenate([nodes, nodes[a]])),
                    pa.array(np.concatenate([nodes, nodes[b]]), mask=np.arange(len(nodes) + len(a)) < len(nodes)),
                    pa.array(np.concatenate([links, np.zeros(len(a), dtype=np.int64)]))], names=["a", "b", "links"])


def lattice_links(classes: DataFrame, cosine: float = COSINE, tables: int = TABLES, homes: int = HOMES) -> DataFrame:
    """(a, b, links) of classes of equal vectors; see ``_found``. No pairs of a group are handed on."""
    placed = materialize(in_cells(classes, tables), "lattice-cells")
    dealt = split_homes(placed, homes, "scope", "tab", "id", "n", "vector")
    return (dealt.repartition("part").sortWithinPartitions("part")
            .mapInArrow(lambda it: _found(it, cosine), "a long, b long, links long"))


def near_vectors(rows: DataFrame, cosine: float = COSINE, tables: int = TABLES) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id (smallest vec_id reachable), kept.

    Vectors of one label and one length are linked where their cosine in double precision is at least
    ``cosine``. Null, empty and zero vectors, vectors with null or non-finite components and those without a label
    link with nothing. Equal vectors are one class, so copies cost a row each. A null vec_id counts
    as larger than any other; rows that repeat a vec_id count as vectors of their own. An empty table gives
    no rows; other columns are not read.
    """
    good = (F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(F.forall(
        "vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists("vector", lambda v: v != 0), F.lit(False)))
    given = materialize(
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vector"),
                    F.col("label").cast("string").alias("label"))
        .select("vec_id", "label", F.when(good, F.col("vector")).alias("vector"))
        .withColumn("hash", F.xxhash64("label", "vector")), "vectors")
    same = given.where("vector is not null").groupBy("hash", "label", "vector")
    classes = materialize(
        same.agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
        # Numbered, as classes of different vectors may share their smallest vec_id.
        .withColumn("id", F.monotonically_increasing_id()).withColumn("scope", F.xxhash64("label")), "vector-classes")
    found = materialize(lattice_links(classes, cosine, tables), "lattice-links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    linked = components(found.where("b is not null").select("a", "b"))
    members = materialize(
        classes.join(counts, F.col("id") == F.col("a"), "left").join(linked, F.col("id") == F.col("node"), "left")
        .where("n > 1 or links > 0").select(
            F.col("hash").alias("s_hash"), F.col("label").alias("s_label"), F.col("vector").alias("s_vector"), "least",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component")),
        "vectors-members")
    heads = materialize(members.groupBy(F.col("component").alias("h_component")).agg(F.min("least").alias("head")), "vectors-heads")
    shared = materialize(
        members.join(heads, F.col("component") == F.col("h_component"))
        .select("s_hash", "s_label", "s_vector", "n_links", "head"), "vectors-linked")
    met = given.join(shared, (F.col("hash") == F.col("s_hash")) & (F.col("label") == F.col("s_label"))
                     & (F.col("vector") == F.col("s_vector")), "left")
    return met.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("head", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
