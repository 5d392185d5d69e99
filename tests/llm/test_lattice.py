import math

import numpy as np
from pyspark.sql import functions as F

from salescast.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=lattice.COSINE):
    """[(vec_id, n_links, component_id)] by comparing all pairs."""
    ok = [label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
          for _, v, label in rows]
    up = list(range(len(rows)))
    key = [(i is None, i or 0) for i, _, _ in rows]
    links = [0] * len(rows)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    unit = []
    for (_, v, _), good in zip(rows, ok):
        x = np.array(np.array(v, dtype=np.float32), dtype=float) if good else None
        unit.append(None if x is None else x / np.linalg.norm(x / np.abs(x).max()) / np.abs(x).max())
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                up[max(a, b, key=lambda x: key[x])] = min(a, b, key=lambda x: key[x])
    return sorted((str(r[0]), n, str(rows[top(i)][0])) for i, (r, n) in enumerate(zip(rows, links)))


def found(frame, **kw):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in lattice.near_vectors(frame, **kw).collect())


def clustered(n=260, dim=24, seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.7:
            base = np.array(rows[rng.integers(len(rows))][1])
            v = base if rng.random() < 0.2 else base + rng.normal(size=dim) * np.linalg.norm(base) / np.sqrt(dim) * rng.choice([0.02, 0.1, 0.19, 0.22])
        else:
            v = rng.normal(size=dim) * rng.choice([1e-3, 1.0, 50.0])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows


def test_decoding_finds_the_nearest_point():
    x = np.random.default_rng(0).normal(size=(3000, 8)) * 3
    p = lattice.nearest_e8(x)
    near = ((x - p) ** 2).sum(1)
    others = ((x[:, None] - p[:, None] - lattice.roots()[None]) ** 2).sum(2).min(1)
    assert (near <= others + 1e-12).all() and near.max() <= 1 + 1e-9  # the covering radius of E8 is 1
    assert ((p % 1 == 0).all(1) | (p % 1 == 0.5).all(1)).all() and (p.sum(1) % 2 == 0).all()
    assert len(lattice.roots()) == 240 and np.allclose((lattice.roots() ** 2).sum(1), 2)


def test_all_links_of_clusters(spark):
    rows = clustered()
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_crowded_cells_are_cut(spark, monkeypatch):
    rows = clustered(seed=9)
    monkeypatch.setattr(lattice.lattice_links, "__defaults__", (lattice.COSINE, lattice.TABLES, 4))
    monkeypatch.setattr(lattice, "PAIRS", 64)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(5000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    way = rng.normal(size=x.shape)
    way -= (way * x).sum(1)[:, None] * x
    y = 0.98 * x + math.sqrt(1 - 0.98 ** 2) * way / np.linalg.norm(way, axis=1)[:, None]
    met = np.zeros(len(x), dtype=bool)
    for t in range(lattice.TABLES):
        (p, left), (q, rest) = lattice.place(x, t), lattice.place(y, t)
        met |= lattice.visits(p, q, rest) | lattice.visits(q, p, left)
    assert met.mean() > 0.999


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0, 8.0], 0), (4, v, None), (5, None, 0), (6, [0.0] * 4, 0), (7, [nan, 1.0, 1.0, 1.0], 0),
            (8, [None, 1.0, 1.0, 1.0], 0), (9, [inf, 1.0, 1.0, 1.0], 0), (10, v[:3], 0), (11, [], 0), (None, v, 0), (12, v, 1),
            (None, [9.0, -1.0, 0.0, 0.0], 0), (13, [-0.0, 1e-30, 0.0, 0.0], 2), (14, [0.0, 3e30, 0.0, 0.0], 2), (15, [5.0], 0), (16, [7.0], 0)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("id", "n", "a", "b", "cell", "part", "vector", "hash")})
    assert found(frame) == brute(rows)
    kept = {(r.vec_id, r.kept) for r in lattice.near_vectors(frame).collect()}
    assert (1, True) in kept and (2, False) in kept and (None, False) in kept and (12, True) in kept
    assert lattice.near_vectors(frame.limit(0)).count() == 0


def test_embeddings(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert found(frame) == brute([(r.vec_id, r.embedding, r.label) for r in frame.collect()])


def test_parts_of_a_crowded_cell_are_bounded_and_meet_once(spark):
    from salescast.llm import runs

    rows = [(7, i, i % 3 > 0) for i in range(600)] + [(8, i, i == 1000) for i in range(1000, 1300)] + [(9, 1, True), (9, 2, False)]
    dealt = runs.split_homes(spark.createDataFrame(rows, "cell long, id long, home boolean"), 16, "cell", "id").collect()
    by_part = {}
    for r in dealt:
        by_part.setdefault(r.part, []).append(r)
    assert max(map(len, by_part.values())) <= 2 * (16 + 4 * 16)
    met = sorted((h.cell, h.id, v.id) for p in by_part.values() for h in p if h.home for v in p if v["visit"])
    assert met == sorted((c, h, v) for c, h, home in rows if home for d, v, _ in rows if c == d)


def test_different_vectors_of_one_id_are_linked_and_counted_apart(spark):
    v, w, far = [1.0, 0.0, 0.0, 0.0], [1.0, 0.1, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    rows = [(2, v, 0), (2, w, 0), (4, v, 1), (4, far, 1), (3, w, 1), (5, far, 1), (None, v, 2), (None, w, 2), (9, far, 2), (9, far, 2)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    # The brute force names a component by its smallest id too.
    assert got == brute(rows) and ("2", 1, "2") in got and got.count(("4", 1, "3")) == 1 and got.count(("4", 1, "4")) == 1
