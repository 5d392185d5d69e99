import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from salescast.operators import incremental
from salescast.operators.daily import daily_brand_summary
from salescast.sources.star import TIE_BREAK
from salescast.sources.versions import Conflict
from salescast.staging import materialize

CUTS = ("1994-06-01", "1996-01-01", "1997-09-01")


def batches(raw, cuts=CUTS):
    edges = [dt.date(1900, 1, 1), *map(dt.date.fromisoformat, cuts), dt.date(2100, 1, 1)]
    return [raw.where(F.col("sale_date").between(a, b - dt.timedelta(days=1))) for a, b in zip(edges, edges[1:])]


def same(got, want):
    keys = ["category", "brand", "sale_date"]
    a = {tuple(r[k] for k in keys): r for r in got.collect()}
    b = {tuple(r[k] for k in keys): r for r in want.collect()}
    assert a.keys() == b.keys() and sorted(got.columns) == sorted(want.columns)
    for k, r in b.items():
        for c in want.columns:
            x, y = a[k][c], r[c]
            assert x == y or isinstance(y, float) and x == pytest.approx(y, rel=1e-7, abs=1e-7), (k, c, x, y)


@pytest.fixture(scope="module")
def gappy(raw_sales):
    """Sales with missing values of every filled column, also of the target, and rows without a brand or category."""
    return materialize(raw_sales.withColumns({
        "total_sales": F.expr("CASE WHEN k1 % 7 <> 0 THEN total_sales END"),
        "quantity_sold": F.expr("CASE WHEN k1 % 5 <> 0 THEN quantity_sold END"),
        "brand": F.expr("CASE WHEN k1 % 31 <> 0 THEN brand END"),
        "category": F.expr("CASE WHEN k1 % 37 <> 0 THEN category END"),
        "is_holiday": F.expr("CASE WHEN k1 % 11 <> 0 THEN is_holiday END")}), "gappy")


def test_equals_the_full_computation(spark, raw_sales, processed, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "OPEN", 1)
    root = str(tmp_path / "s")
    for i, batch in enumerate(batches(raw_sales, CUTS[1:2])):
        incremental.start(batch, root, TIE_BREAK) if not i else incremental.add(batch, root)
    same(incremental.summary(spark, root), processed)


def test_earlier_rows_are_not_read_again(spark, gappy, tmp_path):
    """The rows of each batch are gone before the next one is added and before the summary is made, and every batch
    moves the medians that stand for missing values of the batches before it."""
    root, want = str(tmp_path / "s"), daily_brand_summary(gappy, TIE_BREAK)
    for i, batch in enumerate(batches(gappy)):
        folder = str(tmp_path / f"rows-{i}")
        batch.write.parquet(folder)
        rows = spark.read.parquet(folder)
        incremental.start(rows, root, TIE_BREAK) if not i else incremental.add(rows, root)
        shutil.rmtree(folder)
    same(incremental.summary(spark, root), want)


ROW = "sale_date date, category string, brand string, region string, k int, total_sales double, quantity_sold double, online_popularity double"


def test_brands_with_one_row_and_brands_that_come_later(spark, tmp_path):
    d = [dt.date(2024, 1, i) for i in range(1, 9)]
    rows = [(d[0], "c", "one", "n", 1, 5.0, 1.0, 2.0), (d[0], "c", "two", "n", 2, None, 1.0, None), (d[1], "c", "two", None, 3, 7.0, 2.0, 3.0),
            (d[3], "c", "two", "s", 4, 1.0, 2.0, 3.0), (d[3], "b", "new", "s", 5, 9.0, 4.0, 3.0), (d[5], "c", "one", "w", 6, 6.0, 2.0, 9.0),
            (d[5], "c", "one", "a", 5, None, None, 9.0), (d[6], "b", "late", "s", 7, 2.0, 4.0, 3.0)]
    raw = spark.createDataFrame(rows, ROW)
    root = str(tmp_path / "s")
    for i, (a, b) in enumerate(((0, 3), (3, 5), (5, 6), (6, 9))):
        batch = raw.where(F.col("sale_date").isin(d[a:b]))
        incremental.start(batch, root, ["k"]) if not i else incremental.add(batch, root)
        same(incremental.summary(spark, root), daily_brand_summary(raw.where(F.col("sale_date") < d[min(b, 7)]), ["k"]))


def test_what_a_state_refuses(spark, tmp_path, monkeypatch):
    d = dt.date(2024, 1, 5)
    raw = spark.createDataFrame([(d, "c", "a", "n", i, float(i), 1.0, 1.0) for i in range(9)], ROW)
    root = str(tmp_path / "s")
    monkeypatch.setattr(incremental, "OPEN", 1)
    incremental.start(raw, root, ["k"])
    with pytest.raises(ValueError, match="ends at 2024-01-05"):
        incremental.add(raw.withColumn("k", F.col("k") + 100), root)
    with pytest.raises(ValueError, match="without a date"):
        incremental.add(raw.withColumn("sale_date", F.lit(None).cast("date")), root)
    with pytest.raises(ValueError, match="columns"):
        incremental.add(raw.drop("region"), root)
    with pytest.raises(ValueError, match="has a state"):
        incremental.start(raw, root, ["k"])
    later = raw.withColumns({"sale_date": F.lit(dt.date(2024, 2, 1)), "total_sales": F.lit(1e6)})

    def overtaken(batch, tails):
        monkeypatch.setattr(incremental, "_check", check)
        incremental.add(batch, root)

    check = incremental._check
    monkeypatch.setattr(incremental, "_check", overtaken)
    with pytest.raises(Conflict):
        incremental.add(later.where("k = 0"), root)
    incremental.add(later.withColumn("sale_date", F.lit(dt.date(2024, 3, 1))), root)
    incremental.add(later.withColumn("sale_date", F.lit(dt.date(2024, 3, 2))), root)
    with pytest.raises(ValueError, match="left its fence"):
        incremental.summary(spark, root)


def test_a_long_fence_is_narrowed(spark, monkeypatch):
    values = spark.range(5000).selectExpr("pow(id, 1.5) AS v", "id % 3 + 1 AS cnt")
    flat = sorted(v for r in values.collect() for v in [r.v] * r.cnt)
    monkeypatch.setattr(incremental, "RANKED", 10)
    for rank in (0, 1, 4321, len(flat) - 1):
        assert incremental._at_rank(values, rank, 5000, flat[0], flat[-1]) == flat[rank]
