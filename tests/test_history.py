import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salescast.operators import history
from salescast.operators.history import add_sales_history, fill_forward_back, ordered_buckets
from tests import brute

SCHEMA = "brand string, sale_date date, k1 long, k2 int, total_sales double"
DAY = dt.date(2024, 1, 1)


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = add_sales_history(df, tie_break=("k1", "k2"), **kw).collect()
    records = [r.asDict() for r in got]
    lag, mean = brute.history(records, "brand", "sale_date", ("k1", "k2"), "total_sales")
    assert len(got) == len(rows)
    for i, r in enumerate(records):
        assert r["sales_lag_1"] == lag[i], r
        assert r["sales_ma_3"] == pytest.approx(mean[i], rel=1e-12), r
    return records


def random_rows(n, brands, days, seed, null_dates=False):
    rng = random.Random(seed)
    keys = rng.sample(range(n * 5), n)
    return [(f"b{rng.randrange(brands)}",
             None if null_dates and rng.random() < 0.1 else DAY + dt.timedelta(days=rng.randrange(days)),
             k, rng.randrange(3), round(rng.uniform(1, 100), 2)) for k in keys]


def test_many_days_with_null_dates(spark):
    check(spark, random_rows(400, 4, 60, 1, null_dates=True))


def test_one_row_and_two_row_brands(spark):
    got = check(spark, [("solo", DAY, 1, 1, 5.0), ("pair", DAY, 1, 1, 2.0), ("pair", DAY, 2, 1, 8.0)])
    lags = {(r["brand"], r["k1"]): r["sales_lag_1"] for r in got}
    assert lags == {("solo", 1): None, ("pair", 1): 2.0, ("pair", 2): 2.0}


def test_ties_follow_the_second_key(spark):
    check(spark, [("a", DAY, 7, k, float(k)) for k in (3, 1, 2)] + [("a", DAY, 6, 9, 100.0)])


def hot_rows():
    """One brand-day holds most rows; its keys are far from uniform."""
    rng = random.Random(3)
    rows = [("hot", DAY, k, 0, float(k % 97)) for k in rng.sample(range(300), 200)]
    rows += [("hot", DAY, 10**12 + i, 0, float(i)) for i in range(40)]
    return rows + random_rows(100, 3, 5, 4)


@pytest.mark.parametrize("buckets", [1, 3, 17, 200])
def test_hot_days_are_cut_without_changing_results(spark, buckets):
    check(spark, hot_rows(), buckets=buckets)


@pytest.mark.parametrize("buckets", [1, 40])
def test_text_null_and_tied_keys(spark, buckets):
    """Keys sort as their own type does: '10' before '9', and nulls before both."""
    rows = [(b, d, None if k == 5 else str(k), t, None if null else float(k)) for b in ("a", "b", None)
            for k, (d, t, null) in enumerate([(DAY, i % 2, i % 4 == 1) for i in range(30)])]
    df = spark.createDataFrame(rows, SCHEMA.replace("k1 long", "k1 string"))
    records = [r.asDict() for r in add_sales_history(df, tie_break=("k1", "k2"), buckets=buckets).collect()]
    lag, mean = brute.history(records, "brand", "sale_date", ("k1", "k2"), "total_sales", null_first=True)
    assert len(records) == len(rows)
    for i, r in enumerate(records):
        if r["brand"] is None:
            assert r["sales_lag_1"] is None and r["sales_ma_3"] == r["total_sales"]
        else:
            assert r["sales_lag_1"] == lag[i] and r["sales_ma_3"] == pytest.approx(mean[i])


@pytest.mark.parametrize("values", [
    [5.0, None, 7.0, 8.0], [None, None, 3.0], [None, 3.0, None], [None, None], [None], [4.0, None], [None, 2.0, None, None, 6.0]])
@pytest.mark.parametrize("buckets", [1, 9])
def test_gaps_take_the_last_known_value_else_the_first(spark, values, buckets):
    rows = [("a", DAY, i, 0, v) for i, v in enumerate(values)] + [("b", DAY, 1, 0, 1.0), ("b", DAY, 2, 0, 2.0), (None, DAY, 1, 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    series = brute.pandas_series(values)
    got = {r.k1: r.sales_lag_1 for r in add_sales_history(df, tie_break=("k1", "k2"), buckets=buckets).where("brand = 'a'").collect()}
    assert [got[i] for i in range(len(values))] == brute.known(series.shift(1).ffill().bfill())
    out = fill_forward_back(df, "total_sales", tie_break=("k1", "k2"), buckets=buckets)
    assert out.columns == df.columns
    got = {r.k1: r.total_sales for r in out.where("brand = 'a'").collect()}
    assert [got[i] for i in range(len(values))] == brute.known(series.ffill().bfill())
    assert out.where("brand is null and total_sales is null").count() == 1


def test_buckets_are_balanced_and_ordered(spark):
    rows = [("hot", DAY, k * k, 0, 1.0) for k in range(5000)] + [("cold", DAY, 1, 0, 1.0)]
    got = ordered_buckets(spark.createDataFrame(rows, SCHEMA), ["brand", "sale_date", "k1"], 50).collect()
    by_key = sorted((r.k1, r._slice) for r in got if r.brand == "hot")
    slices = [s for _, s in by_key]
    assert slices == sorted(slices)
    assert max(slices.count(s) for s in set(slices)) <= 320


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), buckets=st.sampled_from([2, 30, None]))
def test_random_tables(spark, seed, buckets):
    check(spark, random_rows(80, 3, 6, seed, null_dates=True), buckets=buckets)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_no_frame_reaches_to_the_end_of_its_partition(spark):
    """Such a frame is read anew for every row: its cost is the square of a range."""
    out = fill_forward_back(spark.createDataFrame(hot_rows(), SCHEMA), "total_sales", tie_break=("k1", "k2"), buckets=2)
    assert "unboundedfollowing$()" not in plan(out)


def test_ranges_grow_in_number_and_rows_move_once(spark, monkeypatch):
    monkeypatch.setattr(history, "RANGE_ROWS", 20)
    df = spark.createDataFrame(hot_rows(), SCHEMA)
    stored = ordered_buckets(df, ["brand", "sale_date", "k1"])
    assert stored.select("_slice").distinct().count() > 8
    keys = sorted((r._position, r.brand, r.sale_date, r.k1, r._slice) for r in stored.collect())
    assert [k[1:4] for k in keys] == sorted(k[1:4] for k in keys) and [k[4] for k in keys] == sorted(k[4] for k in keys)
    assert "hashpartitioning" not in plan(add_sales_history(df, tie_break=("k1", "k2")))
    check(spark, hot_rows())


def test_range_ends_are_plain_aggregates(spark, monkeypatch):
    """The ends of the ranges take one hashed pass over the stored rows, without a sort."""
    plans, before = [], history.materialize
    monkeypatch.setattr(history, "materialize", lambda df, label: plans.append(plan(df)) or before(df, label))
    monkeypatch.setattr(history, "RANGE_ROWS", 20)
    add_sales_history(spark.createDataFrame(hot_rows(), SCHEMA), tie_break=("k1", "k2"))
    assert len(plans) == 1 and "row_number" not in plans[0] and "SortAggregate" not in plans[0].split("== Physical Plan ==")[1]
    check(spark, hot_rows())
