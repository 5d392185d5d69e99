import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescast.operators import series as se
from salescast.operators.columns import minmax_inverse, minmax_scale

D = dt.date(2024, 1, 30)


def make(spark, lengths, value=lambda i: float(i), extra="", extra_value=()):
    rows = [(f"n{n}", D + dt.timedelta(days=i), value(i), *extra_value) for n in lengths for i in range(n)]
    return spark.createDataFrame(rows, "brand string, sale_date date, total_sales double" + extra)


LENGTHS = (1, 2, 3, 7, 8, 26, 27)


def test_decomposable_gate_by_length(spark):
    got = {r.brand: r for r in se.decomposable_gate(make(spark, LENGTHS)).collect()}
    assert {b for b, r in got.items() if r.skip_reason} == {"n1", "n2"}
    assert (got["n3"].train_rows, got["n3"].test_rows) == (2, 1)
    for n in LENGTHS:
        assert got[f"n{n}"].train_rows == int(n * 0.8)


def test_decomposable_gate_sees_nulls_of_train_rows_only(spark):
    df = make(spark, (10,)).withColumn("early", F.when(F.col("total_sales") != 2, 1.0))
    df = df.withColumn("late", F.when(F.col("total_sales") != 9, 1.0))
    assert se.decomposable_gate(df.drop("late")).first().skip_reason == "not enough valid train data"
    assert se.decomposable_gate(df.drop("early")).first().skip_reason is None


def test_brand_without_usable_target_is_listed_as_skipped(spark):
    gate = se.decomposable_gate(make(spark, (5,), value=lambda i: float("nan"))).first()
    assert (gate.series_rows, gate.clean_rows, gate.dropped_rows) == (5, 0, 5)
    assert gate.skip_reason == "insufficient data"


def test_sequence_gate_by_length(spark):
    got = {r.brand: r.skip_reason for r in se.sequence_gate(make(spark, LENGTHS)).collect()}
    assert got["n7"] == "insufficient rows" and got["n8"] == got["n26"] == "not enough samples"
    assert got["n27"] is None


def test_clean_series(spark):
    df = spark.createDataFrame(
        [("a", D, 1.0, float("inf")), ("a", D, float("-inf"), 1.0), ("a", D, float("nan"), 1.0), ("a", D, None, 1.0)],
        "brand string, sale_date date, total_sales double, x double")
    assert [(r.total_sales, r.x) for r in se.clean_series(df).collect()] == [(1.0, None)]


def test_split_is_chronological_and_complete(spark):
    rows = se.split_rows(make(spark, LENGTHS)).collect()
    assert len(rows) == sum(LENGTHS)
    for n in LENGTHS:
        mine = sorted((r.sale_date, r.is_train) for r in rows if r.brand == f"n{n}")
        assert [t for _, t in mine] == [True] * int(n * 0.8) + [False] * (n - int(n * 0.8))


def test_constant_in_train_is_inactive_even_if_it_varies_in_test(spark):
    df = make(spark, (10,)).withColumns({
        "late": F.when(F.col("total_sales") >= 8, 5.0).otherwise(1.0),
        "nulls": F.when(F.col("total_sales") < 3, 2.0)})
    assert se.active_regressors(se.split_rows(df), ["total_sales", "late", "nulls"]).first().regressors == ["total_sales"]


@pytest.mark.parametrize("n", (7, 8, 27))
def test_sequences(spark, n):
    rows = se.sequences(make(spark, (n,)), ["total_sales"]).orderBy("sale_date").collect()
    assert len(rows) == max(n - 7, 0)
    for i, r in enumerate(rows):
        assert [x for (x,) in r.sequence] == [float(i + k) for k in range(7)] and r.target == float(i + 7)


def test_future_frame_follows_the_train_end_and_carries_forward(spark):
    df = make(spark, (10,)).withColumn("x", F.when(F.col("total_sales") != 9, F.col("total_sales")))
    rows = se.future_frame(se.split_rows(df), ["x"]).orderBy("sale_date").collect()
    assert len(rows) == 8 + 30
    future = [r for r in rows if r.kind == "future"]
    assert future[0].sale_date == D + dt.timedelta(days=8)
    assert [r.x for r in future] == [8.0] * 30  # day 8 is known, day 9 is null, the rest is missing
    ends = se.future_frame(se.split_rows(df), ["x"], horizon=5, anchor="data_end").where("kind = 'future'")
    assert ends.agg(F.min("sale_date")).first()[0] == D + dt.timedelta(days=10) and ends.count() == 5


def test_minmax_in_range_and_back(spark):
    df = make(spark, (3, 9), value=lambda i: (i * 7) % 5 - 2.0).withColumn("flat", F.lit(4.0))
    scaled = minmax_scale(df, ["total_sales", "flat"])
    back = scaled.selectExpr("*", f"{minmax_inverse('total_sales_scaled', 'total_sales_low', 'total_sales_high')} AS b",
                             f"{minmax_inverse('flat_scaled', 'flat_low', 'flat_high')} AS flat_back").collect()
    for r in back:
        assert 0 <= r.total_sales_scaled <= 1 and r.b == pytest.approx(r.total_sales)
        assert r.flat_scaled == 0 and r.flat_back == 4.0


def test_series_sums_over_categories_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [("c1", "a", D, 1.0, 2.0), ("c2", "a", D, 5.0, 4.0), ("c1", "a", None, 9.0, 9.0), ("c1", None, D, 9.0, 9.0),
         ("c1", "b", D, None, None)],
        "category string, brand string, sale_date date, total_sales double, promotion double")
    got = {r.brand: (r.total_sales, r.promotion) for r in se.brand_series(df, ["promotion", "absent"]).collect()}
    assert got == {"a": (6.0, 3.0), "b": (0.0, None)}
