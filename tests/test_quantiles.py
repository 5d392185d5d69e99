import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salescast.operators import quantiles
from salescast.operators.columns import median_fill
from salescast.operators.quantiles import exact_quantiles, quantile_name


def quantile_row(df, columns, probs, **kw):
    row = exact_quantiles(df, columns, probs, **kw).first()
    return {(c, p): row[quantile_name(c, p)] for c in columns for p in probs}


@pytest.mark.parametrize("n", [1, 2, 5, 10, 11, 1000])
def test_small_tables(spark, n):
    x = np.random.default_rng(n).normal(size=n) * 100
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = quantile_row(df, ["x"], (0.0, 0.25, 0.5, 0.9, 1.0))
    for (_, p), v in got.items():
        assert v == pytest.approx(np.quantile(x, p), rel=1e-12)


def test_fenced_path_is_exact(spark):
    """Enough sampled rows for the fences to exclude most values, with heavy duplicates and outliers."""
    df = spark.range(200_000).select(
        (F.hash("id") / 7.0).alias("spread"),
        (F.abs(F.hash("id")) % 3).cast("double").alias("few"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pow(F.lit(1.0001), F.col("id") % 50_000)).alias("lumpy"),
        F.when(F.col("id") % 2 == 0, F.hash("id").cast("double")).alias("gaps"))
    assert quantiles._fences(df, ["spread"], (0.5,), 0.4)["spread", 0.5][0] > float("-inf")
    probs = (0.25, 0.5, 0.75)
    got = quantile_row(df, df.columns, probs, sample=0.4)
    pdf = df.toPandas()
    for (c, p), v in got.items():
        assert v == pytest.approx(pdf[c].quantile(p), rel=1e-12), (c, p)


def test_missed_fence_fails_loudly(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(quantiles, "_fences", lambda *a: {("x", 0.5): (10.0, 20.0)})
    with pytest.raises(Exception, match="missed its rank"):
        exact_quantiles(df, ["x"]).first()


def test_nulls_nan_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (4.0, None)],
                               "x double, nothing double")
    assert quantile_row(df, ["x", "nothing"], (0.5,)) == {("x", 0.5): 2.5, ("nothing", 0.5): None}
    assert quantile_row(df.where("false"), ["x"], (0.5,)) == {("x", 0.5): None}


def test_median_fill_keeps_rows_and_leaves_all_null_columns(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, None, None), (3, 30.0, None)],
                               "id int, total_sales double, stock_level double")
    rows = median_fill(df).orderBy("id").collect()
    assert [r.total_sales for r in rows] == [10.0, 20.0, 30.0]
    assert [r.stock_level for r in rows] == [None, None, None]


def test_values_inside_a_fence_are_found_once(spark):
    """They are read for the bins and for the ranks: from a stored table, not by passing over all rows again."""
    df = spark.range(500).selectExpr("double(id) AS x")
    out = exact_quantiles(df, ["x"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 500") <= 1
    assert out.first()[0] == 249.5
