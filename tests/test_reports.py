import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.operators import evaluate, slices, trends
from salescast.plans import marts

JAN, FEB = dt.date(2024, 1, 15), dt.date(2024, 2, 3)
DAILY = "category string, brand string, sale_date date, total_sales double, online_popularity double"
AHEAD = "sale_date date, brand string, predicted_sales double"


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame([
        ("c1", "a", JAN, 999.0, 1.0), ("c1", "a", FEB, 10.0, 1.0), ("c1", "b", FEB, 20.0, 3.0),
        ("c1", "c", FEB, 20.0, 3.0), ("c1", "d", FEB, 5.0, None), ("c2", "zero", FEB, 0.0, None)], DAILY)


@pytest.fixture(scope="module")
def ahead(spark):
    march = dt.date(2024, 3, 1)
    return spark.createDataFrame([
        (march, "a", 15.0), (march, "b", 10.0), (march, "new", 7.0), (march, "zero", 4.0),
        (march, "c", 25.0), (dt.date(2024, 2, 9), "a", 1000.0)], AHEAD)


def test_growth(daily, ahead):
    got = {r.brand: r for r in marts.monthly_growth(daily, ahead).collect()}
    assert (got["a"].growth, got["a"].growth_pct, got["a"].trend) == (5.0, 50.0, "up")
    assert (got["b"].growth, got["b"].trend) == (-10.0, "down")
    assert (got["new"].growth, got["new"].growth_pct, got["new"].trend) == (None, None, "down")
    assert (got["zero"].growth, got["zero"].growth_pct, got["zero"].trend) == (4.0, None, "up")


def test_ranking_breaks_ties_by_brand_and_puts_unknown_last(daily, ahead):
    assert [r.brand for r in marts.growth_ranking(daily, ahead).collect()] == ["a", "c", "zero", "b", "new"]
    assert [r.brand for r in marts.growth_ranking(daily, ahead, 2).collect()] == ["a", "c"]


def test_kpis(daily, ahead):
    k = marts.kpi_overview(daily, ahead).first()
    assert tuple(k) == (55.0, 61.0, "a", 5.0, 3)
    cards = marts.kpi_cards(marts.kpi_overview(daily.withColumn("total_sales", F.col("total_sales") * 1000), ahead))
    assert cards.first().this_month_revenue == "55,000"


def test_kpis_without_forecast(spark, daily):
    k = marts.kpi_overview(daily, spark.createDataFrame([], AHEAD)).first()
    assert tuple(k) == (55.0, 0.0, "N/A", 0.0, 0)


def test_fastest_brand_when_no_growth_is_known(spark, daily):
    only_new = spark.createDataFrame([(FEB, "y", 1.0), (FEB, "x", 2.0)], AHEAD)
    k = marts.kpi_overview(daily, only_new).first()
    assert (k.fastest_brand, k.fastest_growth, k.growing_brands) == ("x", None, 0)


def test_category_leaders(spark, daily):
    rows = marts.category_leaders(daily, marts.category_table(spark, ["c1", "c2", "c9"])).collect()
    got = sorted((r.category, r["rank"], r.brand, r.total_sales) for r in rows if r.category != "c9")
    assert got == [("c1", 1, "b", 20.0), ("c1", 2, "c", 20.0), ("c1", 3, "a", 10.0), ("c2", 1, "zero", 0.0)]
    assert [(r.brand, r.total_sales) for r in rows if r.category == "c9"] == [("No data", None)]


def test_overlay_limits_actuals_only(daily, ahead):
    both = {"one": ahead, "two": ahead}
    lines = marts.forecast_overlay(daily, both, brand="a", first=FEB, last=FEB, models=["two"]).collect()
    assert sorted((r.series, r.sales) for r in lines) == [("actual", 10.0), ("two", 15.0), ("two", 1000.0)]


def test_comparison_draws_brands_of_the_first_model(spark, ahead):
    other = spark.createDataFrame([(FEB, "a", 1.0), (FEB, "unknown", 2.0)], AHEAD)
    got = marts.forecast_comparison({"one": ahead, "two": other}).where("model = 'two'").collect()
    assert [r.brand for r in got] == ["a"]


def test_decision_skips_brands_of_one_model(spark, daily, ahead):
    second = spark.createDataFrame([(FEB, "b", 30.0), (FEB, "c", 15.0), (FEB, "only", 10**6 * 1.0)], AHEAD)
    scores = {r.brand: r.combined_score for r in evaluate.ensemble_scores(ahead, second).collect()}
    assert scores["only"] is None and scores["a"] is None and scores["b"] == scores["c"] == 20.0
    choice = marts.decision(daily, ahead, second)
    assert tuple(choice.first()) == ("b", 20.0, "b")
    text = marts.forecast_summary(choice, "2024-03-01").first().summary
    assert text.splitlines()[0] == "Forecast Summary (2024-03-01)"
    assert text.splitlines()[3] == "Average Forecasted Sales Score: 20.00"


def test_top_brands_by_model(ahead):
    rows = marts.top_brands_by_model({"m": ahead}, 2).collect()
    assert sorted((r["rank"], r.brand, r.mean_forecast) for r in rows) == [(1, "a", 507.5), (2, "c", 25.0)]


def test_compare_metrics_is_inner(spark):
    a = spark.createDataFrame([("x", 1.0, 2.0), ("y", 3.0, 4.0)], S.struct(S.METRICS))
    b = spark.createDataFrame([("x", 5.0, 6.0)], S.struct(S.METRICS))
    got = evaluate.compare_metrics(a, b).collect()
    assert [tuple(r) for r in got] == [("x", 1.0, 2.0, 5.0, 6.0)]


def test_brand_picker(daily):
    assert [r.brand for r in slices.brand_picker(daily, "A").collect()] == ["a"]
    everything = slices.brand_picker(daily).collect()
    assert [r.brand for r in everything] == ["a", "b", "c", "d", "zero"]
    assert {(r.min_date, r.max_date) for r in everything} == {(JAN, FEB)}
    assert slices.brand_picker(daily, "%").count() == 0


def test_profile(daily):
    got = {r.column_name: r for r in slices.profile(daily, ["total_sales", "online_popularity"]).collect()}
    assert (got["online_popularity"].null_count, got["online_popularity"].q50) == (2, 2.0)
    assert got["total_sales"].row_count == 6


EVENTS = "brand string, ts timestamp"


def test_interest_scores(spark):
    last = dt.datetime(2024, 6, 30, 12)
    rows = [("a", last)] + [("a", last - dt.timedelta(days=1))] * 4 + [("a", last - dt.timedelta(days=8))] * 9
    rows += [("quiet", last - dt.timedelta(days=2)), ("old", last - dt.timedelta(days=7))]
    scores = trends.interest_scores(spark.createDataFrame(rows, EVENTS))
    assert {r.brand: r.score for r in scores.collect()} == {"a": 25.0, "quiet": 0.0}


def test_refresh_overwrites_the_whole_history(spark):
    old, new = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    sales = spark.createDataFrame([("a", old, 1.0), ("a", new, 2.0), ("gone", old, 3.0), ("b", new, 4.0)],
                                  "brand string, sale_date date, online_popularity double")
    scores = spark.createDataFrame([("a", 80.0), ("gone", 70.0)], "brand string, score double")
    got = sorted((r.brand, r.sale_date, r.online_popularity)
                 for r in trends.popularity_refresh(sales, scores).collect())
    assert got == [("a", old, 80.0), ("a", new, 80.0), ("b", new, 55.0), ("gone", old, None)]
    unfilled = trends.popularity_refresh(sales, scores, fallback=None).where("brand = 'b'").first()
    assert unfilled.online_popularity is None


def test_coverage_and_profile_leave_out_missing_values(spark):
    import datetime as dt

    from salescast.operators import slices

    d = dt.date(2024, 1, 1)
    rows = [("a", d, 1.0), ("a", d + dt.timedelta(1), float("nan")), (None, d + dt.timedelta(2), 3.0), (None, d, None), ("b", None, 5.0)]
    df = spark.createDataFrame(rows, "brand string, sale_date date, x double")
    assert sorted(((r.brand or "", r.distinct_dates) for r in slices.date_coverage(df).collect())) == [("", 3), ("a", 2)]
    got = slices.profile(df, ["x"]).first()
    assert (got.row_count, got.non_null, got.null_count, got.mean, got.max, got.q50) == (5, 3, 2, 3.0, 5.0, 3.0)
    assert [r.sale_date for r in slices.first_dates(df, 2).collect()] == [d, d + dt.timedelta(1)]
    assert [tuple(r) for r in slices.column_types(df).collect()] == [
        (1, "brand", "string"), (2, "sale_date", "date"), (3, "x", "double")]
