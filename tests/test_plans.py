"""Physical plans: what is exchanged, broadcast, pushed down and kept out of Python."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries
from salescast.models import decomposable
from salescast.operators import history, series, slices, trends
from salescast.sources import star
from salescast.staging import materialize
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_checked_queries_stay_out_of_python(spark, monkeypatch):
    for name in oracle_sql():
        if name in ("forecast_summary", "active_regressors", "daily_brand_summary", "daily_summary_hot_days",
                    "daily_summary_incremental", "decomp_regressor_forecast", "sequence_forecast", "sequence_metrics"):
            continue  # covered below: they share one expensive preparation
        if name.startswith("op") or name == "pipeline":
            continue  # their own tests say which of them run Python
        text = plan(queries()[name](spark, SF))
        assert "InPandas" not in text and "EvalPython" not in text, name


def test_daily_summary_stays_out_of_python(processed):
    assert "InPandas" not in plan(processed)


def test_sale_rows_are_exchanged_once_for_lag_and_mean(spark, raw_sales, no_aqe):
    """The ordered rows are stored; their windows need one exchange by brand and slice, and the carried rows none."""
    text = plan(history.add_sales_history(raw_sales, tie_break=star.TIE_BREAK))
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in text


def test_decomposable_fit_uses_exchanges_of_the_series_only(spark, raw_sales, no_aqe):
    base = series.brand_series(raw_sales.select("brand", "sale_date", "total_sales"))
    text = plan(decomposable.score_series(base))
    assert len(re.findall(r"Exchange hashpartitioning\(brand#\d+, \d+\)", text)) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scan_reads_only_the_needed_columns(spark, raw_sales, no_aqe):
    text = plan(series.brand_series(raw_sales))
    assert "stock_level" not in text.split("ReadSchema")[1].split("\n")[0]


def test_filters_reach_the_scan(spark, raw_sales, no_aqe):
    import datetime as dt

    text = plan(slices.brand_rows(raw_sales, "Brand#7", dt.date(1996, 1, 1), dt.date(1997, 1, 1)))
    pushed = text.split("PushedFilters")[1].split("\n")[0]
    assert "EqualTo(brand,Brand#7)" in pushed and "GreaterThanOrEqual(sale_date" in pushed


def test_stored_dimensions_are_broadcast_by_their_bytes(spark, no_aqe):
    fact = spark.range(10**6).withColumnRenamed("id", "k")
    small = materialize(spark.range(100).selectExpr("id AS k"), "small")
    wide = materialize(spark.range(100).selectExpr("id AS k", "repeat(uuid(), 1000) AS text"), "wide")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        assert "BroadcastHashJoin" in plan(fact.join(small, "k"))
        assert "SortMergeJoin" in plan(fact.join(wide, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_n_within_limits_before_the_exchange(spark, raw_sales, no_aqe):
    totals = raw_sales.groupBy("category", "brand").sum("total_sales").withColumnRenamed("sum(total_sales)", "s")
    assert "WindowGroupLimit" in plan(slices.top_n_within(totals, "category", "s", 3))


def test_interest_filter_runs_before_grouping(spark, no_aqe):
    text = plan(trends.interest_scores(star.trend_events(spark, SF)))
    assert "Subquery" in text.split("HashAggregate")[-1] or "subquery" in text


def test_full_run_joins_the_raw_rows_once(spark, monkeypatch):
    """The popularity refresh and the summary pass over stored rows, not over the joins that make them."""
    from salescast.plans import full_run

    class Seen(Exception):
        pass

    def seen(sales, scores):
        raise Seen(plan(sales))

    monkeypatch.setattr(full_run, "popularity_refresh", seen)
    with pytest.raises(Seen) as stop:
        full_run.run_all(star.sales(spark, SF), star.trend_events(spark, SF), star.TIE_BREAK, "unused", "now")
    assert "Join" not in str(stop.value)
