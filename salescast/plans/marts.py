"""Report tables over the processed sales, the forecasts and the metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.functions.calendar import month_start
from salescast.functions.numeric import direction, pct_change, thousands
from salescast.operators.evaluate import best_of, ensemble_scores
from salescast.operators.slices import (
    latest_month_slice,
    mean_by_brand,
    top_n,
    top_n_within,
)


def monthly_growth(daily: DataFrame, forecast: DataFrame) -> DataFrame:
    """Last forecast month against last actual month, by forecast brand.

    The months are the last ones with rows, whether complete or not. A brand without
    actual sales in its month has a null growth, which counts as down.
    """
    ahead = (latest_month_slice(forecast).groupBy("brand")
             .agg(F.sum("predicted_sales").alias("predicted_sales")))
    last = (latest_month_slice(daily).groupBy("brand")
            .agg(F.sum("total_sales").alias("last_month_sales")))
    growth = F.col("predicted_sales") - F.col("last_month_sales")
    return (ahead.join(last, "brand", "left")
            .withColumn("growth", growth)
            .withColumn("growth_pct", pct_change(F.col("growth"), F.col("last_month_sales")))
            .withColumn("trend", direction(F.col("growth"))))


def growth_ranking(daily: DataFrame, forecast: DataFrame, n: int = 10) -> DataFrame:
    return top_n(monthly_growth(daily, forecast), "growth", n)


def kpi_overview(daily: DataFrame, forecast: DataFrame) -> DataFrame:
    """One row: revenue of the last month, projected revenue, fastest brand, brands that grow.

    Without a forecast the fastest brand is ``N/A`` with growth 0.
    """
    growth = monthly_growth(daily, forecast)
    # desc_nulls_last by growth, then brand: order the candidates in one aggregate
    fastest = F.min(F.struct(F.col("growth").isNull().alias("unknown"),
                             (-F.col("growth")).alias("falling"), "brand", "growth"))
    ahead = growth.agg(
        F.coalesce(F.sum("predicted_sales"), F.lit(0.0)).alias("projected_revenue"),
        fastest.alias("f"),
        F.count_if(F.col("growth") > 0).alias("growing_brands"))
    month = latest_month_slice(daily).agg(
        F.coalesce(F.sum("total_sales"), F.lit(0.0)).alias("this_month_revenue"))
    return month.crossJoin(F.broadcast(ahead)).select(
        "this_month_revenue", "projected_revenue",
        F.coalesce("f.brand", F.lit("N/A")).alias("fastest_brand"),
        F.when(F.col("f").isNull(), F.lit(0.0)).otherwise(F.col("f.growth")).alias("fastest_growth"),
        "growing_brands")


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """The overview as display text, without decimals."""
    return kpis.select(
        thousands("this_month_revenue").alias("this_month_revenue"),
        thousands("projected_revenue").alias("projected_revenue"),
        "fastest_brand", thousands("fastest_growth").alias("fastest_growth"), "growing_brands")


def category_leaders(daily: DataFrame, categories: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` best brands of the last month in each asked category: (category, rank, brand, total_sales).

    ``categories`` is a table with the column ``category``. One that sold nothing stays, as ``No data``.
    """
    totals = (latest_month_slice(daily).groupBy("category", "brand")
              .agg(F.sum("total_sales").alias("total_sales")))
    leaders = top_n_within(totals, "category", "total_sales", n)
    return categories.select("category").join(leaders, "category", "left").select(
        "category", F.coalesce("rank", F.lit(1)).alias("rank"),
        F.coalesce("brand", F.lit("No data")).alias("brand"), "total_sales")


def forecast_overlay(
    daily: DataFrame, forecasts: Mapping[str, DataFrame], brand: str | None = None,
    first: Date | None = None, last: Date | None = None, models: Sequence[str] | None = None,
) -> DataFrame:
    """Actual and forecast lines in long form: (brand, sale_date, series, sales).

    The date range limits the actual line only. ``models`` chooses among the forecasts.
    """
    actual = daily
    if first is not None:
        actual = actual.where(F.col("sale_date") >= first)
    if last is not None:
        actual = actual.where(F.col("sale_date") <= last)
    lines = actual.select("brand", "sale_date", F.lit("actual").alias("series"),
                          F.col("total_sales").alias("sales"))
    for label in (forecasts if models is None else models):
        lines = lines.unionByName(forecasts[label].select(
            "brand", "sale_date", F.lit(label).alias("series"),
            F.col("predicted_sales").alias("sales")))
    return lines if brand is None else lines.where(F.col("brand") == brand)


def forecast_comparison(forecasts: Mapping[str, DataFrame]) -> DataFrame:
    """The lines of all models for the brands of the first one: (brand, sale_date, model, predicted_sales)."""
    labels = list(forecasts)
    lines = None
    for label in labels:
        part = forecasts[label].select("brand", "sale_date", F.lit(label).alias("model"), "predicted_sales")
        lines = part if lines is None else lines.unionByName(part)
    drawn = forecasts[labels[0]].select("brand").distinct()
    return lines.join(drawn, "brand", "left_semi")


def top_brands_by_model(forecasts: Mapping[str, DataFrame], n: int = 5) -> DataFrame:
    """The ``n`` brands of the largest mean forecast of each model: (model, rank, brand, mean_forecast)."""
    means = None
    for label, forecast in forecasts.items():
        part = mean_by_brand(forecast, "predicted_sales", "mean_forecast").withColumn("model", F.lit(label))
        means = part if means is None else means.unionByName(part)
    return top_n_within(means, "model", "mean_forecast", n).select("model", "rank", "brand", "mean_forecast")


def decision(daily: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """One row: best_brand, best_score and trending_brand; null where there is no candidate."""
    best = best_of(ensemble_scores(first, second), "combined_score").select(
        F.col("brand").alias("best_brand"), F.round("combined_score", 2).alias("best_score"))
    trending = best_of(mean_by_brand(daily, "online_popularity", "buzz"), "buzz").select(
        F.col("brand").alias("trending_brand"))
    # Each side is one row at most; the aggregates make it exactly one.
    return (best.agg(F.max("best_brand").alias("best_brand"), F.max("best_score").alias("best_score"))
            .crossJoin(F.broadcast(trending.agg(F.max("trending_brand").alias("trending_brand")))))


def forecast_summary(choice: DataFrame, as_of: str) -> DataFrame:
    """The decision as one text document."""
    # Fixed value: the wording of the summary.
    text = (
        "Forecast Summary (%s)\n\n"
        "Brand expected to perform best next month: %s\n"
        "Average Forecasted Sales Score: %.2f\n\n"
        "Most Trending Brand Right Now (Social buzz): %s"
    )
    return choice.select(F.format_string(
        text, F.lit(as_of), "best_brand", "best_score", "trending_brand").alias("summary"))


def category_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "category string")


def monthly_totals(df: DataFrame, date: str = "sale_date", value: str = "total_sales") -> DataFrame:
    return (df.where(F.col(date).isNotNull())
            .groupBy("brand", month_start(F.col(date)).alias("month_start"))
            .agg(F.sum(value).alias(value)))
