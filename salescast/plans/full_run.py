"""All steps from raw sales and events to forecasts and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.models import decomposable, outcome, regression, sequence
from salescast.models.linear import LinearFit
from salescast.operators.daily import daily_brand_summary
from salescast.operators.evaluate import compare_metrics, holdout_metrics
from salescast.operators.series import brand_series
from salescast.operators.slices import drop_if_present
from salescast.operators.trends import interest_scores, popularity_refresh
from salescast.plans import marts
from salescast.sources.tables import publish, read_published, write_text_report
from salescast.staging import clustered, materialize


def sequence_metrics(scored: DataFrame) -> DataFrame:
    """Holdout scores on the scaled values, with those in sales units beside them."""
    raw = holdout_metrics(scored).select(
        "brand", F.col("rmse").alias("rmse_sales"), F.col("mape_pct").alias("mape_pct_sales"))
    return holdout_metrics(scored, "actual_scaled", "predicted_scaled").join(raw, "brand")


def run_all(raw: DataFrame, events: DataFrame, tie_break: Sequence[str], out: str, as_of: str,
            fit: LinearFit | sequence.Fit = sequence.RIDGE_AUTOREGRESSION,
            with_regressors: bool = True) -> dict[str, DataFrame]:
    """Refresh popularity, preprocess, forecast with both models, score and report.

    Every table is published under ``out`` as a new version and read back, so that each
    is computed once and the next step starts from storage.
    """
    spark = raw.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        publish(df, f"{out}/{name}")
        return read_published(spark, f"{out}/{name}")

    def stored_if_any(df: DataFrame, name: str) -> DataFrame:
        """If every brand is skipped there is nothing to publish; an earlier version stays in place."""
        return df if df.isEmpty() else stored(df, name)

    # Stored once, as the refresh and the summary pass over the rows several times; a row a brand joins them in each pass.
    rows = materialize(drop_if_present(raw, "online_popularity"), "raw-sales", "zstd")
    refreshed = popularity_refresh(rows, interest_scores(events))
    daily = stored(daily_brand_summary(refreshed, tie_break), "processed_sales")

    # Both models work by brand, so the series they share lie in buckets of it.
    series = clustered(stored(brand_series(daily, S.DECOMPOSABLE_REGRESSORS), "brand_series"), "series", "brand")
    if with_regressors:
        first_tried = stored(regression.attempt(series), "decomposable_scored")
    else:
        first_tried = stored(decomposable.attempt(series), "decomposable_scored")
    second_tried = stored(sequence.attempt(series, fit=fit), "sequence_scored")
    first_scored, second_scored = outcome.scores(first_tried), outcome.scores(second_tried)

    tables = {"processed_sales": daily}
    tables["skipped_brands"] = stored(
        outcome.skipped(first_tried).withColumn("model", F.lit("decomposable")).unionByName(
            outcome.skipped(second_tried).withColumn("model", F.lit("sequence"))), "skipped_brands")
    tables["decomposable_forecast"] = stored_if_any(
        decomposable.forecast_rows(first_scored), "decomposable_forecast")
    tables["sequence_forecast"] = stored_if_any(sequence.forecast_rows(second_scored), "sequence_forecast")
    tables["decomposable_metrics"] = stored_if_any(holdout_metrics(first_scored), "decomposable_metrics")
    tables["sequence_metrics"] = stored_if_any(sequence_metrics(second_scored), "sequence_metrics")

    first, second = tables["decomposable_forecast"], tables["sequence_forecast"]
    both = {"decomposable": first, "sequence": second}
    tables["kpi_overview"] = marts.kpi_overview(daily, first)
    tables["category_leaders"] = marts.category_leaders(daily, daily.select("category").distinct())
    tables["growth_ranking"] = marts.growth_ranking(daily, first)
    tables["model_comparison"] = compare_metrics(
        tables["decomposable_metrics"], tables["sequence_metrics"])
    tables["top_brands_by_model"] = marts.top_brands_by_model(both)
    tables["forecast_comparison"] = marts.forecast_comparison(both)
    tables["summary"] = marts.forecast_summary(marts.decision(daily, first, second), as_of)
    write_text_report(tables["summary"], f"{out}/brand_forecast_summary")
    return tables
