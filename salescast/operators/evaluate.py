"""Scores of forecasts and combinations of two models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions.numeric import mape_pct, rmse
from salescast.operators.slices import mean_by_brand, top_n


def holdout_metrics(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """(brand, rmse, mape_pct) over the test rows of a scored table."""
    y, p = F.col(actual), F.col(predicted)
    return (scored.where("kind = 'test'").groupBy("brand")
            .agg(rmse(y, p).alias("rmse"), mape_pct(y, p).alias("mape_pct")))


def compare_metrics(first: DataFrame, second: DataFrame,
                    labels: tuple[str, str] = ("decomposable", "sequence")) -> DataFrame:
    """Metrics of the brands both models scored, side by side."""
    def renamed(df: DataFrame, label: str) -> DataFrame:
        return df.select("brand", F.col("rmse").alias(f"rmse_{label}"),
                         F.col("mape_pct").alias(f"mape_pct_{label}"))

    return renamed(first, labels[0]).join(renamed(second, labels[1]), "brand")


def ensemble_scores(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mean of both models' mean forecasts by brand; null where only one model has the brand."""
    a = mean_by_brand(first, "predicted_sales", "_a")
    b = mean_by_brand(second, "predicted_sales", "_b")
    return a.join(b, "brand", "full").select(
        "brand", ((F.col("_a") + F.col("_b")) / 2).alias("combined_score"))


def best_of(df: DataFrame, value: str) -> DataFrame:
    """The row of the largest known value, ties by brand name; empty if there is none."""
    return top_n(df.where(F.col(value).isNotNull()), value, 1)
