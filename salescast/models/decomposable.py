"""Trend times weekday times month, fitted for all brands at once with window expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.models import outcome
from salescast.operators.series import (
    clean_series,
    decomposable_eligible,
    decomposable_gate,
    split_rows,
    with_horizon,
)


def score_series(series: DataFrame, target: str = "total_sales",
                 horizon: int = S.HORIZON_DAYS, anchor: str = "train_end") -> DataFrame:
    """Fit each eligible brand on its train rows and predict train, test and future days.

    Returns (brand, sale_date, kind, actual, predicted, yhat_lower, yhat_upper).

    The trend is the least-squares line of sales over days. The weekday index is the mean
    ratio of sales to trend, the month index the mean of what then remains; an index that the
    train rows do not show is 1. The band is an 80 % normal one around the train residuals.
    Every fit is a window over the brand, so one exchange by brand serves all of them.
    """
    clean = clean_series(series.select("brand", "sale_date", F.col(target).alias("actual")), "actual")
    return fit_frame(with_horizon(decomposable_eligible(split_rows(clean)), horizon, anchor))


def fit_frame(frame: DataFrame, keys: Sequence[str] = ("brand",)) -> DataFrame:
    """Fit the model to the train rows of each series of a frame (``keys``, sale_date, kind, actual) and predict all its rows."""
    own = Window.partitionBy(*keys)

    def train_only(c: str):
        return F.when(F.col("kind") == "train", F.col(c))

    frame = frame.withColumns({
        "_t": F.datediff("sale_date", F.min("sale_date").over(own)),
        "_dow": F.dayofweek("sale_date"),
        "_month": F.month("sale_date"),
        "_y": train_only("actual"),
    })
    by_dow = Window.partitionBy(*keys, "_dow")
    by_month = Window.partitionBy(*keys, "_month")
    slope, intercept = F.regr_slope("_y", "_t"), F.regr_intercept("_y", "_t")
    frame = frame.withColumn("_trend", intercept.over(own) + slope.over(own) * F.col("_t"))
    frame = frame.withColumn("_ratio", F.try_divide("_y", "_trend"))
    frame = frame.withColumn("_week", F.avg("_ratio").over(by_dow))
    frame = frame.withColumn("_rest", F.try_divide("_ratio", "_week"))
    frame = frame.withColumn("_season", F.avg("_rest").over(by_month))
    frame = frame.withColumn(
        "predicted",
        F.col("_trend") * F.coalesce("_week", F.lit(1.0)) * F.coalesce("_season", F.lit(1.0)))
    sigma = F.stddev_samp(F.col("_y") - F.col("predicted")).over(own)
    half = F.lit(S.INTERVAL_Z) * sigma
    return frame.select(
        *keys, "sale_date", "kind", "actual", "predicted",
        (F.col("predicted") - half).alias("yhat_lower"),
        (F.col("predicted") + half).alias("yhat_upper"))


def attempt(series: DataFrame, target: str = "total_sales",
            horizon: int = S.HORIZON_DAYS, anchor: str = "train_end") -> DataFrame:
    """The rows of :func:`score_series` with a column ``reason``, and a row for every skipped brand (``models.outcome``)."""
    gate = decomposable_gate(series.select("brand", "sale_date", target), target)
    return outcome.attempt(gate, score_series(series, target, horizon, anchor), ("predicted",), "decomposable-scored")


def forecast_rows(scored: DataFrame) -> DataFrame:
    """The forecast table of a scored frame: train history and future days."""
    return scored.where("kind <> 'test'").select(
        "sale_date", "brand", F.col("predicted").alias("predicted_sales"), "yhat_lower", "yhat_upper")
