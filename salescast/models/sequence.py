"""Sliding-window forecast: the last seven days of all features predict the next day's sales."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.models import outcome
from salescast.models.linear import LinearFit, predicted, recursion, ridge
from salescast.operators.columns import minmax_inverse, minmax_scale
from salescast.operators.series import by_brand, by_date, sequence_eligible, sequence_gate
from salescast.staging import materialize

Predictor = Callable[[np.ndarray], np.ndarray]
# Takes windows (n, 7, k) and their targets (n,), returns a function from windows to predictions.
Fit = Callable[[np.ndarray, np.ndarray], Predictor]

RIDGE = 1.0
#: The model by default: linear in the flattened window, with an L2 penalty.
RIDGE_AUTOREGRESSION = ridge(RIDGE)

_SCORED = ("brand string, kind string, step int, actual_scaled double, predicted_scaled double, "
           "low double, high double, sale_date date, reason string")


def _windows(rows: DataFrame) -> DataFrame:
    """(brand, sale_date, kind, x, y, days, low, high): each day with the flattened week before it, train or test."""
    before = by_date().rowsBetween(-S.WINDOW_DAYS, -1)
    placed = rows.withColumns({
        "x": F.flatten(F.collect_list("features").over(before)), "no": F.row_number().over(by_date()),
        "total": F.count("*").over(by_brand())}).where(f"no > {S.WINDOW_DAYS}")
    return placed.selectExpr(
        "brand", "sale_date", f"CASE WHEN no - {S.WINDOW_DAYS} <= (total - {S.WINDOW_DAYS}) * 4 DIV 5 THEN 'train' ELSE 'test' END AS kind",
        "x", "features[0] AS y", f"{S.WINDOW_DAYS} AS days", "low", "high")


def _linear_scores(rows: DataFrame, fit: LinearFit, horizon: int) -> DataFrame:
    """Test windows and days ahead of all brands by a model that is linear in the window, without Python workers."""
    rows = materialize(rows, "sequence-rows")
    windows = _windows(rows)
    models = materialize(fit.models(windows.where("kind = 'train'")), "sequence-models")
    tested = windows.where("kind = 'test'").join(models, "brand").selectExpr(
        "brand", "kind", "0 AS step", "y AS actual_scaled", f"{predicted('x')} AS predicted_scaled", "low", "high", "sale_date")
    last = rows.withColumns({
        "latest": F.collect_list("features").over(by_date().rowsBetween(1 - S.WINDOW_DAYS, 0)),
        "end": F.max("sale_date").over(by_brand())}).where("sale_date = end")
    ahead = last.join(models, "brand").selectExpr(
        "brand", "low", "high", "sale_date", f"posexplode({recursion('latest', horizon)}) AS (at, predicted_scaled)").selectExpr(
        "brand", "'future' AS kind", "at + 1 AS step", "double(null) AS actual_scaled", "predicted_scaled", "low", "high", "sale_date")
    return tested.unionByName(ahead)


def ridge_autoregression(windows: np.ndarray, targets: np.ndarray) -> Predictor:
    """The default model as a function of one series: a linear model of the flattened window, centred, with an L2 penalty."""
    x = windows.reshape(len(windows), -1)
    centre, level = x.mean(axis=0), targets.mean()
    x = x - centre
    beta = np.linalg.solve(x.T @ x + RIDGE * np.eye(x.shape[1]), x.T @ (targets - level))
    return lambda w: (w.reshape(len(w), -1) - centre) @ beta + level


def _brand_scorer(fit: Fit, horizon: int):
    def score(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("sale_date", ignore_index=True)
        brand, last = rows["brand"].iloc[0], rows["sale_date"].iloc[-1]
        scaled = np.stack(rows["features"].to_numpy()).astype(float)
        windows = np.lib.stride_tricks.sliding_window_view(scaled, S.WINDOW_DAYS, axis=0)[:-1]
        windows = windows.transpose(0, 2, 1)
        targets = scaled[S.WINDOW_DAYS:, 0]
        train = len(windows) * 4 // 5
        tested = len(windows) - train
        # The model function is the caller's: whatever it raises is the reason of this brand, and the others go on.
        try:
            predict = fit(windows[:train], targets[:train])
            # Each step predicts sales from the last seven days and repeats the other features.
            latest, ahead = scaled[-S.WINDOW_DAYS:], []
            for _ in range(horizon):
                ahead.append(float(predict(latest[None])[0]))
                latest = np.vstack([latest[1:], np.r_[ahead[-1], latest[-1, 1:]]])
            guesses = np.r_[predict(windows[train:]), ahead]
        except Exception as e:
            return pd.DataFrame([(brand, outcome.SKIP, None, None, None, None, None, None, f"fit failed: {type(e).__name__}: {e}")],
                                columns=[c.split()[0] for c in _SCORED.split(", ")])
        return pd.DataFrame({
            "brand": brand, "kind": ["test"] * tested + ["future"] * horizon,
            "step": [0] * tested + list(range(1, horizon + 1)),
            "actual_scaled": np.r_[targets[train:], np.full(horizon, np.nan)], "predicted_scaled": guesses,
            "low": rows["low"].iloc[0], "high": rows["high"].iloc[0],
            "sale_date": list(rows["sale_date"].iloc[S.WINDOW_DAYS + train:]) + [last] * horizon, "reason": None})
    return score


def attempt(series: DataFrame, regressors: Sequence[str] = S.SEQUENCE_REGRESSORS,
            fit: LinearFit | Fit = RIDGE_AUTOREGRESSION, horizon: int = S.HORIZON_DAYS, fit_on: str = "all") -> DataFrame:
    """Score the holdout windows of each eligible brand and forecast ``horizon`` days past its data.

    Returns (brand, sale_date, kind, actual, predicted, actual_scaled, predicted_scaled, reason) as described in
    ``models.outcome``: a brand is skipped for too few rows, for a missing or non-finite value among its features, for an
    error of the fit, or for a prediction that is not finite. ``fit_on`` takes the scaling bounds from the whole series (``all``)
    or from the rows that the train windows and their targets cover (``train``). A ``LinearFit`` runs in the JVM; any
    other model function gets one series a group of a grouped map, a row a day.
    """
    features = ["total_sales", *S.present(series.columns, ("online_popularity", *regressors))]
    fit_rows = "true"
    kept = sequence_eligible(series, features)
    if fit_on == "train":
        kept = kept.withColumns({"_no": F.row_number().over(by_date()),
                                 "_all": F.count("*").over(by_brand())})
        fit_rows = f"_no <= {S.WINDOW_DAYS} + (_all - {S.WINDOW_DAYS}) * 4 DIV 5"
    scaled = minmax_scale(kept, features, fit_where=fit_rows)
    rows = scaled.selectExpr(
        "brand", "sale_date", f"array({', '.join(f'{c}_scaled' for c in features)}) AS features",
        "total_sales_low AS low", "total_sales_high AS high")
    if isinstance(fit, LinearFit):
        scored = _linear_scores(rows, fit, horizon).withColumn("reason", F.lit(None).cast("string"))
    else:
        scored = rows.groupBy("brand").applyInPandas(_brand_scorer(fit, horizon), _SCORED)
    scored = scored.withColumn("actual_scaled", F.expr("nanvl(actual_scaled, null)")).selectExpr(
        "brand", "CASE WHEN kind = 'future' THEN date_add(sale_date, step) ELSE sale_date END AS sale_date",
        "kind", f"{minmax_inverse('actual_scaled', 'low', 'high')} AS actual",
        f"{minmax_inverse('predicted_scaled', 'low', 'high')} AS predicted",
        "actual_scaled", "predicted_scaled", "reason")
    return outcome.attempt(sequence_gate(series, features), scored, ("predicted",), "sequence-scored")


def score_series(series: DataFrame, regressors: Sequence[str] = S.SEQUENCE_REGRESSORS,
                 fit: LinearFit | Fit = RIDGE_AUTOREGRESSION, horizon: int = S.HORIZON_DAYS, fit_on: str = "all") -> DataFrame:
    """The scored rows of :func:`attempt`, without the brands that were skipped."""
    return outcome.scores(attempt(series, regressors, fit, horizon, fit_on))


def forecast_rows(scored: DataFrame) -> DataFrame:
    return scored.where("kind = 'future'").select(
        "sale_date", "brand", F.col("predicted").alias("predicted_sales"))
