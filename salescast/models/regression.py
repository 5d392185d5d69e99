"""Decomposable forecast with extra regressors: two small ridge systems a brand."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.models import outcome
from salescast.models.linear import block, dot, gram, solve
from salescast.operators.series import (
    by_brand,
    carry_regressors,
    clean_series,
    decomposable_eligible,
    decomposable_gate,
    split_rows,
    with_horizon,
)
from salescast.staging import materialize

# Terms and stiffness of the model.
YEARLY_TERMS = 10
WEEKLY_TERMS = 3
HINGES = 25
HINGE_SPAN = 0.8
RIDGE = 1.0
TREND_RIDGE = 0.1


def _fourier(day: Column, period: float, terms: int) -> list[Column]:
    angles = [day * (2 * math.pi * k / period) for k in range(1, terms + 1)]
    return [wave for a in angles for wave in (F.sin(a), F.cos(a))]


def design_frame(series: DataFrame, regressors: Sequence[str], target: str = "total_sales",
                 horizon: int = S.HORIZON_DAYS, anchor: str = "train_end") -> DataFrame:
    """Frame rows with the feature arrays ``trend`` and ``season`` of every eligible brand.

    Trend features are scaled time and its hinges over the first part of the train span. Season
    features are yearly and weekly waves and the standardised regressors; a regressor that is
    constant over a brand's train rows becomes 0, which takes it out of that brand's model.
    """
    regressors = S.present(series.columns, tuple(regressors))
    clean = clean_series(series.select("brand", "sale_date", F.col(target).alias("actual"), *regressors), "actual")
    frame = with_horizon(decomposable_eligible(split_rows(clean)), horizon, anchor)
    frame = carry_regressors(frame, regressors)

    spread = {}
    for c in regressors:
        seen = f"CASE WHEN kind = 'train' THEN {c} END"
        moments = {f: f"{f}({seen}) OVER (PARTITION BY brand)" for f in ("min", "max", "avg", "stddev_samp")}
        spread[f"_z_{c}"] = F.expr(
            f"CASE WHEN {moments['min']} < {moments['max']}"
            f" THEN coalesce(try_divide({c} - {moments['avg']}, {moments['stddev_samp']}), 0D) ELSE 0D END")
    first = F.min("sale_date").over(by_brand())
    train_end = F.max(F.when(F.col("kind") == "train", F.col("sale_date"))).over(by_brand())
    frame = frame.withColumns({
        **spread,
        "_t": F.datediff("sale_date", first) / F.greatest(F.datediff(train_end, first), F.lit(1)),
        "_day": F.unix_date("sale_date").cast("double"),
    })
    knots = [HINGE_SPAN * (i + 1) / (HINGES + 1) for i in range(HINGES)]
    t, day = F.col("_t"), F.col("_day")
    trend = F.array(t, *[F.greatest(t - k, F.lit(0.0)) for k in knots])
    season = F.array(*_fourier(day, 365.25, YEARLY_TERMS), *_fourier(day, 7.0, WEEKLY_TERMS),
                     *[F.col(f"_z_{c}") for c in regressors])
    return frame.select("brand", "sale_date", "kind", "actual",
                        trend.alias("trend"), season.alias("season"))


def attempt(
    series: DataFrame, regressors: Sequence[str] = ("online_popularity", *S.DECOMPOSABLE_REGRESSORS),
    target: str = "total_sales", horizon: int = S.HORIZON_DAYS, anchor: str = "train_end",
) -> DataFrame:
    """Fit the trend, then the seasons as a share of it, on the train rows of each brand.

    The columns of the closed-form model and ``reason``, as described in ``models.outcome``: a brand is skipped by its
    gate, or where its fit is not finite. Both fits are sums of products and a solve over arrays, without Python workers.
    """
    regressors = S.present(series.columns, tuple(regressors))
    frame = materialize(design_frame(series, regressors, target, horizon, anchor), "design")
    stiff = f"CASE WHEN _i < 2 THEN 1e-9D ELSE {TREND_RIDGE!r}D END"  # the level and the overall slope are free
    sums = gram(frame.where("kind = 'train'"), "concat(array(1D), trend, array(actual))")
    lines = solve(sums, block("a", 0, "(size(a) - 1)", stiff), "slice(a[size(a) - 1], 1, size(a) - 1)", "slopes")
    # y = g * (1 + season): weighted by g, the season is linear in its coefficients.
    level = dot("slopes", "concat(array(1D), trend)")
    weighted = materialize(
        frame.join(lines.select("brand", "slopes"), "brand").selectExpr("brand", "sale_date", "kind", "actual", f"{level} AS g", "season")
        .selectExpr("brand", "sale_date", "kind", "actual", "g", "transform(season, _w -> _w * g) AS w"), "weighted")
    sums = gram(weighted.where("kind = 'train'"), "concat(array(1D, g), w, array(actual - g))").selectExpr(
        "brand", "a", "size(a) - 3 AS p", "coalesce(nullif(try_divide(a[1][1], a[0][0]), 0D), 1D) AS scale")
    shares = solve(sums, block("a", 2, "p", f"{RIDGE!r}D * scale"), "slice(a[p + 2], 3, p)", "beta").select("brand", "beta")
    fitted = weighted.join(shares, "brand").selectExpr("brand", "sale_date", "kind", "actual", f"g + {dot('beta', 'w')} AS predicted")
    half = f"{S.INTERVAL_Z!r}D * stddev_samp(CASE WHEN kind = 'train' THEN actual - predicted END) OVER (PARTITION BY brand)"
    scored = fitted.selectExpr("*", f"{half} AS half").selectExpr(
        "brand", "sale_date", "kind", "actual", "predicted", "predicted - half AS yhat_lower", "predicted + half AS yhat_upper")
    used = series.select("brand", "sale_date", target, *regressors)
    return outcome.attempt(decomposable_gate(used, target), scored, ("predicted", "yhat_lower"), "regressors-scored")


def score_series_with_regressors(
    series: DataFrame, regressors: Sequence[str] = ("online_popularity", *S.DECOMPOSABLE_REGRESSORS),
    target: str = "total_sales", horizon: int = S.HORIZON_DAYS, anchor: str = "train_end",
) -> DataFrame:
    """Same output as the closed-form model: the scored rows of :func:`attempt`."""
    return outcome.scores(attempt(series, regressors, target, horizon, anchor))
