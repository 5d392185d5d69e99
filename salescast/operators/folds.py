"""Evaluation from several origins: each series is cut more than once, and every cut is forecast from what came before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.functions.numeric import mape_pct, rmse

#: Steps to either side whose residuals share a band.
POOLED = 3


def origins(series: DataFrame, folds: int, horizon: int = S.HORIZON_DAYS) -> DataFrame:
    """(brand, fold, origin): the last days of the training parts, ``horizon`` days apart, the last one ``horizon`` days before the end."""
    back = F.explode(F.sequence(F.lit(folds), F.lit(1))).alias("back")
    return (series.groupBy("brand").agg(F.max("sale_date").alias("end")).select("brand", "end", back)
            .selectExpr("brand", f"{folds} + 1 - back AS fold", f"date_sub(end, back * {horizon}) AS origin"))


def fold_frame(series: DataFrame, folds: int, horizon: int = S.HORIZON_DAYS, target: str = "total_sales") -> DataFrame:
    """(brand, fold, origin, sale_date, kind, actual): a copy of each series for each origin, up to ``horizon`` days past it.

    Every row meets the origins of its brand that it is early enough for; there are ``folds`` of them. A fold with fewer than two
    training rows or without a test row is left out.
    """
    days = series.select("brand", "sale_date", F.col(target).alias("actual")).where("actual IS NOT NULL")
    cuts = origins(series, folds, horizon).withColumnRenamed("brand", "o_brand")
    met = days.join(cuts, F.expr(f"brand = o_brand AND sale_date <= date_add(origin, {horizon})")).drop("o_brand")
    own = Window.partitionBy("brand", "fold")
    framed = met.withColumn("kind", F.expr("CASE WHEN sale_date <= origin THEN 'train' ELSE 'test' END")).withColumns({
        "_train": F.count_if(F.col("kind") == "train").over(own), "_test": F.count_if(F.col("kind") == "test").over(own)})
    return framed.where(f"_train >= {S.MIN_TRAIN_ROWS} AND _test > 0").select("brand", "fold", "origin", "sale_date", "kind", "actual")


def fold_metrics(scored: DataFrame) -> DataFrame:
    """(brand, fold, test_rows, rmse, mape_pct) of scored folds."""
    y, p = F.col("actual"), F.col("predicted")
    return scored.where("kind = 'test'").groupBy("brand", "fold").agg(
        F.count(F.lit(1)).alias("test_rows"), rmse(y, p).alias("rmse"), mape_pct(y, p).alias("mape_pct"))


def step_bands(scored: DataFrame) -> DataFrame:
    """(brand, step, half): half the width of the forecast band so many days ahead.

    The root mean square of the residuals of all folds at about that step, as a normal band of the model's level. A band
    is never narrower than at an earlier step.
    """
    steps = (scored.where("kind = 'test'").selectExpr("brand", "datediff(sale_date, origin) AS step", "actual - predicted AS residual")
             .groupBy("brand", "step").agg(F.sum(F.col("residual") * F.col("residual")).alias("squares"), F.count("residual").alias("n")))
    by_step = Window.partitionBy("brand").orderBy("step")
    near = by_step.rangeBetween(-POOLED, POOLED)
    width = F.lit(S.INTERVAL_Z) * F.sqrt(F.sum("squares").over(near) / F.sum("n").over(near))
    return steps.withColumn("half", width).select(
        "brand", "step", F.max("half").over(by_step.rowsBetween(Window.unboundedPreceding, 0)).alias("half"))


def with_step_bands(forecast: DataFrame, bands: DataFrame, origin: DataFrame) -> DataFrame:
    """The future rows of a forecast with bands by step; a step that no fold reached takes the widest band before it.

    ``origin`` is (brand, origin), the day that the forecast starts from.
    """
    steps = forecast.join(origin, "brand").withColumn("step", F.datediff("sale_date", "origin")).where("step > 0")
    both = steps.join(bands, ["brand", "step"], "left")
    half = F.max("half").over(Window.partitionBy("brand").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("half", half).select(
        "sale_date", "brand", "predicted_sales", (F.col("predicted_sales") - F.col("half")).alias("yhat_lower"),
        (F.col("predicted_sales") + F.col("half")).alias("yhat_upper"))
