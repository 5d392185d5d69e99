"""A closed-form second forecast, so that two-model reports can be checked against plain SQL.

It stands in for the sliding-window model, whose fitted values SQL cannot state: the mean of
a brand's train rows on the same weekday, for the 30 days after its data end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.operators.series import split_rows, with_horizon


def score_weekday_means(series: DataFrame) -> DataFrame:
    frame = with_horizon(
        split_rows(series.select("brand", "sale_date", F.col("total_sales").alias("actual"))),
        anchor="data_end")
    frame = frame.withColumn("_dow", F.dayofweek("sale_date"))
    train = F.when(F.col("kind") == "train", F.col("actual"))
    return frame.withColumn(
        "predicted", F.avg(train).over(Window.partitionBy("brand", "_dow"))).drop("_dow")


def weekday_forecast(scored: DataFrame) -> DataFrame:
    return scored.where("kind = 'future'").select(
        "sale_date", "brand", F.col("predicted").alias("predicted_sales"))
