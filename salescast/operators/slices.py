"""Slices, rankings and small lookups over tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.functions.calendar import month_start
from salescast.operators.quantiles import exact_quantiles, quantile_name


def latest_date_slice(df: DataFrame, date: str = "sale_date") -> DataFrame:
    """Rows of the last date. The maximum is a scalar subquery that runs first."""
    return df.where(F.col(date) == df.agg(F.max(date)).scalar())


def latest_month_slice(df: DataFrame, date: str = "sale_date") -> DataFrame:
    """Rows of the last month that has rows; compared by date range, so that it can be pushed down."""
    last = df.agg(month_start(F.max(date))).scalar()
    return df.where(F.col(date) >= last)


def brand_rows(df: DataFrame, brand: str, first: Date, last: Date, date: str = "sale_date") -> DataFrame:
    return df.where((F.col("brand") == brand) & F.col(date).between(first, last))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def brand_picker(df: DataFrame, text: str = "", date: str = "sale_date") -> DataFrame:
    """Brands whose name contains ``text`` in any case, sorted, with the date bounds of the table.

    An empty text keeps all brands. The bounds are those of all rows, as they start the date filter.
    """
    # One aggregate by brand serves both the names and the overall bounds.
    per_brand = df.groupBy("brand").agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    bounds = per_brand.agg(F.min("_first").alias("min_date"), F.max("_last").alias("max_date"))
    return (per_brand.where(F.contains(F.lower("brand"), F.lower(F.lit(text))))
            .crossJoin(F.broadcast(bounds))
            .select("brand", "min_date", "max_date").orderBy("brand"))


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def top_n(df: DataFrame, value: str, n: int, tie: str = "brand") -> DataFrame:
    """The ``n`` rows of the largest value, nulls last, ties by name."""
    return df.orderBy(F.desc_nulls_last(value), F.asc(tie)).limit(n)


def top_n_within(df: DataFrame, group: str, value: str, n: int, tie: str = "brand") -> DataFrame:
    """The ``n`` rows of the largest value in each group, with their ``rank``."""
    w = Window.partitionBy(group).orderBy(F.desc_nulls_last(value), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def last_rows(df: DataFrame, k: int, group: str = "brand", date: str = "sale_date") -> DataFrame:
    """The last ``k`` rows of each series by date."""
    w = Window.partitionBy(group).orderBy(F.desc_nulls_last(date))
    return (df.withColumn("_from_end", F.row_number().over(w))
            .where(F.col("_from_end") <= k).drop("_from_end"))


def date_coverage(df: DataFrame, date: str = "sale_date") -> DataFrame:
    """Distinct dates overall (``brand`` is null) and by brand. Rows without a brand count overall only."""
    # Deduplicate once to (brand, date); both counts run on that.
    days = df.where(F.col(date).isNotNull()).groupBy("brand", date).agg(F.lit(1).alias("_one"))
    return (days.groupingSets([["brand"], []], "brand")
            .agg(F.count_distinct(date).alias("distinct_dates"), F.grouping("brand").alias("_overall"))
            .where("_overall = 1 OR brand IS NOT NULL").select("brand", "distinct_dates"))


def mean_by_brand(df: DataFrame, value: str, name: str) -> DataFrame:
    return df.groupBy("brand").agg(F.avg(value).alias(name))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: rows, nulls, mean, deviation, minimum, exact quartiles, maximum. NaN counts as null."""
    quarters = (0.25, 0.5, 0.75)
    df = df.selectExpr(*[f"nanvl(double(`{c}`), null) AS `{c}`" for c in columns])
    basics = df.agg(*[
        F.struct(
            F.count("*").alias("row_count"),
            F.count(c).alias("non_null"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ).alias(c) for c in columns])
    quantiles = exact_quantiles(df, columns, quarters)
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(c).alias("b"),
            *[F.col(quantile_name(c, p)).alias(f"q{int(p * 100)}") for p in quarters],
        ) for c in columns])
    return (basics.crossJoin(F.broadcast(quantiles))
            .select(F.explode(lines).alias("e"))
            .select("e.column_name", "e.b.*", "e.q25", "e.q50", "e.q75"))


def column_types(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type) of a table's columns; its rows are not read."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def first_dates(df: DataFrame, n: int = 5, date: str = "sale_date") -> DataFrame:
    """The first ``n`` distinct dates."""
    return df.select(date).where(F.col(date).isNotNull()).distinct().orderBy(date).limit(n)
