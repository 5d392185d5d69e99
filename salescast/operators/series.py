"""Daily series of a brand: building, cleaning, gating, splitting and framing.

A series has one row per calendar day, so a window or a group over one series is
bounded by the length of the calendar, however many sales a brand has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.functions.calendar import days_after
from salescast.functions.numeric import finite, lenient_double


def by_brand() -> WindowSpec:
    return Window.partitionBy("brand")


def by_date() -> WindowSpec:
    return by_brand().orderBy("sale_date")


def up_to_here() -> WindowSpec:
    return by_date().rowsBetween(Window.unboundedPreceding, 0)


def brand_series(df: DataFrame, regressors: Sequence[str] = ()) -> DataFrame:
    """(brand, sale_date): summed sales, mean popularity and mean regressors, as far as present."""
    means = S.present(df.columns, ("online_popularity", *regressors))
    return (df.where("brand IS NOT NULL AND sale_date IS NOT NULL")
            .groupBy("brand", "sale_date")
            .agg(F.coalesce(F.sum("total_sales"), F.lit(0.0)).alias("total_sales"),
                 *[F.avg(c).alias(c) for c in means]))


def clean_series(series: DataFrame, target: str = "total_sales") -> DataFrame:
    """Infinite and NaN values become null; rows without a usable target are dropped."""
    numeric = [c for c, t in series.dtypes if c != target and t in ("double", "float")]
    return (series
            .withColumns({target: lenient_double(F.col(target)),
                          **{c: finite(F.col(c)) for c in numeric}})
            .where(F.col(target).isNotNull()))


def split_rows(series: DataFrame) -> DataFrame:
    """Add ``row_no``, ``row_total`` and ``is_train``: the first 80 % of each series by date."""
    return series.withColumns({
        "row_no": F.row_number().over(by_date()),
        "row_total": F.count("*").over(by_brand()),
    }).withColumn("is_train", F.expr("row_no <= row_total * 4 DIV 5"))


def decomposable_gate(series: DataFrame, target: str = "total_sales") -> DataFrame:
    """One row per brand of the uncleaned series: row counts and the reason it is skipped, or null."""
    clean = split_rows(clean_series(series, target))
    used = [c for c in clean.columns if c not in ("row_no", "row_total", "is_train")]
    has_null = F.greatest(*[F.col(c).isNull().cast("int") for c in used]) == 1
    counts = clean.groupBy("brand").agg(
        F.count("*").alias("clean_rows"),
        F.count_if("is_train").alias("train_rows"),
        F.count_if(~F.col("is_train")).alias("test_rows"),
        F.count_if(F.col("is_train") & has_null).alias("null_train_rows"))
    reason = (F.when(F.col("clean_rows") < S.MIN_CLEAN_ROWS, "insufficient data")
              .when((F.col("train_rows") < S.MIN_TRAIN_ROWS) | (F.col("null_train_rows") > 0),
                    "not enough valid train data")
              .when(F.col("test_rows") == 0, "empty test set"))
    return (series.groupBy("brand").agg(F.count("*").alias("series_rows"))
            .join(counts, "brand", "left").fillna(0)
            .withColumn("dropped_rows", F.col("series_rows") - F.col("clean_rows"))
            .withColumn("skip_reason", reason))


def _unusable(features: Sequence[str]) -> Column:
    """The names of the features that are null, NaN or infinite in the row."""
    return F.array_compact(F.array(*[F.when(finite(F.col(c).cast("double")).isNull(), F.lit(c)) for c in features]).cast("array<string>"))


def sequence_gate(series: DataFrame, features: Sequence[str] = ()) -> DataFrame:
    """One row per brand: series rows, sequences, and the reason it is skipped, or null.

    A brand that lacks a value of one of ``features`` on any day is skipped by name, as no window over that day can be scaled.
    """
    n = F.col("series_rows")
    gaps = F.array_sort(F.array_distinct(F.flatten(F.collect_set(_unusable(features)))))
    counts = series.groupBy("brand").agg(F.count("*").alias("series_rows"), gaps.alias("_gaps"))
    return (counts
            .withColumn("sequences", F.greatest(n - S.WINDOW_DAYS, F.lit(0)))
            .withColumn("skip_reason",
                        F.when(n < S.WINDOW_DAYS + 1, "insufficient rows")
                        .when(F.col("sequences") < S.MIN_SEQUENCES, "not enough samples")
                        .when(F.size("_gaps") > 0, F.concat(F.lit("missing values: "), F.array_join("_gaps", ", "))))
            .drop("_gaps"))


def decomposable_eligible(split: DataFrame) -> DataFrame:
    """Rows of the clean, split series that pass :func:`decomposable_gate`, without a join.

    With three clean rows there are two train rows and a test row, so the gate
    comes down to the row count and to nulls among the train rows.
    """
    used = [c for c in split.columns if c not in ("row_no", "row_total", "is_train")]
    has_null = " OR ".join(f"`{c}` IS NULL" for c in used)
    return (split.where(F.col("row_total") >= S.MIN_CLEAN_ROWS)
            .withColumn("_broken", F.expr(f"max(is_train AND ({has_null})) OVER (PARTITION BY brand)"))
            .where("NOT _broken").drop("_broken"))


def sequence_eligible(series: DataFrame, features: Sequence[str] = ()) -> DataFrame:
    """Rows of the series that pass :func:`sequence_gate`, without a join."""
    return (series.withColumns({"_rows": F.count("*").over(by_brand()), "_gap": F.max(F.size(_unusable(features))).over(by_brand())})
            .where((F.col("_rows") >= S.WINDOW_DAYS + S.MIN_SEQUENCES) & (F.col("_gap") == 0)).drop("_rows", "_gap"))


def varies(c: str, where: Column) -> Column:
    """Aggregate: more than one distinct non-null value among the rows of ``where``."""
    x = F.when(where, F.col(c))
    return F.coalesce(F.min(x) < F.max(x), F.lit(False))


def active_regressors(split: DataFrame, regressors: Sequence[str]) -> DataFrame:
    """(brand, regressors): the names of those that vary over the brand's train rows."""
    kept = F.array_compact(F.array(*[F.when(F.col(f"_{c}"), F.lit(c)) for c in regressors]))
    return (split.groupBy("brand")
            .agg(*[varies(c, F.col("is_train")).alias(f"_{c}") for c in regressors])
            .select("brand", kept.alias("regressors")))


def sequences(series: DataFrame, features: Sequence[str], target: str = "total_sales") -> DataFrame:
    """(brand, sale_date, sequence, target): the 7 rows before each row, oldest first."""
    before = by_date().rowsBetween(-S.WINDOW_DAYS, -1)
    return (series
            .select("brand", "sale_date", F.col(target).alias("target"),
                    F.collect_list(F.array(*[F.col(c).cast("double") for c in features]))
                    .over(before).alias("sequence"))
            .where(F.size("sequence") == S.WINDOW_DAYS))


def with_horizon(split: DataFrame, horizon: int = S.HORIZON_DAYS, anchor: str = "train_end") -> DataFrame:
    """Append ``horizon`` future days to each split series, with ``kind`` train, test or future.

    The days follow the last train row (``train_end``) or the last row (``data_end``). They are
    exploded from that row in place, so the series keeps its partitioning. A future row has
    a brand, a date and nulls.
    """
    ends = {"train_end": F.expr("row_no = row_total * 4 DIV 5"),
            "data_end": F.col("row_no") == F.col("row_total")}[anchor]
    own = F.array(F.col("sale_date"))
    dates = F.when(ends, F.concat(own, days_after(F.col("sale_date"), horizon))).otherwise(own)
    values = [c for c in split.columns
              if c not in {"brand", "sale_date", "row_no", "row_total", "is_train"}]
    placed = split.select("*", F.posexplode(dates).alias("_step", "_date"))
    is_own = F.col("_step") == 0
    return placed.select(
        "brand", F.col("_date").alias("sale_date"),
        F.when(~is_own, "future").when(F.col("is_train"), "train").otherwise("test").alias("kind"),
        *[F.when(is_own, F.col(c)).alias(c) for c in values])


def carry_regressors(frame: DataFrame, regressors: Sequence[str]) -> DataFrame:
    """Regressors of future days: those of the series on the same day, else the last known ones.

    Both lookups are windows inside the brand, so the frame is not exchanged again.
    """
    same_day = frame.selectExpr(*[c for c in frame.columns if c not in regressors], *[
        f"coalesce({c}, max({c}) OVER (PARTITION BY brand, sale_date)) AS {c}" for c in regressors])
    return same_day.withColumns({c: F.last(c, ignorenulls=True).over(up_to_here()) for c in regressors})


def future_frame(split: DataFrame, regressors: Sequence[str],
                 horizon: int = S.HORIZON_DAYS, anchor: str = "train_end") -> DataFrame:
    """Train dates and ``horizon`` days after them, with regressors.

    A future day takes the regressors of the same day of the full series where there is one; what is
    missing is carried forward from the day before.
    """
    frame = with_horizon(
        split.select("brand", "sale_date", *regressors, "row_no", "row_total", "is_train"), horizon, anchor)
    return carry_regressors(frame, regressors).where("kind <> 'test'")
