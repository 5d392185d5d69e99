"""The registered queries: each runs one operator or report over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast import schema as S
from salescast.functions import calendar, numeric
from salescast.models import decomposable, linear, outcome, regression, sequence
from salescast.operators import columns, daily, evaluate, folds, history, incremental, series, slices, trends
from salescast.plans import full_run, marts
from salescast.sources import star, tables
from salescast.sources.rejects import checked
from salescast.sources.tables import append_batch, publish, read_published
from salescast.staging import materialize, scoped_folder
from salescast.workloads.second_model import score_weekday_means, weekday_forecast

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

IDS = star.TIE_BREAK
FILLED = ("online_popularity", "total_sales", "quantity_sold", "competitor_price", "stock_level",
          "supply_delay_days", "weather_score")
REGRESSORS = ("competitor_price", "stock_level", "supply_delay_days", "weather_score",
              "promotion", "discount_percentage", "is_holiday")
CATEGORIES = ("ECONOMY", "STANDARD", "PROMO", "MEDIUM", "LARGE", "SMALL", "NOT SOLD")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return columns.replace_columns(df, {n: f"round({n}, {digits}) + 0D" for n in names})


def _stored_sales(spark: SparkSession, sf: str, names: tuple[str, ...] = star.COLUMNS) -> DataFrame:
    """The raw table as a stored one, for operators that pass over it several times."""
    return materialize(star.sales(spark, sf, names), "raw-sales", "zstd")


def _daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of the daily summary that money reports need."""
    return (star.sales(spark, sf, ("category", "brand", "sale_date", "total_sales"))
            .groupBy("category", "brand", "sale_date")
            .agg(F.sum("total_sales").alias("total_sales")))


def _stored_daily(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(_daily_sales(spark, sf), "daily-sales")


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return series.brand_series(star.sales(spark, sf, ("brand", "sale_date", "total_sales")))


def _processed(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_brand_summary(_stored_sales(spark, sf), star.TIE_BREAK)


def _processed_series(spark: SparkSession, sf: str) -> DataFrame:
    return series.brand_series(_processed(spark, sf), S.DECOMPOSABLE_REGRESSORS)


def _first_forecast(base: DataFrame) -> DataFrame:
    return materialize(decomposable.forecast_rows(decomposable.score_series(base)), "forecast")


def _both(base: DataFrame) -> dict[str, DataFrame]:
    """Both forecast tables, stored as a run stores them: reports read them more than once."""
    second = materialize(weekday_forecast(score_weekday_means(base)), "weekday-forecast")
    return {"decomposable": _first_forecast(base), "weekday": second}


def _stored_series(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(_series(spark, sf), "series")


def _sold_and_forecast(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Daily sales and the forecast made from them: one pass over the sale rows for both."""
    sold = _stored_daily(spark, sf)
    return sold, _first_forecast(series.brand_series(sold))


# --- filling, encoding, scaling -------------------------------------------------------


@query
def median_impute(spark, sf):
    filled = columns.constant_fill(
        columns.median_fill(_stored_sales(spark, sf, (*IDS, *FILLED, "is_holiday"))), {"is_holiday": 0})
    return rounded(filled.select(*IDS, *FILLED, "is_holiday"), 6, "online_popularity")


@query
def label_encode(spark, sf):
    return columns.label_encode(_stored_sales(spark, sf, (*IDS, *S.ENCODED)))


@query
def zscore(spark, sf):
    scored = ("quantity_sold", "competitor_price", "stock_level", "supply_delay_days", "weather_score")
    df = columns.zscore(star.sales(spark, sf, (*IDS, *scored)), scored)
    return rounded(df, 4, *scored)


@query
def minmax_scale(spark, sf):
    scaled = columns.minmax_scale(_series(spark, sf), ["total_sales"])
    back = columns.minmax_inverse("total_sales_scaled", "total_sales_low", "total_sales_high")
    return rounded(scaled.selectExpr("brand", "sale_date", "total_sales_scaled", f"{back} AS restored"),
                   4, "total_sales_scaled", "restored")


# --- windows over sale rows and the daily summary -------------------------------------


def _history(spark, sf):
    return history.add_sales_history(
        _stored_sales(spark, sf, (*IDS, "brand", "sale_date", "total_sales")), tie_break=IDS)


@query
def sales_lag_fill(spark, sf):
    return _history(spark, sf).select("brand", "sale_date", *IDS, "total_sales", "sales_lag_1")


@query
def sales_ma3(spark, sf):
    return rounded(_history(spark, sf).select("brand", "sale_date", *IDS, "sales_ma_3"), 6, "sales_ma_3")


#: Ranges that cut every day of the test tables into several.
MANY_BUCKETS = 400


@query
def sales_lag_hot_days(spark, sf):
    """The lag with so many ranges that days and brands are cut all over."""
    df = history.add_sales_history(star.sales(spark, sf, (*IDS, "brand", "sale_date", "total_sales")),
                                   tie_break=IDS, buckets=MANY_BUCKETS)
    return df.select("brand", "sale_date", *IDS, "total_sales", "sales_lag_1")


def _sales_with_gaps(spark, sf):
    """Sale rows without a value for some, without a brand for others, and with one key as text."""
    return star.sales(spark, sf, (*IDS, "brand", "sale_date", "total_sales")).selectExpr(
        *[c if c != "k1" else "string(k1) AS k1" for c in IDS], "CASE WHEN k1 % 9 <> 0 THEN brand END AS brand", "sale_date",
        "CASE WHEN k1 % 5 <> 0 THEN total_sales END AS total_sales")


@query
def sales_history_gaps(spark, sf):
    df = history.add_sales_history(_sales_with_gaps(spark, sf), tie_break=IDS, buckets=MANY_BUCKETS)
    return rounded(df.select("brand", "sale_date", *IDS, "sales_lag_1", "sales_ma_3"), 6, "sales_ma_3")


@query
def fill_forward_back(spark, sf):
    return history.fill_forward_back(_sales_with_gaps(spark, sf), "total_sales", tie_break=IDS, buckets=MANY_BUCKETS).select(
        "brand", "sale_date", *IDS, "total_sales")


@query
def daily_brand_summary(spark, sf):
    df = _processed(spark, sf)
    return rounded(df, 4, *[c for c, t in df.dtypes if t == "double"])


@query
def daily_summary_hot_days(spark, sf):
    df = daily.daily_brand_summary(_stored_sales(spark, sf), star.TIE_BREAK, buckets=MANY_BUCKETS)
    return rounded(df, 4, *[c for c, t in df.dtypes if t == "double"])


@query
def daily_summary_incremental(spark, sf):
    """The daily summary kept up in three batches of days, from state alone."""
    rows = _stored_sales(spark, sf)
    root = scoped_folder(spark, "increments")
    incremental.start(rows.where("sale_date < DATE '1994-07-01'"), root, IDS)
    incremental.add(rows.where("sale_date >= DATE '1994-07-01' AND sale_date < DATE '1998-01-01'"), root)
    incremental.add(rows.where("sale_date >= DATE '1998-01-01'"), root)
    df = incremental.summary(spark, root)
    return rounded(df, 4, *[c for c, t in df.dtypes if t == "double"])


@query
def published_daily(spark, sf):
    """The daily table published by month, and its last month read back."""
    root = scoped_folder(spark, "published")
    publish(_daily_sales(spark, sf).withColumn("month_start", calendar.month_start(F.col("sale_date"))), root, ("month_start",))
    rows = read_published(spark, root)
    last = rows.agg(F.max("month_start")).scalar()
    return rounded(rows.where(F.col("month_start") == last).drop("month_start"), 4, "total_sales")


# --- calendar, cleaning, profile ------------------------------------------------------


@query
def calendar_features(spark, sf):
    days = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderdate").cast("date").alias("sale_date")).distinct()
    df = calendar.with_calendar(days).withColumn(
        "popularity_multiplier", calendar.popularity_multiplier(F.dayofmonth("sale_date") * 3.0))
    return rounded(df, 8, "seasonal_index", "popularity_multiplier")


@query
def lenient_parse(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey",
        F.expr("""CASE o_orderkey % 7 WHEN 0 THEN 'not a date' WHEN 1 THEN ''
                  WHEN 2 THEN date_format(o_orderdate, 'yyyy/MM/dd')
                  ELSE date_format(o_orderdate, 'yyyy-MM-dd') END""").alias("date_text"),
        F.expr("""CASE o_orderkey % 5 WHEN 0 THEN 'inf' WHEN 1 THEN 'n/a' WHEN 2 THEN 'NaN'
                  ELSE CAST(o_totalprice AS STRING) END""").alias("amount_text"))
    return orders.select(
        "o_orderkey", calendar.lenient_date(F.col("date_text")).alias("order_date"),
        numeric.lenient_double(F.col("amount_text")).alias("amount"))


@query
def data_profile(spark, sf):
    cols = ("total_sales", "quantity_sold", "online_popularity", "competitor_price", "stock_level",
            "weather_score")
    df = slices.profile(_stored_sales(spark, sf, cols), cols)
    return rounded(df, 4, "mean", "std", "min", "max", "q25", "q50", "q75")


@query
def zscore_with_gaps(spark, sf):
    """NaN and null alike are left out of mean and deviation."""
    rows = star.sales(spark, sf, (*IDS, "stock_level")).withColumn(
        "stock_level", F.expr("CASE WHEN k1 % 11 = 0 THEN double('NaN') ELSE stock_level END"))
    return rounded(columns.zscore(rows, ("stock_level",)), 4, "stock_level")


@query
def profile_with_gaps(spark, sf):
    cols = ("stock_level", "total_sales")
    rows = materialize(star.sales(spark, sf, ("k1", *cols)).withColumn(
        "stock_level", F.expr("CASE WHEN k1 % 11 = 0 THEN double('NaN') ELSE stock_level END")), "profile")
    return rounded(slices.profile(rows, cols), 4, "mean", "std", "min", "max", "q25", "q50", "q75")


@query
def coverage_with_null_brand(spark, sf):
    rows = star.sales(spark, sf, ("k1", "brand", "sale_date")).withColumn("brand", F.expr("CASE WHEN k1 % 9 <> 0 THEN brand END"))
    return slices.date_coverage(rows)


@query
def first_dates(spark, sf):
    """The beginning of the calendar, with the columns' types beside it as a profile lists them."""
    rows = star.sales(spark, sf, ("sale_date", "brand", "total_sales"))
    kinds = slices.column_types(rows).where("column_name = 'sale_date'").select("column_name", "data_type")
    return slices.first_dates(rows).crossJoin(F.broadcast(kinds))


@query
def date_coverage(spark, sf):
    return slices.date_coverage(star.sales(spark, sf, ("brand", "sale_date")))


@query
def rejected_rows(spark, sf):
    """Dates and amounts of orders written in several ways, of which some cannot be read: each with its reason."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(
        "o_orderkey", """CASE o_orderkey % 7 WHEN 0 THEN 'not a date' WHEN 1 THEN '' WHEN 2 THEN date_format(o_orderdate, 'yyyy/MM/dd')
                         ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS Date""",
        """CASE o_orderkey % 5 WHEN 0 THEN 'inf' WHEN 1 THEN 'n/a' WHEN 2 THEN '12,5' ELSE CAST(o_totalprice AS STRING) END AS Amount""")
    fields = (S.Field("sale_date", "Date", T.DateType()), S.Field("amount", "Amount", T.DoubleType(), False))
    return checked(orders, fields, ["o_orderkey"]).rejects


# --- slices and lookups ---------------------------------------------------------------


@query
def brand_search(spark, sf):
    return slices.brand_picker(star.sales(spark, sf, ("brand", "sale_date")), "BRAND#1")


@query
def distinct_regions(spark, sf):
    return slices.distinct_values(star.sales(spark, sf, ("region",)), "region")


@query
def actuals_in_range(spark, sf):
    return rounded(
        slices.brand_rows(_daily_sales(spark, sf), "Brand#7", Date(1996, 3, 1), Date(1998, 9, 15)),
        4, "total_sales")


@query
def latest_date_slice(spark, sf):
    return slices.latest_date_slice(star.sales(spark, sf, ("sale_date", "brand", "total_sales", *IDS)))


@query
def latest_month_slice(spark, sf):
    return rounded(slices.latest_month_slice(_stored_daily(spark, sf)), 4, "total_sales")


@query
def last_rows(spark, sf):
    return rounded(slices.last_rows(_series(spark, sf), S.WINDOW_DAYS), 4, "total_sales")


@query
def monthly_totals(spark, sf):
    return rounded(marts.monthly_totals(_daily_sales(spark, sf)), 4, "total_sales")


@query
def append_batches(spark, sf):
    rows = star.sales(spark, sf, ("brand", "sale_date", "total_sales"))
    early = "coalesce(sale_date < DATE '1998-01-01', false)"  # rows without a date come with the later batch
    early, late = rows.where(early), rows.where(f"NOT {early}")
    return rounded(append_batch(early, late).groupBy("sale_date").agg(
        F.count("*").alias("sale_rows"), F.sum("total_sales").alias("total_sales")), 4, "total_sales")


@query
def csv_batches(spark, sf):
    """The sales as text files in three batches: columns in two orders, the last batch without the discount, all read as one table."""
    rows = star.sales(spark, sf, ("sale_date", "category", "brand", "region", "promotion", "total_sales", "quantity_sold",
                                  "online_popularity", "discount_percentage", "stock_level", *IDS))
    folder = scoped_folder(spark, "csv")
    batches = (rows.where("k1 % 3 = 0"), rows.where("k1 % 3 = 1").select(*reversed(rows.columns)),
               rows.where("k1 % 3 = 2").drop("discount_percentage"))
    named = {f.name: f.header for f in S.RAW_SALES}
    for batch in batches:
        batch.withColumnsRenamed(named).write.mode("append").option("header", True).csv(folder)
    return tables.read_required(spark, folder, S.RAW_SALES, "csv", extra=dict(rows.select(*IDS).dtypes))


# --- trend enrichment -----------------------------------------------------------------


@query
def trend_score_7d(spark, sf):
    brands = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_brand").alias("brand"))
    scores = trends.interest_scores(star.trend_events(spark, sf))
    return rounded(trends.scores_for(brands, scores), 6, "online_popularity")


@query
def trend_score_incremental(spark, sf):
    """The scores from state that three batches of events were merged into."""
    events = star.trend_events(spark, sf)
    root = scoped_folder(spark, "events")
    for batch in ("ts < TIMESTAMP '2024-01-10'", "ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'",
                  "ts >= TIMESTAMP '2024-01-20' OR ts IS NULL"):
        trends.keep_events(events.where(batch), root)
    brands = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_brand").alias("brand"))
    return rounded(trends.scores_for(brands, trends.kept_scores(spark, root)), 6, "online_popularity")


@query
def hand_made_scores(spark, sf):
    """Scores given as a few rows instead of events, written to the sales of their brands."""
    given = tables.rows_to_table(spark, [{"brand": "Brand#1", "score": 12.5}, {"brand": "Brand#2", "score": 99.0}, {"brand": "none"}],
                                 (S.Field("brand", "Brand", T.StringType()), S.Field("score", "Score", T.DoubleType())))
    rows = trends.popularity_refresh(star.sales(spark, sf, ("brand", "sale_date", "online_popularity")), given)
    return rounded(rows.groupBy("brand").agg(F.count("*").alias("sale_rows"), F.avg("online_popularity").alias("online_popularity")),
                   6, "online_popularity")


@query
def popularity_refresh(spark, sf):
    rows = star.sales(spark, sf, (*IDS, "brand", "sale_date", "online_popularity"))
    scores = trends.interest_scores(star.trend_events(spark, sf))
    return rounded(trends.popularity_refresh(rows, scores), 6, "online_popularity")


# --- series ---------------------------------------------------------------------------


@query
def series_daily(spark, sf):
    df = series.brand_series(
        star.sales(spark, sf, ("brand", "sale_date", "total_sales", "promotion", "is_holiday")),
        S.DECOMPOSABLE_REGRESSORS)
    return rounded(df, 4, "total_sales", "promotion", "is_holiday")


@query
def series_gate(spark, sf):
    """Both gates over the series with an unusable target on some days of the month."""
    day = F.dayofmonth("sale_date") % 10
    broken = _series(spark, sf).withColumn(
        "total_sales", F.when(day == 0, float("inf")).when(day == 1, float("nan"))
        .otherwise(F.col("total_sales")))
    first = series.decomposable_gate(broken).withColumnRenamed("skip_reason", "decomposable_skip")
    second = series.sequence_gate(broken).withColumnRenamed("skip_reason", "sequence_skip")
    return first.join(second.drop("series_rows"), "brand")


@query
def train_test_split(spark, sf):
    return rounded(series.split_rows(_series(spark, sf)).withColumn("is_train", F.col("is_train").cast("int")),
                   4, "total_sales")


@query
def active_regressors(spark, sf):
    df = series.active_regressors(
        series.split_rows(_processed_series(spark, sf)), ("online_popularity", *REGRESSORS))
    return df.select("brand", F.concat_ws(",", "regressors").alias("regressors"))


@query
def sequence_windows(spark, sf):
    df = series.sequences(_series(spark, sf), ["total_sales"])
    days = [F.col("sequence")[i][0].alias(f"x{i + 1}") for i in range(S.WINDOW_DAYS)]
    return rounded(df.select("brand", "sale_date", "target", *days), 4, "target",
                   *[f"x{i + 1}" for i in range(S.WINDOW_DAYS)])


@query
def future_frame(spark, sf):
    regressors = ["promotion", "is_holiday"]
    base = series.brand_series(
        star.sales(spark, sf, ("brand", "sale_date", "total_sales", *regressors)), regressors)
    return rounded(series.future_frame(series.split_rows(base), regressors), 4, *regressors)


# --- forecasts ------------------------------------------------------------------------


@query
def decomp_forecast(spark, sf):
    forecast = decomposable.forecast_rows(decomposable.score_series(_series(spark, sf)))
    return rounded(forecast, 2, "predicted_sales", "yhat_lower", "yhat_upper")


@query
def decomp_metrics(spark, sf):
    metrics = evaluate.holdout_metrics(decomposable.score_series(_series(spark, sf)))
    return rounded(metrics, 4, "rmse", "mape_pct")


@query
def decomp_regressor_forecast(spark, sf):
    base = materialize(_processed_series(spark, sf), "series")
    forecast = decomposable.forecast_rows(regression.score_series_with_regressors(base))
    return rounded(forecast, 2, "predicted_sales", "yhat_lower", "yhat_upper")


def _window_mean_scores(base: DataFrame) -> DataFrame:
    """A closed form in the place of a fitted model: the mean of the window's sales."""
    return sequence.score_series(base, regressors=(), fit=linear.WINDOW_MEAN)


@query
def sequence_recursion(spark, sf):
    """Windows, split, scaling, recursion and inverse of the sequence model, with a model that SQL can state."""
    return rounded(_window_mean_scores(_series(spark, sf)).select("brand", "sale_date", "kind", "predicted"), 4, "predicted")


@query
def regressor_design(spark, sf):
    """What the model with regressors sees: scaled time, its first hinge, the first waves, standardised regressors."""
    base = series.brand_series(
        star.sales(spark, sf, ("brand", "sale_date", "total_sales", "promotion", "is_holiday")), S.DECOMPOSABLE_REGRESSORS)
    df = regression.design_frame(base, ("promotion", "is_holiday"))
    waves = 2 * (regression.YEARLY_TERMS + regression.WEEKLY_TERMS)
    return rounded(df.select(
        "brand", "sale_date", "kind", F.col("trend")[0].alias("t"), F.col("trend")[1].alias("hinge"),
        F.col("season")[0].alias("yearly_sin"), F.col("season")[2 * regression.YEARLY_TERMS + 1].alias("weekly_cos"),
        F.col("season")[waves].alias("z_promotion"), F.col("season")[waves + 1].alias("z_is_holiday")),
        5, "t", "hinge", "yearly_sin", "weekly_cos", "z_promotion", "z_is_holiday")


@query
def two_model_report(spark, sf):
    """Both real scorers side by side, gates included; the sequence one with the closed form."""
    base = _stored_series(spark, sf)
    df = evaluate.compare_metrics(evaluate.holdout_metrics(decomposable.score_series(base)),
                                  evaluate.holdout_metrics(_window_mean_scores(base)))
    return rounded(df, 3, *[c for c in df.columns if c != "brand"])


@query
def gates_on_short_series(spark, sf):
    """Both gates over brand and region, most series cut short, so that some pass and some are skipped."""
    rows = star.sales(spark, sf, ("brand", "region", "sale_date", "total_sales")).where(
        "sale_date < date_add(DATE '1995-01-01', 3 * int(substr(brand, 7)))").withColumn("brand", F.concat_ws("/", "brand", "region"))
    base = series.brand_series(rows)
    first = series.decomposable_gate(base).select("brand", "series_rows", F.col("skip_reason").alias("decomposable_skip"))
    second = series.sequence_gate(base).select("brand", F.col("skip_reason").alias("sequence_skip"))
    return first.join(second, "brand")


@query
def overlay_one_brand(spark, sf):
    """The overlay for one brand and a chosen model."""
    sold = _stored_daily(spark, sf)
    ahead = {"decomposable": rounded(_first_forecast(series.brand_series(sold)), 2, "predicted_sales")}
    ahead["sequence"] = sequence.forecast_rows(_window_mean_scores(series.brand_series(sold)))
    return marts.forecast_overlay(rounded(sold, 4, "total_sales"), ahead, brand="Brand#7", models=["decomposable"])


#: Cuts of each series, so many days apart as the horizon.
FOLDS = 4


def _folds(spark: SparkSession, sf: str) -> DataFrame:
    frame = folds.fold_frame(_stored_series(spark, sf), FOLDS)
    return materialize(decomposable.fit_frame(frame, ("brand", "fold", "origin")), "folds")


@query
def rolling_origin_metrics(spark, sf):
    return rounded(folds.fold_metrics(_folds(spark, sf)), 4, "rmse", "mape_pct")


@query
def rolling_origin_bands(spark, sf):
    return rounded(folds.step_bands(_folds(spark, sf)), 4, "half")


@query
def sequence_forecast(spark, sf):
    base = materialize(_processed_series(spark, sf), "series")
    return rounded(sequence.forecast_rows(sequence.score_series(base)), 2, "predicted_sales")


@query
def sequence_metrics(spark, sf):
    base = materialize(_processed_series(spark, sf), "series")
    scores = full_run.sequence_metrics(sequence.score_series(base))
    # Seven digits: a day at the lowest sales has a scaled value of zero, and so a percentage error beyond any scale.
    return columns.replace_columns(scores, {c: f"double(format_string('%.6e', {c}))" for c in scores.columns if c != "brand"})


def _broken_series(spark: SparkSession, sf: str) -> DataFrame:
    """Daily series in which one brand lacks a feature, one lacks a value on its first day, and four are cut short."""
    rows = star.sales(spark, sf, ("brand", "sale_date", "total_sales", "promotion", "quantity_sold"))
    base = series.brand_series(rows.withColumnsRenamed({"promotion": "stock_level", "quantity_sold": "weather_score"}),
                               ("stock_level", "weather_score"))
    first = F.col("sale_date") == F.min("sale_date").over(series.by_brand())
    base = base.withColumns({
        "weather_score": F.when(F.col("brand") != "Brand#3", F.col("weather_score")),
        "stock_level": F.when((F.col("brand") == "Brand#4") & first, float("nan")).otherwise(F.col("stock_level"))})
    kept = F.expr("CASE brand WHEN 'Brand#5' THEN 2 WHEN 'Brand#6' THEN 7 WHEN 'Brand#7' THEN 8 WHEN 'Brand#8' THEN 26 ELSE 1000000 END")
    return materialize(series.split_rows(base).where(F.col("row_no") <= kept).drop("row_no", "row_total", "is_train"), "broken-series")


def _outcomes(attempted: DataFrame) -> DataFrame:
    return attempted.groupBy("brand").agg(
        F.max("reason").alias("reason"), F.count_if(F.col("kind") == "test").alias("test_rows"),
        F.count_if(F.col("kind") == "future").alias("future_rows"))


@query
def sequence_skips(spark, sf):
    """Every brand with the rows that the sequence model gives it or the reason why there are none."""
    return _outcomes(sequence.attempt(_broken_series(spark, sf), ("stock_level", "weather_score")))


@query
def regressor_skips(spark, sf):
    """The same of the decomposable model with regressors."""
    return _outcomes(regression.attempt(_broken_series(spark, sf), ("stock_level", "weather_score")))


# --- reports --------------------------------------------------------------------------


@query
def model_comparison(spark, sf):
    base = _stored_series(spark, sf)
    df = evaluate.compare_metrics(
        evaluate.holdout_metrics(decomposable.score_series(base)),
        evaluate.holdout_metrics(score_weekday_means(base)), ("decomposable", "weekday"))
    return rounded(df, 4, *[c for c in df.columns if c != "brand"])


@query
def top5_by_model(spark, sf):
    return rounded(marts.top_brands_by_model(_both(_stored_series(spark, sf))), 2, "mean_forecast")


@query
def forecast_overlay(spark, sf):
    # Actuals have four exact decimals, forecasts carry float noise.
    sold = _stored_daily(spark, sf)
    actual = rounded(sold, 4, "total_sales")
    ahead = {k: rounded(v, 2, "predicted_sales") for k, v in _both(series.brand_series(sold)).items()}
    return marts.forecast_overlay(actual, ahead, first=Date(1996, 1, 1), last=Date(2000, 12, 31))


@query
def forecast_comparison(spark, sf):
    return rounded(marts.forecast_comparison(_both(_stored_series(spark, sf))), 2, "predicted_sales")


@query
def ensemble_scores(spark, sf):
    return rounded(evaluate.ensemble_scores(*_both(_stored_series(spark, sf)).values()), 2, "combined_score")


@query
def ensemble_best_brand(spark, sf):
    best = evaluate.best_of(evaluate.ensemble_scores(*_both(_stored_series(spark, sf)).values()), "combined_score")
    return rounded(best, 2, "combined_score")


@query
def forecast_summary(spark, sf):
    sold = _processed(spark, sf)
    choice = marts.decision(sold, *_both(series.brand_series(sold.select("brand", "sale_date", "total_sales"))).values())
    return marts.forecast_summary(choice, "whole history")


def _two_models(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The forecasts of both real scorers, the sequence one with the closed form."""
    base = _stored_series(spark, sf)
    return {"decomposable": _first_forecast(base),
            "sequence": materialize(sequence.forecast_rows(_window_mean_scores(base)), "sequence-forecast")}


@query
def top5_of_two_models(spark, sf):
    return rounded(marts.top_brands_by_model(_two_models(spark, sf)), 2, "mean_forecast")


@query
def lines_of_two_models(spark, sf):
    return rounded(marts.forecast_comparison(_two_models(spark, sf)), 2, "predicted_sales")


@query
def ensemble_of_two_models(spark, sf):
    return rounded(evaluate.ensemble_scores(*_two_models(spark, sf).values()), 2, "combined_score")


@query
def summary_of_two_models(spark, sf):
    choice = marts.decision(star.sales(spark, sf, ("brand", "online_popularity")), *_two_models(spark, sf).values())
    return marts.forecast_summary(choice, "whole history")


@query
def reread_forecast(spark, sf):
    """The comparison from files: one forecast that has replaced another table, and one that was never written."""
    folder = scoped_folder(spark, "forecast-files")
    ahead = rounded(_first_forecast(_series(spark, sf)), 2, "predicted_sales")
    tables.write_table(tables.with_headers(ahead.limit(3).drop("yhat_upper"), S.FORECAST), folder, "csv")
    tables.write_table(tables.with_headers(ahead, S.FORECAST), folder, "csv")
    return marts.forecast_comparison({
        "decomposable": tables.read_required(spark, folder, S.FORECAST, "csv"),
        "sequence": tables.read_optional(spark, f"{folder}-none", S.FORECAST, "csv")})


@query
def summary_of_few_columns(spark, sf):
    """The daily summary of sales that have no optional column."""
    rows = _stored_sales(spark, sf, (*IDS, *[f.name for f in S.RAW_SALES if f.required]))
    df = daily.daily_brand_summary(rows, star.TIE_BREAK)
    return rounded(df, 4, *[c for c, t in df.dtypes if t == "double"])


@query
def whole_run(spark, sf):
    """All steps from sales and events to reports; both models in closed form, compared by their scores."""
    result = full_run.run_all(star.sales(spark, sf), star.trend_events(spark, sf), star.TIE_BREAK, scoped_folder(spark, "run"),
                              "whole history", fit=linear.WINDOW_MEAN, with_regressors=False)
    # The sequence scores are those of the scaled values.
    df = result["model_comparison"].select("brand", "rmse_decomposable", "mape_pct_decomposable", "rmse_sequence")
    return rounded(rounded(df, 3, "rmse_decomposable", "mape_pct_decomposable"), 6, "rmse_sequence")


@query
def kpi_overview(spark, sf):
    df = marts.kpi_overview(*_sold_and_forecast(spark, sf))
    return rounded(rounded(df, 4, "this_month_revenue"), 2, "projected_revenue", "fastest_growth")


@query
def kpi_cards(spark, sf):
    return marts.kpi_cards(marts.kpi_overview(*_sold_and_forecast(spark, sf)))


@query
def category_leaders(spark, sf):
    df = marts.category_leaders(_stored_daily(spark, sf), marts.category_table(spark, CATEGORIES))
    return rounded(df, 4, "total_sales")


@query
def growth_by_brand(spark, sf):
    df = marts.monthly_growth(*_sold_and_forecast(spark, sf))
    return rounded(rounded(df, 4, "last_month_sales"), 2, "predicted_sales", "growth", "growth_pct")


@query
def growth_ranking(spark, sf):
    df = marts.growth_ranking(*_sold_and_forecast(spark, sf))
    return rounded(rounded(df, 4, "last_month_sales"), 2, "predicted_sales", "growth", "growth_pct")
