"""Rejected values, kept events and scores, series in buckets, and evaluation from several origins."""

import datetime as dt
import math
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast import schema as S
from salescast.models import decomposable, sequence
from salescast.operators import folds, trends
from salescast.operators.series import brand_series, sequences
from salescast.sources.rejects import checked
from salescast.sources.versions import read_published
from salescast.staging import clustered

D = dt.date(2024, 1, 1)


def test_rejected_values_are_counted_in_the_same_pass(spark):
    rows = spark.createDataFrame(
        [(1, "2024-01-02", "a", "1.5"), (2, "02.01.2024", "", "x"), (3, None, "NaN", "-inf"), (4, "2024-01-05", "b", "n/a"), (5, "2024-02-30", "c", "1e3")],
        "id int, Date string, Brand string, Total_Sales string")
    fields = (S.Field("sale_date", "Date", T.DateType()), S.Field("brand", "Brand", T.StringType()),
              S.Field("total_sales", "Total_Sales", T.DoubleType(), False), S.Field("stock_level", "Stock_Level", T.DoubleType(), False))
    found = checked(rows, fields, ["id"])
    got = {r.id: (r.sale_date, r.brand, r.total_sales) for r in found.rows.collect()}
    assert found.counts.get == {"rows": 5, "sale_date": 3, "brand": 2, "total_sales": 2}
    assert got[1] == (dt.date(2024, 1, 2), "a", 1.5) and got[2] == (None, None, None) and got[4][0] == dt.date(2024, 1, 5)
    assert {tuple(r) for r in found.rejects.collect()} == {
        (2, "sale_date", "02.01.2024", "not a date"), (2, "brand", "", "missing"), (2, "total_sales", "x", "not a number"),
        (3, "sale_date", None, "missing"), (3, "brand", "NaN", "missing"), (3, "total_sales", "-inf", "not finite"),
        (5, "sale_date", "2024-02-30", "not a date")}
    assert checked(rows.limit(0), fields, ["id"]).rejects.isEmpty()


def events_of(spark, n=4000):
    rng = np.random.default_rng(4)
    start = dt.datetime(2024, 3, 1)
    return spark.createDataFrame([(f"b{int(b)}" if b else None, start + dt.timedelta(seconds=float(s)))
                                  for b, s in zip(rng.integers(0, 6, n), rng.integers(0, 30 * 86400, n), strict=True)], "brand string, ts timestamp")


def test_kept_events_give_the_scores_of_all_events(spark, tmp_path):
    events, root = events_of(spark), str(tmp_path / "e")
    cuts = [dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 9, 5), dt.datetime(2024, 3, 24, 17), dt.datetime(2025, 1, 1)]
    for a, b in zip(cuts, cuts[1:]):
        folder = str(tmp_path / f"events-{a:%m%d}")
        events.where((F.col("ts") >= a) & (F.col("ts") < b)).write.parquet(folder)
        trends.keep_events(spark.read.parquet(folder), root)
        shutil.rmtree(folder)  # no later run may need it
        want = trends.interest_scores(events.where((F.col("ts") < b) & F.col("brand").isNotNull()))
        assert {tuple(r) for r in trends.kept_scores(spark, root).collect()} == {tuple(r) for r in want.collect()}
    kept = read_published(spark, root).agg(F.min("ts"), F.max("ts")).first()
    assert kept[1] - kept[0] < dt.timedelta(days=7)


def test_scores_are_stored_once_a_day(spark, tmp_path):
    events, scores = str(tmp_path / "e"), str(tmp_path / "s")
    trends.keep_events(events_of(spark), events)
    brands = spark.createDataFrame([("b1",), ("b2",), ("new",), (None,)], "brand string")
    first = {tuple(r) for r in trends.store_scores(spark, events, scores, brands.where("brand <> 'new'"), D).collect()}
    trends.keep_events(spark.createDataFrame([("b1", dt.datetime(2024, 6, 1))], "brand string, ts timestamp"), events)
    second = {tuple(r) for r in trends.store_scores(spark, events, scores, brands, D).collect()}
    assert first < second and {b for b, _ in second} == {"b1", "b2", "new"} and ("new", S.FALLBACK_SCORE) in second
    shutil.rmtree(events)  # all that is asked for is stored
    assert {tuple(r) for r in trends.store_scores(spark, events, scores, brands, D).collect()} == second


def test_series_in_buckets_are_not_exchanged_again(spark, raw_sales):
    series = clustered(brand_series(raw_sales.select("brand", "sale_date", "total_sales")), "test-series", "brand")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (decomposable.score_series(series), sequences(series, ["total_sales"]), series.groupBy("brand").count(),
                   folds.fold_metrics(decomposable.fit_frame(folds.fold_frame(series, 3), ("brand", "fold", "origin")))):
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in text and "Bucketed: true" in text
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {r.brand for r in sequence.score_series(series).select("brand").distinct().collect()} == {
        r.brand for r in series.select("brand").distinct().collect()}


def line_with_noise(spark, n=200):
    rng = np.random.default_rng(0)
    return [("a", D + dt.timedelta(days=i), 100 + 2.0 * i + float(rng.normal()) * (1 + i / 40)) for i in range(n) if i % 11]


def test_folds_against_loops(spark):
    rows = line_with_noise(spark)
    series = spark.createDataFrame([*rows, ("short", D, 1.0)], "brand string, sale_date date, total_sales double")
    frame = folds.fold_frame(series, 3, horizon=20)
    end = rows[-1][1]
    want = set()
    for fold in (1, 2, 3):
        origin = end - dt.timedelta(days=20 * (4 - fold))
        want |= {("a", fold, origin, day, "train" if day <= origin else "test", y) for _, day, y in rows if day <= origin + dt.timedelta(days=20)}
    assert {tuple(r) for r in frame.collect()} == want
    scored = decomposable.fit_frame(frame, ("brand", "fold", "origin"))
    for fold in (1, 2, 3):  # each fold is the model fitted to its rows alone
        origin = end - dt.timedelta(days=20 * (4 - fold))
        alone = [r for r in want if r[1] == fold]
        got = {r.sale_date: r.predicted for r in scored.where(f"fold = {fold}").collect()}
        one = spark.createDataFrame([("a", r[3], r[4], r[5]) for r in alone], "brand string, sale_date date, kind string, actual double")
        assert got == pytest.approx({r.sale_date: r.predicted for r in decomposable.fit_frame(one).collect()})
    metrics = {r.fold: r for r in folds.fold_metrics(scored).collect()}
    test = [(r.fold, (r.sale_date - r.origin).days, r.actual - r.predicted) for r in scored.where("kind = 'test'").collect()]
    for fold in (1, 2, 3):
        mine = [e for f, _, e in test if f == fold]
        assert metrics[fold].test_rows == len(mine) and metrics[fold].rmse == pytest.approx(math.sqrt(sum(e * e for e in mine) / len(mine)))
    widest, bands = 0.0, {r.step: r.half for r in folds.step_bands(scored).collect()}
    for step in sorted({s for _, s, _ in test}):
        near = [e for _, s, e in test if abs(s - step) <= folds.POOLED]
        widest = max(widest, S.INTERVAL_Z * math.sqrt(sum(e * e for e in near) / len(near)))
        assert bands[step] == pytest.approx(widest)


def test_bands_widen_along_a_forecast(spark):
    series = spark.createDataFrame(line_with_noise(spark), "brand string, sale_date date, total_sales double")
    scored = decomposable.fit_frame(folds.fold_frame(series, 4, horizon=20), ("brand", "fold", "origin"))
    ahead = decomposable.score_series(series, horizon=25, anchor="data_end").where("kind = 'future'").selectExpr(
        "sale_date", "brand", "predicted AS predicted_sales")
    out = folds.with_step_bands(ahead, folds.step_bands(scored), series.groupBy("brand").agg(F.max("sale_date").alias("origin"))).orderBy("sale_date").collect()
    widths = [r.yhat_upper - r.yhat_lower for r in out]
    assert len(widths) == 25 and all(a <= b + 1e-9 for a, b in zip(widths, widths[1:])) and widths[0] < widths[-1] and out[0].yhat_lower < out[0].predicted_sales
