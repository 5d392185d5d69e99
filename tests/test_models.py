import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.models import decomposable, linear, outcome, regression, sequence
from salescast.operators.evaluate import holdout_metrics
from salescast.plans.full_run import sequence_metrics

D = dt.date(2024, 1, 1)


def linear_series(spark, n=60):
    return spark.createDataFrame([("a", D + dt.timedelta(days=i), 100.0 + 3 * i) for i in range(n)],
                                 "brand string, sale_date date, total_sales double")


def test_line_is_forecast_exactly(spark):
    scored = decomposable.score_series(linear_series(spark)).collect()
    assert len(scored) == 60 + 30
    for r in scored:
        day = (r.sale_date - D).days
        assert r.predicted == pytest.approx(100 + 3 * day, rel=1e-9)
        assert r.yhat_lower <= r.predicted <= r.yhat_upper


def test_horizon_follows_train_end(spark):
    rows = decomposable.forecast_rows(decomposable.score_series(linear_series(spark, 90)))
    assert rows.count() == 72 + 30
    assert rows.agg(F.max("sale_date")).first()[0] == D + dt.timedelta(days=101)
    late = decomposable.score_series(linear_series(spark, 90), anchor="data_end").where("kind = 'future'")
    assert late.agg(F.min("sale_date")).first()[0] == D + dt.timedelta(days=90)


def test_skipped_brands_have_no_rows(spark):
    df = linear_series(spark, 10).unionByName(linear_series(spark, 2).withColumn("brand", F.lit("short")))
    assert {r.brand for r in decomposable.score_series(df).select("brand").distinct().collect()} == {"a"}
    assert sequence.score_series(linear_series(spark, 26)).count() == 0


def test_regressor_model_against_dense_algebra(spark):
    """The grouped map against one dense weighted ridge system built from scratch."""
    n = 120
    rows = [("a", D + dt.timedelta(days=i), 500 + 2 * i + 40 * math.sin(i) + 15 * (i % 5), float(i % 5), 1.0)
            for i in range(n)]
    df = spark.createDataFrame(rows, "brand string, sale_date date, total_sales double, promotion double, flat double")
    got = (regression.score_series_with_regressors(df, ["promotion", "flat"])
           .where("kind <> 'future'").orderBy("sale_date").collect())
    train = n * 4 // 5
    y = np.array([r[2] for r in rows])
    t = np.arange(n) / (train - 1)
    trend = np.column_stack([np.ones(n), t, *[np.maximum(t - 0.8 * (k + 1) / 26, 0) for k in range(25)]])
    day = np.array([(r[1] - dt.date(1970, 1, 1)).days for r in rows], float)
    waves = [f(2 * np.pi * k * day / p) for p, terms in ((365.25, 10), (7, 3))
             for k in range(1, terms + 1) for f in (np.sin, np.cos)]
    promo = np.array([r[3] for r in rows])
    promo = (promo - promo[:train].mean()) / promo[:train].std(ddof=1)
    season = np.column_stack([*waves, promo, np.zeros(n)])

    def ridge(x, target, penalty):  # as least squares on stacked rows
        stacked = np.vstack([x, np.diag(np.sqrt(penalty))])
        return np.linalg.lstsq(stacked, np.r_[target, np.zeros(len(penalty))], rcond=None)[0]

    g = trend @ ridge(trend[:train], y[:train], np.r_[[1e-9] * 2, [0.1] * 25])
    weighted = season * g[:, None]
    beta = ridge(weighted[:train], (y - g)[:train], np.full(season.shape[1], np.mean(g[:train] ** 2)))
    want = g + weighted @ beta
    assert np.allclose([r.predicted for r in got], want, rtol=1e-6)
    half = S.INTERVAL_Z * np.std((y - want)[:train], ddof=1)
    assert got[0].yhat_upper - got[0].predicted == pytest.approx(half, rel=1e-6)


def test_regressor_model_on_all_brands(processed_series):
    scored = regression.score_series_with_regressors(processed_series)
    out = decomposable.forecast_rows(scored)
    assert out.where("predicted_sales IS NULL OR isnan(predicted_sales) OR yhat_lower > yhat_upper").count() == 0
    counts = processed_series.groupBy("brand").agg(F.expr("count(*) * 4 DIV 5 + 30 AS want"))
    assert out.groupBy("brand").count().join(counts, "brand").where("count <> want").count() == 0


def ar_reference(x, horizon=30):
    """Windows, ridge fit and recursion spelled out with loops."""
    low, high = x.min(axis=0), x.max(axis=0)
    span = np.where(high == low, 1, high - low)
    s = (x - low) / span
    pairs = [(s[i:i + 7].ravel(), s[i + 7, 0]) for i in range(len(s) - 7)]
    cut = int(len(pairs) * 0.8)
    a = np.array([p for p, _ in pairs[:cut]])
    b = np.array([q for _, q in pairs[:cut]])
    ca, cb = a.mean(axis=0), b.mean()
    stacked = np.vstack([a - ca, np.eye(a.shape[1])])
    beta = np.linalg.lstsq(stacked, np.r_[b - cb, np.zeros(a.shape[1])], rcond=None)[0]
    test = [float((p - ca) @ beta + cb) for p, _ in pairs[cut:]]
    days = [row.copy() for row in s]
    for _ in range(horizon):
        nxt = days[-1].copy()
        nxt[0] = (np.concatenate(days[-7:]) - ca) @ beta + cb
        days.append(nxt)
    return test, [float(d[0] * span[0] + low[0]) for d in days[-horizon:]]


def test_sequence_model_against_loops(processed_series):
    features = ["total_sales", "online_popularity", "competitor_price", "stock_level", "supply_delay_days",
                "weather_score", "is_holiday"]
    scored = sequence.score_series(processed_series).toPandas()
    pdf = processed_series.toPandas().sort_values("sale_date")
    for brand, part in pdf.groupby("brand"):
        test, future = ar_reference(part[features].to_numpy(float))
        mine = scored[scored["brand"] == brand].sort_values("sale_date")
        assert np.allclose(mine.loc[mine["kind"] == "test", "predicted_scaled"], test, atol=1e-8)
        ahead = mine[mine["kind"] == "future"]
        assert np.allclose(ahead["predicted"], future, rtol=1e-8)
        last = part["sale_date"].max()
        assert list(ahead["sale_date"]) == [last + dt.timedelta(days=i) for i in range(1, 31)]


def test_any_model_function_can_be_used(spark):
    def repeat_last(windows, targets):
        return lambda w: w[:, -1, 0]

    scored = sequence.score_series(linear_series(spark, 40), fit=repeat_last)
    future = [r.predicted for r in scored.where("kind = 'future'").collect()]
    assert future == pytest.approx([100 + 3 * 39] * 30)
    metrics = sequence_metrics(scored).first()
    assert metrics.rmse_sales == pytest.approx(3.0) and metrics.rmse == pytest.approx(3.0 / (3 * 39))


def test_scaling_bounds_from_train_only(spark):
    scored = sequence.score_series(linear_series(spark, 40), fit_on="train").where("kind = 'test'")
    assert scored.agg(F.max("actual_scaled")).first()[0] > 1
    assert scored.where("abs(actual - round(actual)) > 1e-6").count() == 0


def test_zero_target_makes_the_percentage_error_explode(spark):
    df = spark.createDataFrame([("a", "test", 0.0, 1.0), ("a", "test", 2.0, 1.0), ("a", "train", 5.0, 0.0)],
                               "brand string, kind string, actual double, predicted double")
    m = holdout_metrics(df).first()
    assert m.rmse == 1.0
    assert m.mape_pct == pytest.approx((1 / 2.220446049250313e-16 + 0.5) / 2 * 100)


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_systems_are_solved_by_array_expressions(spark, n):
    rng = np.random.default_rng(n)
    rows, want = [], {}
    for brand in ("a", "b", "c"):
        x = rng.normal(size=(3 * n + 2, n)) * rng.uniform(0.1, 100, n)
        y = rng.normal(size=len(x))
        want[brand] = np.linalg.solve(x.T @ x + np.eye(n), x.T @ y)
        rows += [(brand, [*map(float, r), float(t)]) for r, t in zip(x, y, strict=True)]
    sums = linear.gram(spark.createDataFrame(rows, "brand string, v array<double>").repartition(3), "v")
    lower = {r.brand: r.a for r in sums.collect()}
    assert [len(line) for line in lower["a"]] == list(range(1, n + 2))
    got = linear.solve(sums, linear.block("a", 0, f"{n}", "1D"), f"slice(a[{n}], 1, {n})", "beta").collect()
    for r in got:
        assert np.allclose(r.beta, want[r.brand], rtol=1e-8, atol=1e-12)


def test_systems_without_a_solution_give_no_error(spark):
    flat = spark.createDataFrame([("a", [1.0, 1.0, 2.0]), ("b", [0.0, 0.0, 1.0])], "brand string, v array<double>")
    got = linear.solve(linear.gram(flat, "v"), linear.block("a", 0, "2", "0D"), "slice(a[2], 1, 2)", "beta").collect()
    assert all(any(x is None or math.isnan(x) for x in r.beta) for r in got)


def by_key(df):
    return {(r.brand, r.sale_date, r.kind): r.predicted for r in df.collect()}


def test_default_model_equals_its_function(processed_series):
    """The fit and the recursion in the JVM against the same model as a function in a grouped map."""
    got, want = by_key(sequence.score_series(processed_series)), by_key(
        sequence.score_series(processed_series, fit=sequence.ridge_autoregression))
    assert got.keys() == want.keys()
    assert np.allclose([got[k] for k in got], [want[k] for k in got], rtol=1e-8)
    got, want = by_key(sequence.score_series(processed_series, fit=linear.WINDOW_MEAN)), by_key(
        sequence.score_series(processed_series, fit=lambda windows, targets: lambda w: w[:, :, 0].mean(axis=1)))
    assert got.keys() == want.keys() and np.allclose([got[k] for k in got], [want[k] for k in got], rtol=1e-9)


def test_no_python_in_either_default_model(processed_series):
    for df in (sequence.attempt(processed_series), regression.attempt(processed_series)):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def with_gaps(spark):
    """Four brands of sixty days: one complete, one without a feature, one with a NaN, one with an infinite target; and a short one."""
    rows = []
    for brand in ("a", "b", "c", "d", "e"):
        for i in range(60 if brand != "e" else 9):
            feature = {"b": None, "c": float("nan") if i == 30 else 1.0 * i}.get(brand, float(i % 7))
            rows.append((brand, D + dt.timedelta(days=i), float("inf") if brand == "d" and i == 5 else 100.0 + i % 5, feature))
    return spark.createDataFrame(rows, "brand string, sale_date date, total_sales double, stock_level double")


def test_every_brand_has_scores_or_a_reason(spark):
    tried = sequence.attempt(with_gaps(spark), ("stock_level",))
    assert {tuple(r) for r in outcome.skipped(tried).collect()} == {
        ("b", "missing values: stock_level"), ("c", "missing values: stock_level"), ("d", "missing values: total_sales"),
        ("e", "not enough samples")}
    scored = outcome.scores(tried)
    assert {r.brand for r in scored.collect()} == {"a"} and "reason" not in scored.columns
    assert scored.where("predicted IS NULL OR isnan(predicted)").count() == 0
    tried = regression.attempt(with_gaps(spark), ("stock_level",))
    assert {tuple(r) for r in outcome.skipped(tried).collect()} == {
        ("b", "not enough valid train data"), ("c", "not enough valid train data")}
    assert {r.brand for r in outcome.scores(tried).select("brand").distinct().collect()} == {"a", "d", "e"}
    tried = decomposable.attempt(linear_and_short(spark))
    assert [tuple(r) for r in outcome.skipped(tried).collect()] == [("short", "insufficient data")]


def linear_and_short(spark):
    return linear_series(spark, 10).unionByName(linear_series(spark, 2).withColumn("brand", F.lit("short")))


def test_a_failing_fit_is_the_reason_of_its_brand_alone(spark):
    df = linear_series(spark, 40).unionByName(linear_series(spark, 40).withColumns({
        "brand": F.lit("z"), "total_sales": F.lit(5.0)})).unionByName(linear_series(spark, 41).withColumn("brand", F.lit("n")))

    def fit(windows, targets):
        if not targets.any():
            raise RuntimeError("flat")
        if len(targets) == 27:
            return lambda w: np.full(len(w), np.nan)
        return lambda w: w[:, -1, 0]

    tried = sequence.attempt(df, fit=fit)
    assert {tuple(r) for r in outcome.skipped(tried).collect()} == {("z", "fit failed: RuntimeError: flat"), ("n", outcome.NOT_FINITE)}
    assert outcome.scores(tried).count() == 7 + 30
    again = sequence.attempt(df.where("brand = 'z'"), fit=fit)
    assert [tuple(r)[:3] for r in again.select("brand", "kind", "reason").collect()] == [("z", "skip", "fit failed: RuntimeError: flat")]
