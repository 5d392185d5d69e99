import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.operators.daily import daily_brand_summary
from salescast.sources import star
from tests import brute

FILLED = ("online_popularity", "total_sales", "quantity_sold", "competitor_price", "stock_level",
          "supply_delay_days", "weather_score")
SCORED = ("quantity_sold", "online_popularity", "sales_lag_1", "sales_ma_3", "competitor_price", "stock_level",
          "supply_delay_days", "weather_score")


def compare(df, tie_break, filled, scored, plain, **kw):
    got = {(r.category, r.brand, r.sale_date): r.asDict() for r in daily_brand_summary(df, tie_break, **kw).collect()}
    want = brute.daily_summary(df.toPandas(), tie_break, filled, scored, plain)
    assert set(got) == set(want)
    for key, w in want.items():
        for c, v in w.items():
            g = got[key][c]
            if v is None or v != v:
                assert g is None, (key, c, g)
            else:
                assert g == pytest.approx(v, rel=1e-9, abs=1e-8), (key, c)
    return got


def test_whole_fixture(raw_sales):
    compare(raw_sales, star.TIE_BREAK, FILLED, SCORED, S.PLAIN_MEANS)


def test_whole_fixture_with_days_cut(raw_sales):
    compare(raw_sales, star.TIE_BREAK, FILLED, SCORED, S.PLAIN_MEANS, buckets=300)


def test_column_order(processed):
    assert processed.columns[:2] == ["brand", "sale_date"]
    assert processed.columns[-1] == "category"


EDGE = "sale_date date, category string, brand string, region string, k1 int, total_sales double, " \
       "quantity_sold int, online_popularity double, stock_level double, is_holiday int"
D = dt.date(2024, 5, 1)


def test_edge_frame(spark):
    """Bad dates, an all-null column, a one-row brand, gaps in the target and equal dates."""
    rows = [
        (D, "c1", "a", "north", 1, 10.0, 1, 50.0, None, None),
        (D, "c1", "a", "south", 2, None, None, None, None, 1),
        (None, "c1", "a", "east", 3, 99.0, 7, 70.0, None, 0),
        (D, "c2", "solo", "north", 4, 40.0, 3, 20.0, None, 0),
        (D + dt.timedelta(days=1), "c2", "a", "west", 5, 30.0, 2, 10.0, None, 0),
        (None, "c3", "ghost", "west", 6, 12.0, 2, 10.0, None, 0),
    ]
    df = spark.createDataFrame(rows, EDGE)
    filled = ("online_popularity", "total_sales", "quantity_sold", "stock_level")
    scored = ("quantity_sold", "online_popularity", "sales_lag_1", "sales_ma_3", "stock_level")
    got = daily_brand_summary(df, ("k1",))
    out = {(r.category, r.brand, r.sale_date): r for r in got.collect()}
    assert set(out) == {("c1", "a", D), ("c2", "solo", D), ("c2", "a", D + dt.timedelta(days=1))}
    assert out["c2", "solo", D].sales_lag_1 is None
    assert out["c1", "a", D].stock_level is None
    assert out["c1", "a", D].is_holiday == 0.5
    assert out["c1", "a", D].region_encoded == 1  # north: east, north, south, west
    assert out["c2", "a", D + dt.timedelta(days=1)].category_encoded == 1
    assert "competitor_price" not in got.columns
    compare(df.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0))), ("k1",), filled, scored, ("is_holiday",))


def test_all_null_quantity_sums_to_zero(spark):
    df = spark.createDataFrame([(D, "c", "a", "r", 1, 5.0, None, 1.0, 1.0, 0),
                                (D, "c", "b", "r", 2, 6.0, None, 2.0, 2.0, 0)], EDGE)
    assert {r.quantity_sold for r in daily_brand_summary(df, ("k1",)).collect()} == {0.0}


def test_result_does_not_depend_on_partitioning(raw_sales, processed):
    other = daily_brand_summary(raw_sales.repartition(7), star.TIE_BREAK)
    a = {(r.category, r.brand, r.sale_date): r for r in processed.collect()}
    for r in other.collect():
        for c, v in r.asDict().items():
            mine = a[r.category, r.brand, r.sale_date][c]
            assert mine == (pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(v, float) else v)


def test_only_what_lag_and_mean_need_is_put_in_order(raw_sales, monkeypatch):
    """The other columns are summed where they lie: the widest exchange of the summary does not move them."""
    from salescast.operators import history

    moved, before = [], history.ordered_buckets
    monkeypatch.setattr(history, "ordered_buckets", lambda df, *a: moved.append(set(df.columns)) or before(df, *a))
    daily_brand_summary(raw_sales, star.TIE_BREAK)
    assert moved == [{"category", "brand", "sale_date", "region", "total_sales", *star.TIE_BREAK}]


def test_holidays_of_all_days(spark):
    """Month and day as numbers mark the days that their text does; a missing date is no holiday."""
    days = spark.sql("SELECT explode(concat(sequence(TIMESTAMP '1995-12-20 23:59:59', TIMESTAMP '1997-01-05 00:00:00', INTERVAL 1 DAY),"
                     " array(TIMESTAMP(null)))) AS o_orderdate")
    rule = star._EXPRESSIONS["is_holiday"]
    assert "date_format" not in rule
    text = "CASE WHEN date_format(o_orderdate, 'MM-dd') IN ('01-26', '08-15', '10-02', '12-25') THEN 1 ELSE 0 END"
    rows = days.selectExpr(f"{rule} AS got", f"{text} AS want").collect()
    assert [r.got for r in rows] == [r.want for r in rows] and sum(r.got for r in rows) == 5
