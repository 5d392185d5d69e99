import datetime as dt

import pytest

from salescast import schema as S
from salescast.operators.columns import constant_fill, label_codes, label_encode, zscore
from salescast.operators.slices import drop_if_present
from salescast.plans.full_run import run_all
from salescast.sources import star, tables
from salescast.sources.star import TIE_BREAK
from tests.conftest import SF

CSV = """Date,Category,Brand,Region,Total_Sales,Quantity_Sold,Online_Popularity,Stock_Level,Is_Holiday
2024-01-02,Dairy,a,north,10.5,3,40.0,100,0
bad,Dairy,b,south,x,4.0,,7,
"""


@pytest.fixture
def csv_path(tmp_path):
    (tmp_path / "sales.csv").write_text(CSV)
    return str(tmp_path / "sales.csv")


def test_csv_is_read_leniently_with_optional_columns_absent(spark, csv_path):
    df = tables.read_required(spark, csv_path, S.RAW_SALES, "csv")
    assert "weather_score" not in df.columns
    rows = {r.brand: r for r in df.collect()}
    assert rows["a"].sale_date == dt.date(2024, 1, 2) and rows["a"].total_sales == 10.5
    assert rows["b"].sale_date is None and rows["b"].total_sales is None and rows["b"].quantity_sold == 4


FIRST = "Date,Category,Brand,Region,Total_Sales,Quantity_Sold,Online_Popularity,note\n"


@pytest.fixture
def batches(tmp_path):
    """Two orders of the columns, an optional and a further column in one of them only, and files without rows or lines."""
    (tmp_path / "a.csv").write_text(FIRST + "2024-01-01,c,x,north,1.5,2,30,\"one, two\"\n")
    (tmp_path / "b.csv").write_text("Quantity_Sold,Stock_Level,Brand,Category,Online_Popularity,Date,Region,Total_Sales\n"
                                    "20,7,y,B,40,2024-01-02,south,2.5\n")
    (tmp_path / "c.csv").write_text(FIRST + "2024-01-03,d,z,west,3.5,4,50,\n")
    (tmp_path / "d.csv").write_text(FIRST)
    (tmp_path / "e.csv").write_text("")
    return tmp_path


def test_files_with_other_header_orders(spark, batches):
    df = tables.read_required(spark, str(batches), S.RAW_SALES, "csv")
    got = {r.brand: (r.sale_date.day, r.category, r.region, r.total_sales, r.quantity_sold, r.online_popularity, r.stock_level, r.note)
           for r in df.collect()}
    assert got == {"x": (1, "c", "north", 1.5, 2, 30.0, None, "one, two"), "y": (2, "B", "south", 2.5, 20, 40.0, 7.0, None),
                   "z": (3, "d", "west", 3.5, 4, 50.0, None, None)}
    assert len(tables.csv_by_header(spark, str(batches))) == 2  # files with one header share a scan
    only = df.select("brand").where("brand = 'y'")
    assert [r.brand for r in only.collect()] == ["y"]


def test_a_batch_without_a_required_column_is_refused(spark, batches):
    (batches / "f.csv").write_text("Date,Category,Brand,Region,Quantity_Sold,Online_Popularity\n2024-01-01,c,x,north,2,30\n")
    with pytest.raises(ValueError, match="Total_Sales"):
        tables.read_required(spark, str(batches), S.RAW_SALES, "csv")


def test_partitioned_and_compressed_text(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.0, 2.0, "x"), ("b", 3.0, 4.0, "y")], "brand string, rmse double, mape_pct double, region string")
    named = rows.withColumnsRenamed({f.name: f.header for f in S.METRICS})
    named.write.partitionBy("region").option("header", True).option("compression", "gzip").csv(str(tmp_path / "p"))
    named.drop("region").select("MAPE (%)", "Brand", "RMSE").write.option("header", True).csv(str(tmp_path / "p" / "region=z"))
    got = {(r.brand, r.rmse, r.mape_pct, r.region) for r in tables.read_required(spark, str(tmp_path / "p"), S.METRICS, "csv").collect()}
    assert got == {("a", 1.0, 2.0, "x"), ("b", 3.0, 4.0, "y"), ("a", 1.0, 2.0, "z"), ("b", 3.0, 4.0, "z")}


def test_folder_without_text_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        tables.read_required(spark, str(tmp_path / "empty"), S.METRICS, "csv")
    assert tables.read_optional(spark, str(tmp_path / "empty"), S.METRICS, "csv").isEmpty()


def test_missing_required_column(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Date,Brand\n2024-01-01,a\n")
    with pytest.raises(ValueError, match="Total_Sales"):
        tables.read_required(spark, str(tmp_path / "x.csv"), S.RAW_SALES, "csv")


def test_missing_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_required(spark, str(tmp_path / "none"), S.METRICS)
    empty = tables.read_optional(spark, str(tmp_path / "none"), S.METRICS)
    assert empty.columns == ["brand", "rmse", "mape_pct"] and empty.isEmpty()


def test_headers_survive_a_round_trip(spark, tmp_path):
    metrics = tables.rows_to_table(spark, [{"brand": "a", "rmse": 1.5, "mape_pct": 2.5}], S.METRICS)
    tables.write_table(tables.with_headers(metrics, S.METRICS), str(tmp_path / "m"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).columns == ["Brand", "RMSE", "MAPE (%)"]
    assert [tuple(r) for r in tables.read_required(spark, str(tmp_path / "m"), S.METRICS, "csv").collect()] == [("a", 1.5, 2.5)]


def test_partitioned_write(spark, tmp_path, raw_sales):
    tables.write_table(raw_sales.selectExpr("brand", "total_sales", "trunc(sale_date, 'MM') AS month_start"),
                       str(tmp_path / "p"), partition_by=("month_start",))
    assert spark.read.parquet(str(tmp_path / "p")).count() == raw_sales.count()


def test_table_can_be_read_and_replaced(spark, tmp_path):
    root = str(tmp_path / "scores")
    tables.publish(spark.range(3), root)
    current = tables.read_published(spark, root)
    tables.publish(current.where("id > 0"), root)
    assert tables.read_published(spark, root).count() == 2 and current.count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_published(spark, str(tmp_path / "nothing"))


def test_append_and_drop(spark):
    a = spark.createDataFrame([(1, "x")], "id int, old string")
    b = spark.createDataFrame([(2, 5)], "id int, new int")
    assert sorted(tuple(r) for r in tables.append_batch(a, b).collect()) == [(1, "x", None), (2, None, 5)]
    assert drop_if_present(a, "old", "absent").columns == ["id"]


def test_codes_and_scores(spark):
    df = spark.createDataFrame([("b", 1.0, None), ("a", 3.0, None), ("b", 5.0, None), (None, 7.0, 1)],
                               "brand string, x double, is_holiday int")
    assert sorted((r.brand or "", r.brand_encoded) for r in label_encode(df, ["brand"]).collect()) == [
        ("", None), ("a", 0), ("b", 1), ("b", 1)]
    z = [r.x for r in zscore(df, ["x"]).collect()]
    assert sum(z) == pytest.approx(0) and max(z) == pytest.approx(3 / (20 / 3) ** 0.5, rel=1e-6)
    assert [r.is_holiday for r in constant_fill(df, {"is_holiday": 0, "absent": 1}).collect()] == [0, 0, 0, 1]


def test_codes_of_a_large_dictionary(spark):
    df = spark.range(5000).selectExpr("concat('v', id % 3000) AS brand")
    got = label_codes(df, "brand").collect()
    assert sorted((r.brand, r.brand_encoded) for r in got) == [
        (b, i) for i, b in enumerate(sorted(f"v{i}" for i in range(3000)))]


def test_whole_run(spark, tmp_path):
    out = str(tmp_path / "out")
    result = run_all(star.sales(spark, SF), star.trend_events(spark, SF), TIE_BREAK, out, "2024-01-30")
    assert result["decomposable_metrics"].count() == 25 and result["sequence_metrics"].count() == 25
    assert result["sequence_forecast"].count() == 25 * 30
    assert result["model_comparison"].count() == 25
    assert tables.read_published(spark, f"{out}/processed_sales").count() == 5770
    text = "\n".join(r.value for r in spark.read.text(f"{out}/brand_forecast_summary").collect())
    assert "expected to perform best next month: Brand#" in text


def test_run_with_too_little_data_publishes_no_forecast(spark, tmp_path):
    rows = [(dt.date(2024, 1, 1), "c", "a", "r", 1, 5.0, 1, 2.0), (dt.date(2024, 1, 2), "c", "a", "r", 2, 6.0, 1, 2.0)]
    raw = spark.createDataFrame(rows, "sale_date date, category string, brand string, region string, k1 int, "
                                      "total_sales double, quantity_sold int, online_popularity double")
    events = spark.createDataFrame([("a", dt.datetime(2024, 1, 2))], "brand string, ts timestamp")
    result = run_all(raw, events, ("k1",), str(tmp_path / "out"), "2024-01-02")
    with pytest.raises(FileNotFoundError):
        tables.read_published(spark, f"{tmp_path}/out/decomposable_forecast")
    assert result["kpi_overview"].first().fastest_brand == "N/A"
    assert result["decomposable_forecast"].isEmpty()
    assert {tuple(r) for r in result["skipped_brands"].select("model", "brand", "reason").collect()} == {
        ("decomposable", "a", "insufficient data"), ("sequence", "a", "insufficient rows")}


TEXT = """Date,Category,Brand,Region,Total_Sales,Quantity_Sold,Online_Popularity,Stock_Level,Is_Holiday,sale_id,shop
2024-01-02 13:45:00,Dairy,a,NaN,10.5,3,NaN,100,0,9,x
2024-01-03T00:00:00,NA,b,south,nan,4.0,null,n/a,0,10,NaN
 2024-01-04,Dairy,c,south,1,4.0,1,2,0,11,
"""


def test_missing_values_times_and_types_of_a_text_file(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(TEXT)
    df = tables.read_required(spark, str(tmp_path / "sales.csv"), S.RAW_SALES, "csv", extra={"sale_id": "long"})
    rows = {r.brand: r for r in df.collect()}
    assert [rows[b].sale_date for b in "ab"] == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert rows["a"].region is None and rows["a"].online_popularity is None
    assert rows["b"].category is None and rows["b"].total_sales is None and rows["b"].stock_level is None
    assert rows["b"].shop is None and rows["c"].shop is None and rows["a"].shop == "x"
    assert dict(df.dtypes)["sale_id"] == "bigint" and dict(df.dtypes)["shop"] == "string"
    assert [r.sale_id for r in df.orderBy("sale_id").collect()] == [9, 10, 11]


def test_published_partitions_are_pruned(spark, tmp_path):
    root = str(tmp_path / "daily")
    df = spark.sql("SELECT date_add(DATE '2024-01-30', int(id)) AS sale_date, id FROM range(5)").selectExpr(
        "*", "trunc(sale_date, 'MM') AS month_start")
    tables.publish(df, root, ("month_start",))
    last = tables.read_published(spark, root).where("month_start = DATE '2024-02-01'")
    assert last.count() == 3
    assert "PartitionFilters: [isnotnull(month_start" in last._jdf.queryExecution().executedPlan().toString()
