"""Logical tables, column roles and the fixed settings of the workload."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One column of a logical table: canonical name, header used in files, type."""

    name: str
    header: str
    dtype: T.DataType
    required: bool = True


RAW_SALES = (
    Field("sale_date", "Date", T.DateType()),
    Field("category", "Category", T.StringType()),
    Field("brand", "Brand", T.StringType()),
    Field("region", "Region", T.StringType()),
    Field("promotion", "Promotion", T.IntegerType(), False),
    Field("total_sales", "Total_Sales", T.DoubleType()),
    Field("quantity_sold", "Quantity_Sold", T.IntegerType()),
    Field("online_popularity", "Online_Popularity", T.DoubleType()),
    Field("discount_percentage", "Discount_Percentage", T.IntegerType(), False),
    Field("month", "Month", T.IntegerType(), False),
    Field("week", "Week", T.IntegerType(), False),
    Field("is_holiday", "Is_Holiday", T.IntegerType(), False),
    Field("competitor_price", "Competitor_Price", T.DoubleType(), False),
    Field("category_trend_index", "Category_Trend_Index", T.DoubleType(), False),
    Field("customer_growth_rate", "Customer_Growth_Rate", T.DoubleType(), False),
    Field("customer_retention_rate", "Customer_Retention_Rate", T.DoubleType(), False),
    Field("stock_level", "Stock_Level", T.DoubleType(), False),
    Field("supply_delay_days", "Supply_Delay_Days", T.IntegerType(), False),
    Field("inflation_rate", "Inflation_Rate", T.DoubleType(), False),
    Field("weather_score", "Weather_Score", T.DoubleType(), False),
)

FORECAST = (
    Field("sale_date", "Date", T.DateType()),
    Field("brand", "Brand", T.StringType()),
    Field("predicted_sales", "Predicted_Sales", T.DoubleType()),
    Field("yhat_lower", "yhat_lower", T.DoubleType(), False),
    Field("yhat_upper", "yhat_upper", T.DoubleType(), False),
)

METRICS = (
    Field("brand", "Brand", T.StringType()),
    Field("rmse", "RMSE", T.DoubleType()),
    Field("mape_pct", "MAPE (%)", T.DoubleType()),
)

PROCESSED_SALES = (
    Field("brand", "Brand", T.StringType()),
    Field("sale_date", "Date", T.DateType()),
    Field("total_sales", "Total_Sales", T.DoubleType()),
    Field("quantity_sold", "Quantity_Sold", T.DoubleType()),
    Field("online_popularity", "Online_Popularity", T.DoubleType()),
    Field("competitor_price", "Competitor_Price", T.DoubleType(), False),
    Field("category_trend_index", "Category_Trend_Index", T.DoubleType(), False),
    Field("customer_growth_rate", "Customer_Growth_Rate", T.DoubleType(), False),
    Field("customer_retention_rate", "Customer_Retention_Rate", T.DoubleType(), False),
    Field("stock_level", "Stock_Level", T.DoubleType(), False),
    Field("supply_delay_days", "Supply_Delay_Days", T.DoubleType(), False),
    Field("inflation_rate", "Inflation_Rate", T.DoubleType(), False),
    Field("weather_score", "Weather_Score", T.DoubleType(), False),
    Field("promotion", "Promotion", T.DoubleType(), False),
    Field("discount_percentage", "Discount_Percentage", T.DoubleType(), False),
    Field("is_holiday", "Is_Holiday", T.DoubleType(), False),
    Field("sales_lag_1", "Sales_Lag_1", T.DoubleType()),
    Field("sales_ma_3", "Sales_MA_3", T.DoubleType()),
    Field("category_encoded", "Category_Encoded", T.IntegerType()),
    Field("brand_encoded", "Brand_Encoded", T.IntegerType()),
    Field("region_encoded", "Region_Encoded", T.IntegerType()),
    Field("category", "Category", T.StringType()),
)

# The column roles and settings below decide the results.
MEDIAN_FILLED = ("online_popularity", "total_sales", "quantity_sold")
MEDIAN_FILLED_OPTIONAL = (
    "competitor_price", "category_trend_index", "customer_growth_rate",
    "customer_retention_rate", "stock_level", "supply_delay_days",
    "inflation_rate", "weather_score",
)
ZSCORED = (
    "quantity_sold", "online_popularity", "sales_lag_1", "sales_ma_3",
    *MEDIAN_FILLED_OPTIONAL,
)
ENCODED = ("category", "brand", "region")
PLAIN_MEANS = ("promotion", "discount_percentage", "is_holiday")
DECOMPOSABLE_REGRESSORS = (*MEDIAN_FILLED_OPTIONAL, *PLAIN_MEANS)
SEQUENCE_REGRESSORS = (*MEDIAN_FILLED_OPTIONAL, "is_holiday")
ZSCORE_EPSILON = 1e-6
WINDOW_DAYS = 7
HORIZON_DAYS = 30
MIN_SEQUENCES = 20
MIN_CLEAN_ROWS = 3
MIN_TRAIN_ROWS = 2
HOLIDAYS = ("01-26", "08-15", "10-02", "12-25")
FALLBACK_SCORE = 55.0  # midpoint of the 30 to 80 fallback range
INTERVAL_Z = 1.2815515655446004  # two-sided 80 % normal band


def struct(fields: tuple[Field, ...]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dtype) for f in fields])


def present(columns: list[str], wanted: tuple[str, ...]) -> list[str]:
    """The wanted columns that a table really has, in the wanted order."""
    have = set(columns)
    return [c for c in wanted if c in have]
