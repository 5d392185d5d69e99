"""The raw sales table and the interest events, laid over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.staging import spread

TIE_BREAK = ("k1", "k2", "k3", "k4", "k5", "k6")

_EXPRESSIONS = {
    "sale_date": "CAST(o_orderdate AS DATE)",
    "category": "p_type",
    "brand": "p_brand",
    "region": "r_name",
    "total_sales": "CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
                   " AS DECIMAL(16,4)) AS DOUBLE)",
    "quantity_sold": "CAST(l_quantity AS INT)",
    "online_popularity": "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_tax * 1000 END",
    "promotion": "CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END",
    "discount_percentage": "CASE WHEN l_discount >= 0.08 THEN CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS INT)"
                           " ELSE 0 END",
    "competitor_price": "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE p_retailprice END",
    "stock_level": "CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE s_acctbal END",
    "weather_score": "CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE c_acctbal END",
    "supply_delay_days": "CAST(l_linenumber % 4 AS INT)",
    "is_holiday": "CASE WHEN month(o_orderdate) * 100 + day(o_orderdate) IN (126, 815, 1002, 1225) THEN 1 ELSE 0 END",
    "k1": "l_orderkey",
    "k2": "l_linenumber",
    "k3": "l_partkey",
    "k4": "l_suppkey",
    "k5": "l_extendedprice",
    "k6": "l_shipdate",
}

_NEEDS_PART = {"category", "brand", "competitor_price"}
_NEEDS_SUPPLIER = {"stock_level"}
_NEEDS_CUSTOMER = {"weather_score", "region"}
_NEEDS_REGION = {"region"}

COLUMNS = tuple(_EXPRESSIONS)


def sales(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Sales rows with the asked columns.

    Every foreign key of the star has exactly one match, so a dimension whose columns
    are not asked for is not joined at all.
    """
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    wanted = set(columns)
    # What hangs on an order joins the orders, so the far more numerous lines are not moved for it.
    orders = table("orders")
    if wanted & _NEEDS_CUSTOMER:
        orders = orders.join(table("customer"), F.expr("o_custkey = c_custkey"))
    if wanted & _NEEDS_REGION:
        orders = (orders.join(table("nation"), F.expr("c_nationkey = n_nationkey"))
                  .join(table("region"), F.expr("n_regionkey = r_regionkey")))
    df = spread(table("lineitem"), "l_orderkey").join(orders, F.expr("l_orderkey = o_orderkey"))
    if wanted & _NEEDS_PART:
        df = df.join(table("part"), F.expr("l_partkey = p_partkey"))
    if wanted & _NEEDS_SUPPLIER:
        df = df.join(table("supplier"), F.expr("l_suppkey = s_suppkey"))
    return df.select([F.expr(_EXPRESSIONS[c]).alias(c) for c in columns])


def trend_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interest events: (brand, ts)."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.expr("concat('Brand#', cast(user_id % 25 + 1 as string))").alias("brand"), "ts")
