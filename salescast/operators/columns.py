"""Column-statistic operators: filling, encoding and scaling.

Lists of like expressions are stated as SQL text, which the session parses in one call each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.operators.quantiles import exact_quantiles, quantile_name
from salescast.staging import materialize


def replace_columns(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """``df`` with SQL expressions in the place of some columns; new names go last."""
    kept = [f"{expressions[c]} AS `{c}`" if c in expressions else f"`{c}`" for c in df.columns]
    return df.selectExpr(*kept, *[f"{e} AS `{c}`" for c, e in expressions.items() if c not in df.columns])


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column, one small row brought to the driver."""
    row = exact_quantiles(df, columns).first()
    return {c: row[quantile_name(c, 0.5)] for c in columns}


def literal(x: float | None) -> str:
    """A double as SQL text that reads back as the same double."""
    return "double(null)" if x is None else f"double('{x!r}')"


def median_fill(df: DataFrame, columns: Sequence[str] | None = None,
                medians: dict[str, float | None] | None = None) -> DataFrame:
    """Replace nulls by the exact median of the whole column; columns become doubles.

    The medians enter the plan as literals, so branches of the result do not compute them again.
    """
    columns = columns or S.present(df.columns, S.MEDIAN_FILLED + S.MEDIAN_FILLED_OPTIONAL)
    medians = column_medians(df, columns) if medians is None else medians
    return replace_columns(df, {
        c: f"coalesce(nanvl(double(`{c}`), null), {literal(medians[c])})" for c in columns})


def constant_fill(df: DataFrame, values: dict[str, int | float]) -> DataFrame:
    """Replace nulls by a constant, for the columns that exist."""
    have = {c: v for c, v in values.items() if c in df.columns}
    return df.fillna(have) if have else df


def code_tables(df: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """For each column a stored table (column, column_encoded): 0..n-1 over its sorted distinct values.

    All columns, which have one type, share one distinct pass and one sorted table. A value's number is its place there:
    the rows in the partitions before its own, its place in the partition, less the first place of its column. Null
    and NaN have no number.
    """
    slots = F.explode(F.array(*[F.struct(F.lit(i).alias("_slot"), F.col(f"`{c}`").alias("_value")) for i, c in enumerate(columns)]))
    values = df.select(slots.alias("_e")).select("_e.*").where("_value IS NOT NULL").distinct()
    # A stored copy keeps the partition numbers of the ids fixed for both readers.
    placed = materialize(
        values.orderBy("_slot", "_value").withColumn("_id", F.monotonically_increasing_id())
        .selectExpr("_slot", "_value", "shiftright(_id, 33) AS _part", "_id & ((1L << 33) - 1) AS _at"), "codes")
    offsets = placed.groupBy("_part").agg(F.expr("count(*) AS _rows")).selectExpr(
        "_part", "sum(_rows) OVER (ORDER BY _part) - _rows AS _before")
    # A row a partition, hence at most as many as there are shuffle partitions.
    numbered = materialize(
        placed.join(F.broadcast(offsets), "_part").selectExpr("_slot", "_value", "_before + _at AS _place"), "places")
    firsts = {r["_slot"]: r["_first"] for r in numbered.groupBy("_slot").agg(F.min("_place").alias("_first")).collect()}
    return {c: numbered.where(f"_slot = {i}").selectExpr(
        f"_value AS `{c}`", f"int(_place - {firsts.get(i, 0)}) AS `{c}_encoded`") for i, c in enumerate(columns)}


def label_codes(df: DataFrame, column: str) -> DataFrame:
    return code_tables(df, [column])[column]


def label_encode(df: DataFrame, columns: Sequence[str] = S.ENCODED) -> DataFrame:
    """Add the code of each column. The tables are stored, so Spark sees their bytes and broadcasts small ones."""
    for c, codes in code_tables(df, columns).items():
        df = df.join(codes, c, "left")
    return df


def zscore(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Standardise by the mean and sample deviation of the whole column; NaN counts as null."""
    columns = columns or S.present(df.columns, S.ZSCORED)
    df = replace_columns(df, {c: f"nanvl(double(`{c}`), null)" for c in columns})
    stats = df.agg(*[F.expr(f"{f}(`{c}`) AS `_{f}_{c}`") for c in columns for f in ("avg", "stddev_samp")])
    return replace_columns(df.crossJoin(F.broadcast(stats)), {
        c: f"(`{c}` - `_avg_{c}`) / (`_stddev_samp_{c}` + double('{S.ZSCORE_EPSILON!r}'))" for c in columns
    }).drop(*stats.columns)


def minmax_scale(df: DataFrame, columns: Sequence[str], group: str = "brand",
                 fit_where: str = "true") -> DataFrame:
    """Scale into [0, 1] within each series; a column without range becomes 0.

    Adds ``<c>_scaled``, ``<c>_low`` and ``<c>_high``. The condition ``fit_where`` limits the rows
    the bounds are taken from, for instance to the training part; by default it is the whole series.
    """
    bounds = [f"{f}(CASE WHEN {fit_where} THEN `{c}` END) OVER (PARTITION BY `{group}`) AS `{c}_{name}`"
              for c in columns for f, name in (("min", "low"), ("max", "high"))]
    # Without range every value equals the bound, so the difference is already 0.
    return df.selectExpr("*", *bounds).selectExpr("*", *[
        f"(`{c}` - `{c}_low`) / {_span(f'`{c}_low`', f'`{c}_high`')} AS `{c}_scaled`" for c in columns])


def _span(low: str, high: str) -> str:
    return f"CASE WHEN {high} = {low} THEN 1D ELSE {high} - {low} END"


def minmax_inverse(scaled: str, low: str, high: str) -> str:
    """SQL text that takes a scaled value back to its unit."""
    return f"{scaled} * {_span(low, high)} + {low}"
