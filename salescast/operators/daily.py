"""Daily brand summary: the processed table every forecast and report reads."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.operators.columns import (
    code_tables,
    column_medians,
    constant_fill,
    label_codes,
    literal,
    median_fill,
    replace_columns,
)
from salescast.operators.history import add_sales_history
from salescast.staging import materialize

KEYS = ("category", "brand", "sale_date")
HISTORY = ("sales_lag_1", "sales_ma_3")


def daily_brand_summary(
    raw: DataFrame, tie_break: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Raw sale rows to one row per (category, brand, date).

    In order: median fill, holiday fill, label codes, lag and trailing mean over the sale
    rows, global z-scores, and the daily sums, means and first codes.

    A z-score is linear in its input, so the daily sums and means are standardised after
    the aggregation. The global moments come from daily counts, sums and sums of squares, taken as
    distances from the median to stay exact for columns far from zero.

    Only what lag and trailing mean need is put in the order of the sale rows. All other columns are summed where they
    lie; both kinds of rows meet in one aggregation.
    """
    region_codes = label_codes(raw, "region")
    medians = column_medians(raw, S.present(raw.columns, S.MEDIAN_FILLED + S.MEDIAN_FILLED_OPTIONAL))
    filled = constant_fill(median_fill(raw, list(medians), medians), {"is_holiday": 0})
    scored = S.present([*filled.columns, *HISTORY], S.ZSCORED)
    plain = S.present(filled.columns, S.PLAIN_MEANS)
    kept = (*KEYS, "region", "total_sales")
    ordered = add_sales_history(filled.select(*dict.fromkeys((*kept, *tie_break))), tie_break=tie_break, buckets=buckets,
                                keep_order=True, columns=kept)
    ordered = ordered.join(region_codes, "region", "left").select(*KEYS, "region_encoded", "_position", *HISTORY)
    summed = filled.select(*KEYS, "total_sales", *[c for c in (*scored, *plain) if c not in HISTORY])
    rows = summed.unionByName(ordered, allowMissingColumns=True)

    def distance(c: str) -> str:
        return f"({c} - {literal(medians.get(c, medians['total_sales']))})"

    daily = materialize(
        rows.groupBy(*KEYS).agg(*map(F.expr, (
            "coalesce(sum(total_sales), 0D) AS total_sales",
            *[f"avg({c}) AS {c}" for c in plain],
            "min_by(region_encoded, _position) AS region_encoded",
            *[f"count({c}) AS _n_{c}" for c in scored],
            *[f"sum({distance(c)}) AS _d_{c}" for c in scored],
            *[f"sum({distance(c)} * {distance(c)}) AS _dd_{c}" for c in scored],
        ))),
        "daily",
    )

    sums = daily.selectExpr(*[f"sum({k}{c}) AS {k}{c}" for c in scored for k in ("_n_", "_d_", "_dd_")]).first()

    def z_sum(c: str) -> str:
        """Sum of the day's z-scores; null if the column has no deviation."""
        n, d, dd = (sums[f"{k}{c}"] for k in ("_n_", "_d_", "_dd_"))
        if not n or n < 2:
            return "double(null)"
        std = math.sqrt(max(dd - d * d / n, 0.0) / (n - 1))
        return f"((_d_{c} - _n_{c} * {literal(d / n)}) / {literal(std + S.ZSCORE_EPSILON)})"

    complete = replace_columns(daily, {
        "quantity_sold": f"coalesce({z_sum('quantity_sold')}, 0D)",
        **{c: f"try_divide({z_sum(c)}, _n_{c})" for c in scored if c != "quantity_sold"}})
    # The codes number the values of all raw rows, also of those without a valid date.
    for key, codes in code_tables(daily, ("category", "brand")).items():
        complete = complete.join(codes, key, "left")
    # Rows without a date count for the moments above, but have no day to be summed under.
    complete = complete.where(" AND ".join(f"{k} IS NOT NULL" for k in KEYS))
    return complete.select(S.present(complete.columns, tuple(f.name for f in S.PROCESSED_SALES)))
