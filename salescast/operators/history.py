"""Lag, trailing mean and gap filling over a brand's transaction rows, without one task per brand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.staging import bucketed, materialize


#: Rows of a range, as far as no number of ranges is asked for; and of the least range that is worth a task.
RANGE_ROWS, LEAST_ROWS = 250_000, 10_000
#: Rows of a table of range ends that goes to all tasks; a longer one is joined as Spark sees fit.
SENT_ROWS = 200_000


def ordered_buckets(
    df: DataFrame, order: Sequence[str | Column], buckets: int | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """``df`` stored in ranges of ``order`` (names ascending, nulls first; or sort expressions), with the number of the range as ``_slice`` and the
    place of the row in the whole order as ``_position``, a long.

    Rows of a lower slice precede those of a higher one in the very order of the columns' own types, and
    equal rows share a slice. Spark cuts the ranges from a sample, so a slice holds about as many rows as any
    other, however many of them belong to one brand or day. The table is stored because another
    evaluation could cut elsewhere, in buckets of ``_slice``, so what is windowed or grouped by it moves no rows again.
    ``buckets`` sets how many ranges there are; by default a range has about ``RANGE_ROWS`` rows, less where there are
    fewer ranges than shuffle partitions. It decides the cost alone. ``columns`` are those that stay, by default all.
    """
    if not buckets:
        rows, partitions = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(1, -(-rows // RANGE_ROWS), min(partitions, -(-rows // LEAST_ROWS)))
    keys = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order]
    placed = df.repartitionByRange(buckets, *keys).sortWithinPartitions(*keys).select(
        *[F.col(f"`{c}`") for c in columns or df.columns], F.spark_partition_id().alias("_slice"),
        F.monotonically_increasing_id().alias("_position"))
    # A single bucket would be a single task; the brands of one range are dealt out instead.
    return bucketed(placed, "ordered", "_slice", buckets) if buckets > 1 else materialize(placed, "ordered")


class _Buckets:
    """Rows of a brand in slices, and for each slice what the rows before and after it bring along."""

    def __init__(self, df: DataFrame, value: str, brand: str, date: str, tie_break: Sequence[str], buckets: int | None,
                 columns: Sequence[str] | None = None):
        self.columns = list(columns or df.columns)
        # Rows without a date come last in their brand.
        self.rows = ordered_buckets(df, [brand, F.col(f"`{date}`").asc_nulls_last(), *tie_break], buckets, self.columns)
        self.brand = brand
        self.ascending = f"PARTITION BY {brand}, _slice ORDER BY _position"
        # Looking ahead is looking back in the opposite order: a frame that ends with its partition costs its square.
        self.descending = f"{self.ascending} DESC"
        along = f"PARTITION BY {brand} ORDER BY _slice"
        # A brand's rows of a slice have consecutive positions, so of its last two one is even and one odd: plain aggregates find both.
        even, odd, known = (f"CASE WHEN {x} THEN _position END" for x in ("_position % 2 = 0", "_position % 2 <> 0", f"{value} IS NOT NULL"))
        tails = (
            self.rows.where(f"{brand} IS NOT NULL")
            .groupBy(brand, "_slice").agg(*map(F.expr, (
                "count(*) AS _n", "min(_position) AS _begin",
                f"max({even}) AS _even_at", f"max_by({value}, {even}) AS _even",
                f"max({odd}) AS _odd_at", f"max_by({value}, {odd}) AS _odd",
                f"min({known}) AS _known_at", f"min_by({value}, {known}) AS _first_known", f"max_by({value}, {known}) AS _last_known")))
            .selectExpr(brand, "_slice", "_n", "_last_known", "coalesce(_even_at, -1) > coalesce(_odd_at, -1) AS _ends_even", "_even", "_odd",
                        "CASE WHEN _known_at IS NOT NULL THEN struct(_known_at - _begin + 1 AS _rn, _first_known AS _v) END AS _first_known")
            .selectExpr("*", "CASE WHEN _ends_even THEN _even ELSE _odd END AS _last", "CASE WHEN _ends_even THEN _odd ELSE _even END AS _second"))
        placed = tails.selectExpr(
            "*", f"sum(_n) OVER ({along}) - _n AS _start",
            f"lag(_last) OVER ({along}) AS _carry_1",
            f"CASE WHEN lag(_n) OVER ({along}) >= 2 THEN lag(_second) OVER ({along})"
            f" ELSE lag(_last, 2) OVER ({along}) END AS _carry_2",
            f"last_value(_last_known, true) OVER ({along} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _known_before",
            f"last_value(_first_known._v, true) OVER ({along} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _known_after")
        opening = f"min(CASE WHEN _first_known IS NOT NULL THEN struct(_start + _first_known._rn AS at, _first_known._v AS v) END) OVER (PARTITION BY {brand})"
        # One row a brand and slice it reaches into: about as many as there are slices and brands.
        self.carry = materialize(placed.selectExpr(
            brand, "_slice", "_carry_1", "_carry_2", "_known_before", "_known_after",
            f"{opening} AS _opening", f"sum(_n) OVER (PARTITION BY {brand}) AS _total"), "carried")

    def joined(self, *windows: str) -> DataFrame:
        carry = F.broadcast(self.carry) if self.carry.count() <= SENT_ROWS else self.carry
        return self.rows.selectExpr("*", *windows).join(carry, [self.brand, "_slice"], "left")


def add_sales_history(
    df: DataFrame,
    *,
    tie_break: Sequence[str],
    value: str = "total_sales",
    brand: str = "brand",
    date: str = "sale_date",
    buckets: int | None = None,
    keep_order: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``sales_lag_1`` and ``sales_ma_3`` in the order (brand, date, tie-break).

    The lag is the value of the brand's previous *row*, filled forward and then backward: where that row has
    none it is the last known value before, and where there is none before it is the first one known, if
    a row follows it. So the first row of a brand takes its own value unless it is the only one. The mean
    is over the known values of the row and the two before it. ``tie_break`` makes the order total;
    its columns may have any type that sorts.

    Rows are windowed inside (brand, slice) buckets of bounded size; what precedes a bucket comes from a small table
    with the ends of every bucket. With ``keep_order`` the position of a row in the order stays as ``_position``.
    ``columns`` are the columns of ``df`` that stay, brand and value among them; by default all do.
    """
    own = _Buckets(df, value, brand, date, tie_break, buckets, columns)
    over = own.ascending
    before = own.joined(
        f"row_number() OVER ({over}) AS _rn", f"lag({value}, 1) OVER ({over}) AS _prev_1", f"lag({value}, 2) OVER ({over}) AS _prev_2",
        f"last_value({value}, true) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _known",
    ).selectExpr(*own.columns, "_position", "_rn", "_known", "_known_before", "_opening", "_total",
                 "CASE WHEN _rn = 1 THEN _carry_1 ELSE _prev_1 END AS _p1",
                 "CASE _rn WHEN 1 THEN _carry_2 WHEN 2 THEN _carry_1 ELSE _prev_2 END AS _p2")
    known = " + ".join(f"int({x} IS NOT NULL)" for x in (value, "_p1", "_p2"))
    total = " + ".join(f"coalesce({x}, 0D)" for x in (value, "_p1", "_p2"))
    # A row without a brand belongs to no series: no lag, and its own value as the mean.
    return before.selectExpr(
        *own.columns,
        f"CASE WHEN {brand} IS NOT NULL THEN coalesce(_known, _known_before,"
        f" CASE WHEN _opening.at < _total THEN _opening.v END) END AS sales_lag_1",
        f"CASE WHEN {brand} IS NULL THEN {value} ELSE try_divide({total}, {known}) END AS sales_ma_3",
        *(["_position"] if keep_order else []))


def fill_forward_back(
    df: DataFrame, value: str, *, tie_break: Sequence[str], brand: str = "brand", date: str = "sale_date", buckets: int | None = None,
) -> DataFrame:
    """Fill nulls of ``value`` with the brand's last known value before the row, else the first one after it.

    A brand without any value keeps its nulls, and so do rows without a brand.
    """
    own = _Buckets(df, value, brand, date, tie_break, buckets)
    over = own.ascending
    filled = own.joined(
        f"last_value({value}, true) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _known",
        f"last_value({value}, true) OVER ({own.descending} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _next")
    new = (f"CASE WHEN {brand} IS NULL THEN {value} ELSE coalesce(_known, _known_before, _next, _known_after) END AS {value}")
    return filled.selectExpr(*[new if c == value else f"`{c}`" for c in own.columns])
