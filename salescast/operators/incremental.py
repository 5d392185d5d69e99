"""The daily brand summary kept up batch by batch, without reading earlier sale rows again.

What :func:`salescast.operators.daily.daily_brand_summary` needs of the rows is kept as state that merges: a daily
cell holds the sums of known values and the number of missing ones, so that a median that has moved since enters
when the summary is made, not when the rows are read. The same holds for lag and trailing mean, which are linear in the median
that stands for missing sales (``a + b * median``), and for the moments, which are quadratic in it. Medians stay
exact: all rows are counted against a fence around each, and the values inside it are kept with their numbers.

The state is a folder of batches, listed by a published table (``sources.versions``), so a batch counts
as a whole or not at all and two writers cannot both add one.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast import schema as S
from salescast.operators.columns import code_tables, literal, replace_columns
from salescast.operators.history import _Buckets
from salescast.sources.versions import current_version, publish, read_published
from salescast.staging import materialize

#: Half the width of a fence, as a share of all ranks: how far a median may move in rank before the state is built anew.
FENCE = 0.1
#: A first batch of fewer rows says little about later ones: its fences are open and hold all values.
OPEN = 10_000
#: Values of a fence that are ranked at once; a fence with more is narrowed first, in so many steps.
RANKED, STEPS = 200_000, 1_024
#: Rows of the first batch that the fences are drawn from.
SAMPLE_ROWS = 2_000_000

_LOG = "log"
#: Columns that are linear in the median that stands for missing sales.
LINEAR = ("sales_lag_1", "sales_ma_3")


def _filled(columns: Sequence[str]) -> list[str]:
    return S.present(list(columns), S.MEDIAN_FILLED + S.MEDIAN_FILLED_OPTIONAL)


def _clean(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    return replace_columns(raw, {c: f"nanvl(double(`{c}`), null)" for c in columns})


def start(raw: DataFrame, root: str, tie_break: Sequence[str]) -> None:
    """Begin a state with the first batch: draw the fences from it, note the columns, then :func:`add` it."""
    spark = raw.sparkSession
    if current_version(spark, f"{root}/{_LOG}"):
        raise ValueError(f"{root} has a state")
    columns = _filled(raw.columns)
    values = _clean(raw, columns).select(columns)
    rows = values.count()
    sampled = values.sample(min(1.0, SAMPLE_ROWS / max(rows, 1)), seed=7)
    row = sampled.selectExpr(*[
        f"percentile_approx({c}, array({0.5 - FENCE}D, 0.5D, {0.5 + FENCE}D), 10000) AS {c}" for c in columns]).first()
    middle = {c: row[c][1] if row[c] else 0.0 for c in columns}
    fences = {c: row[c] if row[c] and rows >= OPEN else [-math.inf, middle[c], math.inf] for c in columns}
    settings = {"columns": raw.columns, "tie_break": list(tie_break), "fences": {c: list(map(repr, f)) for c, f in fences.items()}}
    add(raw, root, settings)


def _settings(spark: SparkSession, root: str) -> dict:
    return json.loads(read_published(spark, f"{root}/{_LOG}").agg(F.min_by("settings", "batch")).first()[0])


def _parts(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the tables of the state over all batches."""
    folders = [r.folder for r in read_published(spark, f"{root}/{_LOG}").select("folder").collect()]
    return spark.read.parquet(*[f"{root}/{f}/{name}" for f in folders])


def add(raw: DataFrame, root: str, settings: dict | None = None) -> None:
    """Add a batch of sale rows; only the batch and the last two rows of each brand are read.

    Every row has a date, and a brand's rows are all later than those it had before; otherwise ``ValueError`` asks for a
    new state. A batch that another writer was adding at the same time raises ``Conflict``.
    """
    spark = raw.sparkSession
    version = current_version(spark, f"{root}/{_LOG}")
    first = settings is not None
    settings = settings or _settings(spark, root)
    columns, ties = _filled(settings["columns"]), settings["tie_break"]
    if sorted(raw.columns) != sorted(settings["columns"]):
        raise ValueError(f"the state has the columns {', '.join(settings['columns'])}")
    fences = {c: [float(x) for x in f] for c, f in settings["fences"].items()}
    folder = f"b-{uuid.uuid4().hex}"
    tails = None if first else last_rows(spark, root)
    batch = _clean(raw, columns)
    if "is_holiday" in batch.columns:
        batch = batch.fillna({"is_holiday": 0})
    _check(batch, tails)

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{folder}/{name}")

    keys = ["brand", "sale_date", *ties]
    own = batch.select("*", F.struct(F.col("total_sales").alias("v")).alias("_sale"), F.lit(False).alias("_old"))
    if tails is not None:
        own = own.unionByName(tails.select(*keys, F.struct("v").alias("_sale"), F.lit(True).alias("_old")), allowMissingColumns=True)
    placed = _Buckets(own, "_sale", "brand", "sale_date", ties, None)
    over = placed.ascending
    before = placed.joined(
        f"row_number() OVER ({over}) AS _rn", f"lag(_sale, 1) OVER ({over}) AS _prev_1", f"lag(_sale, 2) OVER ({over}) AS _prev_2",
    ).selectExpr(*placed.columns, "_position",
                 "CASE WHEN _rn = 1 THEN _carry_1 ELSE _prev_1 END AS _p1",
                 "CASE _rn WHEN 1 THEN _carry_2 WHEN 2 THEN _carry_1 ELSE _prev_2 END AS _p2").where("NOT _old")
    # Lag and mean as a + b * (median - reference); rows without a brand have no row before them.
    origin = literal(fences["total_sales"][1])
    sales = ("_sale", "CASE WHEN brand IS NOT NULL THEN _p1 END", "CASE WHEN brand IS NOT NULL THEN _p2 END")
    known = [f"coalesce(({s}).v - {origin}, 0D)" for s in sales]
    gaps = [f"int(({s}) IS NOT NULL AND ({s}).v IS NULL)" for s in sales]
    members = f"({' + '.join(f'int(({s}) IS NOT NULL)' for s in sales)})"
    rows = before.selectExpr(
        "*", f"CASE WHEN ({sales[1]}) IS NOT NULL THEN {known[1]} END AS a_sales_lag_1",
        f"CASE WHEN ({sales[1]}) IS NOT NULL THEN double({gaps[1]}) END AS b_sales_lag_1",
        f"({' + '.join(known)}) / {members} AS a_sales_ma_3", f"double({' + '.join(gaps)}) / {members} AS b_sales_ma_3")

    plain = S.present(rows.columns, S.PLAIN_MEANS)
    d = {c: f"({c} - {literal(f[1])})" for c, f in fences.items()}
    write(rows.groupBy("category", "brand", "sale_date").agg(*map(F.expr, (
        "count(*) AS n", "min_by(struct(region), _position).region AS region",
        "max(CASE WHEN brand IS NOT NULL AND _p1 IS NULL THEN _sale END) AS first_sale",  # of the first row of a brand
        *[f"sum({c}) AS s_{c}" for c in plain], *[f"count({c}) AS m_{c}" for c in plain],
        *[e for c in columns for e in (f"count({c}) AS n_{c}", f"sum({d[c]}) AS d_{c}", f"sum({d[c]} * {d[c]}) AS dd_{c}",
                                       f"count_if({c} < {literal(fences[c][0])}) AS below_{c}")],
        *[e for c in LINEAR for e in (f"count(a_{c}) AS n_{c}", f"sum(a_{c}) AS a_{c}", f"sum(b_{c}) AS b_{c}", f"sum(a_{c} * a_{c}) AS aa_{c}",
                                      f"sum(a_{c} * b_{c}) AS ab_{c}", f"sum(b_{c} * b_{c}) AS bb_{c}")]))), "cells")
    kept = " OR ".join(f"{c} BETWEEN {literal(f[0])} AND {literal(f[2])}" for c, f in fences.items())
    inside = ", ".join(f"struct('{c}' AS slot, CASE WHEN {c} BETWEEN {literal(f[0])} AND {literal(f[2])} THEN {c} END AS v)" for c, f in fences.items())
    write(batch.where(kept or "false").selectExpr(f"inline(array({inside}))").where("v IS NOT NULL").groupBy("slot", "v").agg(
        F.count(F.lit(1)).alias("cnt")), "inside")
    write(batch.select("region").where("region IS NOT NULL").distinct(), "regions")
    ends = placed.rows.where("brand IS NOT NULL").selectExpr(*keys, "_sale.v AS v", "_slice", "_position").selectExpr(
        "*", f"row_number() OVER ({placed.descending}) AS _at").where("_at <= 2")
    write(ends.selectExpr(*keys, "v", "row_number() OVER (PARTITION BY brand ORDER BY _position DESC) AS back").where("back <= 2"), "tails")

    entry = spark.createDataFrame([(version + 1, folder, json.dumps(settings))], "batch long, folder string, settings string")
    log = entry if first else read_published(spark, f"{root}/{_LOG}", version).unionByName(entry)
    publish(log.coalesce(1), f"{root}/{_LOG}", expected=version)


def last_rows(spark: SparkSession, root: str) -> DataFrame:
    """The last two rows of each brand over all batches, which the next batch continues."""
    tails = _parts(spark, root, "tails").drop("back")
    keys = ", ".join(f"{c} DESC NULLS LAST" for c in tails.columns if c not in ("brand", "v"))
    # A brand has at most two rows a batch here, and may have the same ones again after a batch without it.
    return materialize(tails.distinct().selectExpr("*", f"row_number() OVER (PARTITION BY brand ORDER BY {keys}) AS back")
                       .where("back <= 2").drop("back"), "last-rows")


def _check(batch: DataFrame, tails: DataFrame | None) -> None:
    begins = batch.groupBy("brand").agg(F.min("sale_date").alias("first"), F.count_if(F.col("sale_date").isNull()).alias("undated"))
    if tails is not None:
        begins = begins.join(tails.groupBy("brand").agg(F.max("sale_date").alias("end")), "brand", "left")
    else:
        begins = begins.withColumn("end", F.lit(None).cast("date"))
    bad = begins.where("undated > 0 OR first <= end").first()
    if bad is not None and bad["undated"]:
        raise ValueError("rows without a date cannot be added to a state: build the summary from all rows")
    if bad is not None:
        raise ValueError(f"{bad['brand']} has rows of {bad['first']}, but the state ends at {bad['end']}: build it anew")


def medians(spark: SparkSession, root: str, totals: dict | None = None) -> dict[str, float | None]:
    """The exact median of each column over all batches, from the counts against its fence and the values inside."""
    settings, totals = _settings(spark, root), totals or _totals(spark, root)
    inside = materialize(_parts(spark, root, "inside").groupBy("slot", "v").agg(F.sum("cnt").alias("cnt")), "inside")
    held = {r.slot: r for r in inside.groupBy("slot").agg(
        F.sum("cnt").alias("rows"), F.count(F.lit(1)).alias("kinds"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    wanted: dict[str, tuple[int, int]] = {}
    for c in settings["fences"]:
        if n := totals[f"n_{c}"]:
            wanted[c] = (n - 1) // 2 - totals[f"below_{c}"], n // 2 - totals[f"below_{c}"]
            if c not in held or wanted[c][0] < 0 or wanted[c][1] >= held[c].rows:
                raise ValueError(f"the median of {c} has left its fence: build the state anew")
    found: dict[str, float | None] = dict.fromkeys(settings["fences"])
    for c in [c for c in wanted if held[c].kinds > RANKED]:
        pair = [_at_rank(inside.where(F.col("slot") == c), k, held[c].kinds, held[c].low, held[c].high) for k in wanted[c]]
        found[c] = sum(pair) / 2
    short = [c for c in wanted if held[c].kinds <= RANKED]
    if short:
        ranked = inside.where(F.col("slot").isin(short)).selectExpr("slot", "v", "sum(cnt) OVER (PARTITION BY slot ORDER BY v) AS until")
        ranks = F.broadcast(spark.createDataFrame([(c, *wanted[c]) for c in short], "slot string, one long, two long"))
        for r in ranked.join(ranks, "slot").groupBy("slot").agg(
                F.expr("min(CASE WHEN until > one THEN v END) AS x"), F.expr("min(CASE WHEN until > two THEN v END) AS y")).collect():
            found[r.slot] = (r.x + r.y) / 2
    return found


def _at_rank(values: DataFrame, rank: int, kinds: int, low: float, high: float) -> float:
    """The value (v, with cnt copies) of a rank; a long table is narrowed to one of many steps until few values are left."""
    while kinds > RANKED and low < high:
        width = (high - low) / STEPS
        step = F.least(F.floor((F.col("v") - low) / width), F.lit(STEPS - 1))
        counts = values.groupBy(step.alias("step")).agg(
            F.sum("cnt").alias("rows"), F.count(F.lit(1)).alias("kinds"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("step").collect()
        for r in counts:
            if rank < r.rows:
                values, kinds, low, high = values.where(F.col("v").between(r.low, r.high)), r.kinds, r.low, r.high
                break
            rank -= r.rows
    ranked = values.selectExpr("v", "sum(cnt) OVER (ORDER BY v) AS until")
    return ranked.where(F.col("until") > rank).agg(F.min("v")).first()[0]


def _totals(spark: SparkSession, root: str) -> dict:
    """Sums over all cells."""
    cells = _parts(spark, root, "cells")
    summed = [c for c, t in cells.dtypes if t in ("bigint", "double") and not c.startswith(("s_", "m_"))]
    return cells.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed]).first().asDict()


def summary(spark: SparkSession, root: str) -> DataFrame:
    """The daily brand summary of all batches so far, as the full computation over all their rows gives it."""
    settings = _settings(spark, root)
    references = {c: float(f[1]) for c, f in settings["fences"].items()}
    totals = _totals(spark, root)
    median = medians(spark, root, totals)
    delta = {c: (m - references[c]) if m is not None else None for c, m in median.items()}
    sales = delta["total_sales"]
    columns = list(references)
    # The first row of a brand takes its own sales as lag, unless it is the only one.
    lone = "sum(n) OVER (PARTITION BY brand) > 1 AND first_sale IS NOT NULL"
    cells = _parts(spark, root, "cells").selectExpr("*", f"CASE WHEN {lone} THEN first_sale END AS own").selectExpr(
        "*", f"CASE WHEN own IS NOT NULL THEN coalesce(own.v - {literal(references['total_sales'])}, 0D) END AS own_a",
        "double(int(own IS NOT NULL AND own.v IS NULL)) AS own_b")
    cells = materialize(replace_columns(cells, {
        "n_sales_lag_1": "n_sales_lag_1 + int(own IS NOT NULL)", "a_sales_lag_1": "coalesce(a_sales_lag_1, 0D) + coalesce(own_a, 0D)",
        "b_sales_lag_1": "coalesce(b_sales_lag_1, 0D) + own_b"}), "cells")
    for k, v in cells.selectExpr(
            "count(own) AS n_sales_lag_1", "sum(own_a) AS a_sales_lag_1", "sum(own_b) AS b_sales_lag_1", "sum(own_a * own_a) AS aa_sales_lag_1",
            "sum(own_a * own_b) AS ab_sales_lag_1", "sum(own_b * own_b) AS bb_sales_lag_1").first().asDict().items():
        totals[k] += v or 0

    def moments(c: str) -> tuple[int, float, float]:
        """Number, sum and sum of squares of the filled column, as distances from its reference."""
        if c in LINEAR:
            a, b, shift = totals[f"a_{c}"], totals[f"b_{c}"], sales or 0.0
            return totals[f"n_{c}"], a + shift * b, totals[f"aa_{c}"] + 2 * shift * totals[f"ab_{c}"] + shift * shift * totals[f"bb_{c}"]
        if delta[c] is None:
            return 0, 0.0, 0.0
        missing = totals["n"] - totals[f"n_{c}"]
        return totals["n"], totals[f"d_{c}"] + missing * delta[c], totals[f"dd_{c}"] + missing * delta[c] ** 2

    def cell(c: str) -> tuple[str, str]:
        """SQL text for the number and the sum of a day's filled values, as distances from the reference."""
        if c in LINEAR:
            return f"n_{c}", f"(coalesce(a_{c}, 0D) + {literal(sales or 0.0)} * coalesce(b_{c}, 0D))"
        if delta[c] is None:
            return "0", "0D"
        return "n", f"(coalesce(d_{c}, 0D) + (n - n_{c}) * {literal(delta[c])})"

    def z_sum(c: str) -> str:
        n, d, dd = moments(c)
        if n < 2:
            return "double(null)"
        std = math.sqrt(max(dd - d * d / n, 0.0) / (n - 1))
        count, total = cell(c)
        return f"(({total} - {count} * {literal(d / n)}) / {literal(std + S.ZSCORE_EPSILON)})"

    scored = S.present([*columns, *LINEAR], S.ZSCORED)
    plain = S.present(settings["columns"], S.PLAIN_MEANS)
    total = f"({cell('total_sales')[1]} + n * {literal(references['total_sales'])})" if sales is not None else "0D"
    out = cells.where("category IS NOT NULL AND brand IS NOT NULL").selectExpr(
        "category", "brand", "sale_date", "region", f"{total} AS total_sales", *[f"s_{c} / m_{c} AS {c}" for c in plain],
        *[f"coalesce({z_sum(c)}, 0D) AS {c}" if c == "quantity_sold" else f"try_divide({z_sum(c)}, {cell(c)[0]}) AS {c}" for c in scored])
    labels = cells.select("category", "brand", F.lit(None).cast("string").alias("region")).unionByName(
        _parts(spark, root, "regions"), allowMissingColumns=True)
    for key, codes in code_tables(labels, S.ENCODED).items():
        out = out.join(codes, key, "left")
    return out.select(S.present(out.columns, tuple(f.name for f in S.PROCESSED_SALES)))
