"""What becomes of each brand: rows of scores, or one row that says why there are none.

An attempt is a table of scored rows with a column ``reason``. A brand that could not be scored has one row of kind
``skip`` with its reason, and all other columns null; the rest have no reason. So one brand never ends a run, and
none goes missing without a word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.staging import materialize

SKIP = "skip"
#: The reason of a brand whose fit gave a value that is null, NaN or infinite.
NOT_FINITE = "no finite fit"


def attempt(gate: DataFrame, scored: DataFrame, values: tuple[str, ...], name: str) -> DataFrame:
    """Scored rows of the brands whose ``values`` are all finite, and a row for every other brand of ``gate``.

    ``gate`` has a row a brand with ``skip_reason``, null for those that were to be fitted. ``scored`` may hold rows with
    a reason already, where a fit was given up.
    """
    if "reason" not in scored.columns:
        scored = scored.withColumn("reason", F.lit(None).cast("string"))
    scored = materialize(scored, name)
    broken = " OR ".join(f"{v} IS NULL OR isnan({v}) OR abs({v}) = double('inf')" for v in values)
    bad = scored.groupBy("brand").agg(F.expr("max(reason) AS told"), F.expr(f"max({broken}) AS broken")).where("told IS NOT NULL OR broken")
    bad = bad.selectExpr("brand", f"coalesce(told, '{NOT_FINITE}') AS reason")
    skips = gate.where("skip_reason IS NOT NULL").selectExpr("brand", "skip_reason AS reason").unionByName(bad)
    empty = [F.lit(None).cast(scored.schema[c].dataType).alias(c) for c in scored.columns if c not in ("brand", "kind", "reason")]
    rows = skips.select("brand", F.lit(SKIP).alias("kind"), "reason", *empty)
    return scored.join(bad.select("brand"), "brand", "left_anti").unionByName(rows)


def scores(attempted: DataFrame) -> DataFrame:
    """The scored rows."""
    return attempted.where("reason IS NULL").drop("reason")


def skipped(attempted: DataFrame) -> DataFrame:
    """(brand, reason) of the brands that have none."""
    return attempted.where("reason IS NOT NULL").select("brand", "reason")
