"""Values of text columns that do not read as their type: counted in the pass that reads them, and listed with a reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast import schema as S
from salescast.functions.calendar import lenient_date
from salescast.functions.numeric import finite
from salescast.sources.tables import NULL_TEXTS, typed

MISSING, NO_DATE, NO_NUMBER, NOT_FINITE = "missing", "not a date", "not a number", "not finite"


@dataclass(frozen=True)
class Checked:
    """Typed rows, the list of their rejected values, and the counts that an action over the rows fills in."""

    rows: DataFrame
    rejects: DataFrame
    counts: Observation


def reason(text: Column, field: S.Field) -> Column:
    """Why a text cannot be the value of a field, or null."""
    absent = text.isNull() | text.isin(*NULL_TEXTS)
    otherwise: Column = F.lit(None).cast("string")
    if isinstance(field.dtype, T.DateType):
        otherwise = F.when(lenient_date(text).isNull(), NO_DATE)
    elif isinstance(field.dtype, T.NumericType):
        number = text.try_cast("double")
        otherwise = F.when(number.isNull(), NO_NUMBER).when(finite(number).isNull(), NOT_FINITE)
    return F.when(absent, MISSING if field.required else None).otherwise(otherwise)


def checked(rows: DataFrame, fields: tuple[S.Field, ...], ids: Sequence[str], extra: Mapping[str, str] | None = None) -> Checked:
    """Type the text columns of ``rows`` by ``fields``, and say which of their values are rejected.

    The typed rows are all there, with null in the place of a rejected value, as the readers give them. Their counts (``rows``,
    and one for each column) come with the first action over them, without a pass of their own. ``rejects`` has a row a
    rejected value: ``ids``, column_name, text, reason.
    """
    by_lower = {c.lower(): c for c in rows.columns}
    found = {f.name: by_lower.get(f.header.lower()) or by_lower.get(f.name.lower()) for f in fields}
    reasons = {f.name: reason(F.col(f"`{found[f.name]}`").cast("string"), f) for f in fields if found[f.name] is not None}
    counts = Observation()
    observed = rows.observe(counts, F.count(F.lit(1)).alias("rows"), *[F.count(r).alias(name) for name, r in reasons.items()])
    entries = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(f"`{found[name]}`").cast("string").alias("text"), r.alias("reason"))
                        for name, r in reasons.items()])
    listed = rows.select(*ids, F.explode(F.filter(entries, lambda e: e["reason"].isNotNull())).alias("e")).select(*ids, "e.*")
    return Checked(typed(observed, fields, extra), listed, counts)
