"""Exact interpolated quantiles that never gather a column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.staging import materialize

#: Rows that the sketches see, of a table of any size: one task can merge them.
SAMPLE_ROWS = 2_000_000
_SKETCH_ACCURACY = 100_000
#: Bins inside a fence: between sampled quantiles, each cut into steps of equal width.
_PARTS, _STEPS = 32, 32
# Half widths of a fence, as shares of all ranks. A sample of m rows misplaces a rank by
# a deviation of at most 0.5 / sqrt(m); a width is used from 25 / width**2 sampled rows on,
# where it covers ten deviations.
_WIDTHS = (5e-5, 5e-4, 5e-3, 5e-2)


def quantile_name(column: str, prob: float) -> str:
    return f"{column}__q{prob:g}".replace(".", "_")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.5,), sample: float | None = None
) -> DataFrame:
    """One row with a column ``quantile_name(c, p)`` for every column and probability.

    Nulls and NaN are ignored, ranks between two values are interpolated linearly.

    A sketch over a sample (about ``SAMPLE_ROWS`` rows, or the share ``sample``) first fences each quantile
    between two values close to its rank. All rows are then counted against the fences: how many lie below, and
    how often each distinct value occurs inside. Only that sliver, 1e-2 of a large table, is grouped by value and
    ranked. The sample decides the fences only; the counts are of all rows, so the answer is exact,
    and a rank outside its fence fails the job instead of yielding an estimate.
    """
    values = df.selectExpr(*[f"nanvl(double(`{c}`), null) AS `{c}`" for c in columns])
    if sample is None:
        sample = min(1.0, SAMPLE_ROWS / max(df.count(), 1))
    cuts = _fences(values, columns, probs, sample)
    fences = {k: (x[0], x[-1]) for k, x in cuts.items()}

    totals, entries, held, results, parts = [], [], [], [], []
    for i, c in enumerate(columns):
        bounds = [tuple(f"double('{x!r}')" for x in fences[c, p]) for p in probs]
        inside_any = " OR ".join(f"`{c}` BETWEEN {low} AND {high}" for low, high in dict.fromkeys(bounds))
        entries.append(f"struct({i} AS slot, CASE WHEN {inside_any} THEN `{c}` END AS v)")
        held.append(inside_any)
        totals.append(f"count(`{c}`) AS n{i}")
        for j, (p, (low, high)) in enumerate(zip(probs, bounds)):
            s = f"{i}_{j}"
            totals.append(f"count_if(`{c}` < {low} AND NOT ({inside_any})) AS skipped{s}")
            position = f"({p!r}D * (n{i} - 1))"
            for side in ("floor", "ceil"):
                at = f"({side}{position} - skipped{s})"
                parts.append(f"max(CASE WHEN slot = {i} AND v BETWEEN {low} AND {high} AND before <= {at}"
                             f" AND {at} < before + cnt THEN v END) AS {side}{s}")
            low_v, high_v = (f"coalesce({side}{s}, double(raise_error('quantile fence missed its rank')))"
                             for side in ("floor", "ceil"))
            results.append(
                f"CASE WHEN n{i} > 0 THEN {low_v} + ({high_v} - {low_v}) * ({position} - floor{position}) END"
                f" AS `{quantile_name(c, p)}`")
        parts.append(f"max(n{i}) AS n{i}")

    counted = values.agg(*map(F.expr, totals))
    # Few rows have a value inside a fence; the others leave before they become a row a column. Stored, as it is read twice.
    inside = materialize(
        values.where(" OR ".join(held)).selectExpr(f"inline(array({', '.join(entries)}))").where("v IS NOT NULL")
        .groupBy("slot", "v").agg(F.expr("count(*) AS cnt"))
        .selectExpr("*", f"{_bin_of(columns, probs, cuts)} AS bin"), "fenced")
    # Ranks inside a bin need only the bin's values; a fence has a fixed number of bins.
    bins = inside.groupBy("slot", "bin").agg(F.expr("sum(cnt) AS bin_rows")).selectExpr(
        "slot", "bin", "sum(bin_rows) OVER (PARTITION BY slot ORDER BY bin) - bin_rows AS bin_before")
    ranked = inside.join(F.broadcast(bins), ["slot", "bin"]).selectExpr(
        "slot", "v", "cnt", "bin_before + sum(cnt) OVER (PARTITION BY slot, bin ORDER BY v) - cnt AS before")
    return ranked.crossJoin(F.broadcast(counted)).agg(*map(F.expr, parts)).selectExpr(*results)


def _bin_of(columns: Sequence[str], probs: Sequence[float], cuts: dict[tuple[str, float], list[float]]) -> str:
    """SQL text that puts the values inside the fences of a slot into ordered bins of about as many rows each."""
    cases = []
    for i, c in enumerate(columns):
        by_fence = {(cuts[c, p][0], cuts[c, p][-1]): cuts[c, p] for p in probs}
        for j, (low, high) in enumerate(sorted(by_fence)):
            inner = [f"double('{x!r}')" for x in by_fence[low, high] if abs(x) < float("inf")]
            edges = f"array({', '.join(inner)})" if inner else "array(double('0'))"
            part = f"size(filter({edges}, e -> e <= v))"
            # Beyond the first and last edge there is nothing to divide; an open fence has no edges.
            from_, to = f"element_at({edges}, greatest({part}, 1))", f"element_at({edges}, least({part} + 1, {max(len(inner), 1)}))"
            step = f"least(greatest(int(floor(coalesce(try_divide(v - {from_}, {to} - {from_}), 0D) * {_STEPS})), 0), {_STEPS - 1})"
            cases.append(f"WHEN slot = {i} AND v <= double('{high!r}') THEN {j * (_PARTS + 2) * _STEPS} + {part} * {_STEPS} + {step}")
    return f"CASE {' '.join(cases)} END"


def _fences(values: DataFrame, columns: Sequence[str], probs: Sequence[float],
            sample: float) -> dict[tuple[str, float], list[float]]:
    """Sampled values around the rank of every (column, probability), from the low fence to the high one."""
    at = [min(max(p + w * (2 * k / _PARTS - 1), 0.0), 1.0) for p in probs for w in _WIDTHS for k in range(_PARTS + 1)]
    array = ", ".join(f"{x!r}D" for x in at)
    sampled = values if sample >= 1 else values.sample(sample, seed=7)
    row = sampled.selectExpr(*[
        expression for c in columns for expression in (
            f"count(`{c}`) AS `n_{c}`",
            f"percentile_approx(`{c}`, array({array}), {_SKETCH_ACCURACY}) AS `q_{c}`")]).first()
    cuts = {}
    for c in columns:
        width = next((i for i, w in enumerate(_WIDTHS) if row[f"n_{c}"] >= 25 / w**2), None)
        for i, p in enumerate(probs):
            first = None if width is None else (i * len(_WIDTHS) + width) * (_PARTS + 1)
            cuts[c, p] = ([float("-inf"), float("inf")] if first is None
                          else sorted(row[f"q_{c}"][first:first + _PARTS + 1]))
    return cuts
