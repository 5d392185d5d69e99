"""Linear models of many series at once, fitted with aggregates and array expressions alone.

A model is a row (brand, intercept, beta). What a fit needs of its rows are sums of products, which partial aggregates
merge; the system of each series is then solved in its row by a Cholesky factorisation over arrays. Expressions
are stated as SQL text; lambda variables start with an underscore.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW, _MATRIX = "CAST(array() AS array<double>)", "CAST(array() AS array<array<double>>)"


def dot(a: str, b: str) -> str:
    """The inner product of two arrays of one length."""
    return f"aggregate(zip_with({a}, {b}, (_x, _y) -> _x * _y), 0D, (_sum, _xy) -> _sum + _xy)"


def gram(rows: DataFrame, vector: str, key: str = "brand") -> DataFrame:
    """(key, a): the lower triangle of the sums of ``v[i] * v[j]`` of each series, a row an array of its first i + 1 entries.

    Each row gives its products to partial sums, so nothing but the sums of a series is gathered.
    """
    products = (
        rows.selectExpr(key, f"{vector} AS _v")
        .selectExpr(key, "_v", "explode(sequence(0, size(_v) - 1)) AS _i")
        .selectExpr(key, "_v", "_i", "explode(sequence(0, _i)) AS _j")
        .groupBy(key, "_i", "_j").agg(F.expr("sum(_v[_i] * _v[_j]) AS _s")))
    ordered = "transform(array_sort(collect_list(struct({at}, {value}))), _e -> _e.{value})"
    lines = products.groupBy(key, "_i").agg(F.expr(ordered.format(at="_j", value="_s") + " AS _line"))
    return lines.groupBy(key).agg(F.expr(ordered.format(at="_i", value="_line") + " AS a"))


def solve(systems: DataFrame, matrix: str, right: str, name: str) -> DataFrame:
    """Add ``name``, the solution of a symmetric positive definite system of which ``matrix`` is the lower triangle.

    A system that is not positive definite has a solution of nulls or NaN, never an error.
    """
    entry = "_a[_i][_j]"
    factor = f"""aggregate(sequence(0, size(_a) - 1), {_MATRIX}, (_l, _i) -> concat(_l, array(
        aggregate(sequence(0, _i), {_ROW}, (_r, _j) -> concat(_r, array(CASE
            WHEN _i = _j THEN sqrt({entry} - {dot('_r', '_r')})
            ELSE try_divide({entry} - {dot('_r', 'slice(_l[_j], 1, _j)')}, _l[_j][_j]) END))))))"""
    down = f"""aggregate(sequence(0, size(_f) - 1), {_ROW}, (_z, _i) -> concat(_z, array(
        try_divide(_b[_i] - {dot('_z', 'slice(_f[_i], 1, _i)')}, _f[_i][_i]))))"""
    up = f"""aggregate(sequence(size(_f) - 1, 0), {_ROW}, (_u, _i) -> concat(array(
        try_divide(_d[_i] - aggregate(zip_with(slice(_f, _i + 2, size(_f)), _u, (_line, _y) -> _line[_i] * _y), 0D, (_sum, _xy) -> _sum + _xy),
                   _f[_i][_i])), _u))"""
    kept = systems.columns
    return (systems.selectExpr("*", f"{matrix} AS _a", f"{right} AS _b")
            .selectExpr(*kept, "_b", f"{factor} AS _f")
            .selectExpr(*kept, "_f", f"{down} AS _d")
            .selectExpr(*kept, f"{up} AS {name}"))


def block(a: str, first: int, size: str, diagonal: str) -> str:
    """The triangle of ``size`` lines of a Gram matrix from ``first`` on, with ``diagonal`` (of ``_i``) added to its diagonal."""
    return (f"transform(sequence(0, {size} - 1), _i -> transform(sequence(0, _i), _j -> "
            f"{a}[_i + {first}][_j + {first}] + CASE WHEN _i = _j THEN {diagonal} ELSE 0D END))")


@dataclass(frozen=True)
class LinearFit:
    """A way to find the model of each series from its training rows (brand, x, y), x an array: (brand, intercept, beta)."""

    models: Callable[[DataFrame], DataFrame]


def ridge(penalty: float) -> LinearFit:
    """Least squares on centred rows with an L2 penalty on the coefficients."""
    def models(train: DataFrame) -> DataFrame:
        sums = gram(train, "concat(array(1D), x, array(y))").selectExpr("brand", "a", "size(a) - 2 AS p", "a[0][0] AS n")
        # The Gram matrix of centred columns, from that of the columns and their sums.
        centred = "transform(a, (_line, _k) -> transform(_line, (_s, _m) -> _s - a[_k][0] * a[_m][0] / n))"
        fitted = solve(sums.selectExpr("brand", "a", "n", "p", f"{centred} AS c"),
                       block("c", 1, "p", f"{penalty!r}D"), "slice(c[p + 1], 2, p)", "beta")
        centre = "transform(slice(a, 2, p), _line -> _line[0] / n)"
        return fitted.selectExpr("brand", f"a[p + 1][0] / n - {dot('beta', centre)} AS intercept", "beta")

    return LinearFit(models)


def _window_mean(train: DataFrame) -> DataFrame:
    """The mean of the target's own past: every first feature of the days of a window counts alike."""
    share = "transform(sequence(0, size(x) - 1), _i -> CASE WHEN _i % (size(x) DIV days) = 0 THEN 1D / days ELSE 0D END)"
    return train.groupBy("brand").agg(F.any_value("x").alias("x"), F.any_value("days").alias("days")).selectExpr(
        "brand", "0D AS intercept", f"{share} AS beta")


#: A model in closed form: the mean of the target over the window.
WINDOW_MEAN = LinearFit(_window_mean)


def predicted(x: str) -> str:
    """SQL text for the prediction of a joined model (intercept, beta) at ``x``."""
    return f"(intercept + {dot('beta', x)})"


def recursion(latest: str, steps: int) -> str:
    """The predictions ``steps`` days ahead, each from the window that the ones before have moved on.

    ``latest`` is an array of the window's days, a day an array of features, the target first. Each step drops the
    first day and appends the last one with the prediction as its target.
    """
    moved = "concat(array(_p), slice(element_at(_s.days, -1), 2, size(element_at(_s.days, -1)) - 1))"
    return f"""aggregate(sequence(1, {steps}), named_struct('days', {latest}, 'ahead', {_ROW}), (_s, _k) ->
        transform(array({predicted('flatten(_s.days)')}), _p -> named_struct(
            'days', concat(slice(_s.days, 2, size(_s.days) - 1), array({moved})), 'ahead', concat(_s.ahead, array(_p))))[0],
        _s -> _s.ahead)"""
