"""Correlation and significance expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tallyrill.functions.scalar import col

ALPHA = 0.05


def pearson(x: Column | str, y: Column | str, over=None) -> Column:
    """Pearson r as an aggregate (or window aggregate); null where a side is constant.

    The built-in ``corr`` divides by zero under ANSI mode on a constant column.
    """
    parts = [F.covar_samp(col(x), col(y)), F.stddev_samp(col(x)), F.stddev_samp(col(y))]
    if over is not None:
        parts = [p.over(over) for p in parts]
    return F.try_divide(parts[0], parts[1] * parts[2])


# Terms of the continued fraction: 80 leave an error below 1e-13 for any number of samples.
_FRACTION_TERMS = 80
# From this argument on the expansion of a ratio of gamma functions is exact to 1e-16.
_GAMMA_FROM = 16


def _fraction(a: str, b: str, x: str) -> str:
    """SQL text of the continued fraction of the incomplete beta function (DLMF 8.17.22), worked out from its end."""
    odd = f"-({a} + m) * ({a} + {b} + m) * {x} / (({a} + 2 * m) * ({a} + 2 * m + 1))"
    even = f"m * ({b} - m) * {x} / (({a} + 2 * m - 1) * ({a} + 2 * m))"
    odd, even = (t.replace("m", "CAST(k DIV 2 AS DOUBLE)") for t in (odd, even))
    return (f"(1D / aggregate(sequence({_FRACTION_TERMS}, 1, -1), 1D, "
            f"(acc, k) -> 1D + IF(k % 2 = 1, {odd}, {even}) / acc))")


def _log_p(r: str, n: str) -> str:
    """SQL text of the natural logarithm of the two-sided p of r with n samples.

    p is the regularised incomplete beta function I(1 - r^2; (n - 2) / 2, 1 / 2). It is worked out as such where it is
    small, so no digits are lost however far out r lies, and as one minus its complement where it is not.
    """
    s, a = f"IF({r} IS NULL, NULL, least(abs({r}), 1D))", f"(({n} - 2) / 2D)"
    away = f"(1D - {s}) * (1D + {s})"
    names = {"s": s, "a": a, "x": away, "logx": f"IF({s} < 0.5D, log1p(-{s} * {s}), ln({away}))",
             "z": f"IF({a} < {_GAMMA_FROM}, {a} + ceil({_GAMMA_FROM} - {a}), {a})"}
    bound = ", ".join(f"'{k}', CAST({v} AS DOUBLE)" for k, v in names.items())
    shift = (f"ln(aggregate(sequence(0, {_GAMMA_FROM - 1}), 1D, (acc, k) -> "
             f"IF(v.a + k < {_GAMMA_FROM}, acc * (v.a + k) / (v.a + k + 0.5D), acc)))")
    ratio = (f"({shift} + 0.5D * ln(v.z) - 1 / (8 * v.z) + 1 / (192 * pow(v.z, 3)) - 1 / (640 * pow(v.z, 5)) "
             "+ 17 / (14336 * pow(v.z, 7)) - 31 / (18432 * pow(v.z, 9)))")
    front = f"(v.a * v.logx + ln(v.s) + {ratio} - {0.5 * math.log(math.pi)!r}D)"
    tail = f"{front} - ln(v.a) + ln({_fraction('v.a', '0.5D', 'v.x')})"
    middle = f"log1p(-least(1D, 2D * exp({front}) * {_fraction('0.5D', 'v.a', '(v.s * v.s)')}))"
    body = (f"CASE WHEN v.a < 0 OR v.s IS NULL THEN CAST(NULL AS DOUBLE) WHEN v.a = 0 OR v.s = 0 THEN 0D "
            f"WHEN v.x <= 0 THEN CAST('-Infinity' AS DOUBLE) WHEN v.x < (v.a + 1) / (v.a + 2.5D) THEN {tail} ELSE {middle} END")
    return f"transform(array(named_struct({bound})), v -> {body})[0]"


def pearson_p(r: str, n: str) -> Column:
    """Two-sided p of r (column names) under Student's t with n-2 degrees of freedom; exact in the tail."""
    return F.expr(f"exp({_log_p(r, n)})").alias("p_value")


def log10_p(r: str, n: str) -> Column:
    """Decimal logarithm of ``pearson_p``, also where p itself is below the smallest double."""
    return F.expr(f"{_log_p(r, n)} / {math.log(10)!r}D").alias("log10_p")


def significant(p: Column | str) -> Column:
    return col(p) < F.lit(ALPHA)


def normal_two_sided_p(z: str) -> str:
    """SQL text of erfc(|z| / sqrt 2): power series near zero, continued fraction in the tail."""
    x = f"(abs({z}) / {math.sqrt(2.0)!r}D)"
    series = (f"1D - {2.0 / math.sqrt(math.pi)!r}D * aggregate(sequence(1, 90), "
              f"named_struct('term', {x}, 'total', {x}), (acc, k) -> named_struct("
              f"'term', -acc.term * {x} * {x} / k, "
              f"'total', acc.total - acc.term * {x} * {x} / k / (2 * k + 1)), acc -> acc.total)")
    tail = (f"exp(-{x} * {x}) / ({x} * {math.sqrt(math.pi)!r}D * aggregate(sequence(120, 1, -1), 1D, "
            f"(acc, k) -> 1D + k / (2D * {x} * {x}) / acc))")
    return f"IF({x} < 2D, {series}, {tail})"


def _exact_kendall(n: str, low: str) -> str:
    """SQL text: twice the share of the n! orderings with at most ``low`` inversions.

    Orderings of ``size`` items split by where the newest one lands, so each step replaces the
    shares by means over a sliding window of the previous ones.
    """
    window = "slice(share, CAST(greatest(k - size + 2, 1) AS INT), CAST(least(k + 1, size) AS INT))"
    total = "(a, v) -> a + v"
    return (f"least(1D, 2D * aggregate(sequence(2L, {n}), "
            f"transform(sequence(0L, {low}), k -> IF(k = 0, 1D, 0D)), "
            f"(share, size) -> transform(share, (v, k) -> aggregate({window}, 0D, {total}) / size), "
            f"share -> aggregate(share, 0D, {total})))")


def kendall_p(n: str, dis: str, s: str, xtie: str, ytie: str, x0: str, x1: str, y0: str, y1: str) -> Column:
    """Two-sided p of tau-b from the column names of its counts.

    Exact for series without ties that are short or almost perfectly ordered, the tie-corrected
    normal limit otherwise (Kendall, Rank Correlation Methods).
    """
    pairs = f"({n} * ({n} - 1) DIV 2)"
    low = f"least({dis}, {pairs} - {dis})"
    m = f"({n} * ({n} - 1D))"
    var = (f"(({m} * (2 * {n} + 5) - {x1} - {y1}) / 18D + 2D * {xtie} * {ytie} / {m} "
           f"+ IF({n} > 2, {x0} * {y0} / (9D * {m} * greatest({n} - 2, 1)), 0D))")
    z = f"({s} / sqrt({var}))"
    return F.expr(
        f"CASE WHEN {n} IS NULL OR {n} < 2 THEN CAST(NULL AS DOUBLE) "
        f"WHEN {xtie} = 0 AND {ytie} = 0 AND ({n} = 2 OR 2 * {low} = {pairs}) THEN 1D "
        f"WHEN {xtie} = 0 AND {ytie} = 0 AND ({n} <= 33 OR {low} <= 1) THEN {_exact_kendall(n, low)} "
        f"WHEN {var} > 0 THEN {normal_two_sided_p(z)} END")
