"""Two-sided p-value of a Pearson correlation, from r and the row count."""

from __future__ import annotations

import math


def pearson_p_value(r: float | None, rows: int) -> float | None:
    """P(|R| >= |r|) under no correlation: the regularised incomplete beta I(1-r^2; (n-2)/2, 1/2)."""
    if r is None or rows < 2:
        return None
    if rows == 2:
        return 1.0
    return _regularised_beta(min(1.0, abs(r)) ** 2, (rows - 2) / 2.0, 0.5)


def _regularised_beta(y: float, a: float, b: float) -> float:
    """I(1 - y; a, b); with y given, as 1 - y has lost the digits of a small one."""
    x = 1.0 - y
    if y >= 1.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    front = math.exp(_log_gamma_gain(a, b) - math.lgamma(b) + a * math.log1p(-y) + b * math.log(y))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _continued_fraction(x, a, b) / a
    return 1.0 - front * _continued_fraction(y, b, a) / b


def _log_gamma_gain(a: float, b: float) -> float:
    """log gamma(a + b) - log gamma(a); for a large a by the series, as the difference loses digits."""
    if a < 100.0:
        return math.lgamma(a + b) - math.lgamma(a)

    def rest(z: float) -> float:
        return 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)

    more = (a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b
    return more + rest(a + b) - rest(a)


def _continued_fraction(x: float, a: float, b: float, terms: int = 10_000) -> float:
    """Modified Lentz evaluation of the incomplete beta's continued fraction."""
    tiny = 1e-300

    def guarded(value: float) -> float:
        return value if abs(value) > tiny else tiny

    c = 1.0
    d = 1.0 / guarded(1.0 - (a + b) * x / (a + 1.0))
    result = d
    for m in range(1, terms):
        for coefficient in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / guarded(1.0 + coefficient * d)
            c = guarded(1.0 + coefficient / c)
            result *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return result
