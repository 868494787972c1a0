"""Tail probabilities and quantiles for the last step of a test, on a handful of numbers."""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle

# These functions also run in tasks; they travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def gamma_p(a: float, x: float) -> float:
    """Regularized lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return total * scale
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h, i = d, 1
    while True:
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            return 1 - scale * h
        i += 1


def gamma_quantile(p: float, a: float) -> float:
    """x with gamma_p(a, x) = p, by bisection."""
    low, high = 0.0, max(1.0, a)
    while gamma_p(a, high) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if gamma_p(a, mid) < p else (low, mid)
    return (low + high) / 2


def chi_square_tail(x: float, df: int) -> float:
    return 1 - gamma_p(df / 2, x / 2)


def chi_square_quantile(p: float, df: int) -> float:
    return 2 * gamma_quantile(p, df / 2)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def poisson_interval(events: float, level: float = 0.95) -> tuple[float, float]:
    """Exact confidence limits of a Poisson count."""
    tail = (1 - level) / 2
    low = 0.0 if events == 0 else gamma_quantile(tail, events)
    return low, gamma_quantile(1 - tail, events + 1)
