"""Tail probabilities. Everything here works on a few numbers per test."""

from __future__ import annotations

import math

Z_95 = 1.959963984540054  # 97.5 % point of the standard normal


def chi2_tail(x: float, degrees: int) -> float:
    """P(X > x) for a chi-square variable, by the recurrence over degrees of freedom."""
    if degrees < 1 or x <= 0:
        return 1.0
    half = x / 2
    if degrees % 2:
        tail, k = math.erfc(math.sqrt(half)), 1
    else:
        tail, k = math.exp(-half), 2
    while k < degrees:
        tail += math.exp(k / 2 * math.log(half) - half - math.lgamma(k / 2 + 1))
        k += 2
    return tail


def two_sided_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))
