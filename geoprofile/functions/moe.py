"""Margin-of-error algebra as plain column expressions (no UDF).

Formulas are the published Census Bureau approximations for derived
survey estimates:

* sum of estimates          ``sqrt(sum moe_i^2)``
* weighted sum              ``sqrt(sum (w_i * moe_i)^2)``
* proportion p = A / B      ``sqrt(moe_A^2 - p^2 * moe_B^2) / B``; when the
  radicand is negative the ratio form ``sqrt(moe_A^2 + p^2 * moe_B^2) / B``
  is used instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators._util import sum_propagate


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def moe_sum(moe, policy: str = "propagate", estimate=None, zero_rule: bool = False) -> Column:
    """Aggregate: margin of a sum of estimates.

    ``policy`` treats NULL margins as :func:`sum_propagate` treats NULL
    estimates.  ``zero_rule``: of the categories whose estimate is zero only
    the largest margin counts, as published guidance for sums advises.
    """
    return moe_weighted_sum(moe, F.lit(1.0), policy, estimate, zero_rule)


def moe_of_squares(squares, policy: str = "propagate") -> tuple[Column, Column]:
    """Aggregates: the sum of squared margins, and its root, the margin of the sum.

    With squares in decimals the sum is exact whatever the order of its parts, so
    rollups of rollups agree to the last digit; the root is taken once, from that sum.
    """
    total = sum_propagate(_c(squares), policy)
    return total, F.sqrt(total.cast("double"))


def moe_weighted_sum(moe, weight, policy: str = "propagate", estimate=None, zero_rule: bool = False) -> Column:
    """Aggregate: margin of a weighted sum, as :func:`moe_sum`."""
    sq = F.pow(_c(weight) * _c(moe), 2)
    if not zero_rule:
        return F.sqrt(sum_propagate(sq, policy))
    zero = F.coalesce(_c(estimate) == 0, F.lit(False))
    both = F.coalesce(F.sum(F.when(~zero, sq)), F.lit(0.0)) + F.coalesce(F.max(F.when(zero, sq)), F.lit(0.0))
    known = F.count(sq)
    complete = known > 0 if policy == "ignore" else known == F.count(F.lit(1))
    return F.when(complete, F.sqrt(both))


def moe_prop(est, moe, denom_est, denom_moe) -> Column:
    """Row expression: margin of the proportion est / denom_est.

    NULL when the denominator is zero or NULL.
    """
    a, ma, b, mb = _c(est), _c(moe), _c(denom_est), _c(denom_moe)
    p = F.try_divide(a, b)
    rad = ma * ma - p * p * mb * mb
    rad = F.when(rad < 0, ma * ma + p * p * mb * mb).otherwise(rad)
    return F.try_divide(F.sqrt(rad), b)
