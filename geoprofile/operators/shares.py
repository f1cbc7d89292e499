"""D4 calc_shares and D4a share margins.

The denominator is broadcast over its key with a window: ``max(estimate
where group == denom) OVER (PARTITION BY keys)``.  The input is the output
of a group rollup, i.e. at most one row per (key, group), so a window
partition holds at most ``len(spec)`` rows whatever the data volume: no
key can be skewed, and the shuffle is one exchange on ``keys``.  (On raw,
unaggregated input, roll up first: shares of single categories are a
rollup whose groups each list one category.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.moe import moe_prop


def calc_shares(df: DataFrame, keys: Sequence[str], group_col: str = "group", denom: str = "total_pop",
                value: str = "estimate", moe: str | None = "moe", digits: int | None = None,
                share_col: str = "share", sharemoe_col: str = "sharemoe", origin: str | None = None,
                mixed_col: str = "mixed") -> DataFrame:
    """``share = estimate / estimate[group == denom]`` within ``keys``.

    * the denominator row itself gets NULL share (and NULL sharemoe);
    * a missing or zero denominator gives NULL (``try_divide``), where R
      would give NA / Inf;
    * ``digits`` rounds the share HALF_UP (``None`` keeps it unrounded);
    * ``moe``: when given, ``sharemoe`` is the margin of a proportion;
    * NULL key values form one group together (R's grouping semantics);
    * ``origin``: a column of source bits; ``mixed`` is then true for a share whose numerator and denominator
      together come from more than one source (NULL for the denominator itself).
    """
    w = Window.partitionBy(*keys)
    is_den = F.col(group_col) == F.lit(denom)
    den = F.max(F.when(is_den, F.col(value))).over(w)
    share = F.try_divide(F.col(value), den)
    if digits is not None:
        share = F.round(share, digits)
    cols = {share_col: F.when(~is_den, share)}
    if moe:
        den_moe = F.max(F.when(is_den, F.col(moe))).over(w)
        smoe = moe_prop(value, moe, den, den_moe)
        if digits is not None:
            smoe = F.round(smoe, digits)
        cols[sharemoe_col] = F.when(~is_den, smoe)
    if origin:
        den_origin = F.max(F.when(is_den, F.col(origin))).over(w)
        cols[mixed_col] = F.when(~is_den, F.bit_count(F.col(origin).bitwiseOR(F.coalesce(den_origin, F.lit(0)))) > 1)
    return df.withColumns(cols)
