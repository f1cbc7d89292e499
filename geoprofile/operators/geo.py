"""Geography operators: D5 apportion, D6 geo_levels, D7 suppression.

Both rollups are a join of the leaf-level long table with a (leaf -> target)
membership table, then ONE grouped aggregation (partial aggregation runs
before the shuffle, so a hot target area is reduced map-side).  Overlapping
targets (a town in two regions, a tract split over two neighborhoods) are
simply several membership rows; ``rollup``/``cube`` could not express that.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moe import moe_of_squares, moe_sum, moe_weighted_sum
from ..session import cut_lineage
from ._util import param_frame, sum_propagate

# Fixed level codes (ordinal prefix gives the hierarchy order).
LEVEL_CODES = ["1_state", "2_counties", "3_regions", "4_towns", "5_tracts", "6_neighborhoods", "9_puma"]


def apportion(df: DataFrame, crosswalk: DataFrame, on: str = "geoid", weight: str = "weight",
              targets: Sequence[str] = ("city", "name"), carry: Sequence[str] = ("variable", "year"),
              value: str = "estimate", moe: str | None = "moe", digits: int | None = 0,
              null_policy: str = "propagate", exact_scale: int | None = None) -> DataFrame:
    """Weighted areal rollup ``target = sum(weight * leaf)``.

    The sum is rounded per variable (``digits``) BEFORE any later grouping,
    which is why grouped totals of apportioned areas can miss by a unit.
    ``moe`` combines as ``sqrt(sum((w * moe)^2))``.  Leaves outside the
    crosswalk drop out (inner join); a leaf split over two targets feeds
    both with its weights.  ``exact_scale``: sum in decimals of that scale.
    """
    cw = crosswalk.select(on, *targets, weight)
    j = df.join(cw, on)
    if exact_scale is None:
        prod = F.col(weight) * F.col(value)
    else:
        # exact decimal products and sum, so the per-variable rounding of a
        # half-unit total does not depend on floating-point summation order
        prod = F.col(weight).cast("decimal(12,6)") * F.col(value).cast(f"decimal({16 + exact_scale},{exact_scale})")
    est = sum_propagate(prod, null_policy)
    if digits is not None:
        est = F.round(est, digits)
    if exact_scale is not None:
        est = est.cast("double")
    aggs = [est.alias(value)]
    if moe:
        aggs.append(moe_weighted_sum(moe, weight, null_policy).alias(moe))
    return j.groupBy(*targets, *carry).agg(*aggs)


def membership_frame(spark, members: Mapping[str, Iterable[str]], level: str,
                     leaf_col: str = "leaf", name_col: str = "name", without: str | None = None) -> DataFrame:
    """(leaf, level, name) rows from ``{area: [leaf, ...]}`` parameters.

    ``without`` (F5): areas whose name holds a match of this regex are left out.
    """
    if without is not None:
        members = {k: v for k, v in members.items() if not re.search(without, k)}
    rows = [(leaf, level, area) for area, leaves in members.items() for leaf in leaves]
    return param_frame(spark, rows, f"{leaf_col} string, level string, {name_col} string")


def level_map(leaves: DataFrame, leaf_col: str, level: str, name_expr=None) -> DataFrame:
    """(leaf, level, name) rows derived from a dimension column.

    ``name_expr`` defaults to the leaf itself (the leaf's own level); pass a
    column (e.g. the region of a town) or a literal (the state) to build
    the upper levels from the same dimension.
    """
    name = F.col(leaf_col) if name_expr is None else name_expr
    return leaves.select(F.col(leaf_col).alias("leaf"), F.lit(level).alias("level"), name.alias("name"))


def geo_levels(df: DataFrame, levels: DataFrame, leaf_col: str = "name",
               carry: Sequence[str] = ("variable", "year"), value: str = "estimate",
               moe: str | None = "moe", null_policy: str = "propagate",
               extra: Sequence[str] = (), squares: str | None = None, origin: str | None = None) -> DataFrame:
    """Stack several geography levels into one long frame.

    ``levels`` holds (leaf, level, name [, extra...]) membership rows for
    every level wanted, including the leaves' own level.  Output: one row
    per (level, name, carry) with the summed estimate and combined margin.
    Decimal estimates and ``squares`` (a decimal column of squared margins) are summed exactly, and ``origin`` (source bits) combined, see ``group_rollup``.
    """
    lv = levels.select("leaf", "level", F.col("name").alias("_area"), *extra)
    # the leaves' own level/area columns are replaced by the target's
    src = df.drop(*[c for c in ("level", *extra) if c in df.columns and c != leaf_col])
    j = src.join(lv, src[leaf_col] == lv["leaf"]).drop("leaf", leaf_col)
    aggs = [sum_propagate(value, null_policy).alias(value)]
    if squares:
        total, root = moe_of_squares(squares, null_policy)
        aggs += [total.alias(squares), *([root.alias(moe)] if moe else [])]
    elif moe:
        aggs.append(moe_sum(moe, null_policy).alias(moe))
    if origin:
        aggs.append(F.bit_or(origin).alias(origin))
    return (j.groupBy("level", F.col("_area").alias("name"), *extra, *carry).agg(*aggs))


def membership_closure(members: DataFrame, area: str = "area", part: str = "part") -> DataFrame:
    """Areas made of areas: every (area, part) that follows from ``members``, through any number of steps.

    Each round doubles the steps and is written to the shared folder; the rounds end with the depth of the nesting.  A part that
    reaches itself is an error that names it.  Repeated rows count once, rows with a NULL are left out.
    """
    now = cut_lineage(members.select(area, part).filter(F.col(area).isNotNull() & F.col(part).isNotNull()).distinct())
    known = now.count()
    while True:
        again = now.filter(F.col(area) == F.col(part)).agg(F.min(area)).first()[0]
        if again is not None:
            raise ValueError(f"area {again!r} is a part of itself")
        further = now.select(F.col(area).alias("_via"), F.col(part).alias("_far"))
        more = now.join(further, F.col(part) == F.col("_via")).select(area, F.col("_far").alias(part))
        now = cut_lineage(now.unionByName(more).distinct())
        if (n := now.count()) == known:
            return now
        known = n


def level_ordinal(level_col: str = "level", order: Sequence[str] | None = None):
    """O2 ``fct_relevel``: explicit level order as an int (1-based; 0 if unknown)."""
    order = list(order or LEVEL_CODES)
    return F.array_position(F.array(*[F.lit(x) for x in order]), F.col(level_col)).cast("int")


def suppress_non_additive(df: DataFrame, where, cols: Sequence[str] = ("estimate", "moe")) -> DataFrame:
    """NULL the values of a non-additive measure (a median) where it was
    summed across areas; ``where`` is a boolean column, e.g.
    ``(tbl == 'median_income') & level.rlike('neighborhoods|regions')``."""
    return df.withColumns({c: F.when(~where, F.col(c)) for c in cols})
