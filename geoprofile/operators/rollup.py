"""D3 group_rollup (overlapping category groups), W3 positions, D9 two-stage.

A group spec maps a group name to category members, given either as
1-based POSITIONS (``{"total_pop": range(1, 24), "ages65plus": [18, ..]}``)
or as category LABELS.  Groups may overlap: one input row feeds every group
that lists it.  The plan is one broadcast join of the fact with the small
(category -> group) mapping, fanning a row out to its n groups, followed by
ONE grouped aggregation whose partial (map-side) phase collapses hot keys
before the shuffle.  No ``rollup``/``cube``: those cannot express overlap.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.moe import moe_of_squares, moe_sum
from ..functions.text import unite
from ._util import param_frame, sum_propagate


def _members(m) -> list:
    if isinstance(m, (int, str)):
        return [m]
    return list(m)


def spec_rows(spec: Mapping, by_tbl: bool = False) -> tuple[list[tuple], bool]:
    """Flatten a spec to rows ``([tbl,] grp, grp_ord, member)``.

    Returns the rows and whether members are positions (ints).
    """
    rows: list[tuple] = []
    kinds: set[bool] = set()
    tables = spec.items() if by_tbl else [(None, spec)]
    for tbl, sp in tables:
        for g_ord, (grp, members) in enumerate(sp.items(), start=1):
            for m in _members(members):
                kinds.add(isinstance(m, int))
                rows.append(((tbl,) if by_tbl else ()) + (grp, g_ord, m))
    if len(kinds) > 1:
        raise ValueError("a spec uses either positions or labels, not both")
    return rows, kinds == {True}


def spec_frame(spark, spec: Mapping, by_tbl: bool = False) -> tuple[DataFrame, bool]:
    rows, positional = spec_rows(spec, by_tbl)
    member_t = "int" if positional else "string"
    schema = ("tbl string, " if by_tbl else "") + f"grp string, grp_ord int, member {member_t}"
    return param_frame(spark, rows, schema), positional


def category_positions(df: DataFrame, group_col: str, order_col: str = "variable",
                       by: Sequence[str] = ()) -> DataFrame:
    """Ordinal of each distinct category in order of first appearance.

    ``first appearance`` is made explicit as the smallest ``order_col``
    (variable codes are issued in table order).  Apply this to the LABELS
    dimension (after the same split/filter as the fact), not to the fact:
    the input is then one row per variable, and the window runs over the
    distinct categories only (per ``by`` partition, e.g. per table).
    """
    by = list(by)
    first = df.groupBy(*by, group_col).agg(F.min(order_col).alias("_first"))
    w = Window.partitionBy(*by).orderBy("_first", group_col) if by else Window.orderBy("_first", group_col)
    return first.select(*by, group_col, F.row_number().over(w).alias("position"))


def _mapping(df: DataFrame, spec: Mapping, group_col: str, positions: DataFrame | None,
             by: Sequence[str]) -> DataFrame:
    spark = df.sparkSession
    sdf, positional = spec_frame(spark, spec, by_tbl=bool(by))
    if by and list(by) != ["tbl"]:
        sdf = sdf.withColumnRenamed("tbl", by[0])
    if positional:
        if positions is None:
            raise ValueError("a positional spec needs `positions` (see category_positions)")
        pos = positions.select(*by, group_col, F.col("position").alias("member"))
        return pos.join(sdf, [*by, "member"]).drop("member")
    return sdf.withColumnRenamed("member", group_col)


def _sums(value: str, moe: str | None, null_policy: str, zero_rule: bool, squares: str | None, origin: str | None = None) -> list:
    """Aggregates of a rollup: estimate, margin and, where given, squared margins and the set of sources."""
    aggs = [sum_propagate(value, null_policy).alias(value)]
    if squares and zero_rule:
        raise ValueError("squared margins are summed as they are: zero_rule needs the margins")
    if squares:
        total, root = moe_of_squares(squares, null_policy)
        aggs += [total.alias(squares), *([root.alias(moe)] if moe else [])]
    elif moe:
        aggs.append(moe_sum(moe, null_policy, value, zero_rule).alias(moe))
    if origin:
        aggs.append(F.bit_or(origin).alias(origin))
    return aggs


def group_rollup(df: DataFrame, spec: Mapping, keys: Sequence[str], group_col: str,
                 positions: DataFrame | None = None, value: str = "estimate", moe: str | None = "moe",
                 by: Sequence[str] = (), out_col: str | None = None,
                 null_policy: str = "propagate", order_col: str | None = "grp_ord",
                 zero_rule: bool = False, squares: str | None = None, origin: str | None = None) -> DataFrame:
    """Sum ``value`` (and combine ``moe``) of categories into named groups.

    * ``keys``: grouping keys kept in the output (geography, year, ...).
    * ``group_col``: the category column the spec refers to; the output
      carries the group name under ``out_col`` (default: same name).
    * ``positions``: (``by``..., group_col, position) for positional specs.
    * ``by``: e.g. ``["tbl"]`` when one frame holds several source tables and
      ``spec`` is ``{tbl: {grp: members}}``; all tables run in one plan.
    * ``order_col``: name of the group's ordinal in the output (spec order).
    * ``null_policy`` holds for estimates and margins alike; ``zero_rule``: see ``moe_sum``.
    * a decimal ``value`` stays decimal, so its sums do not depend on the order of their parts; ``squares`` names a
      decimal column of squared margins, which is summed and kept in the same way, with ``moe`` as its root.
    * ``origin``: a column of source bits (see ``prefer_source``), combined over each group in the same aggregation.
    """
    keys, by = list(keys), list(by)
    out_col = out_col or group_col
    mapping = _mapping(df, spec, group_col, positions, by)
    fanned = df.join(mapping, [*by, group_col])
    aggs = _sums(value, moe, null_policy, zero_rule, squares, origin)
    gkeys = [*dict.fromkeys([*by, *keys])]
    out = (fanned.groupBy(*gkeys, F.col("grp").alias(out_col), "grp_ord").agg(*aggs))
    if order_col and order_col != "grp_ord":
        out = out.withColumnRenamed("grp_ord", order_col)
    elif not order_col:
        out = out.drop("grp_ord")
    return out


def two_stage_rollup(df: DataFrame, spec1: Mapping, col1: str, spec2: Mapping, col2: str,
                     keys: Sequence[str], positions1: DataFrame | None = None,
                     positions2: DataFrame | None = None, value: str = "estimate",
                     moe: str | None = "moe", out_col: str = "group", sep: str = "_",
                     by: Sequence[str] = (), null_policy: str = "propagate", zero_rule: bool = False,
                     squares: str | None = None) -> DataFrame:
    """Collapse ``col1`` within ``col2``, then ``col2`` within the first.

    Sums are linear, so both mappings are joined at once and ONE grouped
    aggregation gives ``{grp1}{sep}{grp2}``; for the margin,
    ``sqrt(sum(sqrt(sum m^2)^2)) == sqrt(sum m^2)``, so one pass is exact too.
    Output keeps ``col1`` and ``col2`` (the group names) and their ordinals.
    Decimals and ``squares`` as in :func:`group_rollup`.
    """
    keys, by = list(keys), list(by)
    m1 = _mapping(df, spec1, col1, positions1, by).withColumnsRenamed({"grp": "_g1", "grp_ord": "_o1"})
    m2 = _mapping(df, spec2, col2, positions2, by).withColumnsRenamed({"grp": "_g2", "grp_ord": "_o2"})
    fanned = df.join(m1, [*by, col1]).join(m2, [*by, col2])
    aggs = _sums(value, moe, null_policy, zero_rule, squares)
    gkeys = [*dict.fromkeys([*by, *keys])]
    out = fanned.groupBy(*gkeys, F.col("_g1").alias(col1), F.col("_o1").alias(f"{col1}_ord"),
                         F.col("_g2").alias(col2), F.col("_o2").alias(f"{col2}_ord")).agg(*aggs)
    return out.withColumn(out_col, unite([col1, col2], sep))
