"""Reshaping: R1/R2 unpivot, R3/R4 pivot, R5 multi-measure pivot, R7, D10.

Pivots always take an explicit value list (the caller's heading/group
order): no extra distinct job, a fixed column order that positional ranges
can rely on.  Pivot aggregation is partial, so
a hot id key is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import unite
from ..session import cut_lineage
from ._util import null_safe_join, unmatched_metrics
from .merge import first_per_key


def unpivot_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], names_to: str = "type",
                 values_to: str = "value", cast: str | None = "double") -> DataFrame:
    """``pivot_longer``: NULL cells are kept (as R does); cast to one type."""
    src = df.select(*ids, *[F.col(v).cast(cast).alias(v) if cast else F.col(v) for v in values])
    return src.unpivot(list(ids), list(values), names_to, values_to)


def pivot_wide(df: DataFrame, ids: Sequence[str], names_from: str | Column, values: Sequence[str],
               value_col: str = "value", prefix: str = "", agg: str = "first") -> DataFrame:
    """``pivot_wider(names_from, names_prefix=)`` with an explicit value list.

    ``agg='first'`` takes the single value of a cell and fails when a cell
    holds more than one row; any other Spark aggregate name may be given.
    """
    values = list(values)
    nf = F.col(names_from) if isinstance(names_from, str) else names_from
    key = F.concat(F.lit(prefix), nf) if prefix else nf
    vals = [prefix + v for v in values] if prefix else values
    src = df.select(*ids, key.alias("_names"), F.col(value_col).alias("_v"))
    if agg != "first":
        return src.groupBy(*ids).pivot("_names", vals).agg(getattr(F, agg)("_v"))
    return src.groupBy(*ids).agg(*[single_value(F.col("_names") == v, F.col("_v")).alias(v) for v in vals])


def wide_measures(df: DataFrame, ids: Sequence[str], group_col: str, groups: Sequence[str],
                  measures: Sequence[str]) -> DataFrame:
    """R5 ``make_wide(estimate:sharemoe, group=group)`` -> ``{group}_{measure}``.

    Columns are ordered group-major in the given group order, so positional
    ranges such as ``total_pop_estimate:female_sharemoe`` are stable.
    """
    groups = list(groups)
    return df.groupBy(*ids).agg(*[single_value(F.col(group_col) == g, F.col(m)).alias(f"{g}_{m}") for g in groups for m in measures])


def pivot_found(df: DataFrame, ids: Sequence[str], names_from: str, value_col: str = "value", prefix: str = "") -> DataFrame:
    """R3/R4 with the names found in the data: ``pivot_wider`` as R has it, columns in name order.

    Cells are gathered to one map per id (a hot id holds one entry per name), which is written once to the shared folder; the
    distinct names, a schema's worth, come from there.  A cell with two rows is an error, a NULL name is called ``NA``.
    """
    name = F.coalesce(F.col(names_from).cast("string"), F.lit("NA"))
    cells = cut_lineage(df.groupBy(*ids).agg(F.map_from_entries(F.collect_list(F.struct(name, F.col(value_col)))).alias("_cells")))
    names = sorted(r.name for r in cells.select(F.explode(F.map_keys("_cells")).alias("name")).distinct().collect())
    return cells.select(*ids, *[F.try_element_at("_cells", F.lit(n)).alias(prefix + n) for n in names])


def single_value(cell: Column, value: Column) -> Column:
    """Aggregate: the value of the only row for which ``cell`` holds, NULL without one; fails on two rows.

    Which of two rows a pivot would take depends on task order, so the check
    is part of the aggregation itself.
    """
    n = F.count(F.when(cell, 1))
    return F.when(n <= 1, F.max(F.when(cell, value))).otherwise(
        F.raise_error(F.concat(F.lit("a pivot cell holds "), n.cast("string"), F.lit(" rows"))))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once (empty = safe to pivot): which cells :func:`single_value` fails on."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def to_display_wide(df: DataFrame, headings: DataFrame, ids: Sequence[str],
                    measures: Sequence[str] = ("estimate", "share"), group_col: str = "group",
                    order: Sequence[str] = (), join_on: Sequence[str] = ("indicator",),
                    display_values: Sequence[str] | None = None, report: Observation | None = None) -> DataFrame:
    """Long measures -> ``"{type} {group}"`` -> heading -> wide.

    1. unpivot ``measures`` to (type, value), drop NULL values;
    2. ``indicator = type || ' ' || group`` and left-join ``headings``
       (on ``join_on``, e.g. topic+indicator) for ``display``; indicators without
       a heading have no column (``report`` counts their values: ``rows``, ``unmatched``, ``example``);
    3. keep the first row per (ids, indicator) under ``order`` (the bind
       order of topics, made explicit);
    4. pivot ``display`` with the heading order as explicit column list.
    """
    ids = list(ids)
    keep_cols = [c for c in dict.fromkeys([*ids, group_col, *order, *[j for j in join_on if j != "indicator"]])]
    long = unpivot_long(df.select(*keep_cols, *measures), keep_cols, list(measures))
    long = (long.filter(F.col("value").isNotNull())
            .withColumn("indicator", unite(["type", group_col], " ")))
    hd = headings.select(*join_on, "display", *( ["ord"] if "ord" in headings.columns else []))
    if report is not None:
        hd = hd.withColumn("__found__", F.lit(True))
    long = null_safe_join(long, hd, list(join_on), "left")
    if report is not None:
        long = long.observe(report, *unmatched_metrics(F.col("__found__"), F.concat_ws(" ", *join_on)))
    if display_values is None:
        raise ValueError("display_values (the heading order) is required for a stable pivot")
    firsts = first_per_key(long.select(*ids, "indicator", "display", "value", *order),
                           [*ids, "indicator"], list(order) or ["display"])
    return pivot_wide(firsts, ids, "display", display_values, value_col="value")


def extract_parts(col: str, pattern: str, into: Sequence[str]) -> dict[str, Column]:
    """R7 ``extract(col, into, regex)``: one column per group; NULL (not '')
    when the whole pattern does not match; an unmatched optional group is ''."""
    c = F.col(col)
    return {name: F.when(c.rlike(pattern), F.regexp_extract(c, pattern, i + 1))
            for i, name in enumerate(into) if name is not None}
