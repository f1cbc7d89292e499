"""D12 wide_profile: one long profile, a survey and metadata as one laid-out wide table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import matching, rename_like, select_spec
from ..functions.text import percent
from ._util import null_safe_join, unmatched_metrics
from .merge import first_per_key
from .reshape import wide_measures


def wide_profile(profile: DataFrame, keys: Sequence[str], groups: Sequence[str], lookups: Sequence[tuple[DataFrame, Sequence[str]]],
                 layout: Sequence, header: Sequence[str] | None = None, measures: Sequence[str] = ("estimate", "moe", "share", "sharemoe"),
                 first: Sequence[str] = ("topic_ord",), percents: Mapping[str, float] | None = None,
                 clean: Mapping[str, Column] | None = None, report: Observation | None = None) -> DataFrame:
    """Pivot, join, lay out, format and name, in that order.

    1. of rows with the same ``keys`` and group the first by ``first`` stays (a group
       that several topics report is reported once), or is the only one, which the pivot checks, where
       ``profile`` has none of these columns; ``keys`` has the level, so that a town and a county of one name stay apart;
    2. ``groups`` x ``measures`` become columns ``{group}_{measure}``;
    3. ``lookups`` are left-joined, each on its own columns (NULL matches NULL);
       ``report`` counts, in the same job, the rows that found no partner: ``{i}_rows``, ``{i}_unmatched``, ``{i}_example`` for lookup i;
    4. ``clean``: columns replaced by an expression over the joined row;
    5. ``layout`` selects and orders columns by name, range and pattern (see ``select_spec``);
    6. columns that match a regex of ``percents`` are printed as percentages;
    7. ``header`` renames by position.
    """
    keys = list(keys)
    order = [o for o in first if o in profile.columns]
    once = profile.select(*keys, "group", *measures, *order)
    if order:
        once = first_per_key(once, [*keys, "group"], order)
    out = wide_measures(once, keys, "group", list(groups), list(measures))
    for i, (lookup, on) in enumerate(lookups):
        out = null_safe_join(out, lookup if report is None else lookup.withColumn(f"__found{i}__", F.lit(True)), list(on))
    if report is not None:
        out = out.observe(report, *[m for i, (_, on) in enumerate(lookups) for m in unmatched_metrics(F.col(f"__found{i}__"), F.concat_ws(" ", *on), f"{i}_")])
        out = out.drop(*[f"__found{i}__" for i in range(len(lookups))])
    if clean:
        out = out.withColumns(dict(clean))
    out = select_spec(out, layout)
    printed = {c: percent(f"`{c}`", accuracy) for regex, accuracy in (percents or {}).items() for c in matching(out, regex=regex)}
    if printed:
        out = out.withColumns(printed)
    return rename_like(out, header) if header else out
