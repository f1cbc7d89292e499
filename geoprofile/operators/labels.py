"""D1 label_variables and D2 split_label (R ``separate``)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ._util import unmatched_metrics


def label_variables(df: DataFrame, labels: DataFrame, on: Sequence[str] = ("year", "variable"),
                    label_col: str = "label", how: str = "left", report: Observation | None = None) -> DataFrame:
    """Attach the label path of each variable code (per year).

    ``labels`` is a dimension (one row per year x variable).  No broadcast
    hint: the planner broadcasts it from file statistics or, for a derived
    frame, adaptive execution converts the join once the real size is known.

    ``report`` counts, in the job that runs anyway: ``rows``, ``unmatched`` (codes that the dictionary lacks: they get a
    NULL label and leave every depth) and ``example``, the least of these codes.
    """
    dim = labels.select(*on, label_col)
    if report is None:
        return df.join(dim, list(on), how)
    if how != "left":
        raise ValueError("what found no partner is known of a left join only")
    joined = df.join(dim.withColumn("__found__", F.lit(True)), list(on), how)
    return joined.observe(report, *unmatched_metrics(F.col("__found__"), F.concat_ws(" ", *on))).drop("__found__")


def split_label(df: DataFrame, into: Sequence[str | None], sep: str = "!!", label_col: str = "label",
                keep: str | int | None = None, drop: bool = True) -> DataFrame:
    """``separate(label, into=..., sep=...)`` plus the usual depth filter.

    * Short paths fill the right-hand parts with NULL; extra parts are
      dropped (``get`` is NULL out of range, ``[i]`` would raise under ANSI).
    * ``None`` in ``into`` skips that part, as NA does in R.
    * ``keep='leaf'`` keeps rows whose last part is present
      (the deepest categories); ``keep=k`` keeps rows of exactly depth
      ``k`` (subtotals of one level).
    """
    parts = F.split(F.col(label_col), re.escape(sep))
    cols = {name: F.get(parts, i) for i, name in enumerate(into) if name is not None}
    depth = F.size(parts)
    out = df
    if keep == "leaf":
        out = df.filter(depth >= len(into))
    elif isinstance(keep, int):
        out = df.filter(depth == keep if keep < len(into) else depth >= keep)
    out = out.withColumns(cols)
    return out.drop(label_col) if drop and label_col not in cols else out
