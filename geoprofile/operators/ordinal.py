"""W3/O1 ordinals over a table of any size, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ._util import param_frame

_LOCAL = (1 << 33) - 1  # of a monotonically increasing id: the row in its partition; above it the partition


def ordinals(df: DataFrame, order: Sequence[Column | str], out_col: str = "position") -> DataFrame:
    """``df`` with the 1-based place of each row under ``order``; ties fall by the remaining columns, so places are distinct.

    Rows are range-partitioned and sorted in parallel, and written once to the shared folder with their place in their range.
    A range's first place is the number of rows in the ranges before: one count per range, summed on the driver.  A value in a
    third of all rows is spread over ranges by the remaining columns; only rows that are equal throughout stay together.
    """
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)}
    rest = [F.col(c) for c in df.columns if c not in named]
    held = cut_lineage(df.repartitionByRange(*by, *rest).sortWithinPartitions(*by, *rest).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_id", 33)
    sizes = sorted(tuple(r) for r in held.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row per partition
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    starts = param_frame(df.sparkSession, rows, "_part bigint, _before bigint")
    return (held.join(starts, part == F.col("_part"))
            .select(*df.columns, (F.col("_before") + F.col("_id").bitwiseAND(F.lit(_LOCAL)) + 1).alias(out_col)))
