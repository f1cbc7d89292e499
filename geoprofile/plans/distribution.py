"""Per-slice distribution tables.

long profile -> slices (D11) -> headed wide table (D10, first topic wins)
-> display city names -> per slice: drop all-empty columns (A8), order by
level then town, and write one CSV per slice (S8/S9).

The wide table for every slice is ONE plan, and the writer runs it once: into a
snapshot in the shared folder, partitioned by slice.  The non-empty columns are found by one
aggregation over that snapshot, and all files are written by one job, whatever the number of slices.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import non_empty_columns_by
from ..functions.text import clean_title
from ..operators.geo import level_ordinal
from ..operators.merge import slices
from ..operators.reshape import to_display_wide
from ..session import ensure_checkpoint_dir
from ..sources.csv import write_csv_by
from ..sources.snapshot import write_snapshot

DISPLAY_LEVELS = ["state", "regions", "towns", "neighborhoods"]


def distribution_wide(profile: DataFrame, headings: DataFrame, display_values: Sequence[str],
                      by_name: DataFrame, city_of_slice: Mapping[str, str],
                      ids: Sequence[str] = ("level", "city", "town", "name"),
                      measures: Sequence[str] = ("estimate", "share"), order: Sequence[str] = ("topic_ord",),
                      join_on: Sequence[str] = ("topic", "indicator")) -> DataFrame:
    """Headed wide table of every slice: (slice, ids..., one column per display)."""
    sliced = slices(profile, by_name, city_of_slice=city_of_slice)
    wide = to_display_wide(sliced, headings, ["slice", *ids], measures=measures, group_col="group",
                           order=order, join_on=join_on, display_values=display_values)
    return wide.withColumn("city", clean_title("city")) if "city" in ids else wide


def write_distribution(wide: DataFrame, out_dir: str, slice_col: str = "slice", level_col: str = "level",
                       levels: Sequence[str] = DISPLAY_LEVELS, sort: Sequence[str] = ("town", "name")) -> dict:
    """One CSV per slice (folder ``{slice_col}={slice}``) with its own non-empty columns; returns {slice: columns}."""
    spark = wide.sparkSession
    folder = os.path.join(ensure_checkpoint_dir(spark), f"distribution-{uuid.uuid4().hex}")
    names = {f"c{i}": c for i, c in enumerate(wide.columns) if c != slice_col}  # any header is a valid column here
    write_snapshot(wide.select(slice_col, *[F.col(f"`{c}`").alias(n) for n, c in names.items()]), folder, [slice_col])
    held = spark.read.schema(", ".join([f"{slice_col} string"] + [f"{n} {wide.schema[c].dataType.simpleString()}" for n, c in names.items()])).parquet(folder)
    held = held.select(slice_col, *[F.col(n).alias(c) for n, c in names.items()])
    per = {sl: [c for c in cols if c != slice_col] for sl, cols in non_empty_columns_by(held, slice_col).items()}
    order = [level_ordinal(level_col, levels), *[c for c in sort if c in held.columns]]
    write_csv_by(held, out_dir, slice_col, per, sort=order)
    return per
