"""Small shared helpers for operators."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

def param_frame(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A parameter table built on the driver, as a local relation.

    An Arrow table becomes a ``LocalRelation``, whose size in bytes the planner
    knows, so it decides by its own threshold whether to broadcast it; a frame
    made of a list of rows would have an unknown size.
    """
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), fields)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (R's join semantics).

    ``<=>`` still plans as a hash/sort-merge equi-join.
    """
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def sum_propagate(value: str | Column, policy: str = "propagate") -> Column:
    """Grouped sum with an explicit NULL policy.

    ``propagate``: NULL if any input is NULL (R ``sum`` without na.rm).
    ``ignore``: Spark's default (NULLs skipped; all-NULL gives NULL).
    """
    v = F.col(value) if isinstance(value, str) else value
    s = F.sum(v)
    if policy == "ignore":
        return s
    if policy != "propagate":
        raise ValueError(f"unknown null policy {policy!r}")
    return F.when(F.count(F.lit(1)) == F.count(v), s)


def unmatched_metrics(found: Column, key: Column, name: str = "") -> list[Column]:
    """Metrics for ``DataFrame.observe`` after a left join: rows, rows without a partner (``found`` is NULL), and the least of their keys.

    A task that is run again after a loss counts its rows again, as all observed metrics do: the counts are for people, not for further work.
    """
    lone = found.isNull()
    return [F.count(F.lit(1)).alias(f"{name}rows"), F.count_if(lone).alias(f"{name}unmatched"), F.min(F.when(lone, key)).alias(f"{name}example")]
