"""Union, first-row-per-key, source priority (D8) and slices.

"Keep the first row per key" is done with a grouped ``min`` over a struct
whose leading fields are the priority/order: a declarative aggregate with a
partial (map-side) phase, so a key holding a third of all rows is reduced on
every mapper before the shuffle.  A ``row_number`` window would instead
sort every row of that key inside one task.  A struct minimum plans as a sort
aggregate; ``prefer_source`` with a listed priority and few value columns uses one
conditional minimum per source instead, which hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import param_frame


def union_all(frames: Sequence[DataFrame] | Mapping[str, DataFrame], id_col: str | None = None,
              id_ord_col: str | None = None) -> DataFrame:
    """``bind_rows`` (O3) / ``bind_rows(.id=)`` (O4): union by name, filling
    missing columns with NULL and tagging each part with its key."""
    if isinstance(frames, Mapping):
        parts = []
        for i, (k, f) in enumerate(frames.items(), start=1):
            cols = {}
            if id_col:
                cols[id_col] = F.lit(k)
            if id_ord_col:
                cols[id_ord_col] = F.lit(i)
            parts.append(f.withColumns(cols) if cols else f)
    else:
        parts = list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """A7 ``distinct(keys, .keep_all=TRUE)`` after ``arrange(order)``.

    The kept row is the one with the smallest ``order`` tuple, NULLs last as in
    ``arrange``; the remaining columns break ties, so the result does not
    depend on row order.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    # a struct's minimum puts NULL fields first, so each is preceded by "is it NULL"
    packed = F.struct(*[x for i, o in enumerate(order_cols) for x in (o.isNull().alias(f"_n{i}"), o.alias(f"_o{i}"))],
                      *[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(F.min(packed).alias("_p"))
    return out.select(*keys, *[F.col(f"_p.{c}").alias(c) for c in rest]).select(*df.columns)


def prefer_source(df: DataFrame, keys: Sequence[str], source_col: str = "src",
                  priority: Sequence[str] | None = None, value: str = "estimate",
                  extra_order: Sequence[str] = (), only_listed: bool = False, origin_col: str | None = None) -> DataFrame:
    """Keep, per key, the row from the highest-priority source.

    Rows with a NULL ``value`` are removed FIRST, so a lower-priority source
    fills in where the preferred one is missing.  ``priority`` lists source
    names best first (``fct_relevel``); unlisted sources follow, by name.
    With ``only_listed`` every source is in ``priority`` and gives one numeric row per key:
    then each source is one conditional aggregate and the first that has a value wins.
    ``origin_col`` adds the source as a bit (1 for the first in ``priority``, 2, 4, ..; unlisted ones share the next),
    which rollups combine and shares compare (``origin`` of ``group_rollup``, ``geo_levels`` and ``calc_shares``).
    """
    if origin_col is not None:
        best = prefer_source(df, keys, source_col, priority, value, extra_order, only_listed)
        bit = F.lit(1 << len(priority))
        for i, p in reversed(list(enumerate(priority))):
            bit = F.when(F.col(source_col) == p, F.lit(1 << i)).otherwise(bit)
        return best.withColumn(origin_col, bit)
    if only_listed:
        values = [c for c in df.columns if c not in (*keys, source_col)]
        known = F.col(value).isNotNull()
        g = df.groupBy(*keys).agg(
            *[F.count(F.when(known & (F.col(source_col) == p), 1)).alias(f"_has{i}") for i, p in enumerate(priority)],
            *[F.max(F.when(known & (F.col(source_col) == p), F.col(c))).alias(f"_{c}{i}") for i, p in enumerate(priority) for c in values])

        def chosen(of):
            out = None
            for i in range(len(priority)):
                out = F.when(F.col(f"_has{i}") > 0, of(i)) if out is None else out.when(F.col(f"_has{i}") > 0, of(i))
            return out

        best = g.withColumn(source_col, chosen(lambda i: F.lit(priority[i]))).filter(F.col(source_col).isNotNull())
        return best.select(*[c if c in (*keys, source_col) else chosen(lambda i, c=c: F.col(f"_{c}{i}")).alias(c) for c in df.columns])
    pri = F.col(source_col)
    if priority:
        pos = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(source_col))
        pri_ord = F.when(pos > 0, pos).otherwise(F.lit(len(priority) + 1))
    else:
        pri_ord = F.lit(0)
    kept = df.filter(F.col(value).isNotNull())
    return first_per_key(kept, keys, [pri_ord, pri, *extra_order])


def slice_frame(spark, params: Mapping[str, Mapping[str, object]], always: Iterable[str] = ()) -> DataFrame:
    """(slice, name) rows from ``{slice: {"region": r, "town": [t1, t2]}}``
    plus names every slice gets (e.g. the state)."""
    rows = []
    for sl, p in params.items():
        names: list[str] = []
        for v in p.values():
            names.extend([v] if isinstance(v, str) else list(v))
        names.extend(always)
        for n in dict.fromkeys(names):
            rows.append((sl, n))
    return param_frame(spark, rows, "slice string, name string")


def slices(df: DataFrame, by_name: DataFrame, name_col: str = "name", city_col: str | None = "city",
           slice_col: str = "slice", city_of_slice: Mapping[str, str] | None = None,
           levels: Sequence[str] | None = None, level_col: str = "level") -> DataFrame:
    """Each slice = rows whose name is listed OR whose city is the slice.

    The OR predicate is rewritten as two broadcast equi-joins: by name, and
    by city minus the rows the name branch already produced for that slice
    (an anti-join on the same small table), so no ``distinct`` shuffle and
    no nested-loop join.  A row may land in several slices.
    ``city_of_slice`` maps slice -> city value when they differ.  ``levels``
    restricts the rows taken by name: a name can stand at two levels (a
    town and a county), and only the listed levels are then meant.
    """
    names = by_name.select(F.col("slice").alias(slice_col), F.col("name").alias("_n"))
    listed = df if levels is None else df.filter(F.col(level_col).isin(list(levels)))
    a = listed.join(names, listed[name_col] == names["_n"]).drop("_n")
    if city_col is None:
        return a
    if city_of_slice is None:
        cities = by_name.select(F.col("slice").alias(slice_col), F.col("slice").alias("_c")).distinct()
    else:
        cities = param_frame(df.sparkSession, list(city_of_slice.items()), f"{slice_col} string, _c string")
    b = df.join(cities, df[city_col] == cities["_c"]).drop("_c")
    already = names.withColumnRenamed("_n", name_col)
    if levels is not None:
        already = already.withColumn(level_col, F.explode(F.array(*[F.lit(x) for x in levels])))  # no join without a key
    b = b.join(already, [c for c in already.columns], "left_anti")
    return a.unionByName(b)
