"""Column-set helpers: selection by name, range, pattern and content.

Name-based helpers are driver-side list work on ``df.columns`` (no job).
Content-based helpers (``select_where_all``, ``drop_empty_columns``) run ONE
aggregation job whose single result row holds one flag/count per column, so
only a vector the size of the schema reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """``select(-any_of(...))``: ``drop`` already ignores absent names."""
    return df.drop(*names)


def select_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``select(any_of(...))``."""
    return df.select(*[c for c in names if c in df.columns])


def move_to_front(df: DataFrame, *names: str) -> DataFrame:
    """``select(a, b, everything())``."""
    front = [c for c in names if c in df.columns]
    return df.select(*front, *[c for c in df.columns if c not in front])


def col_range(df_or_cols, start: str, stop: str) -> list[str]:
    """Names from ``start`` to ``stop`` inclusive, by position (``a:b``)."""
    cols = list(df_or_cols.columns if isinstance(df_or_cols, DataFrame) else df_or_cols)
    i, j = cols.index(start), cols.index(stop)
    if j < i:
        raise ValueError(f"range {start}:{stop} is reversed")
    return cols[i:j + 1]


def matching(df_or_cols, prefix: str | None = None, suffix: str | None = None,
             regex: str | None = None) -> list[str]:
    """``starts_with`` / ``ends_with`` / ``matches`` (regex is a search)."""
    cols = list(df_or_cols.columns if isinstance(df_or_cols, DataFrame) else df_or_cols)
    out = cols
    if prefix is not None:
        out = [c for c in out if c.startswith(prefix)]
    if suffix is not None:
        out = [c for c in out if c.endswith(suffix)]
    if regex is not None:
        rx = re.compile(regex)
        out = [c for c in out if rx.search(c)]
    return out


def select_spec(df: DataFrame, spec: Sequence) -> DataFrame:
    """Ordered selection from a mixed spec, keeping first occurrence.

    Items: a column name, ``("range", a, b)``, ``("prefix", p)``,
    ``("suffix", s)``, ``("regex", r)``, ``("rest",)`` for ``everything()``
    and ``("drop", name)`` to remove a name chosen earlier.
    """
    chosen: list[str] = []
    dropped: set[str] = set()
    for item in spec:
        if isinstance(item, str):
            names = [item]
        else:
            kind = item[0]
            if kind == "range":
                names = col_range(df, item[1], item[2])
            elif kind == "prefix":
                names = matching(df, prefix=item[1])
            elif kind == "suffix":
                names = matching(df, suffix=item[1])
            elif kind == "regex":
                names = matching(df, regex=item[1])
            elif kind == "rest":
                names = list(df.columns)
            elif kind == "drop":
                dropped.add(item[1])
                continue
            else:
                raise ValueError(f"unknown selector {item!r}")
        for n in names:
            if n not in chosen:
                chosen.append(n)
    return df.select(*[c for c in chosen if c not in dropped])


def rename_with(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """``rename_with(fn)``: rename every column through ``fn``."""
    return df.toDF(*[fn(c) for c in df.columns])


def rename_like(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``set_names(names(other))``: positional rename with a length guard."""
    names = list(names.columns if isinstance(names, DataFrame) else names)
    if len(names) != len(df.columns):
        raise ValueError(f"positional rename needs {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def with_columns_over(df: DataFrame, cols: Iterable[str], fn) -> DataFrame:
    """``mutate(across(cols, fn))``."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def all_match_flags(df: DataFrame, pattern: str, cols: Sequence[str] | None = None) -> dict[str, bool]:
    """For each column: do all non-null values (as text) match ``pattern``?

    R's ``all(x, na.rm=TRUE)`` is TRUE for an all-NA column; ``bool_and``
    returns NULL there, hence the ``coalesce``.  One aggregation job.
    """
    cols = list(cols or df.columns)
    if not cols:
        return {}
    aggs = [F.coalesce(F.bool_and(F.col(_q(c)).cast("string").rlike(pattern)), F.lit(True)).alias(f"f{i}")
            for i, c in enumerate(cols)]
    row = df.agg(*aggs).first()
    return {c: bool(row[f"f{i}"]) for i, c in enumerate(cols)}


def select_where_all(df: DataFrame, pattern: str, negate: bool = False) -> DataFrame:
    """``select(where(fn))`` with ``fn = all(str_detect(x, pattern), na.rm=TRUE)``."""
    flags = all_match_flags(df, pattern)
    return df.select(*[_q(c) for c in df.columns if flags[c] != negate])


def non_empty_columns(df: DataFrame) -> list[str]:
    """Columns holding at least one non-null value (one aggregation job)."""
    cols = list(df.columns)
    row = df.agg(*[F.count(F.col(_q(c))).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"n{i}"] > 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """``janitor::remove_empty('cols')``: '' is a value, only NULL is empty."""
    keep = non_empty_columns(df)
    return df.select(*[_q(c) for c in keep])


def non_empty_columns_by(df: DataFrame, by: str) -> dict[str, list[str]]:
    """Per value of ``by`` (a slice key), the columns that are non-empty.

    One grouped aggregation; the result has one row per slice, which is a
    parameter-sized set (slices are named by the caller).
    """
    cols = [c for c in df.columns if c != by]
    rows = df.groupBy(by).agg(*[F.count(F.col(_q(c))).alias(f"n{i}") for i, c in enumerate(cols)]).collect()
    return {r[by]: [by] + [c for i, c in enumerate(cols) if r[f"n{i}"] > 0] for r in rows}
