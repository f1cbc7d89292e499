"""A category type with its order (R's factor).

The levels of a column, in order, are part of its type: they are held in the column's metadata, which ``select``, ``filter``, joins, unions
and group keys keep.  So a sort, a relevel or a pivot asks the column for its levels instead of being told them again.  Values stay
strings; a value that is no level sorts after all levels, by name, and NULL comes last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._names import quoted

LEVELS = "levels"


def levels_of(df: DataFrame, col: str) -> list[str]:
    """The levels of a category, in order; an error for a column that is none."""
    meta = df.schema[col].metadata
    if LEVELS not in meta:
        raise ValueError(f"column {col!r} is no category: it has no levels")
    return list(meta[LEVELS])


def with_levels(df: DataFrame, col: str, levels: Iterable[str], value: Column | None = None) -> DataFrame:
    """``factor(col, levels)``: ``col`` (or ``value`` in its place) as a category with these levels."""
    levels = list(levels)
    if len(set(levels)) != len(levels):
        raise ValueError(f"levels repeat: {levels}")
    value = F.col(quoted(col)) if value is None else value
    return df.select(*[value.cast("string").alias(col, metadata={**df.schema[c].metadata, LEVELS: levels}) if c == col else F.col(quoted(c)) for c in df.columns])


def as_category(df: DataFrame, col: str, first_by: str | None = None) -> DataFrame:
    """``as_factor``: levels in order of first appearance, made explicit as the least ``first_by`` (default: by name).

    One aggregation; the distinct values, a category's levels, come to the driver.
    """
    order = F.min(F.col(quoted(first_by)) if first_by else F.col(quoted(col)))
    found = df.filter(F.col(quoted(col)).isNotNull()).groupBy(F.col(quoted(col)).cast("string").alias("level")).agg(order.alias("first"))
    return with_levels(df, col, [r.level for r in found.orderBy("first", "level").collect()])


def relevel(df: DataFrame, col: str, *front: str, after: int = 0) -> DataFrame:
    """``fct_relevel``: the named levels moved to the place after ``after`` others, the rest as they were."""
    old = levels_of(df, col)
    if unknown := [x for x in front if x not in old]:
        raise ValueError(f"no levels of {col!r}: {unknown}")
    rest = [x for x in old if x not in front]
    return with_levels(df, col, [*rest[:after], *front, *rest[after:]])


def _mapped(df: DataFrame, col: str, new: Mapping[str, str]) -> DataFrame:
    """Values and levels through ``new``; levels that become one stand where the first of them stood."""
    old = levels_of(df, col)
    changed = {a: b for a, b in new.items() if a in old and a != b}
    value = F.col(quoted(col))
    if changed:
        table = F.create_map(*[F.lit(x) for pair in changed.items() for x in pair])
        value = F.coalesce(F.try_element_at(table, value), value)
    return with_levels(df, col, dict.fromkeys(new.get(x, x) for x in old), value)


def recode_levels(df: DataFrame, col: str, new: Mapping[str, str]) -> DataFrame:
    """``fct_recode``: ``{old: new}``; a name that is no level is an error."""
    if unknown := [x for x in new if x not in levels_of(df, col)]:
        raise ValueError(f"no levels of {col!r}: {unknown}")
    return _mapped(df, col, new)


def collapse_levels(df: DataFrame, col: str, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """``fct_collapse``: ``{group: [level, ..]}``."""
    return recode_levels(df, col, {x: g for g, members in groups.items() for x in members})


def relabel_levels(df: DataFrame, col: str, fn: Callable[[str], str]) -> DataFrame:
    """``fct_relabel``: every level through ``fn``, which runs once per level."""
    return _mapped(df, col, {x: fn(x) for x in levels_of(df, col)})


def level_place(df: DataFrame, col: str) -> Column:
    """1-based place of the value's level; NULL if it has none."""
    place = F.array_position(F.array(*[F.lit(x) for x in levels_of(df, col)]), F.col(quoted(col)))
    return F.when(place > 0, place.cast("int"))


def arrange_key(df: DataFrame, col: str) -> list[Column]:
    """Sort columns for ``arrange(col)``: by level, then values without one by name, then NULL."""
    return [F.asc_nulls_last(level_place(df, col)), F.asc_nulls_last(quoted(col))]


def pivot_levels(df: DataFrame, ids: Sequence[str], col: str, value_col: str = "value") -> DataFrame:
    """``pivot_wider(names_from = col)`` with one column per level, in level order; levels without rows are NULL columns."""
    from ..operators.reshape import pivot_wide
    return pivot_wide(df, ids, col, levels_of(df, col), value_col)
