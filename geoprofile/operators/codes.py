"""A4 ordered string aggregate, D13 geography codes, D14 profile links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pad_right, recode, remove_first, replace_first, title_case, trim, url_with_query
from .reshape import unpivot_long


def ordered_concat(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str,
                   sep: str = "", out_col: str = "code") -> DataFrame:
    """A4 ``summarise(code = paste(value, collapse=sep))`` in EXPLICIT order.

    R relies on row order; here each group's parts are sorted by
    ``order_col``.  Meant for groups bounded by the schema (the parts of
    one code); for an unbounded group use a column expression instead.
    """
    parts = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(value_col).alias("v"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["v"]), sep).alias(out_col))


def nonzero_part(col: str):
    """A code part, or '' when it is NULL or all zeros (``^0+$``)."""
    c = F.col(col)
    return F.when(c.isNull() | c.rlike("^0+$"), F.lit("")).otherwise(c)


def geo_codes(df: DataFrame, level_col: str, parts: Sequence[str], name_col: str = "name",
              country: str = "US", level_width: int = 7, out_col: str = "code") -> DataFrame:
    """``{level[1:2] right-padded with 0 to 7}{country}{non-zero parts}``.

    The parts of one code live in one row, so the ordered paste is a column
    expression (no shuffle), with the order given by ``parts``.
    """
    lvl = pad_right(F.substring(F.col(level_col), 1, 2), level_width, "0")
    code = F.concat(nonzero_part_expr(lvl), F.lit(country), *[nonzero_part(p) for p in parts])
    return df.select(F.col(name_col).alias("name"), code.alias(out_col))


def nonzero_part_expr(c):
    return F.when(c.isNull() | c.rlike("^0+$"), F.lit("")).otherwise(c)


def codes_by_name(sheet: DataFrame, level_col: str, parts: Sequence[str], name_col: str = "name",
                  levels: Sequence[str] | None = None, states: Sequence[str] | None = None, state_col: str = "state",
                  state_name: str | None = None, country: str = "US") -> DataFrame:
    """D13 on a geocode sheet: the levels and states asked for, names tidied, ONE row per name.

    The sheet's code parts are unpivoted (R2), parts of zeros dropped, and pasted
    in explicit order (A4); areas that share a name share a row, their codes one after the other.
    """
    df = sheet
    if levels is not None:
        df = df.filter(F.col(level_col).isin(list(levels)))
    if states is not None:
        df = df.filter(F.col(state_col).isin(list(states)))
    name = remove_first(name_col, " town")
    if state_name:
        name = replace_first(name, " County", f" County, {state_name}")
    row = F.concat_ws("|", level_col, *parts)  # the areas of one name, in sheet order
    wide = df.select(name.alias("name"), row.alias("area"), pad_right(F.substring(F.col(level_col), 1, 2), 7, "0").alias("0"),
                     F.lit(country).alias("1"), *[F.col(p).cast("string").alias(str(i)) for i, p in enumerate(parts, start=2)])
    rest = [c for c in wide.columns if c not in ("name", "area")]
    long = unpivot_long(wide, ["name", "area"], rest, "part", "value", cast=None).filter(~F.col("value").rlike("^0+$"))
    at = F.struct("area", F.col("part").cast("int"))  # part 10 after part 2
    return ordered_concat(long.withColumn("at", at), ["name"], "at", "value")


def concept_titles(variables: DataFrame, group_regex: str = r"^DP\d{2}$", recoded: dict[str, str] | None = None) -> DataFrame:
    """D14, concept half: (group, concept) of the variables' groups that match ``group_regex``.

    Title case, without "Selected" in front and "In The United States", trimmed, recoded.
    """
    title = trim(remove_first(remove_first(title_case("concept"), "^Selected"), "In The United States"))
    return variables.filter(F.col("group").rlike(group_regex)).select("group", recode(title, recoded or {}).alias("concept")).distinct()


def profile_links(geos: DataFrame, concepts: Sequence[tuple[str, str]], base_url: str, year: int,
                  dataset: str, tid_prefix: str = "ACSDP5Y", name_col: str = "name",
                  code_col: str = "code") -> DataFrame:
    """One URL column per concept, one row per geography.

    The reference crosses every geography with every concept and pivots;
    since the concept list is a small named parameter, each concept becomes
    one projected column instead: no cross join, no pivot shuffle.
    Query order: ``table, g, tid, vintage, d``.
    """
    concepts = list(concepts)
    cols = []
    for group, concept in concepts:
        url = url_with_query(base_url, [("table", group), ("g", F.col(code_col)),
                                        ("tid", f"{tid_prefix}{year}.{group}"), ("vintage", year),
                                        ("d", dataset)])
        cols.append(url.alias(concept))
    return geos.select(F.col(name_col).alias("name"), *cols)
