"""Registered queries for the column, recoding, ordering and NULL rules, over the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.columns import drop_if_present, move_to_front, rename_with, select_if_present, with_columns_over
from ..operators.codes import codes_by_name, concept_titles
from ..operators.geo import geo_levels, level_map, level_ordinal, membership_frame
from ..operators.merge import first_per_key, slice_frame, slices
from ..operators.reshape import unpivot_long
from ..operators.rollup import group_rollup
from . import standins as S
from .catalog import CUSTOM_REGIONS, PRIORITY_LABEL_GROUPS, SLICES, labelled_leaves, profile_long

# ---------------------------------------------------------------- fixed values
RECODED = {"Economy Parts": "Basic Parts"}
SEGMENT_NAMES = {"AUTOMOBILE": "Cars", "MACHINERY": "Machines"}
SEGMENT_GROUPS = {"Home": ["HOUSEHOLD", "FURNITURE"]}
# -----------------------------------------------------------------------------


def q_concept_titles(spark, sf):
    """Parts as a variable list: group from the size, concept from the type, badly typed."""
    part = S.read(spark, sf, "part")
    group = F.concat(F.when(F.col("p_size") % 3 == 0, "B").otherwise("DP"), T.pad_left(F.col("p_size").cast("string"), 2, "0"))
    concept = F.concat(F.lit("SELECTED "), F.col("p_type"), F.lit(" PARTS IN THE UNITED STATES "))
    return concept_titles(part.select(group.alias("group"), concept.alias("concept")), recoded=RECODED)


def q_codes_by_name(spark, sf):
    """Segments of nations as an area sheet: segments of two regions share a name."""
    rows = S.read(spark, sf, "customer", "c_nationkey", "c_mktsegment")
    nat = S.read(spark, sf, "nation", "n_nationkey", "n_regionkey")
    sheet = (rows.join(nat, rows.c_nationkey == nat.n_nationkey)
             .select(F.lit("061").alias("summary_level"), T.pad_left(F.col("n_regionkey").cast("string"), 2, "0").alias("state"),
                     F.lit("000").alias("county"), F.concat(F.initcap(F.lower("c_mktsegment")), F.lit(" County town")).alias("name")).distinct())
    return codes_by_name(sheet, "summary_level", ["state", "county"], levels=["050", "061"], state_name=S.STATE_NAME)


def q_recode_values(spark, sf):
    cus = S.read(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
    return cus.select("c_custkey", T.recode("c_mktsegment", SEGMENT_NAMES).alias("recoded"),
                      T.collapse("c_mktsegment", SEGMENT_GROUPS).alias("collapsed"),
                      T.extract("c_name", "(?<=#0{3,8})[1-9]\\d*$").alias("number"), T.str_sub("c_mktsegment", 1, 3).alias("short"))


def q_unpivot_rest(spark, sf):
    """All columns but the key, as text."""
    sup = rename_with(S.read(spark, sf, "supplier"), lambda c: c.removeprefix("s_"))
    text = with_columns_over(sup, ["acctbal"], lambda c: c.cast("decimal(18,2)"))
    return unpivot_long(text, ["suppkey"], [c for c in text.columns if c != "suppkey"], "variable", "value", cast="string")


def q_optional_columns(spark, sf):
    sup = S.read(spark, sf, "supplier")
    return move_to_front(drop_if_present(select_if_present(sup, ["s_suppkey", "s_phone", "s_name", "s_acctbal"]), "s_acctbal", "s_comment"), "s_name")


def q_sorted_levels(spark, sf):
    """Rows of each slice and variable numbered by level, then city with NULL last, then name."""
    by_name = slice_frame(spark, SLICES, always=[S.STATE_NAME])
    rows = slices(profile_long(spark, sf), by_name, city_of_slice={k: k for k in SLICES},
                  levels=["1_state", "4_towns"])
    order = Window.partitionBy("slice", "variable").orderBy(level_ordinal(), F.asc_nulls_last("city"), "name", "year")  # a slice is a few areas
    return rows.select("slice", "variable", "level", "city", "name", "year", F.row_number().over(order).alias("row"))


def q_filtered_regions(spark, sf):
    geo = S.geography(spark, sf)
    levels = level_map(geo, "n_name", "4_towns").unionByName(membership_frame(spark, CUSTOM_REGIONS, "3_regions", without="B$"))
    out = geo_levels(S.town_estimates(spark, sf), levels)
    return out.select("level", "name", "variable", "year", F.round("estimate", 2).alias("estimate"), F.round("moe", 4).alias("moe"))


def q_first_per_key(spark, sf):
    """One order per customer and status: the lowest priority label, of which one is missing, then the largest price."""
    o = S.read(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    rows = o.withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")))
    return first_per_key(rows, ["o_custkey", "o_orderstatus"], ["o_orderpriority", -F.col("o_totalprice")])


def q_null_margins(spark, sf):
    """Margins of one status are unknown: a group with one of them has no margin, or with "ignore" that of the rest."""
    leaves = labelled_leaves(spark, sf).withColumn("moe", F.when(F.col("status") != "P", F.col("moe")))
    out = None
    for policy in ("propagate", "ignore"):
        part = group_rollup(leaves, PRIORITY_LABEL_GROUPS, ["name", "year"], "priority", out_col="group", null_policy=policy)
        part = part.select(F.lit(policy).alias("policy"), "name", "year", "group", F.round("estimate", 2).alias("estimate"), F.round("moe", 4).alias("moe"))
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {
    "concept_titles": q_concept_titles,
    "codes_by_name": q_codes_by_name,
    "recode_values": q_recode_values,
    "unpivot_rest": q_unpivot_rest,
    "optional_columns": q_optional_columns,
    "sorted_levels": q_sorted_levels,
    "filtered_regions": q_filtered_regions,
    "first_per_key": q_first_per_key,
    "null_margins": q_null_margins,
}
