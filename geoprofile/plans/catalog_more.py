"""Registered queries for reports, provenance, ordinals, found pivots, mixed JSON and nested areas, over the driver tables."""

from __future__ import annotations

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from ..functions.categories import arrange_key, collapse_levels, level_place, relabel_levels, relevel, with_levels
from ..functions.columns import rename_like
from ..functions.text import clean_names
from ..operators._util import param_frame
from ..operators.assembly import wide_profile
from ..operators.geo import geo_levels, membership_closure
from ..operators.labels import label_variables, split_label
from ..operators.merge import prefer_source
from ..operators.ordinal import ordinals
from ..operators.reshape import pivot_found
from ..operators.rollup import group_rollup
from ..operators.shares import calc_shares
from ..session import cut_lineage
from ..sources.metadata import explode_json_variant
from . import standins as S
from .catalog import SPLIT_INTO, PRIORITY_LABEL_GROUPS, STATUS_TOPIC_GROUPS, label_positions, source_cells

# ---------------------------------------------------------------- fixed values
NESTED = [("Inner ring", "NATION_0"), ("Inner ring", "NATION_5"), ("Outer ring", "Inner ring"), ("Outer ring", "AMERICA"),
          ("Both hemispheres", "Outer ring"), ("Both hemispheres", "ASIA"), ("Both hemispheres", "NATION_0")]
# -----------------------------------------------------------------------------


def q_unmatched_rows(spark, sf):
    """What found no partner on the way to a wide profile, counted by the job that makes it: codes of one status
    are missing in the dictionary, and the nations of one region in a lookup."""
    codes, partners = Observation("codes"), Observation("partners")
    known = S.labels(spark).filter(~F.col("variable").startswith("ord_P_"))
    est = label_variables(S.town_estimates(spark, sf, exact=True), known, on=("variable",), report=codes)
    roll = group_rollup(split_label(est, SPLIT_INTO, keep="leaf"), PRIORITY_LABEL_GROUPS, ["name", "year"], "priority", out_col="group", squares="moe_sq")
    region = S.nation_region(spark, sf).withColumnRenamed("town", "name")
    wide = wide_profile(roll, ["name", "year"], list(PRIORITY_LABEL_GROUPS), [(region.filter("county <> 'ASIA'"), ["name"]), (region.select("name"), ["name"])],
                        ["name", "year", "county", ("rest",)], measures=("estimate", "moe"), report=partners)
    cut_lineage(wide)
    of = {"code": (codes.get, ""), "county": (partners.get, "0_"), "name": (partners.get, "1_")}
    return param_frame(spark, [(k, *[m[f"{prefix}{x}"] for x in ("rows", "unmatched", "example")]) for k, (m, prefix) in of.items()],
                       "lookup string, rows bigint, unmatched bigint, example string")


def q_source_origins(spark, sf):
    """Shares of status groups with the sources behind them: orders, where they cover a status, else line items."""
    best = prefer_source(source_cells(spark, sf), ["name", "year", "variable"], "src", ["orders", "lineitem"], only_listed=True, origin_col="origin")
    lab = split_label(label_variables(best, S.labels(spark), on=("variable",)), SPLIT_INTO, keep=2)
    roll = group_rollup(lab, STATUS_TOPIC_GROUPS, ["name", "year"], "status", positions=label_positions(spark, sf, "status"), moe=None,
                        out_col="group", origin="origin")
    sh = calc_shares(roll, ["name", "year"], "group", denom="total", moe=None, origin="origin")
    return sh.select("name", "year", "group", F.round("estimate", 2).alias("estimate"), F.round("share", 6).alias("share"), "origin", F.coalesce("mixed", F.lit(False)).alias("mixed"))


def q_part_ordinals(spark, sf):
    return ordinals(S.read(spark, sf, "part", "p_name", "p_partkey"), ["p_name", "p_partkey"]).select("p_partkey", "p_name", "position")


def q_found_pivot(spark, sf):
    ev = S.read(spark, sf, "events", "ts", "event_type", "value")
    daily = (ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
             .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value")))
    return pivot_found(daily, ["day"], "event_type", prefix="ev_")


def q_json_variant_explode(spark, sf):
    return explode_json_variant(S.read(spark, sf, "events", "event_id", "props"), "props", keep=["event_id"])


def q_nested_regions(spark, sf):
    """Estimates of regions that are made of nations, of regions, and of regions of these."""
    own = S.geography(spark, sf).select(F.col("r_name").alias("area"), F.col("n_name").alias("part"))
    closed = membership_closure(own.unionByName(param_frame(spark, NESTED, "area string, part string")))
    levels = closed.select(F.col("part").alias("leaf"), F.lit("3_regions").alias("level"), F.col("area").alias("name"))
    out = geo_levels(S.town_estimates(spark, sf, exact=True), levels, squares="moe_sq")
    return out.select("name", "year", "variable", F.round(F.col("estimate").cast("double"), 2).alias("estimate"), F.round("moe", 4).alias("moe"))


def q_category_levels(spark, sf):
    """Orders by priority, a category whose levels are named once, in the dictionary's order: releveled, collapsed and relabelled, it sorts
    and numbers the rows of a union by the levels that its column carries."""
    o = S.read(spark, sf, "orders", "o_orderpriority", "o_orderstatus", "o_totalprice")
    cells = (o.groupBy(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value")))
    cat = with_levels(cells, "priority", S.PRIORITY_DOMAIN)
    cat = relabel_levels(collapse_levels(relevel(cat, "priority", "5-LOW"), "priority", {"0-RUSH": ["1-URGENT", "2-HIGH"]}), "priority", lambda x: x[2:].title())
    both = cat.select("priority", "status", "value").unionByName(cat.filter("status = 'F'").withColumn("status", F.lit("again")))
    sums = both.groupBy("priority", "status").agg(F.round(F.sum("value"), 2).alias("value"))
    by = Window.partitionBy("status").orderBy(*arrange_key(sums, "priority"))  # a status has a row per level
    return sums.select("status", F.col("priority").cast("string").alias("priority"), level_place(sums, "priority").alias("place"), F.row_number().over(by).alias("row"), "value")


def q_clean_headers(spark, sf):
    """Supplier with the headers of a sheet, two of which clean to one name."""
    sup = S.read(spark, sf, "supplier", "s_suppkey", "s_name", "s_acctbal")
    return rename_like(sup, clean_names(["Supplier Key", "Name (legal)", "name legal"]))


QUERIES = {
    "unmatched_rows": q_unmatched_rows,
    "source_origins": q_source_origins,
    "part_ordinals": q_part_ordinals,
    "found_pivot": q_found_pivot,
    "json_variant_explode": q_json_variant_explode,
    "nested_regions": q_nested_regions,
    "category_levels": q_category_levels,
    "clean_headers": q_clean_headers,
}
