"""Registered queries: each survey operator run over the driver tables.

Every query reads whole tables (``orders``/``customer``/``lineitem``/
``events`` and the dimensions), so its work grows with the data.  Parameter
tables (group specs, crosswalk weights, slice lists, headings) are small,
driver-built and broadcast.  Outputs are rounded to fixed digits (money 2,
shares 6) so independent engines agree on the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.columns import drop_empty_columns, select_where_all
from ..operators._util import param_frame
from ..operators.assembly import wide_profile
from ..operators.codes import geo_codes, profile_links
from ..operators.geo import apportion, geo_levels, level_map, membership_frame, suppress_non_additive
from ..operators.labels import label_variables, split_label
from ..operators.merge import prefer_source, slice_frame, slices
from ..operators.reshape import extract_parts, pivot_wide, to_display_wide, wide_measures
from ..operators.rollup import category_positions, group_rollup, two_stage_rollup
from ..operators.shares import calc_shares
from ..session import cut_lineage
from ..sources.metadata import explode_json_map
from . import standins as S
from .distribution import distribution_wide
from .profile import Topic, build_profile

# ---------------------------------------------------------------- fixed values
SPLIT_INTO = ["total", "status", "priority"]
PRIORITY_LABELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PRIORITY_GROUPS = {"total": range(1, 6), "high": range(1, 3), "low": range(4, 6)}
PRIORITY_LABEL_GROUPS = {"total": PRIORITY_LABELS, "high": PRIORITY_LABELS[:2], "low": PRIORITY_LABELS[3:]}
STATUS_GROUPS = {"all": range(1, 4), "open": 2, "closed": [1, 3]}
PRIORITY_STAGE2 = {"determined": range(1, 6), "urgent": 1, "top3": range(1, 4)}
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# crosswalk: (leaf nation, target city, target area, weight); NATION_2 and
# NATION_4 are split, NATION_11.. are in no area, "north" exists in 2 cities
CROSSWALK = [
    ("NATION_0", "alpha", "north", 1.0), ("NATION_1", "alpha", "north", 1.0),
    ("NATION_2", "alpha", "north", 0.6), ("NATION_2", "alpha", "south", 0.4),
    ("NATION_3", "alpha", "south", 1.0), ("NATION_4", "alpha", "south", 0.5),
    ("NATION_4", "beta", "east", 0.5), ("NATION_5", "beta", "east", 1.0),
    ("NATION_6", "beta", "east", 1.0), ("NATION_7", "beta", "east", 0.75),
    ("NATION_10", "beta", "north", 0.25),
]
# overlapping custom regions (a nation may sit in both)
CUSTOM_REGIONS = {"Ring A": ["NATION_0", "NATION_1", "NATION_5"], "Ring B": ["NATION_1", "NATION_2", "NATION_7"]}
SLICES = {
    "nation_0": {"region": "AFRICA", "town": "NATION_0"},
    "nation_1": {"region": "AMERICA", "town": ["NATION_1", "NATION_6"]},
    "nation_5": {"region": "AFRICA", "town": "NATION_5"},
}
HEADINGS = [
    ("estimate total", "Total order value", 1),
    ("estimate high", "High-priority order value", 2),
    ("share high", "Share high priority", 3),
    ("estimate low", "Low-priority order value", 4),
    ("share low", "Share low priority", 5),
]
CONCEPTS = [("DP02", "Social Characteristics"), ("DP03", "Economic Characteristics"),
            ("DP04", "Housing Characteristics"), ("DP05", "Demographic Characteristics")]
LINK_BASE = "https://data.census.gov/cedsci/table"
LINK_YEAR = 2019
LINK_DATASET = "ACS 5-Year Estimates Data Profiles"
PREFERRED_COVERS = ["F", "O"]  # statuses for which the preferred source has values
STATUS_TOPIC_GROUPS = {"total": range(1, 4), "open": 2, "done": [1, 3]}
# regions whose neighborhoods report their town
TOWN_REGIONS = ["AMERICA"]
NB_HEADINGS = [
    ("priority", "estimate total", "Order value"), ("priority", "estimate high", "High-priority value"),
    ("priority", "share high", "High-priority rate"), ("priority", "estimate low", "Low-priority value"),
    ("priority", "share low", "Low-priority rate"), ("status", "estimate total", "Order value"),
    ("status", "estimate open", "Open order value"), ("status", "share open", "Open rate"),
]
NB_DISPLAY = ["Order value", "High-priority value", "High-priority rate", "Low-priority value",
              "Low-priority rate", "Open order value", "Open rate"]
# -----------------------------------------------------------------------------


def _r(c: str, d: int):
    return F.round(F.col(c).cast("double"), d).alias(c)


# ------------------------------------------------------------ shared building blocks
def labelled_leaves(spark, sf, exact=False):
    est = label_variables(S.town_estimates(spark, sf, exact=exact), S.labels(spark), on=("variable",))
    return split_label(est, SPLIT_INTO, keep="leaf")


def label_positions(spark, sf, col="priority"):
    """Positions of a label part, from the LABELS dimension (not the fact)."""
    leaf_labels = split_label(S.labels(spark), SPLIT_INTO, keep="leaf")
    return category_positions(leaf_labels, col, "variable")


def priority_rollup(spark, sf, moe=True, leaves=None):
    exact = leaves is None
    leaves = labelled_leaves(spark, sf, exact=True) if exact else leaves
    out = group_rollup(leaves, PRIORITY_GROUPS, ["name", "year"], "priority",
                       positions=label_positions(spark, sf), moe="moe" if moe else None,
                       out_col="group", squares="moe_sq" if exact and moe else None)
    return out.withColumn("estimate", F.col("estimate").cast("double")).drop("moe_sq")  # shares are ratios of doubles


def priority_shares(spark, sf, moe=True):
    return calc_shares(priority_rollup(spark, sf, moe), ["name", "year"], "group", denom="total",
                       moe="moe" if moe else None)


def geo_level_map(spark, sf):
    geo = S.geography(spark, sf)
    own = level_map(geo, "n_name", "4_towns")
    region = level_map(geo, "n_name", "3_regions", F.col("r_name"))
    state = level_map(geo, "n_name", "1_state", F.lit(S.STATE_NAME))
    custom = membership_frame(spark, CUSTOM_REGIONS, "3_regions")
    return own.unionByName(region).unionByName(state).unionByName(custom)


def stacked_levels(spark, sf, df=None, carry=("variable", "year"), moe="moe"):
    """Levels of ``df``; without it, of the exact town estimates (decimals, squared margins)."""
    exact = df is None
    df = S.town_estimates(spark, sf, exact=True) if exact else df
    out = geo_levels(df, geo_level_map(spark, sf), leaf_col="name", carry=carry, moe=moe, squares="moe_sq" if exact else None)
    return out.withColumn("estimate", F.col("estimate").cast("double")).drop("moe_sq") if exact else out


def suppressed_levels(spark, sf, cells=None):
    both = S.town_estimates(spark, sf, cells, maximum=True)
    st = stacked_levels(spark, sf, both, carry=("tbl", "variable", "year"))
    return suppress_non_additive(st, (F.col("tbl") == "max_price") & T.detect("level", "state|regions"))


def geo_rows(spark, sf):
    """Geocode sheet analogue: region, nation and customer rows."""
    reg = S.read(spark, sf, "region", "r_regionkey", "r_name")
    nat = S.read(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey")
    cus = S.read(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    r = reg.select(F.lit("040").alias("summary_level"), T.pad_left(F.col("r_regionkey").cast("string"), 2, "0").alias("state"),
                   F.lit("000").alias("county"), F.lit("00000").alias("county_subdivision"), F.col("r_name").alias("name"))
    n = nat.select(F.lit("050").alias("summary_level"), T.pad_left(F.col("n_regionkey").cast("string"), 2, "0").alias("state"),
                   T.pad_left(F.col("n_nationkey").cast("string"), 3, "0").alias("county"),
                   F.lit("00000").alias("county_subdivision"), F.col("n_name").alias("name"))
    c = cus.join(nat, cus.c_nationkey == nat.n_nationkey).select(
        F.lit("061").alias("summary_level"), T.pad_left(F.col("n_regionkey").cast("string"), 2, "0").alias("state"),
        T.pad_left(F.col("n_nationkey").cast("string"), 3, "0").alias("county"),
        T.pad_left(F.col("c_custkey").cast("string"), 5, "0").alias("county_subdivision"), F.col("c_name").alias("name"))
    return r.unionByName(n).unionByName(c)


def codes(spark, sf):
    return geo_codes(geo_rows(spark, sf), "summary_level", ["state", "county", "county_subdivision"])


# ------------------------------------------------------------------- the queries
def q_variable_labels(spark, sf):
    est = label_variables(S.town_estimates(spark, sf), S.labels(spark), on=("variable",))
    return est.select("name", "year", "variable", "label", _r("estimate", 2), _r("moe", 4))


def q_label_split_leaves(spark, sf):
    return labelled_leaves(spark, sf).select("name", "year", "variable", "status", "priority",
                                             _r("estimate", 2), _r("moe", 4))


def q_group_rollup(spark, sf):
    out = group_rollup(labelled_leaves(spark, sf, exact=True), PRIORITY_LABEL_GROUPS, ["name", "year"], "priority",
                       moe=None, out_col="group")
    return out.select("name", "year", "group", _r("estimate", 2))


def q_group_rollup_positional(spark, sf):
    return priority_rollup(spark, sf, moe=False).select("name", "year", "group", _r("estimate", 2))


def q_shares(spark, sf):
    return priority_shares(spark, sf, moe=False).select("name", "year", "group", _r("estimate", 2), _r("share", 6))


def q_moe_rollup(spark, sf):
    return priority_rollup(spark, sf, moe=True).select("name", "year", "group", _r("estimate", 2), _r("moe", 4))


def q_moe_share(spark, sf):
    return priority_shares(spark, sf, moe=True).select("name", "year", "group", _r("estimate", 2), _r("moe", 4),
                                                       _r("share", 6), _r("sharemoe", 6))


def q_two_stage_rollup(spark, sf):
    leaves = labelled_leaves(spark, sf, exact=True)
    two = two_stage_rollup(leaves, STATUS_GROUPS, "status", PRIORITY_STAGE2, "priority", ["name", "year"],
                           positions1=label_positions(spark, sf, "status"),
                           positions2=label_positions(spark, sf, "priority"), moe=None)
    two = two.withColumn("estimate", F.col("estimate").cast("double"))
    sh = calc_shares(two, ["name", "year", "status"], "priority", denom="determined", moe=None)
    return sh.select("name", "year", "group", _r("estimate", 2), _r("share", 6))


def q_weighted_apportion(spark, sf):
    cw = param_frame(spark, CROSSWALK, "geoid string, city string, name string, weight double")
    est = S.town_estimates(spark, sf).withColumnRenamed("name", "geoid")
    out = apportion(est, cw, on="geoid", targets=("city", "name"), carry=("variable", "year"), digits=0,
                    exact_scale=2)
    return out.select("city", "name", "variable", "year", "estimate", _r("moe", 4))


def q_geo_levels(spark, sf):
    return stacked_levels(spark, sf).select("level", "name", "year", "variable", _r("estimate", 2), _r("moe", 4))


def q_suppress_medians(spark, sf):
    return suppressed_levels(spark, sf).select("level", "name", "year", "tbl", "variable",
                                               _r("estimate", 2), _r("moe", 4))


def source_cells(spark, sf):
    """(name, year, variable, src, estimate): two sources for one measure, the first of which covers some statuses only."""
    # lines are summed per order BEFORE the join: the partial aggregate
    # collapses a hot order map-side, and its hash partitioning on the
    # order key is the one the join needs, so it adds no exchange
    li = (S.read(spark, sf, "lineitem", "l_orderkey", "l_extendedprice")
          .groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("li_est")))
    o = S.read(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    c = S.read(spark, sf, "customer", "c_custkey", "c_nationkey")
    cg = c.join(S.geography(spark, sf), c.c_nationkey == F.col("n_nationkey"))
    lj = o.join(li, li.l_orderkey == o.o_orderkey, "left").join(cg, o.o_custkey == cg.c_custkey)
    # both measures in one pass; the preferred source covers some statuses only
    both = (lj.groupBy("n_name", F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status"))
            .agg(F.sum(F.when(F.col("o_orderstatus").isin(PREFERRED_COVERS), F.col("o_totalprice").cast("decimal(18,2)"))).alias("orders"),
                 F.sum("li_est").alias("lineitem"))
            .select(F.col("n_name").alias("name"), "year", S.variable_code("status").alias("variable"),
                    F.col("orders").cast("double").alias("orders"), F.col("lineitem").cast("double").alias("lineitem")))
    return both.unpivot(["name", "year", "variable"], ["orders", "lineitem"], "src", "estimate")


def q_prefer_source(spark, sf):
    best = prefer_source(source_cells(spark, sf), ["name", "year", "variable"], "src", ["orders", "lineitem"], only_listed=True)
    return best.select("name", "year", "variable", "src", _r("estimate", 2))


def profile_long(spark, sf):
    """All levels stacked: state, regions, towns (no city) + neighborhoods."""
    cells = S.segment_cells(spark, sf)
    up = stacked_levels(spark, sf, S.town_estimates(spark, sf, cells)).withColumn(
        "city", F.lit(None).cast("string"))
    nb = S.neighborhood_estimates(spark, sf, cells).select("level", "city", "name", "variable", "year", "estimate", "moe")
    return up.unionByName(nb)


def q_param_slices(spark, sf):
    by_name = slice_frame(spark, SLICES, always=[S.STATE_NAME])
    out = slices(profile_long(spark, sf), by_name, city_of_slice={k: k for k in SLICES})
    return out.select("slice", "level", "city", "name", "year", "variable", _r("estimate", 2))


def level_shares(spark, sf):
    """Priority groups and shares at every stacked level (keys level, name, year)."""
    st = stacked_levels(spark, sf)
    lab = split_label(label_variables(st, S.labels(spark), on=("variable",)), SPLIT_INTO, keep="leaf")
    roll = group_rollup(lab, PRIORITY_GROUPS, ["level", "name", "year"], "priority",
                        positions=label_positions(spark, sf), out_col="group")
    return calc_shares(roll, ["level", "name", "year"], "group", denom="total")


def q_display_wide(spark, sf):
    sh = level_shares(spark, sf).withColumns({"estimate": F.round("estimate", 2), "share": F.round("share", 6)})
    hd = param_frame(spark, HEADINGS, "indicator string, display string, ord int")
    return to_display_wide(sh, hd, ["level", "name", "year"], display_values=[h[1] for h in HEADINGS])


def q_wide_measures(spark, sf):
    sh = priority_shares(spark, sf).select("name", "year", "group", _r("estimate", 2), _r("moe", 4),
                                           _r("share", 6), _r("sharemoe", 6))
    return wide_measures(sh, ["name", "year"], "group", list(PRIORITY_GROUPS),
                         ["estimate", "moe", "share", "sharemoe"])


def q_prefixed_pivot(spark, sf):
    ev = S.read(spark, sf, "events", "ts", "event_type", "value")
    daily = (ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
             .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value")))
    return pivot_wide(daily, ["day"], "event_type", EVENT_TYPES, prefix="ev_")


def q_content_selected_columns(spark, sf):
    return select_where_all(S.read(spark, sf, "customer"), "^\\d", negate=True)


def q_drop_empty_columns(spark, sf):
    # the margin of a maximum is unknown everywhere, so its column is empty
    sup = suppressed_levels(spark, sf).filter(F.col("variable").isin("ord", "max_price"))
    wide = wide_measures(sup.withColumns({"estimate": F.round("estimate", 2), "moe": F.round("moe", 4)}),
                         ["level", "name", "year"], "variable", ["ord", "max_price"], ["estimate", "moe"])
    return drop_empty_columns(cut_lineage(wide))  # small; its columns are looked at before it is returned


def q_ordered_codes(spark, sf):
    return codes(spark, sf)


def q_profile_links(spark, sf):
    return profile_links(codes(spark, sf), CONCEPTS, LINK_BASE, LINK_YEAR, LINK_DATASET)


def q_json_map_explode(spark, sf):
    ev = S.read(spark, sf, "events", "event_id", "props")
    return explode_json_map(ev, "props", "int", keep=["event_id"])


def q_percent_format(spark, sf):
    sh = priority_shares(spark, sf, moe=False)
    return sh.select("name", "year", "group", T.percent("share", 0.1).alias("share_pct"))


# optional lower-case city and underscore, then a name that starts with a capital
NAME_PATTERN = "^(?:([a-z0-9 _]+)_)?([A-Z].*)$"


def q_name_normalise(spark, sf):
    cus = S.read(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nat = S.read(spark, sf, "nation", "n_nationkey", "n_name")
    nb = cus.join(nat, cus.c_nationkey == nat.n_nationkey).select(
        F.col("c_custkey").alias("id"), F.lit("6_neighborhoods").alias("level"),
        F.concat(F.lower("n_name"), F.lit("_"), F.initcap(F.lower("c_mktsegment"))).alias("raw"),
        F.col("c_name").alias("label"))
    up = nat.select((-1 - F.col("n_nationkey")).cast("bigint").alias("id"), F.lit("4_towns").alias("level"),
                    F.col("n_name").alias("raw"), F.col("n_name").alias("label"))
    u = nb.unionByName(up)
    parts = extract_parts("raw", NAME_PATTERN, ["city", "name"])
    return u.select(
        "id", "raw", parts["city"].alias("city"), parts["name"].alias("name"),
        T.remove_first("label", "0+").alias("short"),
        T.replace_first("label", "(?<=Customer)#", " No. ").alias("long_label"),
        T.remove_first("level", "^\\d_").alias("level"))


def q_null_fill_coalesce(spark, sf):
    cells = S.segment_cells(spark, sf)
    up = suppressed_levels(spark, sf, cells).withColumn("city", F.lit(None).cast("string")).drop("tbl")
    nb = S.neighborhood_estimates(spark, sf, cells).drop("tbl")
    u = up.unionByName(nb)
    filled = u.na.fill({"moe": 0.0})
    return filled.select(
        "level", F.when(T.detect("level", "neighborhoods"), F.col("city")).otherwise(F.lit("")).alias("city"),
        "name", "year", "variable", _r("estimate", 2), _r("moe", 4))


def cws_long(spark, sf):
    """Survey analogue: share of event value by type per nation (long)."""
    ev = S.read(spark, sf, "events", "user_id", "event_type", "value")
    c = S.read(spark, sf, "customer", "c_custkey", "c_nationkey")
    n = S.read(spark, sf, "nation", "n_nationkey", "n_name")
    j = ev.join(c, ev.user_id == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    by_type = j.groupBy("n_name", "event_type").agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("v"))
    # the total is a window over the sums by type: one pass over the events
    total = F.sum("v").over(Window.partitionBy("n_name"))
    return by_type.select(
        F.col("event_type").alias("indicator"), F.col("n_name").alias("name"),
        F.try_divide(F.col("v").cast("double"), total.cast("double")).alias("value"))


ASSEMBLY_HEADER_GROUPS = ["total", "high", "low"]


def q_profile_assembly(spark, sf):
    # shares stay unrounded here: they are printed as percentages below
    sh = priority_shares(spark, sf).select("name", "year", "group", _r("estimate", 2), _r("moe", 4),
                                           "share", "sharemoe")
    county = S.nation_region(spark, sf).withColumnRenamed("town", "name")
    cws = pivot_wide(cws_long(spark, sf), ["name"], "indicator", EVENT_TYPES, prefix="cws_")
    nat = S.read(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey")
    meta = profile_links(geo_codes(nat.select(F.lit("050").alias("summary_level"),
                                              T.pad_left(F.col("n_regionkey").cast("string"), 2, "0").alias("state"),
                                              T.pad_left(F.col("n_nationkey").cast("string"), 3, "0").alias("county"),
                                              F.col("n_name").alias("name")),
                                   "summary_level", ["state", "county"]),
                         CONCEPTS, LINK_BASE, LINK_YEAR, LINK_DATASET)
    layout = ["name", "county", "year", ("prefix", "cws_"), ("range", f"{ASSEMBLY_HEADER_GROUPS[0]}_estimate", f"{ASSEMBLY_HEADER_GROUPS[-1]}_sharemoe"),
              ("suffix", "Characteristics")]
    header = (["Town", "County", "Year"] + [f"Survey {e}" for e in EVENT_TYPES]
              + [f"{g} {m}" for g in ASSEMBLY_HEADER_GROUPS for m in ("estimate", "moe", "share", "sharemoe")]
              + [c for _, c in CONCEPTS])
    return wide_profile(sh, ["name", "year"], ASSEMBLY_HEADER_GROUPS, [(county, ["name"]), (cws, ["name"]), (meta, ["name"])], layout, header,
                        percents={"share(moe)?$": 0.1, "^cws_": 1},
                        clean={"name": T.replace_first("name", "(?<= County)$", ", " + S.STATE_NAME), "county": T.remove_first("county", " County$")})


def q_town_profile(spark, sf):
    """Three topics bound into one long profile at every stacked level."""
    st = stacked_levels(spark, sf, carry=("tbl", "variable", "year"))
    topics = {
        "total": Topic(tbl=S.TABLE, variables=[S.VAR_PREFIX], group_name="total_value"),
        "priority": Topic(tbl=S.TABLE, into=SPLIT_INTO, keep="leaf", group_col="priority",
                          spec=PRIORITY_GROUPS, denom="total"),
        "status": Topic(tbl=S.TABLE, into=SPLIT_INTO, keep=2, group_col="status",
                        spec=STATUS_TOPIC_GROUPS, denom="total"),
    }
    prof = build_profile(st, S.labels(spark), topics)
    return prof.select("topic", "topic_ord", "level", "name", "year", "group", "grp_ord", _r("estimate", 2),
                       _r("moe", 4), _r("share", 6), _r("sharemoe", 6))


def q_neighborhood_wide(spark, sf):
    """Neighborhood profile tail: topics at every level incl. neighborhoods,
    shares to 2 digits, slices, headed wide table (first topic wins)."""
    cells = S.segment_cells(spark, sf)
    up = (stacked_levels(spark, sf, S.town_estimates(spark, sf, cells), carry=("tbl", "variable", "year"))
          .withColumn("city", F.lit("")))
    long = up.unionByName(S.neighborhood_estimates(spark, sf, cells)).withColumn("level", T.remove_first("level", "^\\d_"))
    topics = {
        "priority": Topic(tbl=S.TABLE, into=SPLIT_INTO, keep="leaf", group_col="priority",
                          spec=PRIORITY_GROUPS, denom="total", digits=2),
        "status": Topic(tbl=S.TABLE, into=SPLIT_INTO, keep=2, group_col="status",
                        spec=STATUS_TOPIC_GROUPS, denom="total", digits=2),
    }
    prof = build_profile(long, S.labels(spark), topics, keys=("level", "city", "name", "year"), moe=False)
    cus = S.read(spark, sf, "customer", "c_nationkey", "c_mktsegment")
    nat = S.geography(spark, sf).filter(F.col("r_name").isin(TOWN_REGIONS))
    lookup = (cus.join(nat, cus.c_nationkey == nat.n_nationkey)
              .select(F.lower("n_name").alias("city"), F.initcap(F.lower("c_mktsegment")).alias("name"),
                      F.col("n_name").alias("town")).distinct())
    prof = prof.join(lookup, ["city", "name"], "left").withColumn("estimate", F.round("estimate", 2))
    hd = param_frame(spark, NB_HEADINGS, "topic string, indicator string, display string")
    return distribution_wide(prof, hd, NB_DISPLAY, slice_frame(spark, SLICES, always=[S.STATE_NAME]),
                             {k: k for k in SLICES}, ids=("level", "city", "town", "name", "year"))


QUERIES = {
    "variable_labels": q_variable_labels,
    "label_split_leaves": q_label_split_leaves,
    "group_rollup": q_group_rollup,
    "group_rollup_positional": q_group_rollup_positional,
    "shares": q_shares,
    "moe_rollup": q_moe_rollup,
    "moe_share": q_moe_share,
    "two_stage_rollup": q_two_stage_rollup,
    "weighted_apportion": q_weighted_apportion,
    "geo_levels": q_geo_levels,
    "suppress_medians": q_suppress_medians,
    "prefer_source": q_prefer_source,
    "param_slices": q_param_slices,
    "display_wide": q_display_wide,
    "wide_measures": q_wide_measures,
    "prefixed_pivot": q_prefixed_pivot,
    "content_selected_columns": q_content_selected_columns,
    "drop_empty_columns": q_drop_empty_columns,
    "ordered_codes": q_ordered_codes,
    "profile_links": q_profile_links,
    "json_map_explode": q_json_map_explode,
    "percent_format": q_percent_format,
    "name_normalise": q_name_normalise,
    "null_fill_coalesce": q_null_fill_coalesce,
    "profile_assembly": q_profile_assembly,
    "town_profile": q_town_profile,
    "neighborhood_wide": q_neighborhood_wide,
}
