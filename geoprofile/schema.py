"""Declared schemas: the canonical survey tables and the driver's inputs.

Schemas are fixed at ingest (never inferred): inference lists and opens
files at planning time, which on a 100 TB folder is itself a job, and a
declared schema also lets a read carry only the columns a plan uses.
"""

from __future__ import annotations

# Canonical long-format survey tables.
ESTIMATES = ("src string, tbl string, level string, level_ord int, city string, name string, geoid string, "
             "year int, variable string, label string, estimate double, moe double")
LABELS = "year int, variable string, label string, ord int"
CROSSWALK = "city string, name string, geoid string, weight double"
MEMBERS = "region string, town string"
GROUPSPEC = "tbl string, grp string, grp_ord int, position int"
HEADINGS = "topic string, indicator string, display string, ord int"
SLICES = "slice string, name string"
PROFILE = ("topic string, indicator string, level string, city string, town string, name string, year int, "
           "group string, estimate double, moe double, share double, sharemoe double")

# Driver tables used as stand-ins (TESTDATA.md); same at every scale factor.
INPUT_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
               ("event_type", "string"), ("value", "double"), ("props", "string")],
}


def input_schema(table: str, columns=None) -> str | None:
    """DDL schema of a driver table, limited to ``columns`` (in table order)."""
    cols = INPUT_COLUMNS.get(table)
    if cols is None:
        return None
    want = set(columns) if columns else None
    if want is not None and not want <= {c for c, _ in cols}:
        return None
    return ", ".join(f"{c} {t}" for c, t in cols if want is None or c in want)
