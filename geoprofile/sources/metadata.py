"""Metadata sources: S10 nested variable JSON, S11 geocode sheet (landed as
CSV), S12 landed leaf-level survey files."""

from __future__ import annotations

import csv
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .csv import read_csv

VARIABLES_SCHEMA = "variables map<string, struct<label: string, concept: string, group: string>>"

#: Column and the pattern of its heading (letters and single spaces, lower case).
GEOCODE_HEADINGS = {"summary_level": "^summary level", "state": "^state", "county": "^county(?! sub)", "county_subdivision": "sub",
                    "place": "^place", "consolidated_city": "city", "area_name": "^area"}


def read_variables_json(spark: SparkSession, path: str) -> DataFrame:
    """``{"variables": {code: {label, concept, group}}}`` -> one row per
    code: (variable, label, concept, group).  The map is exploded in Spark;
    nothing is flattened on the driver."""
    raw = spark.read.schema(VARIABLES_SCHEMA).option("multiLine", True).json(path)
    ex = raw.select(F.explode("variables").alias("variable", "v"))
    return ex.select("variable", "v.label", "v.concept", F.col("v.group").alias("group"))


def read_geocodes(spark: SparkSession, path: str) -> DataFrame:
    """The geocode workbook landed as CSV, all-string fixed schema.

    Columns are found by the sheet's header row, in any order and wherever the row stands: the first one that names a
    summary level.  Rows whose summary level is no 3-digit code (the preamble, the header) are
    dropped, instead of a row-count skip, which depends on row order.
    """
    line = spark.read.text(path).filter(F.col("value").rlike("(?i)summary.?level")).first()
    if line is None:
        raise ValueError(f"no header row with a summary level in {path}")
    names = [" ".join(re.findall("[a-z]+", c.lower())) for c in next(csv.reader([line.value]))]
    at = {}
    for column, pattern in GEOCODE_HEADINGS.items():
        found = [i for i, n in enumerate(names) if re.search(pattern, n)]
        if len(found) != 1:
            raise ValueError(f"{len(found)} columns of the header {names} name {column}")
        at[column] = f"_c{found[0]}"
    df = spark.read.option("header", False).schema(", ".join(f"_c{i} string" for i in range(len(names)))).csv(path)
    return df.select(*[F.col(c).alias(column) for column, c in at.items()]).filter(F.col("summary_level").rlike("^\\d{3}$"))


ESTIMATES_SCHEMA = ("tbl string, level string, name string, geoid string, year int, variable string, "
                    "estimate double, moe double")


def read_landed_estimates(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Landed leaf-level survey extracts -> the long estimates table."""
    if fmt == "csv":
        return read_csv(spark, path, ESTIMATES_SCHEMA)
    return spark.read.schema(ESTIMATES_SCHEMA).format(fmt).load(path)


def explode_json_map(df: DataFrame, col: str, value_type: str = "string", keep=(),
                     key_col: str = "key", value_col: str = "value") -> DataFrame:
    """R9 ``flatten`` of a JSON object held in a string column: one row per
    (kept columns, key, value).  Parsing is the JVM ``from_json``."""
    m = F.from_json(F.col(col), f"map<string,{value_type}>")
    return df.select(*keep, F.explode(m).alias(key_col, value_col))


def explode_json_variant(df: DataFrame, col: str, keep=()) -> DataFrame:
    """R9/S10 for objects of MIXED values: one row per (kept columns, key, kind, value), whatever the values are.

    The text becomes a VARIANT, so numbers, texts, flags, lists and objects stand side by side without a declared
    type: ``kind`` is the value's own type, ``value`` its text (JSON for lists and objects, NULL for a JSON null).  What is no JSON object, and
    an empty one, has no rows.
    """
    parsed = df.select(*keep, F.try_parse_json(F.col(col)).alias("_json"))
    objects = parsed.filter(F.schema_of_variant("_json").startswith("OBJECT"))
    rows = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_json").outer()))
    kind = F.schema_of_variant("value")
    text = F.when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json("value")).otherwise(F.try_variant_get("value", "$", "string"))
    return rows.select(*keep, "key", F.regexp_replace(kind, "^(OBJECT|ARRAY).*$", "$1").alias("kind"), text.alias("value"))
