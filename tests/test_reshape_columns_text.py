import pytest
from pyspark.sql import functions as F

from conftest import rows
from geoprofile.functions import text as T
from geoprofile.functions.columns import (col_range, drop_empty_columns, matching, non_empty_columns_by,
                                          rename_like, select_spec, select_where_all)
from geoprofile.operators.codes import geo_codes, ordered_concat, profile_links
from geoprofile.plans.catalog import NAME_PATTERN
from geoprofile.operators.reshape import (check_unique, extract_parts, pivot_wide, to_display_wide,
                                          unpivot_long, wide_measures)


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([("A", 1.0, None)], "name string, estimate double, share double")
    out = unpivot_long(df, ["name"], ["estimate", "share"])
    assert rows(out) == [("A", "estimate", 1.0), ("A", "share", None)]


def test_pivot_prefix_and_sparse(spark):
    df = spark.createDataFrame([("x", "A", 0.5), ("y", "A", 0.1), ("x", "B", 0.2)],
                               "indicator string, name string, value double")
    out = pivot_wide(df, ["name"], "indicator", ["x", "y"], prefix="cws_")
    assert out.columns == ["name", "cws_x", "cws_y"]
    assert rows(out) == [("A", 0.5, 0.1), ("B", 0.2, None)]


def test_wide_measures_names_and_order(spark):
    df = spark.createDataFrame([("A", "total", 10.0, 1.0), ("A", "male", 4.0, 0.5)],
                               "name string, group string, estimate double, moe double")
    out = wide_measures(df, ["name"], "group", ["total", "male"], ["estimate", "moe"])
    assert out.columns == ["name", "total_estimate", "total_moe", "male_estimate", "male_moe"]
    assert col_range(out, "total_moe", "male_estimate") == ["total_moe", "male_estimate"]


def test_display_wide_first_topic_wins(spark):
    df = spark.createDataFrame([
        ("age", 1, "A", "total_pop", 100.0, None), ("age", 1, "A", "kids", 20.0, 0.2),
        ("race", 2, "A", "total_pop", 101.0, None)],
        "topic string, topic_ord int, name string, group string, estimate double, share double")
    hd = spark.createDataFrame([("age", "estimate total_pop", "Total population"),
                                ("race", "estimate total_pop", "Total population"),
                                ("age", "estimate kids", "Kids"), ("age", "share kids", "Percent kids")],
                               "topic string, indicator string, display string")
    out = to_display_wide(df, hd, ["name"], order=["topic_ord"], join_on=["topic", "indicator"],
                          display_values=["Total population", "Kids", "Percent kids"])
    assert out.columns == ["name", "Total population", "Kids", "Percent kids"]
    assert rows(out) == [("A", 100.0, 20.0, 0.2)]


def test_check_unique(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "x"), ("B", "x")], "name string, ind string")
    assert check_unique(df, ["name", "ind"]).count() == 1


def test_extract_parts(spark):
    df = spark.createDataFrame([("bridgeport_Black Rock",), ("nhv_East Rock",), ("New Haven",), ("lower",)], "raw string")
    p = extract_parts("raw", NAME_PATTERN, ["city", "name"])
    got = {r.raw: (r.city, r.name) for r in df.select("raw", p["city"].alias("city"), p["name"].alias("name")).collect()}
    assert got["bridgeport_Black Rock"] == ("bridgeport", "Black Rock")
    assert got["nhv_East Rock"] == ("nhv", "East Rock")
    assert got["New Haven"] == ("", "New Haven")
    assert got["lower"] == (None, None)


def test_select_where_all_null_column_counts_as_true(spark):
    df = spark.createDataFrame([("1", "a", None, "09"), ("2", "3", None, "x")], "a string, b string, c string, d string")
    # not_digits keeps b (mixed) and d (mixed); a is all digits; c is all NULL -> has_digits TRUE
    assert select_where_all(df, "^\\d", negate=True).columns == ["b", "d"]
    assert select_where_all(df, "^\\d").columns == ["a", "c"]


def test_drop_empty_columns_keeps_empty_string(spark):
    df = spark.createDataFrame([("x", "", None), ("y", "", None)], "a string, city string, town string")
    assert drop_empty_columns(df).columns == ["a", "city"]
    per = non_empty_columns_by(df.withColumn("town", F.when(F.col("a") == "x", "T")), "a")
    assert per["x"] == ["a", "city", "town"] and per["y"] == ["a", "city"]


def test_select_spec_and_rename_guard(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "Town int, cws_a int, x_estimate int, x_share int")
    out = select_spec(df, ["Town", ("prefix", "cws_"), ("range", "x_estimate", "x_share")])
    assert out.columns == ["Town", "cws_a", "x_estimate", "x_share"]
    assert matching(df, regex="share$") == ["x_share"]
    with pytest.raises(ValueError):
        rename_like(df, ["a", "b"])
    assert rename_like(df, ["a", "b", "c", "d"]).columns == ["a", "b", "c", "d"]


def test_text_helpers(spark):
    df = spark.createDataFrame([("Hartford town town", "Fairfield County", "12", None, "non-hispanic white", 0.1234)],
                               "a string, b string, c string, n double, t string, p double")
    r = df.select(
        T.remove_first("a", " town").alias("rm"),
        T.replace_first("b", "(?<= County)$", ", Connecticut").alias("rep"),
        T.pad_right("c", 7, "0").alias("pad"), T.pad_right(F.lit("123456789"), 7, "0").alias("nopad"),
        T.title_case("t").alias("title"), T.percent("p", 0.1).alias("pct"), T.percent("n", 1).alias("pct_null"),
        T.url_encode(F.lit("ACS 5-Year*~")).alias("url"),
        T.unite(["a", "n"], "_").alias("unite"), T.extract("b", "(?<=Fair)\\w+").alias("ext"),
        T.extract("b", "zzz").alias("ext_none"),
        T.clean_title(F.lit("new_haven")).alias("ct")).first()
    assert r.rm == "Hartford town" and r.rep == "Fairfield County, Connecticut"
    assert r.pad == "1200000" and r.nopad == "123456789"
    assert r.title == "Non-Hispanic White" and r.pct == "12.3%" and r.pct_null is None
    assert r.url == "ACS%205-Year%2A~" and r.unite == "Hartford town town_NA"
    assert r.ext == "field" and r.ext_none is None and r.ct == "New Haven"
    assert T.clean_name("Summary Level") == "summary_level" and T.clean_name("2019 Value") == "x2019_value"


def test_codes_and_links(spark):
    df = spark.createDataFrame([("040", "09", "000", "00000", "Connecticut"), ("050", "09", "001", "00000", "Fairfield"),
                                ("061", "09", "001", "04720", "Bethel")],
                               "summary_level string, state string, county string, cosub string, name string")
    codes = geo_codes(df, "summary_level", ["state", "county", "cosub"])
    assert rows(codes) == [("Bethel", "0600000US0900104720"), ("Connecticut", "0400000US09"),
                           ("Fairfield", "0500000US09001")]
    links = profile_links(codes, [("DP02", "Social")], "https://x/table", 2019, "ACS 5-Year")
    url = [r.Social for r in links.collect() if r.name == "Connecticut"][0]
    assert url == "https://x/table?table=DP02&g=0400000US09&tid=ACSDP5Y2019.DP02&vintage=2019&d=ACS%205-Year"
    long = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "k string, o int, v string")
    assert rows(ordered_concat(long, ["k"], "o", "v")) == [("a", "xy"), ("b", "z")]
