"""Edge rules of readers, text functions and operators."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from geoprofile.functions import text as T
from geoprofile.functions.moe import moe_sum
from geoprofile.operators._util import param_frame
from geoprofile.operators.assembly import wide_profile
from geoprofile.operators.labels import label_variables
from geoprofile.operators.merge import first_per_key, prefer_source, slice_frame, slices
from geoprofile.operators.reshape import pivot_wide, to_display_wide, wide_measures
from geoprofile.plans.distribution import write_distribution
from geoprofile.sources.csv import read_csv, write_csv
from geoprofile.sources.snapshot import read_keyed


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "x string").select(expr.alias("y")).first().y


def test_first_match_of_alternations_and_lines(spark):
    assert one(spark, "a city b city", T.remove_first("x", " town| city")) == "a b city"
    assert one(spark, "dog cat dog", T.replace_first("x", "cat|dog", "$1\\")) == "$1\\ cat dog"
    assert one(spark, "one\ntwo town", T.remove_first("x", " town")) == "one\ntwo"
    assert one(spark, "Selected x", T.remove_first("x", "^Selected")) == " x"
    assert one(spark, "abab", T.remove_first("x", "(?<p>ab)\\k<p>")) == ""
    with pytest.raises(ValueError):
        T.remove_first("x", "(a)\\1")


def test_long_titles_percent_and_names(spark):
    long = "a" * (1 << 20) + "-b"
    assert one(spark, long, F.length(T.title_case("x"))) == len(long) and one(spark, long, F.length(T.clean_title("x", cap_all=False))) == len(long)
    df = spark.createDataFrame([(0.1226,), (None,)], "x double")
    assert [r.y for r in df.select(T.percent("x", 0.5).alias("y")).collect()] == ["12.5%", None]
    assert [r.y for r in df.select(T.percent("x", 1).alias("y")).collect()] == ["12%", None]
    assert one(spark, " \t a b\n", T.trim("x")) == "a b"
    assert T.clean_names(["A b", "a-b", "A.B", "c"]) == ["a_b", "a_b_2", "a_b_3", "c"]


def test_typed_csv_goes_by_header(spark, tmp_path):
    (tmp_path / "f.csv").write_text('name,level,value\nHartford,towns,1.5\nNA,"",NA\n')
    df = read_csv(spark, str(tmp_path / "f.csv"), "level string, name string, value double")
    assert [tuple(r) for r in df.collect()] == [("towns", "Hartford", 1.5), ("", None, None)]
    write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), "value double, name string, level string")
    assert {tuple(r) for r in back.collect()} == {(1.5, "Hartford", "towns"), (None, None, "")}


def test_keyed_files_with_different_columns(spark, tmp_path):
    spark.range(1).select(F.lit(1).alias("a")).write.parquet(str(tmp_path / "fetch_x.parquet"))
    spark.range(1).select(F.lit(2).alias("a"), F.lit(3).alias("z")).write.parquet(str(tmp_path / "fetch_y.parquet"))
    rows = read_keyed(spark, str(tmp_path / "fetch_*.parquet"), "fetch_(\\w+)\\.parquet").collect()
    assert {(r.src, r.a, r.z) for r in rows} == {("x", 1, None), ("y", 2, 3)}


def test_null_order_comes_last(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 5, 2), ("k", 7, 3), ("n", None, 4)], "k string, o int, v int")
    assert {r.k: r.v for r in first_per_key(df, ["k"], ["o"]).collect()} == {"k": 2, "n": 4}


@pytest.mark.parametrize("only", [False, True])
def test_preferred_source_without_a_value(spark, only):
    df = spark.createDataFrame([("a", "x", None), ("a", "y", 2.0), ("b", "x", 1.0), ("b", "y", 3.0), ("c", "x", None)], "k string, src string, estimate double")
    out = prefer_source(df, ["k"], "src", ["x", "y"], only_listed=only)
    assert {tuple(r) for r in out.collect()} == {("a", "y", 2.0), ("b", "x", 1.0)}


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_both_sources_win_at_every_size(spark, sf):
    from geoprofile.plans.catalog import q_prefer_source
    rows = q_prefer_source(spark, f"/root/testdata/sf{sf}").groupBy("src").count().collect()
    assert {r.src for r in rows} == {"orders", "lineitem"}


def test_margins_follow_the_null_policy(spark):
    df = spark.createDataFrame([(3.0, 1.0), (None, 0.0), (4.0, 0.0), (2.0, 0.0)], "moe double, est double")
    got = df.agg(moe_sum("moe").alias("a"), moe_sum("moe", "ignore").alias("b"), moe_sum("moe", "ignore", "est", True).alias("c")).first()
    assert (got.a, round(got.b, 6), got.c) == (None, round(29**0.5, 6), 5.0)


def test_a_pivot_cell_holds_one_row(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("b", "y", None)], "id string, g string, value double")
    with pytest.raises(Exception, match="a pivot cell holds 2 rows"):
        pivot_wide(df, ["id"], "g", ["x", "y"]).collect()
    with pytest.raises(Exception, match="a pivot cell holds 2 rows"):
        wide_measures(df, ["id"], "g", ["x"], ["value"]).collect()
    assert [tuple(r) for r in pivot_wide(df.filter("id = 'b'"), ["id"], "g", ["x", "y"]).collect()] == [("b", None, None)]


def test_reports_of_what_falls_out(spark):
    df = spark.createDataFrame([("t", "g", 1.0, 0.5), ("t", "h", 1.0, None)], "topic string, group string, estimate double, share double")
    hd = spark.createDataFrame([("estimate g", "G")], "indicator string, display string")
    heads, codes = Observation("heads"), Observation("codes")
    wide = to_display_wide(df, hd, ["topic"], display_values=["G"], report=heads)
    assert [tuple(r) for r in wide.collect()] == [("t", 1.0)] and wide.columns == ["topic", "G"]
    assert heads.get == {"rows": 3, "unmatched": 2, "example": "estimate h"}
    est = spark.createDataFrame([("v1",), ("v2",), ("v2",), (None,)], "variable string")
    labels = spark.createDataFrame([("v1", "Total")], "variable string, label string")
    assert label_variables(est, labels, ["variable"], report=codes).count() == 4
    assert codes.get == {"rows": 4, "unmatched": 3, "example": ""}
    with pytest.raises(ValueError):
        label_variables(est, labels, ["variable"], how="inner", report=codes)


def test_slices_by_level(spark):
    df = spark.createDataFrame([("towns", "", "Milford"), ("regions", "", "Milford"), ("neighborhoods", "a", "Milford")], "level string, city string, name string")
    by_name = slice_frame(spark, {"a": {"town": "Milford"}})
    got = slices(df, by_name, levels=["towns"]).collect()
    assert sorted((r.level, r.city) for r in got) == [("neighborhoods", "a"), ("towns", "")]
    assert len(slices(df, by_name).collect()) == 3


def test_parameter_tables_have_a_size(spark):
    df = param_frame(spark, [("a", 1, None), ("b", 2, 0.5)], "k string, n int, w double")
    assert [tuple(r) for r in df.collect()] == [("a", 1, None), ("b", 2, 0.5)]
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10_000
    assert param_frame(spark, [], "k string").collect() == []


def test_wide_profile(spark):
    long = spark.createDataFrame([("towns", "X County", "total", 1, 10.0, None), ("towns", "X County", "total", 2, 99.0, None), ("towns", "X County", "low", 1, 4.0, 0.4),
                                  ("regions", "X County", "low", 1, 5.0, 0.5)], "level string, name string, group string, topic_ord int, estimate double, share double")
    county = spark.createDataFrame([("X County", "Y County"), ("Lost", "Z")], "name string, county string")
    out = wide_profile(long, ["level", "name"], ["total", "low"], [(county, ["name"])], ["name", "county", ("range", "total_estimate", "low_share"), "level"],
                       ["Town", "County", "Total", "Total share", "Low", "Low share", "Level"], measures=("estimate", "share"),
                       percents={"share$": 0.1}, clean={"name": T.replace_first("name", "(?<= County)$", ", Here"), "county": T.remove_first("county", " County$")})
    assert sorted(map(tuple, out.collect()), key=str) == [("X County, Here", "Y", 10.0, None, 4.0, "40.0%", "towns"), ("X County, Here", "Y", None, None, 5.0, "50.0%", "regions")]
    report, lost = Observation("lookups"), long.withColumn("name", F.lit("Nowhere"))
    wide_profile(long.unionByName(lost.filter("level = 'towns'")), ["level", "name"], ["total", "low"], [(county, ["name"]), (county, ["name"])], ["name"], measures=("estimate",), report=report).collect()
    assert report.get == {"0_rows": 3, "0_unmatched": 1, "0_example": "Nowhere", "1_rows": 3, "1_unmatched": 1, "1_example": "Nowhere"}


def test_distribution_runs_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(s, "towns", "", None, n, 1.0) for s in "abcd" for n in ("x", "y")], "slice string, level string, city string, town string, name string, `Total, all` double")
    per = write_distribution(df.mapInArrow(count, df.schema), str(tmp_path / "out"), levels=["towns"])
    assert seen.value == 8 and set(per) == set("abcd") and "Total, all" in per["a"] and "town" not in per["a"]


def test_codes_of_ten_parts_and_more_keep_their_order(spark):
    from geoprofile.operators.codes import codes_by_name
    parts = [f"p{i}" for i in range(1, 13)]
    df = spark.createDataFrame([("050", "A town", *[str(i) for i in range(1, 13)]), ("050", "B", *["0"] * 11, "7")],
                               "level string, name string, " + ", ".join(f"{p} string" for p in parts))
    got = {r.name: r.code for r in codes_by_name(df, "level", parts).collect()}
    assert got == {"A": "0500000US123456789101112", "B": "0500000US7"}
