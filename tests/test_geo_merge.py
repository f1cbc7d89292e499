from pyspark.sql import functions as F

from conftest import rows
from geoprofile.operators.geo import apportion, geo_levels, level_map, membership_frame, suppress_non_additive
from geoprofile.operators.merge import first_per_key, prefer_source, slice_frame, slices, union_all


def test_apportion_split_and_uncovered(spark):
    est = spark.createDataFrame([("t1", "v", 2019, 100.0, 10.0), ("t2", "v", 2019, 51.0, 4.0),
                                 ("t3", "v", 2019, 7.0, 1.0)],
                                "geoid string, variable string, year int, estimate double, moe double")
    cw = spark.createDataFrame([("hartford", "Downtown", "t1", 0.6), ("hartford", "South", "t1", 0.4),
                                ("hartford", "South", "t2", 1.0), ("bridgeport", "Downtown", "t2", 0.5)],
                               "city string, name string, geoid string, weight double")
    out = {(r.city, r.name): r for r in apportion(est, cw).collect()}
    assert out[("hartford", "Downtown")].estimate == 60.0
    assert out[("hartford", "South")].estimate == 91.0
    assert out[("bridgeport", "Downtown")].estimate == 26.0     # 25.5 rounded per variable
    assert abs(out[("hartford", "South")].moe - (16 + 16) ** 0.5) < 1e-9
    assert len(out) == 3                                         # t3 is in no neighborhood


def test_geo_levels_overlapping_regions(spark):
    est = spark.createDataFrame([("a", "v", 2019, 1.0, 1.0), ("b", "v", 2019, 2.0, 1.0), ("c", "v", 2019, 4.0, 1.0)],
                                "name string, variable string, year int, estimate double, moe double")
    towns = spark.createDataFrame([("a",), ("b",), ("c",)], "town string")
    lv = (level_map(towns, "town", "4_towns")
          .unionByName(level_map(towns, "town", "1_state", F.lit("All")))
          .unionByName(membership_frame(spark, {"R1": ["a", "b"], "R2": ["b", "c"]}, "3_regions")))
    out = {(r.level, r.name): r.estimate for r in geo_levels(est, lv).collect()}
    assert out[("3_regions", "R1")] == 3.0 and out[("3_regions", "R2")] == 6.0
    assert out[("1_state", "All")] == 7.0 and out[("4_towns", "b")] == 2.0


def test_suppress(spark):
    df = spark.createDataFrame([("median", "regions", 5.0, 1.0), ("median", "towns", 6.0, 1.0),
                                ("pop", "regions", 7.0, 1.0)], "tbl string, level string, estimate double, moe double")
    out = suppress_non_additive(df, (F.col("tbl") == "median") & F.col("level").rlike("regions"))
    assert rows(out, "tbl", "level", "estimate") == sorted(
        [("median", "regions", None), ("median", "towns", 6.0), ("pop", "regions", 7.0)], key=repr)


def test_prefer_source_fills_from_lower_priority(spark):
    df = spark.createDataFrame([
        ("nhv", "A", "v1", 1.0), ("nhoods", "A", "v1", 2.0),
        ("nhv", "A", "v2", None), ("nhoods", "A", "v2", 3.0),
        ("nhoods", "B", "v1", 4.0)], "src string, name string, variable string, estimate double")
    out = prefer_source(df, ["name", "variable"], "src", ["nhv", "nhoods"])
    assert rows(out, "name", "variable", "src", "estimate") == [
        ("A", "v1", "nhv", 1.0), ("A", "v2", "nhoods", 3.0), ("B", "v1", "nhoods", 4.0)]


def test_first_per_key_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 1), (2, "z", 5)], "k int, v string, o int")
    a = first_per_key(df, ["k"], ["o"])
    b = first_per_key(df.repartition(5).orderBy(F.rand(1)), ["k"], ["o"])
    assert rows(a) == rows(b) == [(1, "c", 1), (2, "z", 5)]


def test_slices_or_semantics(spark):
    df = spark.createDataFrame([
        ("state", "", "Connecticut"), ("towns", "", "Hartford"), ("towns", "", "Stamford"),
        ("nbhd", "hartford", "Downtown"), ("nbhd", "stamford", "Downtown"), ("nbhd", None, "Hartford"),
        ("nbhd", "hartford", "Hartford")], "level string, city string, name string")
    by_name = slice_frame(spark, {"hartford": {"town": ["Hartford"]}, "stamford": {"town": "Stamford"}},
                          always=["Connecticut"])
    out = slices(df, by_name, city_of_slice={"hartford": "hartford", "stamford": "stamford"})
    got = rows(out, "slice", "level", "city", "name")
    assert got.count(("hartford", "nbhd", "hartford", "Hartford")) == 1    # matched twice, kept once
    assert ("hartford", "nbhd", None, "Hartford") in got                  # NULL city, name match
    assert ("stamford", "state", "", "Connecticut") in got and ("hartford", "state", "", "Connecticut") in got
    assert ("stamford", "nbhd", "stamford", "Downtown") in got
    assert len(got) == 8


def test_union_with_id(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "q")], "x int, y string")
    out = union_all({"first": a, "second": b}, id_col="tbl", id_ord_col="tbl_ord")
    assert rows(out, "tbl", "tbl_ord", "x", "y") == [("first", 1, 1, None), ("second", 2, 2, "q")]
