import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from geoprofile.sources.csv import read_csv, read_csv_checked, read_csv_union, write_csv, write_csv_by
from geoprofile.sources.metadata import explode_json_map, read_geocodes, read_variables_json
from geoprofile.sources.snapshot import read_keyed, read_snapshot, snapshot_runs, write_snapshot


def scratch():
    return tempfile.mkdtemp(prefix="geoprofile-test-")


def test_csv_empty_string_vs_null_roundtrip(spark):
    d = scratch()
    src = os.path.join(d, "in.csv")
    with open(src, "w") as f:
        f.write('level,city,town,name\nstate,"",,Connecticut\nnbhd,hartford,Hartford,"Downtown, North"\n')
    df = read_csv(spark, src)
    r = {x.level: x for x in df.collect()}
    assert r["state"].city == "" and r["state"].town is None
    assert r["nbhd"].name == "Downtown, North"
    out = os.path.join(d, "out")
    write_csv(df.orderBy("level"), out, na="", single_file=True)
    text = open(glob.glob(os.path.join(out, "part-*.csv"))[0]).read()
    assert 'nbhd,hartford,Hartford,"Downtown, North"' in text
    assert 'state,"",,Connecticut' in text


def test_csv_union_different_headers(spark):
    d = scratch()
    a, b = os.path.join(d, "a.csv"), os.path.join(d, "b.csv")
    open(a, "w").write("topic,indicator,display\nage,estimate total_pop,Total population\n")
    open(b, "w").write("indicator,display\nestimate male,Male population\n")
    out = read_csv_union(spark, [a, b])
    assert rows(out, "topic", "indicator") == [("age", "estimate total_pop"), (None, "estimate male")]


def test_partitioned_outputs(spark):
    d = scratch()
    df = spark.createDataFrame([("a", 1.0, "x"), ("b", None, "y")], "slice string, v double, tbl string")
    write_csv_by(df, os.path.join(d, "csv"), "slice", {"a": ["v", "tbl"], "b": ["tbl"]})
    assert sorted(os.listdir(os.path.join(d, "csv")))[-2:] == ["slice=a", "slice=b"]
    write_snapshot(df, os.path.join(d, "pq"), partition_by=("tbl",))
    back = read_snapshot(spark, os.path.join(d, "pq"), ["slice", "v"])
    assert rows(back) == [("a", 1.0), ("b", None)]


def test_snapshot_replaces_its_own_tables(spark):
    d = os.path.join(scratch(), "pq")
    rows_of = lambda *r: spark.createDataFrame(list(r), "tbl string, year int, v double")
    write_snapshot(rows_of(("x", 2018, 1.0), ("x", 2019, 2.0)), d, ("tbl", "year"), run="r1")
    write_snapshot(rows_of(("y", 2019, 3.0), ("y", 2019, 4.0)), d, ("tbl", "year"), run="r2")
    assert rows(read_snapshot(spark, d, ["tbl", "year", "v"])) == [("x", 2018, 1.0), ("x", 2019, 2.0), ("y", 2019, 3.0), ("y", 2019, 4.0)]
    for _ in range(2):  # a table and year again: the same whether once or twice
        write_snapshot(rows_of(("x", 2019, 5.0)), d, ("tbl", "year"), run="r3")
        assert rows(read_snapshot(spark, d, ["tbl", "year", "v"])) == [("x", 2018, 1.0), ("x", 2019, 5.0), ("y", 2019, 3.0), ("y", 2019, 4.0)]
    assert rows(snapshot_runs(spark, d, ("tbl", "year"))) == [("x", 2018, "r1", 1), ("x", 2019, "r3", 1), ("y", 2019, "r2", 2)]
    assert "_run" not in read_snapshot(spark, d).columns
    write_snapshot(rows_of(("x", 2019, 6.0)).drop("v").withColumn("w", F.lit(7)), d, ("tbl", "year"))  # other columns, no mark
    assert rows(read_snapshot(spark, d, ["tbl", "year", "v", "w"], merge=True))[1] == ("x", 2019, None, 7)
    write_snapshot(rows_of(), d, ("tbl", "year"))  # nothing to replace
    assert read_snapshot(spark, d).count() == 4


def test_fan_out_is_one_job_with_own_columns(spark):
    d = scratch()
    value = ['plain', 'a,b', 'say "x"', '', None, ' padded ', 'é']
    data = [(s, i, v, None if s == "a" else i / 3) for s in ("a", "b") for i, v in enumerate(value)]
    df = spark.createDataFrame(data, "slice string, n int, `text, or not` string, share double").repartition(5)
    columns = {"a": ["n", "text, or not"], "b": ["share", "n", "text, or not"], "empty one": ["n"]}
    group = "fan-out"
    spark.sparkContext.setJobGroup(group, group)
    write_csv_by(df, d + "/many", "slice", columns, sort=[F.col("n") % 2, "n"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    few = len(jobs)
    for sl, cols in columns.items():
        write_csv(df.filter(F.col("slice") == sl).select(*[F.col(f"`{c}`") for c in cols]), f"{d}/one", na="", single_file=True, sort=[F.col("n") % 2, "n"])
        one = b"".join(open(f, "rb").read() for f in glob.glob(f"{d}/one/part-*.csv"))
        many = [open(f, "rb").read() for f in glob.glob(f"{d}/many/slice={sl}/part-*.txt")]
        assert len(many) == 1
        assert many[0] == (one or (",".join(cols) + "\n").encode())
    spark.sparkContext.setJobGroup("more", "more")
    write_csv_by(df.withColumn("slice", F.concat("slice", "n")), d + "/more", "slice", {f"{s}{i}": ["n"] for s in "ab" for i in range(7)})
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("more")) <= few + 1  # not one for each value
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(glob.glob(d + "/more/slice=*")) == 14


def test_list_of_files_with_other_header_orders(spark):
    d = scratch()
    a, b = os.path.join(d, "a.csv"), os.path.join(d, "b.csv")
    open(a, "w").write("name,level,n\nA,town,1\nB,NA,x1\n")
    open(b, "w").write("level,n,name\nstate,2.5,C\ncity,3,NA\n")
    assert rows(read_csv(spark, [a, b], "name string, level string")) == sorted([("A", "town"), ("B", None), ("C", "state"), (None, "city")], key=repr)
    assert rows(read_csv(spark, [a, b]), "name", "n")[0] == ("A", "1")
    good, rejects = read_csv_checked(spark, [a, b], "level string, n int, name string")
    assert rows(good) == sorted([("town", 1, "A"), (None, None, "B"), ("state", None, "C"), ("city", 3, None)], key=repr)
    assert sorted((os.path.basename(r.file), r.row, r.column, r.text) for r in rejects.collect()) == [
        ("a.csv", '{"n":"x1","name":"B"}', "n", "x1"), ("b.csv", '{"level":"state","n":"2.5","name":"C"}', "n", "2.5")]
    with pytest.raises(Exception):
        read_csv(spark, [a, b], "level string, n int, name string").collect()


def test_geocodes_by_header(spark):
    d = scratch()
    g = os.path.join(d, "geo.csv")
    open(g, "w").write('Vintage 2019\n"Estimates, Geography",,\nArea Name (including legal description),State Code (FIPS),Summary Level,Place Code (FIPS),'
                       'County Subdivision Code (FIPS),Consolidated City Code (FIPS),County Code (FIPS)\n"Hartford, town",09,061,00000,37070,00000,003\n')
    assert rows(read_geocodes(spark, g)) == [("061", "09", "003", "37070", "00000", "00000", "Hartford, town")]
    open(g, "w").write("no,header\n040,09\n")
    with pytest.raises(ValueError):
        read_geocodes(spark, g)


def test_keyed_files(spark):
    d = scratch()
    for k in ("nhoods", "nhv", "towns"):
        spark.createDataFrame([(k,)], "x string").write.parquet(os.path.join(d, f"acs_basic_2019_fetch_{k}.parquet"))
    out = read_keyed(spark, os.path.join(d, "*.parquet"), r"fetch_(\w+)\.parquet", keep=["nhoods", "nhv"])
    assert rows(out, "src", "x") == [("nhoods", "nhoods"), ("nhv", "nhv")]


def test_variables_json_and_geocodes(spark):
    d = scratch()
    p = os.path.join(d, "v.json")
    open(p, "w").write('{"variables": {"DP02_0001E": {"label": "Total", "concept": "SELECTED SOCIAL", "group": "DP02"},'
                       ' "for": {"label": "x", "concept": null, "group": "N/A"}}}')
    v = read_variables_json(spark, p)
    assert rows(v, "variable", "group") == [("DP02_0001E", "DP02"), ("for", "N/A")]
    g = os.path.join(d, "geo.csv")
    open(g, "w").write("Table title,,,,,,\nSummary Level,State,County,Cosub,Place,City,Area\n"
                       "040,09,000,00000,00000,00000,Connecticut\n")
    assert read_geocodes(spark, g).count() == 1


def test_json_map_column(spark):
    df = spark.createDataFrame([(1, '{"k": 69, "j": 1}'), (2, None)], "id long, props string")
    assert rows(explode_json_map(df, "props", "int", keep=["id"])) == [(1, "j", 1), (1, "k", 69)]


def test_landed_estimates_and_dynamic_path(spark, tmp_path):
    from geoprofile.sources.metadata import read_landed_estimates
    from geoprofile.sources.snapshot import path_for
    path = path_for(str(tmp_path / "landed_{year}.csv"), year=2019)
    with open(path, "w") as f:
        f.write("variable,estimate,moe,tbl,level,name,geoid,year\nB01_001,10,NA,total_pop,4_towns,Here,09,2019\n")
    (row,) = read_landed_estimates(spark, path).collect()
    assert (row.tbl, row.variable, row.estimate, row.moe, row.year, row.geoid) == ("total_pop", "B01_001", 10.0, None, 2019, "09")
