import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from geoprofile.functions.categories import (arrange_key, as_category, collapse_levels, level_place, levels_of, pivot_levels, recode_levels, relabel_levels,
                                             relevel, with_levels)
from geoprofile.operators.geo import geo_levels, membership_closure
from geoprofile.operators.merge import prefer_source
from geoprofile.operators.ordinal import ordinals
from geoprofile.operators.reshape import pivot_found
from geoprofile.operators.rollup import group_rollup
from geoprofile.operators.shares import calc_shares
from geoprofile.sources.metadata import explode_json_variant


def test_origins_of_sums_and_shares(spark):
    df = spark.createDataFrame([("a", "x", "new", 1.0), ("a", "x", "old", 9.0), ("a", "y", "new", None), ("a", "y", "old", 2.0), ("a", "z", "other", 3.0),
                                ("b", "x", "new", 4.0), ("b", "y", "new", 1.0)], "name string, g string, src string, estimate double")
    for best in (prefer_source(df, ["name", "g"], "src", ["new", "old"], origin_col="origin"),
                 prefer_source(df.filter("src <> 'other'"), ["name", "g"], "src", ["new", "old"], only_listed=True, origin_col="origin")):
        got = {(r.name, r.g): (r.src, r.estimate, r.origin) for r in best.collect()}
        assert got.pop(("a", "z"), ("other", 3.0, 4)) == ("other", 3.0, 4)
        assert got == {("a", "x"): ("new", 1.0, 1), ("a", "y"): ("old", 2.0, 2), ("b", "x"): ("new", 4.0, 1), ("b", "y"): ("new", 1.0, 1)}
        roll = group_rollup(best, {"all": ["x", "y"], "x": "x", "y": "y"}, ["name"], "g", moe=None, origin="origin")
        sh = calc_shares(roll, ["name"], "g", denom="all", moe=None, origin="origin")
        assert {(r.name, r.g): (r.origin, r.mixed) for r in sh.collect()} == {
            ("a", "all"): (3, None), ("a", "x"): (1, True), ("a", "y"): (2, True), ("b", "all"): (1, None), ("b", "x"): (1, False), ("b", "y"): (1, False)}
        levels = spark.createDataFrame([("a", "s", "S"), ("b", "s", "S")], "leaf string, level string, name string")
        assert [r.origin for r in geo_levels(best.filter("g <> 'z'"), levels, carry=("g",), moe=None, origin="origin").orderBy("g").collect()] == [1, 3]


def test_ordinals_in_ranges(spark):
    r = random.Random(4)
    data = [(i, r.choice(["same"] * 5 + [f"n{k}" for k in range(300)] + [None])) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, name string").repartition(6)
    out = ordinals(df, [F.asc_nulls_last("name")])
    want = sorted(data, key=lambda x: (x[1] is None, x[1] or "", x[0]))
    assert [(x.id, x.name) for x in out.orderBy("position").collect()] == want
    assert sorted(x.position for x in out.collect()) == list(range(1, 2001))
    assert "SinglePartition" not in out._jdf.queryExecution().toString()
    assert ordinals(df.filter("id < 0"), ["name"]).collect() == []


def test_pivot_by_names_in_the_data(spark):
    df = spark.createDataFrame([(1, "b", 1.0), (1, "surprise!", 2.0), (2, "b", None), (2, None, 3.0), (3, "a.b", 4.0)], "id int, kind string, value double")
    out = pivot_found(df, ["id"], "kind", prefix="ev_")
    assert out.columns == ["id", "ev_NA", "ev_a.b", "ev_b", "ev_surprise!"]
    assert rows(out) == [(1, None, None, 1.0, 2.0), (2, 3.0, None, None, None), (3, None, 4.0, None, None)]
    assert pivot_found(df.limit(0), ["id"], "kind").columns == ["id"]
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        pivot_found(df.unionByName(df), ["id"], "kind")


def test_json_of_mixed_values(spark):
    text = ['{"n": 1, "f": 2.5, "s": "x", "b": true, "z": null, "l": [1, "a"], "o": {"k": {"d": 1}}}', "{}", "[1]", "no json", None, '"text"', '{"n": "other"}']
    df = spark.createDataFrame(list(enumerate(text)), "id int, props string")
    out = explode_json_variant(df, "props", keep=["id"])
    got = {(r.id, r.key): (r.kind, r.value) for r in out.collect()}
    assert {k: v for k, v in got.items() if k[0] == 6} == {(6, "n"): ("STRING", "other")}
    assert {k[0] for k in got} == {0, 6} and set(k[1] for k in got if k[0] == 0) == set(json.loads(text[0]))
    assert got[0, "n"] == ("BIGINT", "1") and got[0, "f"][0].startswith("DECIMAL") and got[0, "f"][1] == "2.5" and got[0, "s"] == ("STRING", "x")
    assert got[0, "b"] == ("BOOLEAN", "true") and got[0, "z"] == ("VOID", None)
    assert got[0, "l"][0] == "ARRAY" and json.loads(got[0, "l"][1]) == [1, "a"] and got[0, "o"][0] == "OBJECT" and json.loads(got[0, "o"][1]) == {"k": {"d": 1}}


def test_areas_of_areas(spark):
    chain = [(f"a{i}", f"a{i + 1}") for i in range(12)]
    df = spark.createDataFrame(chain + [("top", "a3"), ("top", "a3"), ("top", "x"), (None, "x"), ("y", None)], "area string, part string")
    got = {tuple(r) for r in membership_closure(df).collect()}
    want = {(f"a{i}", f"a{j}") for i in range(13) for j in range(i + 1, 13)} | {("top", f"a{j}") for j in range(3, 13)} | {("top", "x")}
    assert got == want
    with pytest.raises(ValueError, match="part of itself"):
        membership_closure(df.unionByName(spark.createDataFrame([("a12", "a2")], "area string, part string")))
    assert membership_closure(df.limit(0)).collect() == []


def test_categories_carry_their_levels(spark):
    df = spark.createDataFrame([(1, "low"), (2, "mid"), (3, "high"), (4, None), (5, "odd")], "id int, `the level` string")
    cat = with_levels(df, "the level", ["low", "mid", "high"])
    cat = relevel(cat, "the level", "high")
    assert levels_of(cat, "the level") == ["high", "low", "mid"]
    later = relabel_levels(collapse_levels(cat, "the level", {"rest": ["low", "mid"]}), "the level", str.upper)
    assert levels_of(later, "the level") == ["HIGH", "REST"]
    kept = later.filter("id <> 2").select("the level", "id").unionByName(later.filter("id = 2")).join(df.select("id"), "id").groupBy("the level").agg(F.max("id").alias("id"))
    assert levels_of(kept, "the level") == ["HIGH", "REST"]
    assert [r[0] for r in kept.orderBy(*arrange_key(kept, "the level")).collect()] == ["HIGH", "REST", "odd", None]
    assert {r[0]: r[1] for r in kept.select("the level", level_place(kept, "the level")).collect()} == {"HIGH": 1, "REST": 2, "odd": None, None: None}
    wide = pivot_levels(with_levels(df, "the level", ["mid", "none", "low"]).withColumn("value", F.lit(1.0)), ["id"], "the level")
    assert wide.columns == ["id", "mid", "none", "low"]
    assert levels_of(recode_levels(cat, "the level", {"mid": "high"}), "the level") == ["high", "low"]
    assert levels_of(as_category(df, "the level", "id"), "the level") == ["low", "mid", "high", "odd"]
    for wrong in (lambda: levels_of(df, "the level"), lambda: relevel(cat, "the level", "nope"), lambda: recode_levels(cat, "the level", {"nope": "x"}), lambda: with_levels(df, "the level", ["a", "a"])):
        with pytest.raises(ValueError):
            wrong()
