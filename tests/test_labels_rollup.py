import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from geoprofile.operators.labels import label_variables, split_label
from geoprofile.operators.rollup import category_positions, group_rollup, two_stage_rollup
from geoprofile.operators.shares import calc_shares

EST = "name string, year int, variable string, estimate double, moe double"


def sex_by_age(spark):
    labels = spark.createDataFrame([
        (2019, "v01", "Total"), (2019, "v02", "Total!!Male"), (2019, "v03", "Total!!Male!!Under 5"),
        (2019, "v04", "Total!!Male!!5 to 9"), (2019, "v05", "Total!!Male!!10 plus"),
        (2019, "v06", "Total!!Female"), (2019, "v07", "Total!!Female!!Under 5"),
        (2019, "v08", "Total!!Female!!5 to 9"), (2019, "v09", "Total!!Female!!10 plus"),
        (2019, "v10", "Total!!Female!!10 plus!!extra part"),
    ], "year int, variable string, label string")
    data = []
    for name, base in (("A", 10.0), ("B", 1.0)):
        for i in range(1, 10):
            data.append((name, 2019, f"v{i:02d}", base * i, 1.0))
    est = spark.createDataFrame(data, EST)
    return est, labels


def test_split_label_fills_and_drops(spark):
    df = spark.createDataFrame([("Total",), ("Total!!M",), ("Total!!M!!5",), ("Total!!M!!5!!x",)], "label string")
    out = split_label(df, ["total", "sex", "age"]).collect()
    got = sorted(((r.total, r.sex, r.age) for r in out), key=repr)
    assert got == sorted([("Total", None, None), ("Total", "M", None), ("Total", "M", "5"), ("Total", "M", "5")],
                         key=repr)
    leaves = split_label(df, ["total", "sex", "age"], keep="leaf")
    assert leaves.count() == 2
    depth2 = split_label(df, ["total", "sex", "age"], keep=2)
    assert [r.sex for r in depth2.collect()] == ["M"]


def test_label_join_keeps_unlabelled(spark):
    est, labels = sex_by_age(spark)
    extra = spark.createDataFrame([("A", 2019, "zz", 5.0, 1.0)], EST)
    out = label_variables(est.unionByName(extra), labels)
    assert out.filter(F.col("label").isNull()).count() == 1


def test_positional_overlapping_groups(spark):
    est, labels = sex_by_age(spark)
    leaves = split_label(label_variables(est, labels), ["total", "sex", "age"], keep="leaf")
    pos = category_positions(split_label(labels, ["total", "sex", "age"], keep="leaf"), "age")
    assert rows(pos, "age", "position") == [("10 plus", 3), ("5 to 9", 2), ("Under 5", 1)]
    spec = {"total": range(1, 4), "young": [1, 2], "old": 3}
    out = group_rollup(leaves, spec, ["name", "year"], "age", positions=pos)
    got = {(r.name, r.age): r.estimate for r in out.collect()}
    # both sexes sum into one age position
    assert got[("A", "young")] == 10 * (3 + 4 + 7 + 8)
    assert got[("A", "total")] == 10 * (3 + 4 + 5 + 7 + 8 + 9)
    assert got[("B", "old")] == 5 + 9
    moe = {(r.name, r.age): r.moe for r in out.collect()}
    assert math.isclose(moe[("A", "total")], math.sqrt(6))


def test_label_spec_and_null_policy(spark):
    df = spark.createDataFrame([("A", "x", 1.0, 1.0), ("A", "y", None, 1.0), ("B", "x", 2.0, None)],
                               "name string, cat string, estimate double, moe double")
    out = group_rollup(df, {"all": ["x", "y"], "only_x": "x"}, ["name"], "cat")
    got = {(r.name, r.cat): r.estimate for r in out.collect()}
    assert got[("A", "all")] is None            # NULL propagates by default
    assert got[("A", "only_x")] == 1.0
    ign = group_rollup(df, {"all": ["x", "y"]}, ["name"], "cat", null_policy="ignore")
    assert {r.name: r.estimate for r in ign.collect()}["A"] == 1.0


def test_mixed_spec_rejected(spark):
    df = spark.createDataFrame([("A", "x", 1.0)], "name string, cat string, estimate double")
    with pytest.raises(ValueError):
        group_rollup(df, {"g": [1, "x"]}, ["name"], "cat", moe=None)


def test_rollup_is_order_independent(spark):
    est, labels = sex_by_age(spark)
    leaves = split_label(label_variables(est, labels), ["total", "sex", "age"], keep="leaf")
    pos = category_positions(split_label(labels, ["total", "sex", "age"], keep="leaf"), "age")
    spec = {"total": range(1, 4), "young": [1, 2]}
    a = group_rollup(leaves, spec, ["name", "year"], "age", positions=pos)
    b = group_rollup(leaves.repartition(7).orderBy(F.rand(3)), spec, ["name", "year"], "age", positions=pos)
    assert rows(a) == rows(b)


def test_two_stage_equals_sequential(spark):
    est, labels = sex_by_age(spark)
    leaves = split_label(label_variables(est, labels), ["total", "sex", "age"], keep="leaf")
    lab_leaves = split_label(labels, ["total", "sex", "age"], keep="leaf")
    pa, ps = category_positions(lab_leaves, "age"), category_positions(lab_leaves, "sex")
    s1, s2 = {"kids": [1, 2], "all": range(1, 4)}, {"both": [1, 2], "female": 2}
    one = two_stage_rollup(leaves, s1, "age", s2, "sex", ["name", "year"], pa, ps, moe=None)
    st1 = group_rollup(leaves, s1, ["name", "year", "sex"], "age", positions=pa, moe=None, order_col=None)
    st2 = group_rollup(st1, s2, ["name", "year", "age"], "sex", positions=ps, moe=None, order_col=None)
    st2 = st2.withColumn("group", F.concat_ws("_", "age", "sex"))
    assert rows(one, "name", "group", "estimate") == rows(st2, "name", "group", "estimate")


def test_shares_edge_cases(spark):
    df = spark.createDataFrame([
        ("A", "total", 200.0, 10.0), ("A", "x", 50.0, 5.0),
        ("B", "total", 0.0, 1.0), ("B", "x", 5.0, 1.0),      # zero denominator
        ("C", "x", 5.0, 1.0),                                 # missing denominator
    ], "name string, group string, estimate double, moe double")
    out = {(r.name, r.group): r for r in calc_shares(df, ["name"], denom="total", digits=2).collect()}
    assert out[("A", "x")].share == 0.25
    assert out[("A", "total")].share is None and out[("A", "total")].sharemoe is None
    assert out[("B", "x")].share is None
    assert out[("C", "x")].share is None
    p = 0.25
    assert out[("A", "x")].sharemoe == round(math.sqrt(25 - p * p * 100) / 200, 2)


def test_share_moe_negative_radicand_uses_ratio_form(spark):
    df = spark.createDataFrame([("A", "total", 100.0, 50.0), ("A", "x", 90.0, 1.0)],
                               "name string, group string, estimate double, moe double")
    r = [x for x in calc_shares(df, ["name"], denom="total").collect() if x.group == "x"][0]
    p = 0.9
    assert math.isclose(r.sharemoe, math.sqrt(1 + p * p * 2500) / 100)
