import math
import random
from decimal import Decimal, getcontext

import pytest

from geoprofile.operators.geo import geo_levels
from geoprofile.operators.rollup import group_rollup, two_stage_rollup

getcontext().prec = 60
SCHEMA = "name string, sex string, age string, year int, variable string, estimate decimal(28,2), moe_sq decimal(38,8)"


def facts(seed=1, n=600):
    """Totals near 10^15 with cents: doubles would lose them, and lose them differently by order."""
    r = random.Random(seed)
    return [(f"t{r.randrange(7)}", r.choice("fmx"), r.choice("1234"), 2019, "v", Decimal(r.randrange(10**14, 10**15)) + Decimal(r.randrange(100)) / 100,
             Decimal(r.randrange(10**26)) / 10**8) for _ in range(n)]


def by_key(rows, key):
    out = {}
    for r in rows:
        for k in key(r):
            e, q = out.get(k, (Decimal(0), Decimal(0)))
            out[k] = e + r[5], q + r[6]
    return {k: (e, q, math.sqrt(q)) for k, (e, q) in out.items()}


def frames(spark, rows):
    for seed, parts in ((1, 1), (2, 7), (3, 13)):
        shuffled = list(rows)
        random.Random(seed).shuffle(shuffled)
        yield spark.createDataFrame(shuffled, SCHEMA).repartition(parts)


def test_geo_levels_under_any_partitioning(spark):
    rows = facts()
    regions = {"t0": ["R", "S"], "t1": ["R"], "t2": ["S"], "t3": ["S"]}
    levels = spark.createDataFrame([(f"t{i}", "town", f"t{i}") for i in range(7)] + [(t, "region", g) for t, gs in regions.items() for g in gs], "leaf string, level string, name string")
    want = by_key(rows, lambda r: [("town", r[0]), *[("region", g) for g in regions.get(r[0], ())]])
    for df in frames(spark, rows):
        got = {(r.level, r.name): (r.estimate, r.moe_sq, r.moe) for r in geo_levels(df, levels, squares="moe_sq").collect()}
        assert got == want
        # a rollup of the rollup agrees with one rollup, to the last digit
        again = geo_levels(geo_levels(df, levels.filter("level = 'town'"), squares="moe_sq"), levels.filter("level = 'region'"), squares="moe_sq")
        assert {("region", r.name): (r.estimate, r.moe_sq, r.moe) for r in again.collect()} == {k: v for k, v in want.items() if k[0] == "region"}


def test_rollups_under_any_partitioning(spark):
    rows = facts(2)
    sex, age = {"all": ["f", "m", "x"], "f": "f"}, {"young": ["1", "2"], "all": ["1", "2", "3", "4"]}
    groups = lambda spec, v: [g for g, members in spec.items() if v in members]
    two = by_key(rows, lambda r: [(r[0], f"{a}_{b}") for a in groups(sex, r[1]) for b in groups(age, r[2])])
    one = by_key(rows, lambda r: [(r[0], b) for b in groups(age, r[2])])
    for df in frames(spark, rows):
        got = two_stage_rollup(df, sex, "sex", age, "age", ["name"], squares="moe_sq")
        assert {(r.name, r.group): (r.estimate, r.moe_sq, r.moe) for r in got.collect()} == two
        got = group_rollup(df, age, ["name"], "age", squares="moe_sq")
        assert {(r.name, r.age): (r.estimate, r.moe_sq, r.moe) for r in got.collect()} == one


def test_null_squares_and_zero_rule(spark):
    df = spark.createDataFrame([("a", "1", Decimal(1), None), ("a", "1", Decimal(2), Decimal(4)), ("b", "1", Decimal(3), Decimal(9))],
                               "name string, age string, estimate decimal(10,2), moe_sq decimal(10,2)")
    got = {r.name: (r.moe_sq, r.moe) for r in group_rollup(df, {"g": "1"}, ["name"], "age", squares="moe_sq").collect()}
    assert got == {"a": (None, None), "b": (Decimal(9), 3.0)}
    assert {r.name: r.moe for r in group_rollup(df, {"g": "1"}, ["name"], "age", squares="moe_sq", null_policy="ignore").collect()} == {"a": 2.0, "b": 3.0}
    with pytest.raises(ValueError):
        group_rollup(df, {"g": "1"}, ["name"], "age", squares="moe_sq", zero_rule=True)
