"""The published topics on hand-made landed tables: positions, overlaps, denominators, one pass."""

import pytest

from geoprofile.plans.profile import Topic, build_profile
from geoprofile.plans.specs import NEIGHBORHOOD_TOPICS, TOWN_TOPICS


def flat(tbl, n):
    return [(tbl, f"{tbl}_{i:03}", "Total" if i == 1 else f"Total!!part {i}") for i in range(1, n + 1)]


def sexes(n=23):
    rows, i = [("sex_by_age", "sa_001", "Total")], 2
    for sex in ("Male", "Female"):
        rows.append(("sex_by_age", f"sa_{i:03}", f"Total!!{sex}"))
        i += 1
        for age in range(1, n + 1):
            rows.append(("sex_by_age", f"sa_{i:03}", f"Total!!{sex}!!age {age}"))
            i += 1
    return rows


def nested(tbl, outer, inner, middle=None):
    rows, i = [(tbl, f"{tbl}_001", "Total")], 2
    for a in outer:
        for m in middle or [None]:
            for b in inner:
                rows.append((tbl, f"{tbl}_{i:03}", "!!".join(x for x in ("Total", a, m, b) if x)))
                i += 1
    return rows


LABELS = (flat("total_pop", 1) + sexes() + flat("race", 12) + flat("foreign_born", 6) + flat("tenure", 3)
          + nested("housing_cost", ["Owner", "Renter"], ["less than 20", "20 to 29", "30 or more"], ["income a", "income b"])
          + flat("vehicles", 6) + flat("education", 6) + flat("median_income", 1) + flat("poverty", 8)
          + nested("pov_age", [f"age {a}" for a in range(1, 11)], [f"ratio {r}" for r in range(1, 13)]))


@pytest.fixture(scope="module")
def tables(spark):
    """Every variable's estimate is its number in the table, its margin 3, or NULL for the first."""
    labels = spark.createDataFrame([(t, v, x) for t, v, x in LABELS], "tbl string, variable string, label string").repartition(3)
    est = [(t, lv, name, 2019, v, float(i + 1) * k, 3.0 if i else None)
           for lv, name, k in (("4_towns", "Here", 1.0), ("3_regions", "Area", 10.0))
           for t in sorted({x[0] for x in LABELS}) for i, v in enumerate(x[1] for x in LABELS if x[0] == t)]
    return spark.createDataFrame(est, "tbl string, level string, name string, year int, variable string, estimate double, moe double"), labels


def town(tables):
    est, labels = tables
    rows = build_profile(est, labels, TOWN_TOPICS, fill_moe=0.0).collect()
    return {(r.topic, r.name, r.group): r for r in rows}


def test_town_topics(tables):
    got = town(tables)
    assert {t for t, _, _ in got} == set(TOWN_TOPICS) and len(TOWN_TOPICS) == 12
    number = {}
    for t, v, x in LABELS:
        number.setdefault(t, {})[x] = len(number.get(t, {})) + 1

    def sexage(ages):
        return sum(number["sex_by_age"][f"Total!!{s}!!age {a}"] for s in ("Male", "Female") for a in ages)

    age = got["age", "Here", "ages65plus"]
    assert age.estimate == sexage(range(18, 24)) and age.share == pytest.approx(sexage(range(18, 24)) / sexage(range(1, 24)))
    assert age.moe == pytest.approx(3 * 12**0.5) and age.sharemoe > 0
    assert got["age", "Here", "total_pop"].share is None
    assert got["sex", "Here", "female"].estimate == number["sex_by_age"]["Total!!Female"]
    assert got["race", "Area", "other_race"].estimate == 10 * sum(range(5, 10)) and got["race", "Here", "hispanic"].share == 12.0
    assert got["foreign_born", "Here", "foreign_born"].estimate == 11
    burden = sum(v for k, v in number["housing_cost"].items() if k.endswith("30 or more"))
    assert got["housing_cost", "Here", "cost_burden"].estimate == burden
    assert got["poverty", "Here", "low_income"].estimate == sum(range(2, 8)) and got["poverty", "Here", "poverty"].estimate == 5
    assert ("median_household_income", "Here", "median_household_income") in got
    assert ("median_household_income", "Area", "median_household_income") not in got  # no medians of regions
    kids = [number["pov_age"][f"Total!!age {a}!!ratio {r}"] for a in range(1, 4) for r in range(1, 4)]
    known = [number["pov_age"][f"Total!!age {a}!!ratio {r}"] for a in range(1, 4) for r in range(1, 13)]
    poor = got["pov_age", "Here", "ages0_17_poverty"]
    assert poor.estimate == sum(kids) and poor.share == pytest.approx(sum(kids) / sum(known))
    assert got["total_pop", "Here", "total_pop"].moe == 0.0  # a missing margin counts as 0 on this path


def test_neighborhood_topics(tables):
    est, labels = tables
    rows = build_profile(est, labels, NEIGHBORHOOD_TOPICS, moe=False).collect()
    got = {(r.topic, r.name, r.group): r for r in rows}
    assert {t for t, _, _ in got} == set(NEIGHBORHOOD_TOPICS) and len(got) == len(rows)
    assert {g for t, n, g in got if t == "housing"} == {"total_households", "owner_occupied", "cost_burden"}
    assert got["housing", "Here", "total_households"].estimate == 1.0  # of the tenure table, not the cost table
    assert all(r.share is None or r.share == round(r.share, 2) for r in rows)
    assert {g for t, n, g in got if t == "income_seniors"} == {"ages65plus_poverty_status_determined", "ages65plus_poverty", "ages65plus_low_income"}
    assert got["immigration", "Here", "foreign_born"].estimate == 5 + 6


def test_one_rollup_and_one_window_however_many_topics(tables):
    est, labels = tables
    plan = build_profile(est, labels, TOWN_TOPICS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("estimate") and plan.split("Window [")[1:].__len__() - plan.count("row_number(") <= 1
    assert sum("sum(" in line and line.strip(" +-:").startswith("Aggregate") for line in plan.splitlines()) == 1


def test_null_margins_without_a_fill(tables):
    est, labels = tables
    rows = build_profile(est, labels, {"race": TOWN_TOPICS["race"], "x": Topic("race", {"all": range(1, 4)})}).collect()
    got = {(r.topic, r.name, r.group): r for r in rows}
    assert got["x", "Here", "all"].moe is None and got["race", "Here", "hispanic"].sharemoe is None
    rows = build_profile(est, labels, {"x": Topic("race", {"all": range(1, 4)})}, null_policy="ignore").collect()
    assert all(r.moe == pytest.approx(18**0.5) for r in rows)
