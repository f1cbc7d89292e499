"""Topics of the town and the neighborhood profile.

A spec names groups by the positions of categories in the published table,
in the order in which variable codes are issued.
"""

from __future__ import annotations

from .profile import Topic, with_digits

# ---------------------------------------------------------------- fixed values
# Table names, label parts, group names and positions of categories.
_AGE = ("total", "sex", "age")
_COST = ("total", "tenure", "income", "group")
_RATIO = ("total", "age", "ratio")
_RACE = {"total_pop": 1, "hispanic": 12, "white": 3, "black": 4, "other_race": range(5, 10)}
_TENURE = {"total_households": 1, "owner_occupied": 2}
_BURDEN = {"total_households": range(1, 4), "cost_burden": 3}
_POVERTY = {"poverty_status_determined": 1, "poverty": range(2, 4), "low_income": range(2, 8)}
_POVERTY_AGES = {"ages0_17": range(1, 4), "ages65plus": range(9, 11)}
_POVERTY_RATIOS = {"poverty_status_determined": range(1, 13), "poverty": range(1, 4), "low_income": range(1, 9)}

_RACE_TOPIC = Topic("race", _RACE, denom="total_pop")
_TENURE_TOPIC = Topic("tenure", _TENURE, denom="total_households")
_BURDEN_TOPIC = Topic("housing_cost", _BURDEN, into=_COST, keep="leaf", group_col="group", denom="total_households")
_POVERTY_TOPIC = Topic("poverty", _POVERTY, denom="poverty_status_determined")
_POVERTY_BY_AGE = Topic("pov_age", _POVERTY_RATIOS, into=_RATIO, keep="leaf", group_col="ratio",
                        stage1=("age", _POVERTY_AGES), denom="poverty_status_determined")

TOWN_TOPICS = {
    "total_pop": Topic("total_pop", group_name="total_pop"),
    "age": Topic("sex_by_age", {"total_pop": range(1, 24), "ages0_17": range(1, 5), "ages65plus": range(18, 24)},
                 into=_AGE, keep="leaf", group_col="age", denom="total_pop"),
    "sex": Topic("sex_by_age", {"total_pop": range(1, 3), "male": 1, "female": 2},
                 into=_AGE, keep=2, group_col="sex", denom="total_pop"),
    "race": _RACE_TOPIC,
    "foreign_born": Topic("foreign_born", {"total_pop": 1, "foreign_born": range(5, 7)}, denom="total_pop"),
    "tenure": _TENURE_TOPIC,
    "housing_cost": _BURDEN_TOPIC,
    "vehicles": Topic("vehicles", {"total_households": 1, "has_vehicle": range(3, 7)}, denom="total_households"),
    "education": Topic("education", {"ages25plus": 1, "less_than_high_school": 2, "bachelors_plus": range(5, 7)}, denom="ages25plus"),
    "median_household_income": Topic("median_income", group_name="median_household_income", drop_levels="regions"),
    "poverty": _POVERTY_TOPIC,
    "pov_age": _POVERTY_BY_AGE,
}

NEIGHBORHOOD_TOPICS = with_digits({
    "age": Topic("sex_by_age", {"total_pop": range(1, 24), "ages0_17": range(1, 5), "ages18plus": range(5, 24), "ages65plus": range(18, 24)},
                 into=("total", "sex", "group"), keep="leaf", group_col="group", denom="total_pop"),
    "race": _RACE_TOPIC,
    "immigration": Topic("foreign_born", {"total_pop": range(1, 6), "foreign_born": range(4, 6)},
                         into=("total", "group"), keep="leaf", group_col="group", denom="total_pop"),
    "housing": [_TENURE_TOPIC, Topic("housing_cost", _BURDEN, into=_COST, keep="leaf", group_col="group", denom="total_households",
                                     drop_groups=("total_households",))],
    "income": _POVERTY_TOPIC,
    "income_children": Topic("pov_age", _POVERTY_RATIOS, into=_RATIO, keep="leaf", group_col="ratio",
                             stage1=("age", _POVERTY_AGES), denom="poverty_status_determined", keep_groups="^ages0_17"),
    "income_seniors": Topic("pov_age", _POVERTY_RATIOS, into=_RATIO, keep="leaf", group_col="ratio",
                            stage1=("age", _POVERTY_AGES), denom="poverty_status_determined", keep_groups="^ages65plus"),
}, 2)
# -----------------------------------------------------------------------------
