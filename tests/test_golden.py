"""Invariants of published neighborhood profiles on small files of the same form.

The files are made here, with the traps of the published ones: a city that
is "" (not missing) above neighborhood level, a town column that only one
file fills, a county reported as a region in two files, a heading with a comma,
a rate that lies half-way between two digits, and missing counts.
"""

import glob
import os

import pytest
from pyspark.sql import functions as F

from geoprofile.functions.columns import non_empty_columns_by
from geoprofile.operators.geo import level_ordinal
from geoprofile.operators.merge import union_all
from geoprofile.operators.reshape import unpivot_long
from geoprofile.operators.shares import calc_shares
from geoprofile.sources.csv import read_csv, write_csv

FILES = {
    "alpha": """level,city,name,All people,People under 18,People ages 18+,"Under 18, share"
state,"",Wideland,456000,171000,285000,0.38
regions,"",Shared County,912,342,570,0.38
towns,"",Alpha,456,171,285,0.38
neighborhoods,Alpha,East End,100,25,75,0.25
neighborhoods,Alpha,Nobody Park,0,0,0,
""",
    "beta": """level,city,town,name,All people,People under 18,People ages 18+,"Under 18, share"
state,"",,Wideland,456000,171000,285000,0.38
regions,"",,Shared County,912,342,570,0.38
towns,"",,Beta,300,100,200,0.33
neighborhoods,Beta,Beta,East End,30,20,10,0.67
neighborhoods,Beta,West Beta,Hill,,,,
""",
}
LEVELS = ["state", "regions", "towns", "neighborhoods"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("profiles")
    for name, text in FILES.items():
        (out / f"{name}.csv").write_text(text)
    return out


@pytest.fixture(scope="module")
def goldens(spark, folder):
    return {c: read_csv(spark, str(folder / f"{c}.csv")) for c in FILES}


def test_shape(goldens):
    assert {c: (df.count(), len(df.columns)) for c, df in goldens.items()} == {"alpha": (5, 7), "beta": (5, 8)}


def test_empty_text_is_not_missing(goldens):
    rows = {r.name: r for r in goldens["beta"].collect()}
    assert rows["Wideland"].city == "" and rows["Wideland"].town is None and rows["Hill"]["All people"] is None


def test_share_identity_with_calc_shares(goldens):
    """round(count / denominator, 2) gives the published rate; nothing where the denominator is 0 or missing."""
    for df in goldens.values():
        long = unpivot_long(df, ["city", "name"], ["All people", "People under 18"], names_to="group", values_to="estimate")
        sh = calc_shares(long, ["city", "name"], "group", denom="All people", moe=None, digits=2)
        got = {(r.city, r.name): r.share for r in sh.filter(F.col("group") == "People under 18").collect()}
        want = {(r.city, r.name): None if r["Under 18, share"] is None else float(r["Under 18, share"]) for r in df.collect()}
        assert got == want


def test_additivity(goldens):
    for df in goldens.values():
        assert df.filter(F.col("People under 18").cast("long") + F.col("`People ages 18+`").cast("long") != F.col("All people").cast("long")).count() == 0


def test_town_column_survives_only_where_non_empty(goldens):
    per = non_empty_columns_by(union_all(goldens, id_col="slice"), "slice")
    assert "town" in per["beta"] and "town" not in per["alpha"]
    assert all("city" in per[c] for c in FILES)  # "" counts as a value


def test_level_order_and_fan_out(goldens):
    for df in goldens.values():
        ords = [r.o for r in df.select(level_ordinal("level", LEVELS).alias("o")).collect()]
        assert ords == sorted(ords) and min(ords) == 1
        assert df.filter(F.col("name") == "Wideland").count() == 1
        assert df.filter(F.col("name") == "Shared County").count() == 1


def test_csv_roundtrip_byte_identical(goldens, tmp_path):
    for c, df in goldens.items():
        write_csv(df, str(tmp_path / c), na="", single_file=True)
        assert open(glob.glob(os.path.join(tmp_path, c, "part-*.csv"))[0]).read() == FILES[c]
