"""Every registered query against its DuckDB oracle at sf0.001."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not available")


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    if hasattr(v, "item"):
        v = v.item()
    return float(f"{v:.9g}") if isinstance(v, float) else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    import __spark_entry__ as E
    from __spark_entry__ import QUERIES
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(__import__("__spark_entry__").QUERIES))
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    got = _rows(E.queries()[name](spark, SF).toPandas())
    want = _rows(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["name", "year", "group", "estimate", "moe", "share", "sharemoe"]
