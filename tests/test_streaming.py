import os
import tempfile

from conftest import rows
from geoprofile.operators.rollup import group_rollup
from geoprofile.sources.metadata import ESTIMATES_SCHEMA
from geoprofile.streaming.landed import profile_landed


def test_landed_extracts_profiled_incrementally(spark):
    base = tempfile.mkdtemp(prefix="geoprofile-stream-")
    landed, out, ckpt = (os.path.join(base, x) for x in ("landed", "out", "ckpt"))
    os.makedirs(landed)

    def land(name, data):
        spark.createDataFrame(data, ESTIMATES_SCHEMA).coalesce(1).write.parquet(os.path.join(base, "stage", name))
        src = os.path.join(base, "stage", name)
        part = [f for f in os.listdir(src) if f.endswith(".parquet")][0]
        os.rename(os.path.join(src, part), os.path.join(landed, f"{name}.parquet"))

    def transform(df):
        return group_rollup(df, {"total": ["a", "b"], "a_only": "a"}, ["tbl", "name", "year"], "variable",
                            out_col="group", order_col=None)

    land("race_2019", [("race", "towns", "X", None, 2019, "a", 1.0, 1.0), ("race", "towns", "X", None, 2019, "b", 2.0, 1.0)])
    profile_landed(spark, landed, out, ckpt, transform).awaitTermination()
    first = spark.read.parquet(out)
    assert rows(first, "group", "estimate") == [("a_only", 1.0), ("total", 3.0)]

    land("race_2020", [("race", "towns", "X", None, 2020, "a", 5.0, 1.0), ("race", "towns", "X", None, 2020, "b", 5.0, 1.0)])
    profile_landed(spark, landed, out, ckpt, transform).awaitTermination()
    both = spark.read.parquet(out)
    # the second run only processed the new extract
    assert rows(both, "year", "group", "estimate") == [(2019, "a_only", 1.0), (2019, "total", 3.0),
                                                       (2020, "a_only", 5.0), (2020, "total", 10.0)]
