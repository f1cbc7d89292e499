import glob
import os
import tempfile

import pytest

from geoprofile.plans.catalog import q_neighborhood_wide
from geoprofile.plans.distribution import write_distribution

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not available")


def test_per_slice_files_drop_empty_columns(spark):
    wide = q_neighborhood_wide(spark, SF)
    out = tempfile.mkdtemp(prefix="geoprofile-dist-")
    per = write_distribution(wide, out)
    assert sorted(per) == ["nation_0", "nation_1", "nation_5"]
    headers = {}
    for sl in per:
        f = glob.glob(os.path.join(out, f"slice={sl}", "part-*.txt"))[0]
        lines = open(f).read().splitlines()
        headers[sl] = lines[0].split(",")
        levels = [ln.split(",")[0] for ln in lines[1:]]
        order = ["state", "regions", "towns", "neighborhoods"]
        assert [order.index(x) for x in levels] == sorted(order.index(x) for x in levels)
        assert any(ln.startswith('state,"",') for ln in lines)          # '' city survives as ""
    assert "town" in headers["nation_1"]
    assert "town" not in headers["nation_0"] and "town" not in headers["nation_5"]
