import random
from collections import Counter

import pyarrow as pa
from geoprofile.llm import suffix_dedup as M

from .conftest import words
from .test_suffix_dedup import brute, got


def test_a_shard_gives_each_digest_once():
    r = random.Random(1)
    shared = r.randbytes(400)
    bodies = [r.randbytes(19) + bytes([i]) + shared + bytes([i]) + r.randbytes(19) for i in range(50)]
    n = len(bodies)
    out = M._shard(400)(pa.table({"anchor": pa.array([5] * n), "cid": pa.array([bytes([i]) for i in range(n)], pa.binary()),
                                  "body": pa.array(bodies, pa.binary()), "parts": pa.array([9] * n, pa.int32()), "shard": pa.array([0] * n)}))
    entries = Counter(x for c in ("lone", "known") for own in out.column(c).to_pylist() for x in own)
    assert set(entries.values()) == {1} and sum(map(len, out.column("known").to_pylist())) == 1
    assert out.column("runs").to_pylist() == [[20, 21]] * n


def test_one_passage_in_a_third_of_all_texts(spark):
    passage = words(50, 120)
    rows = [(i, f"{words(300 + i, 40)} {passage if i % 3 == 0 else ''} {words(800 + i, 40)}") for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for shard in (1, 16):
        assert got(M.repeats(df, shard=shard)) == brute(rows, M.LENGTH)
