import random
from collections import Counter

import numpy as np
import pyarrow as pa
from geoprofile.llm import suffix_array as S
from geoprofile.llm import suffix_dedup as M
from geoprofile.llm.common import byte_batches
from geoprofile.llm.exact_dedup import drop_copies
from geoprofile.llm.ngram_join import drop_near_copies
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .conftest import words
from .test_pipeline_passages import planted, without_passages
from .test_suffix_dedup import brute, got


def counted(rows, n=M.WORDS):
    """(id, runs, covered words) by counting all strings of n words."""
    data = [(t or "").split() for _, t in rows]
    count = Counter(tuple(w[i:i + n]) for w in data for i in range(len(w) - n + 1))
    out = Counter()
    for (doc_id, _), w in zip(rows, data):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - n + 1):
            if count[tuple(w[i:i + n])] > 1:
                gone[i:i + n] = True
        out[doc_id, len(M.as_runs(gone)) // 2, int(gone.sum())] += 1
    return out


def test_codes_as_symbols():
    r = random.Random(4)
    for _ in range(20):
        strings = [[r.randrange(1 << 40) if r.random() < .1 else r.randrange(2) for _ in range(r.randint(0, 60))] for _ in range(r.randint(1, 6))]
        for n in (1, 7, 9, 20):
            count = Counter(tuple(s[i:i + n]) for s in strings for i in range(len(s) - n + 1))
            want = [[count[tuple(s[i:i + n])] > 1 for i in range(max(0, len(s) - n + 1))] for s in strings]
            assert [f.tolist() for f in S.repeated_windows([np.array(s, "<u8").tobytes() for s in strings], n, M.CODE)] == want


def test_op1_tells_passages(spark, small, edge_docs, edge_rows, no_docs):
    documents = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    for rows, docs in ((planted(), None), ([r[:2] for r in edge_rows], edge_docs), (documents, None)):
        docs = docs or spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        for shard in (2, M.SHARD) if len(rows) < 100 else (M.SHARD,):
            found = M.repeats(docs, shard=shard, words=M.WORDS)
            assert got(found) == brute(rows, M.LENGTH)
            assert Counter((r.doc_id, r.n_passages, r.n_passage_words) for r in found.collect()) == counted(rows)
    assert M.repeats(no_docs, words=M.WORDS).collect() == []


def test_stages_take_any_column_name(spark):
    rows = [(i, words(i % 7, 90), i) for i in range(12)] + [(3, words(3, 90), 3), (3, words(3, 90), 3)]
    names = ["own_hash", "near", "known_id", "known_hash", "kept", "several", "gone", "row", "doc_id_", "tid", "text_hash", "c0", "C1",
             "__words__", "__gone__", "__text_hash__", "__near__", "__id__", "__row__", "a.b", "c`d"]
    docs = spark.createDataFrame([(*r, *[r[2]] * len(names)) for r in rows], StructType(
        [StructField("doc_id", LongType()), StructField("text", StringType()), *(StructField(n, LongType()) for n in ["n_chars", *names])]))
    for stage in (drop_copies, drop_near_copies, M.strip_passages, M.strip_repeats):
        assert stage(docs).columns == docs.columns
    assert Counter(tuple(r)[:2] for r in drop_copies(docs).collect()) == Counter((i, words(i % 7, 90)) for i in range(5, 12))
    assert {r[0] for r in drop_near_copies(docs).collect()} == set(range(7))
    assert Counter(r[1] for r in M.strip_passages(docs).collect()) == Counter(without_passages([r[1] for r in rows]))
    assert all(len(set(tuple(r)[2:])) == 1 for r in M.strip_repeats(docs).collect())


def test_many_rows_of_one_id_and_text(spark):
    docs = spark.range(20_000).selectExpr("cast(1 as bigint) doc_id", "if(id % 2 = 0, 'same', concat('text ', id)) text", "'x' lang")
    left = drop_copies(docs).collect()
    assert len(left) == 10_001 and sum(r.text == "same" for r in left) == 1


def test_batches_are_cut_by_bytes():
    batch = pa.record_batch({"doc_id": pa.array([1, 2, None, 4]), "text": ["a" * 10, "b" * 3, "", "c" * 30]})
    assert [ids for ids, _ in byte_batches([batch], 13)] == [[1, 2, None], [4]]
