import corpus_pipeline as P
import pytest
from geoprofile.llm import packing, toxicity
from tokenizers import Tokenizer

from .conftest import SCHEMA, words
from .test_packing import check
from .test_pipeline_near import kept as near_kept
from .test_pipeline_passages import without_passages


def stages(spark, docs, sf_dir, tmp):
    out = []
    for name, stage in P.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
        out.append(docs)
    return out


def strip(texts, length=400):
    data = [t.encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] = seen.get(d[i:i + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append(bytes(b for b, g in zip(d, gone) if not g).decode("utf-8", "ignore"))
    return out


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_str(packing.tokenizer_spec())


def test_each_stage_against_brute_force(spark, small, tmp_path, plain):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = stages(spark, docs, small, tmp_path)
    rows = {r.doc_id: r for r in docs.collect()}
    scores = {r.doc_id: r.predicted for r in toxicity.classify(docs, spark.read.parquet(f"{small}/labels.parquet")).collect()}
    kept = {i: r.text for i, r in rows.items() if not scores[i]}
    assert sorted(r.doc_id for r in got[0].collect()) == sorted(kept)
    last = {t: i for i, t in sorted(kept.items())}
    kept = {i: t for t, i in last.items()}
    assert {r.doc_id: r.text for r in got[1].collect()} == kept
    stay = set(near_kept(list(kept.items())))
    kept = {i: t for i, t in kept.items() if i in stay}
    assert {r.doc_id: r.text for r in got[2].collect()} == kept
    kept = dict(zip(kept, strip(without_passages(list(kept.values())))))
    assert {r.doc_id: (r.text, r.n_chars) for r in got[3].collect()} == {i: (t, len(t)) for i, t in kept.items()}
    check(got[4].collect(), kept.items(), plain, packing.WINDOW)
    for df in got[:4]:
        assert df.columns == docs.columns and dict(df.dtypes) == dict(docs.dtypes)
        source = {r.doc_id: r.source for r in df.collect()}
        assert all(rows[i].source == s for i, s in source.items())
    assert len(kept) < len(rows)


def test_run(spark, small):
    df = P.run(spark, small)
    assert df.columns == [c.split()[0] for c in packing.PIECES.split(", ")] and df.count() > 100


def test_edge_rows_and_empty_tables(spark, edge_docs, no_docs, tmp_path, small):
    got = stages(spark, edge_docs, small, tmp_path / "a")
    assert all(df.columns == edge_docs.columns for df in got[:4])
    texts = [r.text or "" for r in got[1].collect()]
    assert len(texts) == len(set(texts))
    assert all(not df.count() for df in stages(spark, no_docs, small, tmp_path / "b"))
    clash = spark.createDataFrame([(1, words(1, 30), "x", "y", 3, 4, 5)], SCHEMA.split(", kept")[0] + ", __row__ int, tid int")
    assert stages(spark, clash, small, tmp_path / "c")[3].columns == clash.columns
