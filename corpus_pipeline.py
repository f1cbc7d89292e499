"""Corpus pipeline: from raw documents to packed training sequences.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
All stages but the last return the columns of ``documents``.

1. toxicity          documents that the classifier rejects go,
2. exact_dedup       of equal texts the row with the largest id stays,
3. ngram_join        of near copies (NEAR_WORDS-word shingles, similarity NEAR_PERCENT/100; looser than op10's query) the document with the smallest id stays,
4. suffix_dedup      passages of over 50 words that stand elsewhere too are cut out of the texts, however few
                     bytes they have (windows of 51 words); then, of what is left, strings of 400 bytes that
                     stand elsewhere too, for texts with long words or without spaces;
                     n_chars follows, and a document stays even if nothing of it is left,
5. packing           token windows; one row per piece of a document.

Nulls, empty texts, repeated rows and empty tables are treated as the
operators' docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoprofile.llm.common import shared_folder, table, written
from geoprofile.llm.exact_dedup import drop_copies
from geoprofile.llm.ngram_join import drop_near_copies
from geoprofile.llm.packing import pack, tokenizer_spec
from geoprofile.llm.suffix_dedup import strip_passages, strip_repeats
from geoprofile.llm.toxicity import drop_toxic

NEAR_WORDS, NEAR_PERCENT = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, shingle=NEAR_WORDS, percent=NEAR_PERCENT)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = strip_repeats(written(strip_passages(docs)))
    if "n_chars" in left.columns:
        left = left.withColumn("n_chars", F.length("text").cast(left.schema["n_chars"].dataType))
    return left


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_spec())


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("ngram_join", ngram_join),
          ("suffix_dedup", suffix_dedup), ("packing", packing)]

#: A trained classifier and the packing's dynamic program are no SQL; tests/llm/test_pipeline.py holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
