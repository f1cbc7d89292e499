"""Small helpers shared by the corpus operators.

Conventions that hold for every operator here, unless its docstring says otherwise:

* only the named id and text columns are read, so other columns may have any
  name, clash with an output name, or hold nulls;
* a null text counts as the empty text; a null id is an id like any other;
* rows are the unit: a repeated row is a document of its own.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


MUCH = 1 << 20
BATCH_SIZE, BATCH_DEFAULT, ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, null texts as empty ones."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    A scratch folder is used only where none is named and the master is local.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("name a shared folder in spark.checkpoint.dir")
        if spark.sparkContext.getCheckpointDir() is None:  # the setting itself is fixed once a session runs
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: smaller than a checkpoint, and read by column."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_place(docs: DataFrame, *wanted: str) -> tuple:
    """``docs`` with its columns named c0, c1, .. by place, and what the wanted ones are called now.

    So no name that a column may have clashes with one that an operator adds, or needs quoting.
    """
    names = [n.lower() for n in docs.columns]
    return docs.toDF(*(f"c{i}" for i in range(len(names)))), *(f"c{names.index(w.lower())}" for w in wanted)


class Numbers(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


READY: dict = {}  # what this worker keeps from task to task, by its key: one thing


def kept(key, make):
    """What ``make`` gives, kept for this worker's later tasks, until one reads texts (``sliced``) without it."""
    if key not in READY:
        READY.clear()
        READY[key] = make()
    return READY[key]


def byte_batches(batches: Iterator[pa.RecordBatch], most: int, keep=None) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as bytes) in runs of about ``most`` bytes, one text at least; no more than a run is held as Python objects."""
    for batch in sliced(batches, most, keep=keep):
        yield batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()


def give_back() -> None:
    """Return the memory that this worker has freed to the system: a worker lives on for later stages, and several share an executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library has no such function
        ctypes.CDLL(None).malloc_trim(0)


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow``, in batches of ARROW_BYTES (unless the session names another size), after which a task gives back what it has freed.

    A batch is held by the executor, in its worker and on the way between, for each task, and ten thousand texts are much.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SIZE, None) in (None, BATCH_DEFAULT):
        conf.set(BATCH_SIZE, ARROW_BYTES)

    def task(batches):
        yield from run(batches)
        give_back()  # nothing of the run is held any more

    return df.mapInArrow(task, schema)


def sliced(batches: Iterator[pa.RecordBatch], most: int, column: str = "text", keep=None) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of ``column``, one row at least; nothing is copied.

    What is freed by then is given back to the system after the last row, if it was much.  What the worker has ``kept`` for
    another operator, under another key than ``keep``, goes before the first row.
    """
    if READY and keep not in READY:
        READY.clear()
        give_back()
    total = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        total += int(ends[-1]) if len(ends) else 0
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end
    batch = None
    if total > MUCH:
        give_back()


def keep_matching(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is among the (distinct) ids in the only column of ``kept``."""
    k = kept.toDF("__kept_id__").distinct()
    return docs.join(k, docs[id_col].eqNullSafe(k["__kept_id__"]), "left_semi")
