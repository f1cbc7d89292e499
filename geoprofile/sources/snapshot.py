"""Table snapshots (S5/S6), keyed file discovery (S4), dynamic paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "_run"


def read_snapshot(spark: SparkSession, path: str, columns: Sequence[str] | None = None, merge: bool = False) -> DataFrame:
    """S5 ``readRDS`` -> parquet; selecting columns here prunes the scan.

    ``merge``: tables written at different times differ in columns, and a column that only some
    of them have is NULL in the others (all footers are read).  The run mark is left out unless asked for.
    """
    df = spark.read.option("mergeSchema", merge).parquet(path)
    return df.select(*columns) if columns else df.drop(RUN)


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ("tbl",),
                   mode: str = "overwrite", run: str | None = None) -> None:
    """S6 ``saveRDS`` -> parquet partitioned by table (and year), so later
    reads prune whole folders; the write itself is one job.

    ``overwrite`` replaces exactly the folders whose values ``df`` holds: another
    table's or year's folder stays as it is, and writing a table again replaces it whole.
    A table without rows in ``df`` keeps its old folder.  ``run`` marks every row with
    the run that wrote it (column :data:`RUN`), so a folder names its
    last writer (:func:`snapshot_runs`) and a half-replaced one would show two.
    Without partition columns the snapshot is replaced as a whole.
    """
    if run is not None:
        df = df.withColumn(RUN, F.lit(run))
    cols = [c for c in partition_by if c in df.columns]
    w = df.write.mode(mode)
    if cols:
        w = w.partitionBy(*cols).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def snapshot_runs(spark: SparkSession, path: str, partition_by: Sequence[str] = ("tbl",)) -> DataFrame:
    """Which run wrote each folder of a marked snapshot, with its rows: (partition columns, run, rows)."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    cols = [c for c in partition_by if c in df.columns]
    return df.groupBy(*cols, F.col(RUN).alias("run")).agg(F.count(F.lit(1)).alias("rows"))


def read_keyed(spark: SparkSession, pattern: str, key_regex: str, keep: Sequence[str] | None = None,
               key_col: str = "src", fmt: str = "parquet") -> DataFrame:
    """Read every file matching ``pattern`` and tag rows with a key
    extracted from the file path (``str_extract(path, key_regex)``), then
    keep the listed keys.  The file name comes from the ``_metadata``
    column, so the filter prunes nothing but costs no extra job.  The
    files' schemas are merged: a column that only some of them have is
    NULL in the rows of the others.
    """
    df = spark.read.format(fmt).option("mergeSchema", True).load(pattern)
    name = F.col("_metadata.file_path")
    df = df.withColumn(key_col, F.regexp_extract(name, key_regex, 1))
    if keep is not None:
        df = df.filter(F.col(key_col).isin(list(keep)))
    return df


def path_for(template: str, **params) -> str:
    """S13 ``str_glue("...{year}...")`` for job parameters."""
    return template.format(**params)
