"""CSV sources and sinks (S1-S3, S7-S9) with R's ``""`` vs NA semantics.

On read, an unquoted empty field is NA and a quoted ``""`` is the empty
string.  Spark turns both into NULL unless ``nullValue`` is something that
never occurs, so readers set a sentinel and map only unquoted empties to
NULL (``emptyValue`` keeps the quoted ones as '').
On write, Spark's defaults already match ``write_csv(na = "")``: NULL is
written as nothing and '' as ``""``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators._util import param_frame

NULL_SENTINEL = "\u0000__NA__\u0000"
_FILE = "__file__"


def _text_reader(spark: SparkSession, keep_empty_strings: bool):
    r = (spark.read.option("header", True).option("multiLine", False).option("escape", '"')
         .option("inferSchema", False))
    if keep_empty_strings:
        # quoted "" stays '', unquoted empty stays NULL
        r = r.option("nullValue", NULL_SENTINEL).option("emptyValue", "")
    return r


def _text_columns(spark: SparkSession, path: str | Sequence[str], keep_empty_strings: bool, names: Sequence[str] | None) -> DataFrame:
    """All columns as text, found by each file's OWN header; with ``names`` those columns alone.

    The reader takes one header for all files it is given, so files of a list are read one by one and unioned by name.
    """
    paths = [path] if isinstance(path, str) else list(path)
    frames = []
    for one in paths:
        df = _text_reader(spark, keep_empty_strings).csv(one)
        frames.append(df if names is None else df.select(*[_quoted(c) for c in names]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=names is None), frames)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _fields(schema: StructType | str | None) -> list | None:
    return None if schema is None else list(schema if isinstance(schema, StructType) else StructType.fromDDL(schema))


def _known(name: str, na: Sequence[str]):
    c = F.col(_quoted(name))
    return F.when(~c.isin(list(na)), c) if na else c


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
             keep_empty_strings: bool = True, na: Sequence[str] = ("NA",)) -> DataFrame:
    """S1 typed read (explicit schema) / S2 all-string read (no schema).

    Columns are found by the file's HEADER, whatever their order: the file is read
    as text columns, which are then selected and cast by name (a reader schema
    would be applied by position).  Each file of a list goes by its own header.
    Unquoted empty fields and the strings in ``na``
    are NULL, as ``read_csv`` has it; a schema column that a file lacks is an
    error, and so is a cell that is no value of its type (:func:`read_csv_checked` goes on).
    Never infers types: inference is a full extra pass over the data.
    """
    fields = _fields(schema)
    df = _text_columns(spark, path, keep_empty_strings, None if fields is None else [f.name for f in fields])
    wanted = [(c, None) for c in df.columns] if fields is None else [(f.name, f.dataType) for f in fields]
    return df.select(*[(c if kind is None else c.cast(kind)).alias(name) for name, kind in wanted for c in [_known(name, na)]])


REJECTS = "file string, row string, column string, text string"


def read_csv_checked(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, keep_empty_strings: bool = True,
                     na: Sequence[str] = ("NA",)) -> tuple[DataFrame, DataFrame]:
    """S1/S3 that survive malformed cells: (rows, rejects).

    Rows are as of :func:`read_csv`, with NULL for a cell that is no value of its column's type.  Rejects lists these cells: (file, row,
    column, text), where ``row`` is the row's cells in schema order, as JSON.  Both frames have the same scan and parse and
    are parts of one expression (``try_cast``), so what one leaves out the other has.
    """
    fields = _fields(schema)
    paths = [path] if isinstance(path, str) else list(path)
    frames = []
    for one in paths:
        text = _text_reader(spark, keep_empty_strings).csv(one)
        frames.append(text.select(*[_known(f.name, na).alias(f.name) for f in fields], F.col("_metadata.file_path").alias(_FILE)))
    held = reduce(lambda a, b: a.unionByName(b), frames)
    typed = {f.name: F.col(_quoted(f.name)).try_cast(f.dataType) for f in fields}
    bad = [F.when(F.col(_quoted(f.name)).isNotNull() & typed[f.name].isNull(),
                  F.struct(F.lit(f.name).alias("column"), F.col(_quoted(f.name)).alias("text"))) for f in fields]
    rejects = (held.select(F.col(_FILE).alias("file"), F.to_json(F.struct(*[F.col(_quoted(f.name)) for f in fields])).alias("row"),
                           F.explode(F.array_compact(F.array(*bad))).alias("cell"))
               .select("file", "row", "cell.column", "cell.text"))
    return held.select(*[typed[f.name].alias(f.name) for f in fields]), rejects


def read_csv_union(spark: SparkSession, paths: Sequence[str],
                   schemas: Sequence[StructType | str | None] | None = None) -> DataFrame:
    """S3 ``map_dfr(read_csv)`` over files with DIFFERENT headers: each file
    is read on its own and the frames are unioned by name (missing columns
    are NULL)."""
    schemas = list(schemas or [None] * len(paths))
    frames = [read_csv(spark, p, s) for p, s in zip(paths, schemas)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_csv(df: DataFrame, path: str, na: str = "NA", single_file: bool = False,
              mode: str = "overwrite", sort: Sequence = ()) -> None:
    """S7 (``na='NA'``) / S8 (``na=''``) CSV sink with header.

    ``single_file`` gathers the finished rows in one part file: only for small,
    final outputs (a distribution file); large outputs keep their partitions.
    With ``sort``, the rows are made by as many tasks as before and one task
    sorts and writes them; without it, a sorted frame's order is kept.
    """
    out = df
    if single_file:
        out = df.repartition(1).sortWithinPartitions(*sort) if sort else df.coalesce(1)
    w = out.write.mode(mode).option("header", True)
    if na != "":
        w = w.option("nullValue", na)
    w.csv(path)


def write_csv_by(df: DataFrame, path: str, by: str, columns: Mapping[str, Sequence[str]], na: str = "", mode: str = "overwrite",
                 sort: Sequence = ()) -> None:
    """S9 fan-out sink: one folder ``{by}={value}`` per value of ``by``, each with its OWN columns and header, in ONE job.

    ``columns`` maps each value to the columns that it keeps, in order; other values' rows are not written.  A value's columns
    differ from another's, which a CSV writer's one schema cannot express, so lines are made by ``to_csv``
    cell by cell, with the writer's quoting, and written as text: the header is the first line of a value's file,
    which one task sorts (``sort``) and writes; all other work is done by as many tasks as before.  A value without rows is a header alone.
    """
    names = list(dict.fromkeys(c for cols in columns.values() for c in cols))
    place = {c: i for i, c in enumerate(names)}
    plan = param_frame(df.sparkSession, [(str(v), [place[c] for c in cols]) for v, cols in columns.items()], "__by__ string, __keep__ array<int>")
    cells = F.array(*[F.when(F.col(_quoted(c)).isNull(), F.lit(na)).otherwise(F.to_csv(F.struct(F.col(_quoted(c))))) for c in names])
    heads = F.array(*[F.to_csv(F.struct(F.lit(c))) for c in names])

    def line(of):
        return F.array_join(F.transform("__keep__", lambda i: F.get(of, i)), ",")

    keys = [f"__sort{i}__" for i in range(len(sort))]
    rows = (df.withColumns(dict(zip(keys, _nulls_last(sort)))).withColumn("__cells__", cells)
            .join(plan, F.col(by).cast("string") == F.col("__by__"))
            .select(F.col("__by__").alias(by), F.lit(1).alias("__row__"), *keys, line(F.col("__cells__")).alias("value")))
    header = plan.select(F.col("__by__").alias(by), F.lit(0).alias("__row__"), *[F.lit(None).alias(k) for k in keys], line(heads).alias("value"))
    (rows.unionByName(header).repartition(by).sortWithinPartitions(by, "__row__", *keys).select(by, "value")
     .write.mode(mode).partitionBy(by).text(path))


def _nulls_last(sort: Sequence) -> list:
    """Sort columns as comparable values: NULL after all others."""
    out = []
    for c in sort:
        c = F.col(_quoted(c)) if isinstance(c, str) else c
        out.append(F.struct(c.isNull(), c))
    return out
