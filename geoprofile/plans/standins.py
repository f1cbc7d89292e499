"""Survey-shaped inputs derived from the driver's TPC-H-like tables.

Role mapping (see FIXTURES.md §3):

* geography: region > nation (``town`` level) > customer market segment
  inside a nation (``neighborhood`` level, city = lower-case nation name);
* survey table ``orders``: label path ``Total!!{status}!!{priority}``, so
  status plays "sex" and priority plays "age" of a sex-by-age table;
* estimate = sum of order value (exact, decimal cents), margin = the
  half-width sqrt(sum((0.05 * value)^2)) of a 5% per-order error (squares summed exactly, as whole numbers).

The one heavy step is :func:`segment_leaves`: orders joined to customer
(shuffle join on the customer key; adaptive execution splits a hot
customer) and to the nation/region dimensions (tiny files, broadcast by the
planner from file statistics), then ONE grouped aggregation to the leaf
cells.  Its partial aggregation reduces the data on every mapper before
the shuffle; everything downstream runs on the aggregated cells, and the
exchange is reused when a plan reads the leaves more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._util import param_frame
from ..schema import input_schema
from ..session import cut_lineage, table_path

# Survey-table code and label root of the stand-in table.
TABLE = "orders"
MAX_TABLE = "max_price"
VAR_PREFIX = "ord"
LABEL_ROOT = "Total"
MOE_RATE = 0.05
STATE_NAME = "World"
STATUS_DOMAIN = ["F", "O", "P"]
PRIORITY_DOMAIN = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan with the declared schema, carrying only ``cols``."""
    ddl = input_schema(name, cols or None)
    reader = spark.read.schema(ddl) if ddl else spark.read
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region dimension: (n_nationkey, n_name, n_regionkey, r_name)."""
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region", "r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).drop("r_regionkey")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level facts with geography: one row per order."""
    o = read(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_orderpriority",
             "o_totalprice", "o_orderdate")
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    cg = c.join(geography(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))
    j = o.join(cg, o.o_custkey == cg.c_custkey)
    return j.select(
        "r_name", "n_name", "c_mktsegment",
        F.year("o_orderdate").alias("year"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        # squared cents as two whole numbers, whose sums are exact (an order beyond 30 million is an overflow error)
        *[half(_square()).alias(c) for c, half in (("hi", lambda x: F.shiftright(x, 32)), ("lo", lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))))],
    )


def _square():
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return cents * cents


def _leaves(rows: DataFrame, geo: list[str]) -> DataFrame:
    return (rows.groupBy(*geo, "year", "status", "priority")
            .agg(F.sum("price").alias("est"), F.max("price").alias("mx"),
                 (F.sum("hi").cast("decimal(18,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.sum("lo")).cast("decimal(28,0)").alias("sq")))


def segment_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf cells (region, nation, segment, year, status, priority):
    ``est`` exact decimal sum, ``sq`` exact sum of squared cents, ``mx`` largest price."""
    return _leaves(order_rows(spark, sf_dir), ["r_name", "n_name", "c_mktsegment"])


def segment_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`segment_leaves` written once to the shared checkpoint folder.

    For plans that read the leaf cells more than once: the orders are then
    scanned, joined and aggregated once, whatever the planner makes of
    the branches.  A lost executor costs nothing but a re-read of the cells.
    """
    return cut_lineage(segment_leaves(spark, sf_dir))


def nation_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf cells per nation, aggregated straight from the order rows."""
    return _leaves(order_rows(spark, sf_dir), ["r_name", "n_name"])


def variable_code(status=None, priority=None):
    parts = [F.lit(VAR_PREFIX)]
    if status is not None:
        parts.append(F.col(status) if isinstance(status, str) else status)
    if priority is not None:
        parts.append(F.col(priority) if isinstance(priority, str) else priority)
    return F.concat_ws("_", *parts)


def margin_squares(sq):
    """Squared margins in the estimates' unit, as a decimal, from squared cents."""
    return sq.cast("decimal(28,0)") * F.lit(f"{(MOE_RATE / 100) ** 2:.8f}").cast("decimal(9,8)")


def _depths(leaves: DataFrame, geo: list[str], maximum: bool = False, exact: bool = False) -> DataFrame:
    """All label depths (total, status, status x priority) of the table in
    ONE aggregation over the small leaf cells (grouping sets), not a union
    of three plans over the facts.

    ``maximum`` adds the largest price as a table of its own, from the same aggregation.
    ``exact``: estimates stay decimals, and squared margins (``moe_sq``, decimals) come along, for rollups that go on.
    """
    keys = [*geo, "year"]
    g = (leaves.groupingSets([[*keys, "status", "priority"], [*keys, "status"], keys], *keys, "status", "priority")
         .agg(F.sum("est").alias("est"), F.sum("sq").alias("sq"), F.max("mx").alias("mx"), F.grouping_id().alias("_gid")))
    # grouping_id bits: priority rolled up = 1, status and priority = 3
    status = F.when(F.col("_gid") < 3, F.col("status"))
    priority = F.when(F.col("_gid") == 0, F.col("priority"))
    own = F.struct(F.lit(TABLE).alias("tbl"), variable_code(status, priority).alias("variable"),
                   (F.col("est") if exact else F.col("est").cast("double")).alias("estimate"),
                   F.sqrt(margin_squares(F.col("sq")).cast("double")).alias("moe"),
                   *([margin_squares(F.col("sq")).alias("moe_sq")] if exact else []))
    if not maximum:
        return g.select(*geo, "year", own.alias("v")).select(*geo, "year", "v.*")
    top = F.struct(F.lit(MAX_TABLE).alias("tbl"), F.lit(MAX_TABLE).alias("variable"),
                   F.col("mx").cast("double").alias("estimate"), F.lit(None).cast("double").alias("moe"))
    return g.select(*geo, "year", F.inline(F.when(F.col("_gid") == 3, F.array(own, top)).otherwise(F.array(own))))


def town_estimates(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None, maximum: bool = False, exact: bool = False) -> DataFrame:
    """Long estimates at the nation ("town") level, every label depth:
    (tbl, level, name, year, variable, estimate, moe).

    ``cells``: segment cells at hand (:func:`segment_cells`), for plans that also need the neighborhoods.
    """
    d = _depths(nation_leaves(spark, sf_dir) if cells is None else cells, ["n_name"], maximum, exact)
    return d.select("tbl", F.lit("4_towns").alias("level"),
                    F.col("n_name").alias("name"), "year", "variable", "estimate", "moe", *(["moe_sq"] if exact else []))


def neighborhood_estimates(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    """Long estimates at the segment-within-nation ("neighborhood") level:
    city = lower-case nation, name = title-case segment."""
    d = _depths(segment_leaves(spark, sf_dir) if cells is None else cells, ["n_name", "c_mktsegment"])
    return d.select("tbl", F.lit("6_neighborhoods").alias("level"),
                    F.lower("n_name").alias("city"), F.initcap(F.lower("c_mktsegment")).alias("name"),
                    "year", "variable", "estimate", "moe")


def labels(spark: SparkSession) -> DataFrame:
    """Variable dictionary (variable, label) of the stand-in table.

    Like published survey metadata it is a small fixed dimension built from
    the table's category domains (TPC-H order status and priority), not
    re-derived from the facts; the ``report`` of ``label_variables`` counts
    codes of the facts that it lacks.
    """
    rows = [(f"{VAR_PREFIX}", LABEL_ROOT)]
    for st in STATUS_DOMAIN:
        rows.append((f"{VAR_PREFIX}_{st}", f"{LABEL_ROOT}!!{st}"))
        for pr in PRIORITY_DOMAIN:
            rows.append((f"{VAR_PREFIX}_{st}_{pr}", f"{LABEL_ROOT}!!{st}!!{pr}"))
    return param_frame(spark, rows, "variable string, label string")


def nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(town, county) analogue: nation -> region."""
    return geography(spark, sf_dir).select(F.col("n_name").alias("town"), F.col("r_name").alias("county"))
