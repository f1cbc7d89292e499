"""Topic-driven profile builder in one pass over the estimates.

A profile is a list of topics.  A topic takes one source table, picks label
depths, rolls categories into (overlapping) groups, in one or two stages,
and gives shares of a denominator, or passes a measure through.

All of that is a property of the label dictionary: :func:`topic_mapping` turns
the topics into ONE small table (tbl, variable) -> (topic, part, group,
denominator).  The estimates are joined with it once, summed by one
aggregation with the topic as a key, and shared by one window, however
many topics there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.moe import moe_prop, moe_sum
from ..functions.text import unite
from ..operators._util import sum_propagate
from ..operators.labels import split_label
from ..operators.rollup import category_positions, spec_frame


@dataclass(frozen=True)
class Topic:
    """One block of a profile, or one part of a stacked block.

    * ``spec`` None: pass-through; every row becomes group ``group_name``.
    * ``into``/``keep``: label split and depth filter (``None`` keeps the
      whole label as the category).
    * ``group_col``: the label part the spec refers to.
    * ``stage1``: (label part, spec) of a first stage; groups are then named
      ``{stage 1}_{group}`` and each first group has its own denominator.
    * ``denom``: denominator group for shares (None: no shares); ``digits`` rounds them.
    * ``drop_groups``: groups removed after shares (a denominator that is
      only a helper).  ``keep_groups``: regex of the groups that are reported.
      ``drop_levels``: regex of levels not reported.
    """
    tbl: str
    spec: Mapping | None = None
    into: Sequence[str | None] | None = None
    keep: str | int | None = None
    group_col: str = "label"
    stage1: tuple[str, Mapping] | None = None
    denom: str | None = None
    digits: int | None = None
    group_name: str | None = None
    drop_groups: Sequence[str] = ()
    keep_groups: str | None = None
    drop_levels: str | None = None
    variables: Sequence[str] | None = None


def _part_mapping(labels: DataFrame, t: Topic, year: Sequence[str]) -> DataFrame:
    """(year.., variable, group, grp_ord, denom) of one part."""
    own = labels.filter(F.col("tbl") == t.tbl)
    if t.variables is not None:
        own = own.filter(F.col("variable").isin(list(t.variables)))
    if t.spec is None:
        return own.select(*year, "variable", F.lit(t.group_name or t.tbl).alias("group"), F.lit(1).alias("grp_ord"),
                          F.lit(None).cast("string").alias("denom"))
    if t.into is not None:
        own = split_label(own, t.into, keep=t.keep)

    def members(spec, col, name):
        frame, positional = spec_frame(labels.sparkSession, spec)
        if positional:
            pos = category_positions(own, col, "variable", by=["tbl", *year]).withColumnRenamed("position", "member")
            frame = pos.join(frame, "member").drop("member")
        else:
            frame = frame.withColumnRenamed("member", col)
        return frame.withColumnsRenamed({"grp": name, "grp_ord": f"{name}_ord"})

    keys = ["tbl", *year] if any(isinstance(m, int) for v in t.spec.values() for m in ([v] if isinstance(v, (int, str)) else v)) else []
    out = own.join(members(t.spec, t.group_col, "_g"), [*keys, t.group_col])
    group, order, denom = F.col("_g"), F.col("_g_ord"), F.lit(t.denom).cast("string")
    if t.stage1:
        col, spec = t.stage1
        out = out.join(members(spec, col, "_s"), [*keys, col])
        group, order, denom = unite(["_s", "_g"]), F.col("_s_ord") * max(1000, len(t.spec) + 1) + F.col("_g_ord"), unite(["_s", F.lit(t.denom)]) if t.denom else denom
    out = out.select(*year, "variable", group.alias("group"), order.cast("int").alias("grp_ord"), denom.alias("denom"))
    return out


def topic_mapping(labels: DataFrame, topics: Mapping[str, Topic | Sequence[Topic]], year: Sequence[str] = ()) -> DataFrame:
    """(tbl, year.., variable, topic, topic_ord, part, group, grp_ord, denom), from the label dictionary alone.

    ``labels`` has tbl, variable and label (and the ``year`` columns, when codes are issued by year).
    """
    parts = []
    for order, (name, t) in enumerate(topics.items(), start=1):
        for k, part in enumerate([t] if isinstance(t, Topic) else t):
            parts.append(_part_mapping(labels, part, list(year)).select(
                F.lit(part.tbl).alias("tbl"), *year, "variable", F.lit(name).alias("topic"), F.lit(order).alias("topic_ord"),
                F.lit(k).alias("part"), "group", "grp_ord", "denom"))
    return reduce(DataFrame.unionByName, parts)


def build_profile(estimates: DataFrame, labels: DataFrame, topics: Mapping[str, Topic | Sequence[Topic]],
                  keys: Sequence[str] = ("level", "name", "year"), label_on: Sequence[str] = ("variable",),
                  moe: bool = True, fill_moe: float | None = None, null_policy: str = "propagate", zero_rule: bool = False) -> DataFrame:
    """Every topic in one long profile:
    (topic, topic_ord, keys..., group, grp_ord, estimate, [moe,] share, [sharemoe]).

    ``fill_moe`` replaces NULL margins first; ``label_on`` lists the
    columns by which codes are found, besides the table.
    """
    keys = list(keys)
    df = estimates.na.fill({"moe": fill_moe}) if moe and fill_moe is not None else estimates
    year = [c for c in label_on if c != "variable"]
    if "tbl" not in labels.columns:
        used = sorted({t.tbl for v in topics.values() for t in ([v] if isinstance(v, Topic) else v)})
        labels = labels.withColumn("tbl", F.explode(F.array(*[F.lit(x) for x in used])))  # no join without a key
    named = df.join(topic_mapping(labels, topics, year), ["tbl", *label_on])
    parts = [(name, k, t) for name, v in topics.items() for k, t in enumerate([v] if isinstance(v, Topic) else v)]
    for name, k, t in parts:
        if t.drop_levels:
            named = named.filter(~((F.col("topic") == name) & (F.col("part") == k) & F.col("level").rlike(t.drop_levels)))
    aggs = [sum_propagate("estimate", null_policy).alias("estimate")]
    if moe:
        aggs.append(moe_sum("moe", null_policy, "estimate", zero_rule).alias("moe"))
    ids = ["topic", "topic_ord", "part", *keys]
    rolled = named.groupBy(*ids, "group", "grp_ord", "denom").agg(*aggs)
    w = Window.partitionBy(*ids, "denom")
    is_denom = F.col("group") == F.col("denom")
    den = F.max(F.when(is_denom, F.col("estimate"))).over(w)
    cols = {"share": F.try_divide(F.col("estimate"), den)}
    if moe:
        cols["sharemoe"] = moe_prop("estimate", "moe", den, F.max(F.when(is_denom, F.col("moe"))).over(w))
    shared = rolled.withColumns({c: F.when(~is_denom, e) for c, e in cols.items()})
    for digits in sorted({t.digits for _, _, t in parts if t.digits is not None}):
        here = reduce(lambda a, b: a | b, [(F.col("topic") == n) & (F.col("part") == k) for n, k, t in parts if t.digits == digits])
        shared = shared.withColumns({c: F.when(here, F.round(c, digits)).otherwise(F.col(c)) for c in cols})
    for name, k, t in parts:
        here = (F.col("topic") == name) & (F.col("part") == k)
        if t.drop_groups:
            shared = shared.filter(~(here & F.col("group").isin(list(t.drop_groups))))
        if t.keep_groups:
            shared = shared.filter(~here | F.col("group").rlike(t.keep_groups))
    return shared.select("topic", "topic_ord", *keys, "group", "grp_ord", "estimate", *(["moe"] if moe else []),
                         "share", *(["sharemoe"] if moe else []))


def with_digits(topics: Mapping[str, Topic | Sequence[Topic]], digits: int | None) -> dict:
    """The same topics with shares rounded to ``digits``."""
    return {k: replace(t, digits=digits) if isinstance(t, Topic) else [replace(x, digits=digits) for x in t] for k, t in topics.items()}
