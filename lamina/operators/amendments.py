"""Amendment histories folded into one current row per contract."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.functions.values import column

#: Descriptions of a posting and the kinds that they mean.
KINDS = {
    "ALL_DATA": ("all data", "alldata", "all"),
    "CHANGES_ONLY": ("changes only", "changesonly", "changes"),
    "NEW": ("new",),
}
UNDESCRIBED, UNKNOWN = "NULL_DESC", "UNKNOWN"


def kind_of(description: Column | str) -> Column:
    """The kind of a posting by its description; null and blank are undescribed, all else is unknown."""
    text = F.lower(F.trim(column(description)))
    kind = F.when(text.isNull() | (text == ""), UNDESCRIBED)
    for name, words in KINDS.items():
        kind = kind.when(text.isin(*words), name)
    return kind.otherwise(UNKNOWN)


@dataclass(frozen=True)
class NullRule:
    """Undescribed postings count as new; in a group of more than `group` of them, those after the first `running` as all data."""

    group: int = 2
    running: int = 1


def place(values: Sequence[Column]) -> Column:
    """A value that orders rows by the values, ascending with nulls last."""
    return F.struct(*[c for i, v in enumerate(values) for c in (v.isNull().alias(f"n{i}"), v.alias(f"v{i}"))])


def _with_group(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df with the columns of its group, if there is one; groups has the keys as _k0, _k1 and so on. Null parts are equal."""
    own = [f"_k{i}" for i in range(len(keys))]
    return df.join(groups, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own)], "left").drop(*own)


def settle_undescribed(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rule: NullRule | None = NullRule(), kind_col: str = "kind") -> DataFrame:
    """df with kinds in which nothing is undescribed; without a rule all undescribed become new.

    order: what dates the postings, ascending with nulls last; it should tell them apart. How many undescribed postings a
    group has, and the last of its first `running` ones, are aggregates that each task begins, and are joined to the rows;
    so a group of very many postings is never gathered in one task.
    """
    kind = F.col(kind_col)
    settled = F.when(kind != UNDESCRIBED, kind)
    if not rule:
        return df.withColumn(kind_col, settled.otherwise("NEW"))
    own = [f"_k{i}" for i in range(len(keys))]
    undescribed = df.filter(kind == UNDESCRIBED).select(*[F.col(k).alias(o) for k, o in zip(keys, own)], place(order).alias("_place"))
    edge = F.min("_place") if rule.running == 1 else F.min(F.when(F.lit(False), F.col("_place")))
    groups = undescribed.groupBy(*own).agg(F.count(F.lit(1)).alias("_all"), edge.alias("_edge"))
    if rule.running > 1:
        first = undescribed.withColumn("_n", F.row_number().over(W.partitionBy(*own).orderBy("_place"))).filter(F.col("_n") <= rule.running)
        edges = first.select(*own, F.lit(None).cast("long").alias("_all"), F.col("_place").alias("_edge"))
        groups = groups.unionByName(edges).groupBy(*own).agg(F.max("_all").alias("_all"), F.max("_edge").alias("_edge"))
    crowded = groups.filter(F.col("_all") > rule.group)
    later = F.col("_all").isNotNull() & (F.col("_edge").isNull() | (place(order) > F.col("_edge")))
    return _with_group(df, crowded, keys).withColumn(kind_col, settled.when(later, "ALL_DATA").otherwise("NEW")).drop("_all", "_edge")


def fold(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    description: Column | str,
    posted: Column,
    tie_break: Sequence[Column],
    rule: NullRule | None = NullRule(),
    orphans: bool = True,
) -> DataFrame:
    """One row per key (null parts are equal): of each column the newest value that is not null, and how it came about.

    The newest new or all-data posting is the baseline; postings before it are dropped, and so are undated ones where there is
    a baseline. Groups without a baseline stay with all their postings, or not at all with orphans=False. An empty text is a
    value. Postings of one time are in the order of tie_break, the last of them newest, and undated ones are the oldest.

    Added columns: amend_kind (of the newest posting), amend_postings_applied (int), amend_baseline_ts. Rows are shuffled
    once, by the keys; what is known of a group joins them there, and each task begins the aggregates before that.
    """
    classed = df.withColumn("_posted", posted).withColumn("_kind", kind_of(description))
    settled = settle_undescribed(classed, keys, [F.col("_posted"), *tie_break], rule, "_kind")
    full = classed.filter(F.col("_kind").isin("NEW", "ALL_DATA", UNDESCRIBED))  # undescribed ones become one of the two
    bases = full.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max("_posted").alias("_base"))
    based = _with_group(settled, bases, keys)
    later = F.col("_posted") >= F.col("_base")
    kept = based.filter(F.col("_base").isNull() | later if orphans else later)
    newest = F.struct(F.col("_posted").alias("t"), *[t.alias(f"k{i}") for i, t in enumerate(tie_break)])
    values = [F.max_by(F.struct(F.col(c)), F.when(F.col(c).isNotNull(), newest)).getField(c).alias(c) for c in columns if c not in keys]
    return kept.groupBy(*keys).agg(
        *values,
        F.max_by("_kind", newest).alias("amend_kind"),
        F.count(F.lit(1)).cast("int").alias("amend_postings_applied"),
        F.max("_base").alias("amend_baseline_ts"),
    )


def fold_state(df: DataFrame, keys: Sequence[str], columns: Sequence[str], description: Column | str, posted: Column, tie_break: Sequence[Column], rule: NullRule | None = NullRule()) -> DataFrame:
    """What fold() has to know of each key's postings, in a form that merge_states() puts together: one row per key.

    _base: the newest new, all-data or undescribed posting. _last: order, kind and place of the newest. Each column: order and value of the newest
    that is not null. _undescribed and _first: how many postings are undescribed, and the places of the first rule.running of them. No posting that
    comes later can make an older one matter again but by these, so postings themselves need not be kept (counts aside, see fold_counts).
    """
    order = F.struct(posted.alias("t"), *[t.alias(f"k{i}") for i, t in enumerate(tie_break)])
    rows = df.select(*keys, *[c for c in columns if c not in keys], posted.alias("_posted"), kind_of(description).alias("_kind"), order.alias("_order"), place([posted, *tie_break]).alias("_place"))
    undescribed, running = F.col("_kind") == UNDESCRIBED, rule.running if rule else 0
    values = [F.max(F.when(F.col(c).isNotNull(), F.struct("_order", F.col(c).alias("value")))).alias(c) for c in columns if c not in keys]
    first = F.filter(F.array(F.min(F.when(undescribed, F.col("_place")))), lambda x: x.isNotNull()) if running == 1 else F.filter(F.array(F.min("_place")), lambda x: F.lit(False))
    state = rows.groupBy(*keys).agg(
        F.max(F.when(F.col("_kind").isin("NEW", "ALL_DATA", UNDESCRIBED), F.col("_posted"))).alias("_base"),
        F.max(F.struct("_order", "_kind", "_place")).alias("_last"), *values, F.count(F.when(undescribed, 1)).alias("_undescribed"), first.alias("_first"),
    )
    if running < 2:
        return state
    ranked = rows.filter(undescribed).withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy("_place"))).filter(F.col("_n") <= running)
    return merge_states(state.unionByName(ranked.select(*keys, F.lit(0).cast("long").alias("_undescribed"), F.array("_place").alias("_first")), allowMissingColumns=True), keys, rule)


def merge_states(states: DataFrame, keys: Sequence[str], rule: NullRule | None = NullRule()) -> DataFrame:
    """One state per key of several, whatever their postings' order: each part is a greatest value, a sum, or the first few of all."""
    most = [F.max(c).alias(c) for c in states.columns if c not in (*keys, "_undescribed", "_first")]
    first = F.slice(F.array_sort(F.flatten(F.collect_list("_first"))), 1, rule.running if rule else 0)
    return states.groupBy(*keys).agg(*most, F.sum("_undescribed").alias("_undescribed"), first.alias("_first")).select(*states.columns)


def fold_counts(df: DataFrame, keys: Sequence[str], posted: Column) -> DataFrame:
    """(keys, _posted, _n): how many postings a key has at each time. Sums of several are those of all their postings."""
    return df.select(*keys, posted.alias("_posted")).groupBy(*keys, "_posted").agg(F.count(F.lit(1)).alias("_n"))


def folded(states: DataFrame, counts: DataFrame, keys: Sequence[str], rule: NullRule | None = NullRule(), orphans: bool = True) -> DataFrame:
    """What fold() gives for all postings, of their states and counts."""
    columns = [c for c in states.columns if c not in keys and not c.startswith("_")]
    base = F.col("_base")
    own = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    applied = counts.join(states.select(*own, "_base"), [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]).filter(base.isNull() | (F.col("_posted") >= base))
    applied = applied.groupBy(*own).agg(F.sum("_n").cast("int").alias("_applied"))
    edge = F.array_max("_first")
    later = (F.col("_undescribed") > rule.group) & (edge.isNull() | (F.col("_last._place") > edge)) if rule else F.lit(False)
    kind = F.when(F.col("_last._kind") != UNDESCRIBED, F.col("_last._kind")).when(later, "ALL_DATA").otherwise("NEW")
    values = [F.when(base.isNull() | (F.col(f"`{c}`._order.t") >= base), F.col(f"`{c}`.value")).alias(c) for c in columns]
    kept = states if orphans else states.filter(base.isNotNull())
    return _with_group(kept, applied, keys).select(*keys, *values, kind.alias("amend_kind"), F.col("_applied").alias("amend_postings_applied"), base.alias("amend_baseline_ts"))
