"""Add and remove lists that scope a feed's rows by a partner's number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.operators.checks import require_unique, require_values
from lamina.sources.labels import spellings

#: The column of each raw table that holds the partner's number, and its name.
SHIPPER_KEYS = {
    "gtran_firm": ("kholder", "kholdername"),
    "gtran_it": ("kholder", "kholdername"),
    "gawd": ("bidderduns", "biddername"),
    "gindex": ("shipperduns", "shipper"),
}

#: The columns of the table of verdicts and their types.
MAPPING_SCHEMA = "id long, workflow_id int, source string, kholdernumber string, kholdername string, action string, created_at timestamp, updated_at timestamp"


def checked(mapping: DataFrame) -> DataFrame:
    """The mapping, or an error if an action is neither add nor remove or a verdict occurs twice."""
    require_values(mapping, "action", ("add", "remove"), "shipper_mapping")
    return require_unique(mapping, ["workflow_id", "source", "kholdernumber"], "shipper_mapping")


def applying(mapping: DataFrame, feed: str) -> DataFrame:
    """Rows for this feed, under any spelling of its name, and those for every feed."""
    return mapping.filter(F.col("source").isNull() | F.lower(F.trim("source")).isin(*spellings(feed)))


def scoped(df: DataFrame, mapping: DataFrame | None, feed: str, number_col: str | None) -> DataFrame:
    """Rows whose number is on the add list, if there is one, and not on the remove list.

    Numbers are compared without surrounding spaces; remove beats add. A null number passes the remove list and fails the
    add list. Without a mapping or a number column nothing is filtered. The lists are configuration of unknown size: Spark
    broadcasts them if they are small and shuffles both sides otherwise.
    """
    if mapping is None or number_col is None:
        return df
    own, number = applying(mapping, feed), F.trim(F.col(number_col).cast("string"))
    listed = lambda action: own.filter(F.col("action") == action).select(F.trim("kholdernumber").alias("_listed")).distinct()
    if not own.filter("action = 'add'").isEmpty():
        df = df.join(listed("add"), number == F.col("_listed"), "left_semi")
    return df.join(listed("remove"), number == F.col("_listed"), "left_anti")


def scope_table(df: DataFrame, mapping: DataFrame | None, feed: str, table: str) -> DataFrame:
    """scoped() by the number column that the raw table has, if it has one."""
    return scoped(df, mapping, feed, SHIPPER_KEYS.get(table, (None,))[0])


def describe(mapping: DataFrame, feed: str | None = None) -> list[str]:
    """Lines on which partners scope which feed: a configuration report, in a fixed order."""
    rows = applying(mapping, feed) if feed else mapping
    rows = rows.orderBy(F.asc_nulls_first("source"), "action", "kholdername", "kholdernumber").collect()
    if not rows:
        return [f"{feed or 'all feeds'}: no shipper attached, every row passes"]
    lines = [f"{r.source or 'every feed'}: {r.action} {r.kholdernumber} {r.kholdername or ''}".rstrip() for r in rows]
    added = len({(r.kholdernumber or "").strip(" ") for r in rows if r.action == "add"})
    return [*lines, f"{added} on the allow list" if added else "no allow list: every row passes that is not removed"]
