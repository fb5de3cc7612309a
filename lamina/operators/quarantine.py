"""Rows whose texts do not cast set aside, so that one bad cell ends no job and loses no other row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.values import blank_to_null

#: Columns that tell where a row is from; those that a table has are listed with its bad cells.
ORIGIN = ("bronze_row_id", "hash_key", "source_file_name", "pipeline_run_id")


def bad_cells(casts: Mapping[str, str]) -> Column:
    """An array of the cells of a row that do not cast, from the columns' types: column, value and reason. Null and empty texts cast to null."""
    cells = [
        F.when(blank_to_null(c).isNotNull() & blank_to_null(c).try_cast(kind).isNull(), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.lit(f"no {kind}").alias("reason")))
        for c, kind in casts.items()
    ]
    return F.filter(F.array(*cells), lambda x: x.isNotNull())


def set_aside(df: DataFrame, casts: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """The rows of which all cells cast, and a row for each bad cell of the others, with their columns of ORIGIN."""
    marked = df.withColumn("_bad", bad_cells({c: k for c, k in casts.items() if c in df.columns}))
    errors = marked.filter(F.size("_bad") > 0).select(*[c for c in ORIGIN if c in df.columns], F.explode("_bad").alias("_cell"))
    return marked.filter(F.size("_bad") == 0).drop("_bad"), errors.select(*[c for c in ORIGIN if c in df.columns], "_cell.column", "_cell.value", "_cell.reason")
