"""Elements of arrays nested in a JSON payload, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(text: Column) -> Column:
    """JSON text with sorted keys, so that equal content has equal text; what is not JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def elements(df: DataFrame, section: str, keys: Sequence[str], payload_col: str = "raw_payload", carry: Sequence[str] = (), lenient: bool = False) -> DataFrame:
    """A row for each element of the payload's array `section`: carried columns, each key's text, `element`, `hash_key`.

    Keys match exactly and become lower-case columns; a key that an element lacks is null. hash_key is the MD5 of the
    element alone, so equal elements of two parents are equal. A payload whose section is missing, empty, null or no array
    gives no row; with lenient, a text that holds an array counts as one.
    """
    raw = F.get_json_object(payload_col, f"$.{section}")
    parsed = F.from_json(raw, "array<string>")
    if not lenient:  # a string value that looks like an array is no array
        array = F.try_variant_get(F.try_parse_json(payload_col), f"$.{section}", "array<variant>")
        parsed = F.when(array.isNotNull(), parsed)
    rows = df.select(*carry, F.explode(parsed).alias("element"))
    struct = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    values = rows.withColumn("_v", F.from_json("element", struct))
    return values.select(*carry, *[F.col("_v").getField(k).alias(k.lower()) for k in keys], F.md5(canonical(F.col("element"))).alias("hash_key"), "element")
