"""Lineage cuts and size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.checkpoints import cut, shared_dir, shed

__all__ = ["BROADCAST_BYTES", "BROADCAST_ROWS", "cut", "shared_dir", "shed", "small_or_not"]

#: Rows, and bytes of their columns, up to which a side may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20


def _leaves(schema: T.StructType, above: str = "") -> list[tuple[str, T.DataType]]:
    """The plain columns of a schema, those in structs too."""
    out = []
    for f in schema:
        name = f"{above}`{f.name}`"
        out += _leaves(f.dataType, f"{name}.") if isinstance(f.dataType, T.StructType) else [(name, f.dataType)]
    return out


def small_or_not(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A cut table with a broadcast hint if it has at most so many rows and bytes; a plain shuffle join serves it otherwise.

    A column counts 8 bytes a row, or its length where that varies; arrays of numbers count 8 bytes an element, others and maps
    by their JSON.
    """
    leaves, varying = _leaves(df.schema), []
    for n, kind in leaves:
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            varying.append(8 * F.size(n))
        elif isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)):
            varying.append(F.octet_length(F.to_json(n) if isinstance(kind, (T.ArrayType, T.MapType)) else F.col(n)))
    n, more = df.agg(F.count(F.lit(1)), sum((F.coalesce(F.sum(x), F.lit(0)) for x in varying), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and 8 * len(leaves) * n + more <= size else df
