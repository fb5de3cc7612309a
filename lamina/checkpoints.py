"""Lineage cuts in a folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Rows, and bytes of their texts, up to which a side may be broadcast.
SMALL_ROWS, SMALL_BYTES = 200_000, 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the session's spark.checkpoint.dir. Only a session of one machine may do without one.

    Spark deletes checkpoints that nothing refers to any more if spark.cleaner.referenceTracking.cleanCheckpoints is set, as
    lamina.session sets it.
    """
    context = spark.sparkContext
    given, current = spark.conf.get("spark.checkpoint.dir", None), context.getCheckpointDir()
    if current is None:
        if not given and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        context.setCheckpointDir(given or tempfile.mkdtemp(prefix="lamina-checkpoint-"))
        current = context.getCheckpointDir()
    return given or current


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared checkpoint folder, without its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shed(spark: SparkSession) -> None:
    """Has Spark delete shuffle files and checkpoints of tables that nothing refers to; else they stay until the driver's heap happens to fill."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """df computed once and kept as compressed columns beside the checkpoints, without its lineage, until the block ends: for wide rows of which most steps read little."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}")
    try:
        df.write.option("compression", "zstd").parquet(folder.toString())
        yield spark.read.schema(df.schema).parquet(folder.toString())
    finally:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A cut table with a broadcast hint if it is counted to have few rows and bytes; a shuffle join serves it otherwise."""
    sizes = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    n, held = df.agg(F.count(F.lit(1)), sum((F.coalesce(F.sum(x), F.lit(0)) for x in sizes), F.lit(0))).first()
    return F.broadcast(df) if n <= SMALL_ROWS and held <= SMALL_BYTES else df
