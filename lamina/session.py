"""Session settings that the operators rely on."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(name: str = "lamina", **settings: str) -> SparkSession:
    """A session with the library's settings; on a cluster, master and resources come from spark-submit."""
    spark = SparkSession.builder.appName(name).config(map=SETTINGS | settings).getOrCreate()
    reach(spark)
    return spark


def reach(spark: SparkSession) -> SparkSession:
    """Python workers find this library where the driver found it, as they do where the files are shared."""
    root, known = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [root, known.get("PYTHONPATH", "")]))
    return spark
