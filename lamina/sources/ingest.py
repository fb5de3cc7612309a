"""Payload files into raw tables: validated, hashed, appended once, and logged."""

from __future__ import annotations

import logging
import os
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.checkpoints import stored
from lamina.operators.scope import MAPPING_SCHEMA
from lamina.sources.database import Database, Layers
from lamina.sources.export import export_raw
from lamina.sources.feeds import BUSINESS, FEEDS, LOG_SCHEMA, META, Feed, columns_of, schema_of
from lamina.sources.payloads import read_payloads, require_valid
from lamina.sources.tables import Tables

log = logging.getLogger(__name__)
RAW = os.environ.get("BRONZE_SCHEMA", "bronze")
#: A number of each record's own, once a run has stored what it parsed.
ROW = "_row"


@dataclass
class Settings:
    """Names that rows and log entries carry, from the environment where not given."""

    source_system: str = field(default_factory=lambda: os.environ.get("SOURCE_SYSTEM", ""))
    api_prefix: str = field(default_factory=lambda: os.environ.get("SOURCE_API_PREFIX", "source"))
    pipeline_name: str = field(default_factory=lambda: os.environ.get("PIPELINE_NAME", "ingestion"))
    triggered_by: str = field(default_factory=lambda: os.environ.get("TRIGGERED_BY", "manual"))
    sink: str = field(default_factory=lambda: os.environ.get("DB_TYPE", "parquet"))
    layer: str = field(default_factory=lambda: RAW)


@dataclass
class Ingested:
    """What a run read and wrote."""

    run_id: str
    objects_read: int = 0
    rows_written: int = 0
    rows_rejected: int = 0
    status: str = "Succeeded"
    error: str = ""
    exports: list[str] = field(default_factory=list)


def raw_rows(parsed: DataFrame, table: str, run_id: str) -> DataFrame:
    """Rows for a raw table: its business columns, then where they come from; file and position keep the order."""
    now = F.current_timestamp()
    meta = {
        "raw_record_id": F.col("raw_record_id"), "hash_key": F.col("hash_key"), "pipeline_run_id": F.lit(run_id), "source_system": F.col("source_system"), "source_api": F.col("source_api"),
        "source_file_name": F.col("file"), "ingestion_timestamp": now, "updated_ts": now, "ingestion_status": F.when(F.size("missing") > 0, "INVALID").otherwise("LOADED"), "raw_payload": F.col("raw_payload"),
    }
    names = columns_of(table)
    # one loop over the names: as many single look-ups make a method that the JVM never compiles
    values = F.transform(F.array(*map(F.lit, names)), lambda name: F.element_at("business", name)).alias("_values")
    own = [c for c in ("file", "position", ROW) if c in parsed.columns]
    rows = parsed.filter(F.col("table") == table).select("*", values)
    return rows.select(*own, *[F.get("_values", F.lit(i)).alias(c) for i, c in enumerate(names)], *[meta[n].cast(t).alias(n) for n, t in META])


def sink_for(kind: str, tables: Tables | Database | Layers | None = None):
    """Where raw tables are, by the kind of sink: the given tables, or a database, the environment's if none is given.

    Unknown kinds, and those that only have a name so far, are errors.
    """
    if kind == "parquet" or kind in ("postgres", "jdbc") and isinstance(tables, (Database, Layers)):
        return tables
    if kind in ("postgres", "jdbc"):
        return Database.from_environment(tables.spark)
    if kind in ("azure_sql", "azuresql"):
        raise NotImplementedError("this sink has no writer yet")
    raise ValueError(f"unknown sink {kind!r}")


def ingest(spark: SparkSession, path: str, tables: Tables, settings: Settings | None = None, feeds: dict[str, Feed] | None = None, export_dir: str = "", dry_run: bool = False) -> Ingested:
    """Appends the records of payload files whose content the raw tables lack, and logs the run.

    Content is a record's business values: of equal ones in a run the first in the files' order is written. Records that lack
    a required value are written, too, as INVALID. Row numbers go on from the table's greatest. With dry_run nothing is
    written or logged. A bad payload raises PayloadError before anything is written.
    """
    settings, run, began = settings or Settings(), Ingested(str(uuid.uuid4())), datetime.now(UTC)
    tables = sink_for(settings.sink, tables)
    read = read_payloads(spark, path, feeds or FEEDS, settings.source_system, settings.api_prefix)
    with stored(read.withColumn(ROW, F.monotonically_increasing_id())) as kept:
        return _ingested(require_valid(kept), tables, settings, run, began, export_dir, dry_run)


def _ingested(parsed: DataFrame, tables: Tables, settings: Settings, run: Ingested, began: datetime, export_dir: str, dry_run: bool) -> Ingested:
    try:
        feed_of = count_rows(run, parsed)
        for table in [t for t in BUSINESS if t in feed_of]:
            rows = raw_rows(parsed, table, run.run_id)
            if dry_run:
                log.info("%s: %d rows, the first: %s", table, rows.count(), rows.limit(1).collect())
                continue
            if exported := export_raw(rows.drop("position", "file", ROW), table, feed_of[table], export_dir, run.run_id):
                run.exports.append(exported)
            run.rows_written += append_new(tables, settings.layer, table, rows)
    except Exception as e:
        run.status, run.error = "Failed", f"{type(e).__name__}: {e}"
        raise
    finally:
        if not dry_run:
            write_log(tables, settings, run, parsed, began)
    return run


def tallies(parsed: DataFrame) -> DataFrame:
    """(table, feed, objects_read, rows_rejected) of parsed records."""
    rejected = F.count(F.when(F.size("missing") > 0, 1))
    return parsed.groupBy("table").agg(F.first("feed").alias("feed"), F.count(F.lit(1)).alias("objects_read"), rejected.alias("rows_rejected"))


def count_rows(run: Ingested, parsed: DataFrame) -> dict[str, str]:
    """Counts a run's records; the feed of each table that has some."""
    tally = tallies(parsed).collect()
    run.objects_read, run.rows_rejected = sum(r.objects_read for r in tally), sum(r.rows_rejected for r in tally)
    return {r.table: r.feed for r in tally}


def append_new(tables: Tables | Database | Layers, layer: str, table: str, rows: DataFrame) -> int:
    """Appends rows (with file and position) of new content to a raw table; how many."""
    return tables.append_new(layer, table, rows, [F.col("file").asc(), F.col("position").asc()], drop=("file", "position"), row=ROW if ROW in rows.columns else None)


def write_log(tables: Tables, settings: Settings, run: Ingested, parsed: DataFrame, began: datetime, batch: tuple[str, int] | None = None) -> None:
    first = parsed.select("source_system", "source_api", "file").limit(1).collect()
    system, api, file = first[0] if first else (settings.source_system, None, None)
    ended = datetime.now(UTC)
    row = (
        settings.pipeline_name, "Bronze", run.run_id, "ingest", str(uuid.uuid4()), system, api, file, settings.triggered_by, began, ended, None, run.objects_read, run.rows_written, run.rows_rejected,
        run.status, "Warn" if run.rows_rejected else "Pass", run.error, ended,
    )
    entry = tables.spark.createDataFrame([row], LOG_SCHEMA).withColumn("activity_duration_secs", F.lit((ended - began).total_seconds()).cast("decimal(38,10)"))
    tables.append(settings.layer, "ingestion_log", entry, batch)


def provision(tables: Tables, layer: str | None = None) -> list[str]:
    """Writes the raw tables, the log and the scope mapping as empty tables where they are missing; their names."""
    layer, schemas = layer or Settings().layer, {t: schema_of(t) for t in BUSINESS} | {"ingestion_log": LOG_SCHEMA, "shipper_mapping": MAPPING_SCHEMA}
    made = [t for t in schemas if not tables.exists(layer, t)]
    for t in made:
        tables.append(layer, t, tables.spark.createDataFrame([], schemas[t]))
    return made
