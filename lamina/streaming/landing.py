"""A folder of arriving payload files as a stream into the raw tables."""

from __future__ import annotations

import hashlib
import logging
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lamina.sources.feeds import BUSINESS, FEEDS, Feed
from lamina.sources.ingest import RAW, Ingested, Settings, append_new, count_rows, raw_rows, write_log
from lamina.sources.payloads import parse_files
from lamina.sources.tables import Tables

log = logging.getLogger(__name__)

#: The table of files that are no payloads, beside the raw tables.
REJECTED = "rejected_files"


def stream_payloads(
    spark: SparkSession, folder: str, tables: Tables, checkpoint: str, layer: str = RAW, feeds: dict[str, Feed] | None = None, files_per_batch: int = 1000, settings: Settings | None = None, **trigger
) -> StreamingQuery:
    """Appends records of new content from files as they arrive, in batches of at most files_per_batch files, each logged.

    Content decides what is new, so a batch that is run again after a failure adds nothing twice; its rejected files and its log entry are
    keyed by the stream (its checkpoint folder) and the batch's number. Files that are no payload of a known feed are listed with
    their errors in the table rejected_files, and the others of their batch go on.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder, wholetext=True)
    files = lines.selectExpr("_metadata.file_name AS file", "value")
    settings = settings or Settings(layer=layer)

    stream = f"stream-{hashlib.sha256(checkpoint.encode()).hexdigest()[:8]}"

    def add(batch: DataFrame, number: int) -> None:
        run, began = Ingested(f"{stream}-{number}"), datetime.now(UTC)
        parsed = parse_files(batch, feeds or FEEDS, settings.source_system, settings.api_prefix).persist()
        try:
            bad = parsed.filter("error IS NOT NULL").select("file", "error", F.lit(run.run_id).alias("pipeline_run_id"), F.current_timestamp().alias("rejected_ts"))
            if not bad.isEmpty():
                log.warning("batch %d: files set aside: %s", number, [r.file for r in bad.select("file").limit(10).collect()])
                tables.append(layer, REJECTED, bad, (stream, number))
                run.error = "files set aside"
            good = parsed.filter("error IS NULL").drop("error")
            there = count_rows(run, good)
            for table in [t for t in BUSINESS if t in there]:
                run.rows_written += append_new(tables, layer, table, raw_rows(good, table, run.run_id))
            write_log(tables, settings, run, good, began, (stream, number))
        finally:
            parsed.unpersist()

    return files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
