"""Payload files: JSON objects with header values and an array of records."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lamina.functions.jsontext import content_hash, records, text_of
from lamina.sources.feeds import BUSINESS, FEEDS, Feed

PARSED = (
    "file string, position long, feed string, source_system string, source_api string, table string, raw_record_id string, missing array<string>, "
    "business map<string,string>, hash_key string, raw_payload string, error string"
)
#: Records, of any number of files, and characters of their payloads that are given to Spark at a time.
BATCH_ROWS, BATCH_CHARS = 1000, 8 << 20
_payload_text = json.JSONEncoder(default=str, ensure_ascii=False, check_circular=False).encode


class PayloadError(ValueError):
    """A file is no payload of a known feed."""


def _lowered(record: dict) -> dict:
    """The record by its keys in lower case; of several that differ in case alone, the last."""
    return {k.lower(): v for k, v in record.items()}


def _blank(value) -> bool:
    return value is None or isinstance(value, str) and not value.strip()


@cache
def _known(table: str) -> frozenset[str]:
    return frozenset(k.lower() for k in BUSINESS.get(table, ()))


def _business(table: str, lowered: dict) -> dict[str, str | None]:
    known = _known(table) or lowered
    return {k: text_of(v) for k, v in lowered.items() if k in known}


def parse(text: str, feeds: dict[str, Feed], system: str, api_prefix: str) -> Iterator[dict]:
    """A row for each record and for each element of the record's children; one row with an error for a bad payload."""
    try:
        payload = json.loads(text)
    except ValueError as e:
        yield {"error": f"not JSON: {e}"}
        return
    if not isinstance(payload, dict):
        yield {"error": "not an object"}
        return
    name = str(payload.get("feedType") or payload.get("feed_type") or "").strip()
    if name not in feeds:
        yield {"error": f"unknown feed {name!r}" if name else "no feed type"}
        return
    feed, position = feeds[name], 0
    shared = {
        "feed": name,
        "source_system": payload.get("sourceSystem", system),
        "source_api": payload.get("sourceApi") or payload.get("source_api") or f"{api_prefix}/{name}",
    }
    header = {k: payload[k] for k in feed.header if k in payload}
    for record in records(payload.get(feed.records_key)):
        lowered = _lowered(record)
        if absent := {k: v for k, v in header.items() if k.lower() not in lowered}:
            record = record | absent
            lowered = _lowered(record)
        rows = [(feed.table, record, lowered, feed.id_field, feed.required)]
        for child in feed.children:
            taken = {k: lowered[k.lower()] for k in child.inherit if k.lower() in lowered}
            items = [taken | item for item in records(lowered.get(child.array_key.lower()))]
            rows += [(child.table, item, _lowered(item), child.id_field, child.required) for item in items]
        for table, own, lowered, id_field, required in rows:
            business, number = _business(table, lowered), lowered.get(id_field.lower())
            yield {
                **shared,
                "position": position,
                "table": table,
                "raw_record_id": "" if number is None else str(number),
                "missing": [k for k in required if _blank(lowered.get(k.lower()))],
                "business": list(business.items()),
                "hash_key": content_hash(business),
                "raw_payload": _payload_text(own),
            }
            position += 1


def read_payloads(spark: SparkSession, path: str, feeds: dict[str, Feed] | None = None, system: str = "", api_prefix: str = "source") -> DataFrame:
    """Rows of all payload files under path, by any file system that Spark reads; files are parsed in parallel.

    Values are texts as the payload has them. A required key that is absent or blank is listed in `missing`; the row stays.
    A file that is no payload of a known feed gives one row with an error. system and api_prefix stand in where a payload
    names no system or interface.
    """
    files = spark.read.text(path, wholetext=True).selectExpr("_metadata.file_name AS file", "value")
    return parse_files(files, feeds or FEEDS, system, api_prefix)


def _column(values: list, kind: pa.DataType) -> pa.Array:
    """The values as an Arrow column. Maps, given as lists of pairs, are put together of their keys and items, in half the time that Arrow takes for them."""
    if not pa.types.is_map(kind):
        return pa.array(values, kind)
    offsets, pairs = [], []
    for v in values:
        offsets.append(None if v is None else len(pairs))
        pairs += v or ()
    keys, items = pa.array([k for k, _ in pairs], kind.key_type), pa.array([x for _, x in pairs], kind.item_type)
    return pa.MapArray.from_arrays(pa.array([*offsets, len(pairs)], pa.int32()), keys, items, kind)


def record_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    """The rows as Arrow columns; what a row lacks is null."""
    return pa.RecordBatch.from_arrays([_column([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def in_batches(batches: Iterator[pa.RecordBatch], feeds: dict[str, Feed], system: str, api_prefix: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """parse() of (file, value) rows. A batch holds the rows of many small files, or a part of those of a large one."""
    rows, held = [], 0
    for batch in batches:
        for file, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for row in parse(text, feeds, system, api_prefix):
                row["file"] = file
                rows.append(row)
                held += len(row.get("raw_payload", ""))
                if len(rows) == BATCH_ROWS or held >= BATCH_CHARS:
                    yield record_batch(rows, schema)
                    rows, held = [], 0
    if rows:
        yield record_batch(rows, schema)


def parse_files(files: DataFrame, feeds: dict[str, Feed], system: str = "", api_prefix: str = "source") -> DataFrame:
    """read_payloads() of (file, value) rows."""
    schema = to_arrow_schema(StructType.fromDDL(PARSED))
    return files.mapInArrow(lambda batches: in_batches(batches, feeds, system, api_prefix, schema), PARSED)


def require_valid(parsed: DataFrame) -> DataFrame:
    """The rows, or an error that names the first bad file."""
    bad = parsed.filter("error IS NOT NULL").select("file", "error").orderBy("file").limit(1).collect()
    if bad:
        raise PayloadError(f"{bad[0][0]}: {bad[0][1]}")
    return parsed.drop("error")
