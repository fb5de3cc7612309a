"""Payload files are parsed in batches of many small files, or parts of a large one."""

import json

import pyarrow as pa

from lamina.sources import payloads
from lamina.sources.feeds import Child, Feed

SCHEMA = pa.schema([("file", pa.string()), ("position", pa.int64()), ("raw_record_id", pa.string()), ("raw_payload", pa.string()), ("missing", pa.list_(pa.string())), ("error", pa.string())])
FEEDS = {"doc": Feed("doc", "records", "docs", "Id", ("Id", "LANG"), ("Batch",), (Child("parts", "parts", "No", ("No",), ("Id", "Batch")),))}


def batches_of(texts):
    files = pa.RecordBatch.from_pydict({"file": [str(i) for i in range(len(texts))], "value": texts})
    return list(payloads.in_batches(iter([files.slice(0, 7), files.slice(7)]), FEEDS, "", "source", SCHEMA))


def test_small_files_share_a_batch():
    found = batches_of([json.dumps({"feedType": "doc", "records": {"Id": i}}) for i in range(2500)])
    assert [b.num_rows for b in found] == [1000, 1000, 500]
    rows = [r for b in found for r in b.to_pylist()]
    assert [(r["file"], r["position"], r["raw_record_id"]) for r in rows] == [(str(i), 0, str(i)) for i in range(2500)]


def test_a_large_file_is_divided_by_rows_and_by_characters(monkeypatch):
    monkeypatch.setattr(payloads, "BATCH_ROWS", 3)
    monkeypatch.setattr(payloads, "BATCH_CHARS", 500)
    found = batches_of([json.dumps({"feedType": "doc", "records": [{"Id": i, "Lang": "x" * (600 if i == 4 else 1)} for i in range(7)]}), "{"])
    assert [b.num_rows for b in found] == [3, 2, 3]
    assert found[-1].to_pylist()[-1]["error"].startswith("not JSON")


def test_of_keys_in_several_cases_the_last_counts():
    record = {"id": 1, "ID": 2, "lang": " ", "Lang": "en", "batch": "own", "Parts": "[{\"no\": 7, \"BATCH\": \"part\"}, {}]"}
    rows = [r for b in batches_of([json.dumps({"feedType": "doc", "Batch": "shared", "records": [record]})]) for r in b.to_pylist()]
    assert [(r["raw_record_id"], r["missing"]) for r in rows] == [("2", []), ("7", []), ("", ["No"])]
    assert [json.loads(r["raw_payload"]) for r in rows[1:]] == [{"Id": 2, "Batch": "own", "no": 7, "BATCH": "part"}, {"Id": 2, "Batch": "own"}]
