"""New content is found and numbered without the payloads, which are stored once as compressed columns and go after a run."""

import json
import os

from lamina.operators import ids
from lamina.sources import tables as module
from lamina.sources.ingest import RAW, Settings, ingest
from lamina.sources.tables import Tables


def test_steps_of_an_ingestion_keep_no_payloads(spark, tmp_path, monkeypatch):
    steps, cut = [], ids.cut

    def seen(df):
        steps.append(set(df.columns))
        return cut(df)

    monkeypatch.setattr(ids, "cut", seen)
    monkeypatch.setattr(module, "cut", seen)
    for n in range(3):
        records = [{"Id": str(i % 7), "FirmId": str(i % 7)} for i in range(5 * n, 5 * n + 5)]
        (tmp_path / f"{n}.json").write_text(json.dumps({"feedType": "gTRAN_FIRM", "contracts": records}))
    tables, stored = Tables(spark, str(tmp_path / "tables")), spark.sparkContext.getCheckpointDir()
    assert [ingest(spark, str(tmp_path / "*.json"), tables, Settings(sink="parquet")).rows_written for _ in range(2)] == [7, 0]
    assert steps and not any("raw_payload" in s or "business" in s for s in steps)
    rows = tables.read(RAW, "gtran_firm").orderBy("bronze_row_id").collect()
    assert [(r.bronze_row_id, r.id, r.source_file_name) for r in rows] == [(i + 1, str(i), f"{i // 5}.json") for i in range(7)]
    assert "_row" not in rows[0].asDict() and rows[0].raw_payload
    stored = (stored or spark.sparkContext.getCheckpointDir()).removeprefix("file:")
    assert not [n for n in os.listdir(stored) if n.startswith("stored-")]
