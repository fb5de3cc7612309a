"""Wide rows of payloads: columns of a map by one loop, and Arrow columns that are what Arrow makes of the rows."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lamina.sources.feeds import FEEDS, META, columns_of
from lamina.sources.ingest import raw_rows
from lamina.sources.payloads import PARSED, parse, parse_files, record_batch

TEXTS = [
    json.dumps({"feedType": "gTRAN_FIRM", "TspDuns": 61, "contracts": [{"id": "1", "FIRMID": "a", "KHolder": None, "KQtyK": "", "locations": [{"Loc": "x"}], "unknown": 1}, {"id": "2"}, {}]}),
    "no JSON", json.dumps({"feedType": "gTRAN_FIRM", "contracts": []}),
]


def test_batches_are_what_arrow_makes_of_rows(spark):
    schema = to_arrow_schema(StructType.fromDDL(PARSED))
    rows = [row | {"file": "f"} for text in TEXTS for row in parse(text, FEEDS, "", "s")] + [{"business": [], "missing": []}, {"business": [("k", None)]}]
    for some in (rows, rows[::-1], rows[:1], [{}], []):
        got, want = record_batch(some, schema), pa.RecordBatch.from_pylist(some, schema=schema)
        assert got.schema == want.schema and got.to_pylist() == want.to_pylist()
        got.validate(full=True)


def test_business_columns_are_those_of_the_map(spark):
    parsed = parse_files(spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "file string, value string"), FEEDS)
    rows = raw_rows(parsed, "gtran_firm", "run")
    names = columns_of("gtran_firm")
    assert rows.columns == ["file", "position", *names, *[n for n, _ in META]]
    got = [tuple(r) for r in rows.orderBy("file", "position").select(*names).collect()]
    records = [dict(r.business) for r in parsed.filter(F.col("table") == "gtran_firm").orderBy("file", "position").collect()]
    assert got == [tuple(r.get(n) for n in names) for r in records] and len(got) == 3 and got[0][names.index("kholder")] is None and got[0][names.index("kqtyk")] == ""
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("element_at") < len(names) and plan.count("transform(") == 1  # a look-up for each name makes a method too large for the JVM's compiler
