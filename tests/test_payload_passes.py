"""Queries over payloads parse each file once."""

from lamina import queries


def test_the_final_core_table_parses_each_file_once(spark, monkeypatch):
    met, parse = spark.sparkContext.accumulator(0), queries.parse_files

    def count(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(queries, "parse_files", lambda files, feeds: parse(files.mapInArrow(count, files.schema), feeds))
    rows = queries.queries()["final_core_of_payloads"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == met.value > 1000
