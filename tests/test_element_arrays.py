"""Whether a section is an array is told without the schema of all its elements."""

from lamina.operators.elements import elements


def test_arrays_are_told_from_texts_without_a_schema(spark):
    payloads = ['{"s": [{"K": 1}, {"K": "2"}, 7, null]}', '{"s": "[{\\"K\\": 3}]"}', '{"s": {"K": 4}}', '{"s": []}', '{"s": null}', "{}", "no JSON", None]
    rows = elements(spark.createDataFrame(list(enumerate(payloads)), "id int, raw_payload string"), "s", ["K"], carry=["id"])
    assert sorted((r.id, str(r.k)) for r in rows.collect()) == [(0, "1"), (0, "2"), (0, "None"), (0, "None")]
    assert "schemaofvariant" not in rows._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "")
