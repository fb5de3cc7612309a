"""Payload files through all layers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lamina.__main__ import main
from lamina.functions import jsontext
from lamina.plans.inspect import explain, inventory, readiness
from lamina.plans.models import NATURAL_KEYS, mapping, model
from lamina.plans.registry import CURATED, RAW, STAGING, Plan, default_registry, in_group
from lamina.plans.runner import ordered, run_many, run_one, selected, summary
from lamina.sources import feeds as f
from lamina.sources.export import Export, export
from lamina.sources.ingest import Settings, ingest, provision, sink_for
from lamina.sources.labels import feed_name, spellings
from lamina.sources.payloads import PayloadError, parse
from lamina.sources.tables import Tables


def location(contract, loc, purpose, index):
    return {"Index": index, "UniqueId": f"{contract}-{loc}", "KQtyLoc": "100", "Loc": loc, "LocName": f"P{loc}", "LocPurp": purpose, "LocPurpDesc": purpose.title(), "KEntBegDateTime": "2026-04-01T00:00:00Z"}


def contract(n, locations, **more):
    rate = {"UniqueId": f"R{n}", "RateChgd": "0.4500", "RateIdDesc": "Reservation", "RecLoc": "1", "DelLoc": "2"}
    return {"Id": f"I{n}", "FirmId": f"F{n}", "PostedDateTime": "2026-04-14T15:00:00Z", "AmendRptgDesc": "Not an amendment", "KHolder": n, "KQtyK": 25000, "locations": locations, "rates": [rate]} | more


def firm_payload(*contracts):
    return {"feedType": "gTRAN_FIRM", "sourceSystem": "S", "TspName": "T", "TspDuns": 61, "contracts": list(contracts)}


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "data"))


def write(tmp_path, name, payload):
    path = tmp_path / name
    path.write_text(json.dumps(payload) if not isinstance(payload, str) else payload, encoding="utf-8")
    return str(path)


@pytest.fixture
def sample(tmp_path):
    two = [contract(1, [location("F1", "1", "REC", "1"), location("F1", "2", "DEL", "")]), contract(2, [location("F2", "9", "REC", "2")])]
    return write(tmp_path, "firm.json", firm_payload(*two))


def test_end_to_end(spark, tables, sample, tmp_path):
    assert (ingest(spark, sample, tables).rows_written, ingest(spark, sample, tables).rows_written) == (2, 0)
    out = run_many(default_registry(), tables, to=Export.start(str(tmp_path / "exports")))
    counts = summary(out)
    assert counts["failed"] == 0
    rows = {r.name.removeprefix("silver_"): r.rows for r in out if r.status == "succeeded"}
    assert {k: rows[k] for k in ("firm_core_dedup", "firm_locations_dedup", "firm_rates_dedup", "firm_core", "firm_locations", "firm_rates", "firm_rec_del_pair")} == {
        "firm_core_dedup": 2, "firm_locations_dedup": 3, "firm_rates_dedup": 2, "firm_core": 2, "firm_locations": 3, "firm_rates": 2, "firm_rec_del_pair": 2,
    }
    pairs = {(r.contract_key, r.receipt_loc_code, r.delivery_loc_code, r.pair_status, r.rec_del_pair_id) for r in tables.read(CURATED, "firm_rec_del_pair").collect()}
    assert pairs == {("F1", "1", "2", "PAIRED", 1), ("F2", "9", None, "UNPAIRED_RECEIPT", 2)}
    core = tables.read(STAGING, "firm_core").filter("firmid = 'F1'").first()
    assert (core.amend_kind, core.amend_postings_applied, core.amend_baseline_ts, core.tspduns, core.locations) == ("UNKNOWN", 1, None, "61", None)
    final = tables.read(CURATED, "final_core_master_capacity").filter("ngh_contract_id = 'F2'").first()
    assert (final.source_type, float(final.contract_quantity), final.contract_type, final.source, final.calculated_end_date.year) == ("firm", 25000.0, "FIRM", "gTRAN FIRM", 2999)
    assert {r["index"] for r in tables.read(CURATED, "final_locations_master_capacity").collect()} == {1, 2, None}
    assert list((tmp_path / "exports").glob("stage_4/firm/firm_rec_del_pair/run_date=*/*.parquet/part-*"))
    again = summary(run_many(default_registry(), tables))
    assert again["succeeded"] == 0 and again["rows"] == 0
    assert run_one("silver_firm_core", default_registry(), tables, reload=True).rows == 2
    log = tables.read(RAW, "ingestion_log")
    assert [(r.objects_read, r.rows_written, r.pipeline_status) for r in log.orderBy("pipeline_start_ts").collect()] == [(2, 2, "Succeeded"), (2, 0, "Succeeded")]


def test_all_feeds(spark, tables, sample, tmp_path):
    it = {"feed_type": "gTRAN_IT", "contracts": [{"Id": "1", "InterruptibleId": "IT1", "ITQtyK": "7", "locations": [{"UniqueId": "u", "Loc": "5", "LocPurp": "DEL", "ItQtyLoc": "3"}], "rates": [{"UniqueId": "r"}]}]}
    award = {"Id": "A1", "AwardNumber": "N1", "AwardQuantityContract": "9", "locations": [{"Id": "L1", "AwardNumber": "N1", "LocationPropCode": "7", "LocationPurposeCode": "REC", "AwardQuantityLocation": "4"}], "rates": [{"Id": "L1", "AwardNumber": "N1", "LocationPropCode": "7", "LocationPurpose": "rec", "LocationName": "P"}]}
    index = {"feedType": "gINDEX", "records": [{"ID": 1, "Pipe": "p", "K": "x"}, {"ID": 2, "Pipe": " "}]}
    write(tmp_path, "it.json", it)
    write(tmp_path, "gawd.json", {"feedType": "gAWD", "awards": [award]})
    write(tmp_path, "index.json", index)
    done = ingest(spark, str(tmp_path / "*.json"), tables)
    assert (done.objects_read, done.rows_written, done.rows_rejected) == (6, 6, 1)
    assert summary(run_many(default_registry(), tables, [n for n in default_registry() if n != "silver_firm_transport_rate"]))["failed"] == 0
    final = {(r.source_type, r.ngh_contract_id) for r in tables.read(CURATED, "final_core_master_capacity").collect()}
    assert final == {("firm", "F1"), ("firm", "F2"), ("interruptible", "IT1"), ("awards", "N1")}
    rate = tables.read(CURATED, "awards_rates_master_capacity").first()
    assert (rate.receipt_location, rate.receipt_location_name, rate.delivery_location) == ("7", "P", None)
    assert {r.source_type for r in tables.read(CURATED, "final_rates_master_capacity").collect()} == {"firm", "interruptible", "awards"}
    assert {r.ingestion_status for r in tables.read(RAW, "gindex").collect()} == {"LOADED", "INVALID"}


def test_scope_reaches_every_layer(spark, tables, sample):
    ingest(spark, sample, tables)
    verdicts = spark.createDataFrame([(1, 1, "Firms", " 1 ", "x", "add")], "id long, workflow_id int, source string, kholdernumber string, kholdername string, action string")
    tables.replace(RAW, "shipper_mapping", verdicts)
    run_many(default_registry(), tables, selected(default_registry(), source="firm"))
    assert [r.ngh_contract_id for r in tables.read(CURATED, "firm_core_master_capacity").collect()] == ["F1"]
    assert tables.read(STAGING, "firm_locations_dedup").count() == 2


def test_equal_elements_of_two_contracts_are_one(spark, tables, tmp_path):
    same = {"UniqueId": "u", "Loc": "1", "LocPurp": "REC"}
    ingest(spark, write(tmp_path, "p.json", firm_payload(contract(1, [same]), contract(2, [same]))), tables)
    run_one("silver_firm_locations_dedup", default_registry(), tables)
    assert [r.firmid for r in tables.read(STAGING, "firm_locations_dedup").collect()] == ["F1"]


def test_amended_contract(spark, tables, tmp_path):
    new = contract(1, [], AmendRptgDesc="New", RateSch="FT", Rte="a")
    change = contract(1, [], AmendRptgDesc="Changes Only", PostedDateTime="2026-05-01T00:00:00Z", RateSch=None, Rte="b")
    ingest(spark, write(tmp_path, "a.json", firm_payload(new)), tables)
    ingest(spark, write(tmp_path, "b.json", firm_payload(change)), tables)
    run_many(default_registry(), tables, [f"silver_firm_core{s}" for s in ("_dedup", "_amended", "")])
    row = tables.read(STAGING, "firm_core").first()
    assert (row.ratesch, row.rte, row.amend_kind, row.amend_postings_applied, row.bronze_row_id) == ("FT", "b", "CHANGES_ONLY", 2, 2)


def test_failure_keeps_the_old_table_and_skips_what_reads_it(spark, tables, sample, tmp_path):
    ingest(spark, sample, tables)
    registry = default_registry()
    run_many(registry, tables, selected(registry, source="firm"))
    before = tables.read(STAGING, "firm_locations").count()
    bad = registry["silver_firm_locations"]
    registry["silver_firm_locations"] = Plan(**{**bad.__dict__, "build": lambda t: t["firm_locations_dedup"].unionByName(t["firm_locations_dedup"])})
    out = {r.name: r for r in run_many(registry, tables, ["silver_firm_locations", "silver_firm_rec_del_pair", "silver_firm_rates"], reload=True)}
    assert [out[n].status for n in ("silver_firm_locations", "silver_firm_rec_del_pair", "silver_firm_rates")] == ["failed", "skipped", "succeeded"]
    assert tables.read(STAGING, "firm_locations").count() == before


def test_null_contract_fails_the_pairs(spark, tables, tmp_path):
    ingest(spark, write(tmp_path, "p.json", firm_payload(contract(1, [location("x", "1", "REC", "1")], FirmId=""), contract(2, [location("y", "2", "REC", "1")]) | {"FirmId": None})), tables)
    out = run_many(default_registry(), tables, ["silver_firm_locations_dedup", "silver_firm_locations", "silver_firm_rec_del_pair"])
    assert [r.status for r in out] == ["succeeded", "succeeded", "succeeded"]  # both were INVALID and take no part


def test_finals_without_sources(spark, tables):
    result = run_one("silver_final_core_master_capacity", default_registry(), tables)
    assert (result.status, result.rows, tables.exists(CURATED, "final_core_master_capacity")) == ("succeeded", 0, False)
    assert run_one("silver_firm_core", default_registry(), tables).error == "missing silver_staging.firm_core_amended"


def test_registry():
    registry = default_registry()
    assert len(registry) == 36
    with pytest.raises(ValueError, match="registered already"):
        registry.register(registry["silver_firm_core"])
    order = ordered(registry, registry)
    assert len(order) == 36
    at = {n: i for i, n in enumerate(order)}
    assert at["silver_firm_core_dedup"] < at["silver_firm_core_amended"] < at["silver_firm_core"] < at["silver_firm_core_master_capacity"] < at["silver_final_core_master_capacity"]
    assert [n for n in selected(registry, group="stage_4", source="it")] == ["silver_interruptible_rec_del_pair"]
    assert selected(registry, group="master_capacity/firm/core") == ["silver_firm_core_master_capacity"]
    assert selected(registry, group="") == ["silver_firm_transport_rate"]
    assert not in_group(registry["silver_firm_core"], "nothing")
    assert [len(model(g)) for g in ("core", "locations", "rates")] == [26, 20, 32]
    assert all(set(NATURAL_KEYS[g]) <= set(model(g)) for g in NATURAL_KEYS)


def test_fixed_lists():
    assert len(f.BUSINESS["gtran_firm"]) == 44 and len(f.BUSINESS["gtran_it"]) == 38 and len(f.BUSINESS["gindex"]) == 32 and len(f.BUSINESS["gawd"]) == 86
    assert [len(f.ELEMENT_KEYS[k]) for k in (("firm", "locations"), ("firm", "rates"), ("interruptible", "locations"), ("interruptible", "rates"), ("awards", "locations"), ("awards", "rates"))] == [22, 53, 23, 55, 28, 33]


@pytest.mark.parametrize(
    ("text", "error"),
    [("[1]", "not an object"), ("{", "not JSON"), ("{}", "no feed type"), ('{"feedType": "x"}', "unknown feed 'x'")],
)
def test_bad_payloads(spark, tables, tmp_path, text, error):
    with pytest.raises(PayloadError, match=error):
        ingest(spark, write(tmp_path, "bad.json", text), tables)
    assert not tables.exists(RAW, "gtran_firm")


def test_parse_values():
    record = {"id": "lower", "FIRMID": "F", "KStatDesc": {"b": 1, "a": True}, "Affil": '[1, {"z": 0, "y": null}]', "Rte": "[bad", "KQtyK": 1.5, "MaxTrfRate": "0.4500", "KRoll": True, "PkgId": None, "Other": 1, "tspname": "own"}
    [row] = parse(json.dumps(firm_payload(record)), f.FEEDS, "", "source")
    business = dict(row["business"])
    assert business == {"id": "lower", "firmid": "F", "kstatdesc": '{"a":true,"b":1}', "affil": '[1,{"y":null,"z":0}]', "rte": "[bad", "kqtyk": "1.5", "maxtrfrate": "0.4500", "kroll": "true", "pkgid": None, "tspname": "own", "tspduns": "61"}
    assert (row["raw_record_id"], row["missing"], row["source_api"]) == ("lower", [], "source/gTRAN_FIRM")
    assert "Other" in json.loads(row["raw_payload"])
    assert jsontext.content_hash({"a": None}) != jsontext.content_hash({})
    assert jsontext.content_hash({"a": "1", "b": "2"}) == jsontext.content_hash({"b": "2", "a": "1"})


def test_parse_record_lists_and_children():
    assert jsontext.records('[{"a": 1}, 2, "{\\"b\\": 2}"]') == [{"a": 1}, {"b": 2}]
    assert [jsontext.records(x) for x in (None, "", "x", {"a": 1}, 5)] == [[], [], [], [{"a": 1}], []]
    feed = f.Feed("X", "rows", "gindex", "ID", ("ID",), children=(f.Child("parts", "part_table", "PartId", ("PartId",), ("ID",)),))
    rows = list(parse(json.dumps({"feedType": " X ", "rows": [{"ID": 1, "Parts": [{"PartId": "p"}, {}]}]}), {"X": feed}, "s", "api"))
    assert [(r["table"], r["raw_record_id"], r["missing"], dict(r["business"]).get("id")) for r in rows] == [("gindex", "1", [], "1"), ("part_table", "p", [], "1"), ("part_table", "", ["PartId"], "1")]


def test_labels():
    assert [feed_name(x) for x in ("Firms ", "gtran_it", "award", "x", None, "final")] == ["firm", "interruptible", "awards", "_combined", "_combined", "_combined"]
    assert spellings("firm") == ("firm", "firms", "gtran_firm")


def test_sinks_and_dry_run(spark, tables, sample):
    with pytest.raises(NotImplementedError):
        sink_for("azure_sql")
    with pytest.raises(ValueError):
        sink_for("x")
    done = ingest(spark, sample, tables, Settings(source_system="S"), dry_run=True)
    assert (done.objects_read, done.rows_written, tables.list(RAW)) == (2, 0, [])


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2])], "a int, b array<int>")
    to = Export.start(str(tmp_path / "out"), "stage3")
    path = export(df, "t", to, "firms")
    assert path.startswith(f"{tmp_path}/out/stage3/firm/t/run_date=") and spark.read.parquet(path).first().b == "[1,2]"
    assert export(df.limit(0), "t", to) is None and export(df, "t", Export.start("")) is None


def test_inspection(spark, tables, sample):
    ingest(spark, sample, tables)
    run_one("silver_firm_core_dedup", default_registry(), tables)
    assert {(r.layer, r.table_name): r.row_count for r in inventory(tables, (RAW, STAGING)).collect()} == {(RAW, "gtran_firm"): 2, (RAW, "ingestion_log"): 1, (STAGING, "firm_core_dedup"): 2}
    ready = {n: s for n, s, _ in readiness(default_registry(), tables)}
    assert (ready["silver_firm_core_dedup"], ready["silver_firm_core_amended"], ready["silver_firm_core"], ready["silver_final_core_master_capacity"]) == ("SKIP", "READY", "BLOCKED", "READY")
    assert "Physical Plan" in explain(default_registry(), tables, "silver_firm_core_amended")


def test_provision(spark, tables, sample):
    assert len(provision(tables)) == 6 and provision(tables) == []
    assert ingest(spark, sample, tables).rows_written == 2
    assert tables.read(RAW, "gtran_firm").count() == 2 and tables.read(RAW, "shipper_mapping").isEmpty()
    run_one("silver_firm_core_dedup", default_registry(), tables)
    assert tables.read(STAGING, "firm_core_dedup").count() == 2


def test_streaming(spark, tables, tmp_path):
    from lamina.streaming.landing import stream_payloads

    folder = tmp_path / "landing"
    folder.mkdir()
    write(folder, "1.json", firm_payload(contract(1, [])))
    for name, n in (("2.json", 1), ("3.json", 2)):
        stream_payloads(spark, str(folder), tables, str(tmp_path / "state")).awaitTermination()
        write(folder, name, firm_payload(contract(n, [])))
    stream_payloads(spark, str(folder), tables, str(tmp_path / "state")).awaitTermination()
    got = tables.read(RAW, "gtran_firm").select("firmid", "bronze_row_id").orderBy("bronze_row_id").collect()
    assert [tuple(r) for r in got] == [("F1", 1), ("F2", 2)]


def test_streaming_sets_bad_files_aside(spark, tables, tmp_path):
    from lamina.streaming.landing import REJECTED, stream_payloads

    folder = tmp_path / "landing"
    folder.mkdir()
    for name, payload in (("1.json", firm_payload(contract(1, []))), ("2.json", "not JSON"), ("3.json", {"feedType": "none"}), ("4.json", firm_payload(contract(2, [])))):
        write(folder, name, payload)
    for _ in range(2):  # a second start finds nothing new
        stream_payloads(spark, str(folder), tables, str(tmp_path / "state"), settings=Settings(source_system="S")).awaitTermination()
    assert sorted(r.firmid for r in tables.read(RAW, "gtran_firm").collect()) == ["F1", "F2"]
    assert sorted(r.file for r in tables.read(RAW, REJECTED).collect()) == ["2.json", "3.json"]
    log = tables.read(RAW, "ingestion_log").collect()
    assert [(r.objects_read, r.rows_written, r.error_details) for r in log] == [(2, 2, "files set aside")]


def test_versions(spark, tables):
    one, two = spark.range(3).selectExpr("id AS a"), spark.range(5).selectExpr("id AS a")
    tables.append("x", "t", one)
    before = tables.read("x", "t")
    assert tables.exists("x", "t") and tables.versions("x", "t") == []
    assert tables.replace("x", "t", two).count() == 5 and before.count() == 3  # who reads the old one goes on
    with pytest.raises(ZeroDivisionError):
        tables.replace("x", "t", one, check=lambda df: 1 / 0)
    assert tables.read("x", "t").count() == 5 and len(tables.versions("x", "t")) == 1
    for _ in range(3):
        tables.replace("x", "t", tables.read("x", "t"))
    tables.append("x", "t", one)
    assert tables.read("x", "t").count() == 8 and len(tables.versions("x", "t")) == 2 and tables.list("x") == ["t"]
    with pytest.raises(ZeroDivisionError):
        tables.replace("x", "new", one, check=lambda df: 1 / 0)
    assert not tables.exists("x", "new") and tables.list("x") == ["t"]
    tables.drop("x", "t")
    assert tables.list("x") == [] and not tables.exists("x", "t")


def test_plans_are_shown_without_sources(spark, tables):
    registry = default_registry()
    for name in registry:
        text = explain(registry, tables, name)
        if name == "silver_firm_transport_rate":
            assert text.endswith("not known: bronze.gtran_rates, bronze.gtran_loc")
        else:
            assert "sources are missing" in text and "Physical Plan" in text and "columns: " in text
    text = explain(registry, tables, "silver_firm_rec_del_pair")
    assert "rec_del_pair_id bigint" in text and "pair_status string not null" in text and "silver_loaded_ts timestamp" in text


def test_command_line(spark, tables, sample, capsys, tmp_path):
    root = ["--root", tables.root]
    assert main([*root, "--list", "--source", "awards"]) == 0 and "silver_awards_core gawd" not in capsys.readouterr().out
    assert main([*root, "--table", "nothing"]) == 2
    assert main([*root, "ingest", sample]) == 0
    assert main([*root, "ingest", str(tmp_path / "none.json")]) == 2
    assert main([*root, "--group", "stage_3/deduplication", "--source", "firm"]) == 0
    assert main([*root, "--group", "none"]) == 0
    assert main([*root, "--inspect"]) == 0 and main([*root, "--shippers"]) == 0 and main([*root, "--list-groups"]) == 0
    assert tables.read(STAGING, "firm_core_dedup").filter(F.col("firmid") == "F1").count() == 1


def test_mappings_fill_known_columns(spark):
    for feed in ("firm", "interruptible", "awards"):
        for grain in ("core", "locations", "rates"):
            assert set(mapping(feed, grain)) <= set(model(grain))
    assert len(mapping("awards", "rates")) == 22 and len(mapping("firm", "rates")) == 31
