"""Operators on hand-built rows with nulls, ties and blanks."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lamina.functions import values as v
from lamina.operators import checks
from lamina.operators.amendments import NullRule, fold
from lamina.operators.elements import elements
from lamina.operators.ids import numbered
from lamina.operators.latest import distinct_content, latest_by, new_content, newest, newest_dated, upsert
from lamina.operators.model import latest_in_model, project_model, union_tagged
from lamina.operators.pairing import Pairing, pair
from lamina.operators.scope import checked, describe, scope_table, scoped


def col(df, *names):
    return sorted((tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.collect()), key=repr)


@pytest.mark.parametrize(("order", "winner"), [(newest, 1), (newest_dated, 3)])
def test_latest_by_null_order(spark, order, winner):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 7, 3), (None, 1, 4), (None, 2, 5)], "k string, ts int, id int")
    got = {r.k: r.id for r in latest_by(df, ["k"], [order("ts"), newest("id")]).collect()}
    assert got == {"a": winner, None: 5}


def test_latest_by_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 9), ("a", 1, 4)], "k string, ts int, id int")
    assert col(latest_by(df, ["k"], [newest("ts"), newest("id")]), "id") == [9]


def test_distinct_content_keeps_null_hashes(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None)], "bronze_row_id long, hash_key string")
    assert col(distinct_content(df), "bronze_row_id") == [1, 3, 4]
    assert col(distinct_content(df.limit(0)), "bronze_row_id") == []


def test_new_content_is_idempotent(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "bronze_row_id long, hash_key string")
    first = new_content(df, None)
    assert col(first, "bronze_row_id") == [1, 2]
    assert new_content(df, first).isEmpty()


def test_upsert_matches_null_keys(spark):
    target = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, n int")
    delta = spark.createDataFrame([(None, 9), ("b", 8), ("c", 7)], "k string, n int")
    assert col(upsert(target, delta, ["k"]), "k", "n") == sorted([("a", 2), (None, 9), ("b", 8), ("c", 7)], key=repr)


def test_values(spark):
    df = spark.createDataFrame([("", " ", "12.50", "y"), ("7", "x", " 1e3", "n"), (None, None, None, "?")], "a string, b string, c string, d string")
    got = df.select(v.bigint("a").alias("a"), v.blank_to_null("b").alias("b"), v.numeric("c").cast("double").alias("c"), v.yes_no("d").alias("d"), v.is_blank("b").alias("e")).collect()
    assert [tuple(r) for r in got] == [(None, " ", 12.5, True, True), (7, "x", 1000.0, False, False), (None, None, None, None, True)]


def test_bad_text_raises(spark):
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("abc",)], "a string").select(v.numeric("a")).collect()
    with pytest.raises(PySparkException):
        spark.createDataFrame([("13/4/2026",)], "a string").select(v.timestamp("a")).collect()


def test_times_are_utc(spark):
    df = spark.createDataFrame([("2026-04-01", "2027-03-31T23:00:00Z")], "a string, b string")
    row = df.select(v.days_between("a", "b").alias("days"), v.timestamp("b").cast("long").alias("s")).first()
    assert (row.days, row.s) == (364, 1806534000)


def test_checks(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, v string")
    with pytest.raises(checks.ConstraintError, match="not unique"):
        checks.require_unique(df, ["k", "v"])
    checks.require_unique(df, ["k", "v"], nulls_distinct=True)
    with pytest.raises(checks.ConstraintError, match="null in v"):
        checks.require_not_null(df, ["k", "v"])
    with pytest.raises(checks.ConstraintError, match="'a'"):
        checks.require_values(df, "v", ["b"])


def test_numbered_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")).repartition(7)
    got = numbered(df, [F.col("x").asc()], "n", 5).collect()
    assert sorted((r.n, r.x) for r in got) == [(i + 5, i) for i in range(1000)]


MAPPING = "workflow_id int, source string, kholdernumber string, kholdername string, action string"


@pytest.mark.parametrize(
    ("rows", "kept"),
    [
        ([], ["1", " 2", "3", None]),
        ([(1, "firm", "1", "x", "add"), (1, None, " 2 ", "y", "add")], ["1", " 2"]),
        ([(1, "firm", "1", "x", "remove")], [" 2", "3", None]),
        ([(1, "firm", "1", "x", "add"), (2, "FIRMS ", "1", "x", "remove")], []),
        ([(1, "awards", "1", "x", "add")], ["1", " 2", "3", None]),
        ([(1, "gtran_firm", "3", "x", "add")], ["3"]),
    ],
)
def test_scope(spark, rows, kept):
    df = spark.createDataFrame([("1",), (" 2",), ("3",), (None,)], "kholder string")
    mapping = spark.createDataFrame(rows, MAPPING)
    assert col(scoped(df, mapping, "firm", "kholder"), "kholder") == sorted(kept, key=repr)
    assert scope_table(df, mapping, "firm", "other").count() == 4
    assert describe(mapping, "firm")


def test_scope_mapping_is_checked(spark):
    with pytest.raises(checks.ConstraintError):
        checked(spark.createDataFrame([(1, "firm", "1", "x", "drop")], MAPPING))
    with pytest.raises(checks.ConstraintError):
        checked(spark.createDataFrame([(None, None, "1", "x", "add"), (None, None, "1", "y", "remove")], MAPPING))


def test_elements(spark):
    payloads = [(1, '{"L":[{"Loc":"a","n":1},{"n":1,"Loc":"a"},{"loc":"b"}]}'), (2, '{"L":"[{}]"}'), (3, '{"L":{}}'), (4, None), (5, '{"L":[]}'), (6, '{"L":null}'), (7, "[bad")]
    df = spark.createDataFrame(payloads, "id int, raw_payload string")
    got = elements(df, "L", ["Loc", "n"], carry=["id"]).collect()
    assert [(r.id, r.loc, r.n) for r in got] == [(1, "a", "1"), (1, "a", "1"), (1, None, None)]
    assert got[0].hash_key == got[1].hash_key != got[2].hash_key
    assert col(elements(df, "L", ["Loc"], carry=["id"], lenient=True), "id") == [1, 1, 1, 2]


POSTINGS = "k string, p string, desc string, ts timestamp, id int, a string, b string"


def folded(spark, rows, **more):
    import datetime

    day = lambda n: None if n is None else datetime.datetime(2026, 1, n)
    df = spark.createDataFrame([("k", None, d, day(t), i, a, b) for i, (d, t, a, b) in enumerate(rows)], POSTINGS)
    out = fold(df, ["k", "p"], ["a", "b"], "desc", F.col("ts"), [F.col("id")], **more).collect()
    return [(r.a, r.b, r.amend_kind, r.amend_postings_applied, r.amend_baseline_ts and r.amend_baseline_ts.day) for r in out]


def test_fold_takes_the_newest_value_of_each_column(spark):
    assert folded(spark, [("New", 1, "1", "1"), ("Changes only", 2, None, "2"), ("changes", 3, "", None)]) == [("", "2", "CHANGES_ONLY", 3, 1)]


def test_fold_drops_what_a_full_posting_supersedes(spark):
    rows = [("New", 1, "1", "1"), ("Changes Only", 2, "2", None), (" ALL data ", 3, "3", None), ("changes only", None, "9", "9")]
    assert folded(spark, rows) == [("3", None, "ALL_DATA", 1, 3)]


def test_fold_of_orphans(spark):
    rows = [("Changes only", 1, "1", None), ("Not an amendment", 2, None, "2"), ("Changes only", None, "0", "0")]
    assert folded(spark, rows) == [("1", "2", "UNKNOWN", 3, None)]
    assert folded(spark, rows, orphans=False) == []


@pytest.mark.parametrize(("count", "kept"), [(1, 1), (2, 1), (3, 1), (4, 1)])
def test_undescribed_postings(spark, count, kept):
    rows = [(None if i % 2 else " ", i + 1, str(i), "x" if not i else None) for i in range(count)]
    [(a, _, kind, n, base)] = folded(spark, rows)
    assert (a, n, base) == (str(count - 1), kept, count)
    assert kind == ("ALL_DATA" if count > 2 else "NEW")
    assert folded(spark, rows, rule=None)[0][2] == "NEW"
    assert folded(spark, rows, rule=NullRule(group=10))[0][2] == "NEW"


def test_fold_does_not_depend_on_row_order(spark):
    rows = [("New", 1, "1", "1"), ("Changes only", 2, "2", None), ("Changes only", 2, "3", "3"), ("x", 3, None, "4")]
    df_rows = [(d, t, a, b) for d, t, a, b in rows]
    assert folded(spark, df_rows) == [("3", "4", "UNKNOWN", 4, 1)]


POINTS = "firmid string, loc string, locname string, loczn string, locpurp string, locqti string, kqtyloc string, kentbegdatetime string, kentenddatetime string, source_system string, source_api string, pipeline_run_id string, hash_key string, ingestion_status string, ingestion_timestamp int"


def point(key, loc, purpose, h, status="LOADED", ts=1, qty="5"):
    return (key, loc, "n", "z", purpose, "q", qty, "2026-01-01", "", "s", "a", "r", h, status, ts)


def test_pairing(spark):
    rows = [
        point("c1", "1", "REC", "h1"), point("c1", "2", "del", "h2"), point("c2", "1", "rec", "h3"), point("c3", "9", "DEL", "h4", qty=""), point("c4", "1", "MQ", "h5"), point("c1", "3", "REC", "h6", "INVALID"),
        point("c5", "1", "REC", "h7"), point("c5", "2", "REC", "h8"), point("c5", "3", "DEL", "h9"), point("c5", "4", "DEL", "ha"), point("c1", "1", "REC", "h0", ts=0), point(None, "1", "REC", "hn"), point(None, "2", "DEL", "hm"),
    ]
    df = spark.createDataFrame(rows, POINTS)
    got = pair(df, Pairing("firm"))
    assert col(got, "contract_key", "pair_status", "receipt_hash_key", "delivery_hash_key") == sorted(
        [("c1", "PAIRED", "h1", "h2"), ("c2", "UNPAIRED_RECEIPT", "h3", None), ("c3", "UNPAIRED_DELIVERY", None, "h4"), *[("c5", "PAIRED", r, d) for r in ("h7", "h8") for d in ("h9", "ha")], (None, "UNPAIRED_DELIVERY", "hn", None), (None, "UNPAIRED_DELIVERY", None, "hm")],
        key=repr,
    )
    row = got.filter("contract_key = 'c1'").first()
    assert (int(row.receipt_qty_dth), row.term_begin_ts.day, row.term_end_ts, row.term_days, row.path_qty_dth) == (5, 1, None, None, None)
    by_quantity = Pairing("firm", rule=lambda r, d: r("loc_qty") == d("loc_qty"))
    assert col(pair(df.filter("firmid = 'c3' OR firmid = 'c2'").withColumn("firmid", F.lit("c")), by_quantity), "pair_status") == ["UNPAIRED_DELIVERY", "UNPAIRED_RECEIPT"]


def test_pairing_fields(spark):
    df = spark.createDataFrame([point("c1", "1", "REC", "h1")], POINTS)
    assert pair(df, Pairing("x", {"loc_zone": None})).first().receipt_zone is None
    with pytest.raises(KeyError):
        Pairing("x").column_of("nothing")


def test_model(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "n string, t string")
    got = project_model(df, {"x": "int", "index": "bigint", "y": "string"}, {"x": F.col("n"), "y": F.col("t")})
    assert got.dtypes == [("x", "int"), ("index", "bigint"), ("y", "string")]
    with pytest.raises(KeyError):
        project_model(df, {"x": "int"}, {"z": F.col("n")})
    both = union_tagged({"a": got, "b": None, "c": got})
    assert both.count() == 4 and col(both.select("source_type").distinct(), "source_type") == ["a", "c"]
    assert union_tagged({"a": None}) is None


def test_latest_in_model(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, 1), ("k", None, 9), (None, None, None)], "k string, update_date int, posted_date int")
    assert {r.k: r.update_date for r in latest_in_model(df, ["k"]).collect()} == {"k": 2, None: None}


@pytest.mark.parametrize("rule", [NullRule(), NullRule(2, 0), NullRule(1, 2), NullRule(4, 3), None])
def test_undescribed_rule_equals_its_definition(spark, rule):
    import random

    from lamina.operators.amendments import UNDESCRIBED, settle_undescribed

    rng = random.Random(6)
    rows = [(rng.choice(("a", "b", None, "c")), rng.choice((None, 1, 2, 3)), i, rng.choice((UNDESCRIBED, UNDESCRIBED, "NEW", "UNKNOWN"))) for i in range(40)]
    want = {}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key and r[3] == UNDESCRIBED), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        for n, r in enumerate(own, start=1):
            want[r[2]] = "ALL_DATA" if rule and len(own) > rule.group and n > rule.running else "NEW"
    df = spark.createDataFrame(rows, "k string, ts int, id int, kind string")
    got = settle_undescribed(df, ["k"], [F.col("ts"), F.col("id")], rule)
    assert got.columns == df.columns
    assert {r.id: r.kind for r in got.collect()} == {r[2]: want.get(r[2], r[3]) for r in rows}


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    from lamina.checkpoints import shared_dir

    made = []
    fake = lambda master, given: SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: given), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append)
    )
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(fake(master, None))
    assert shared_dir(fake("yarn", "hdfs:///c")) == "hdfs:///c" == made.pop()
    assert shared_dir(fake("local[4]", None)) == made.pop()


def test_pairing_of_very_many_points_without_a_contract(spark):
    """They stay where they are: no shuffle gathers them."""
    points = spark.range(2000).selectExpr("CAST(NULL AS STRING) AS firmid", "CAST(id AS STRING) AS loc", "'REC' AS locpurp", "'LOADED' AS ingestion_status", "1 AS ingestion_timestamp")
    none = dict.fromkeys(("loc_name", "loc_zone", "loc_qti", "loc_qty", "term_begin", "term_end", "source_system", "source_api", "pipeline_run_id", "hash_key"))
    paths = pair(points.repartition(4), Pairing("firm", none, newest_only=False))
    assert paths.count() == 2000
    sizes = [r[0] for r in paths.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) >= 4 and max(sizes) < 1000
