"""Queries that exercise the library's operators on the driver's tables, each with its SQL for an oracle.

The tables hold no contract data, so each query dresses one of them up as what the operator works on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.checkpoints import cut, shared_dir
from lamina.functions.values import bigint, blank_to_null, date, days_between, numeric, timestamp, yes_no
from lamina.operators.amendments import NullRule, fold, kind_of, settle_undescribed
from lamina.operators.checks import ConstraintError, require_not_null, require_unique, require_values
from lamina.operators.elements import canonical, elements
from lamina.operators.ids import numbered, renumbered
from lamina.operators.latest import distinct_content, latest_by, new_content, newest, newest_dated, upsert
from lamina.operators.model import latest_in_model, project_model, union_tagged
from lamina.operators.pairing import Pairing, pair
from lamina.operators.quarantine import set_aside
from lamina.operators.scope import describe, scoped
from lamina.operators.transport import transport_rates
from lamina.plans.incremental import AmendmentFold
from lamina.plans.inspect import inventory
from lamina.plans.registry import default_registry, with_nulls
from lamina.plans.runner import run_many
from lamina.session import reach
from lamina.sources.export import as_text
from lamina.sources.feeds import FEEDS, Feed
from lamina.sources.ingest import RAW, Settings, ingest, raw_rows, tallies
from lamina.sources.labels import feed_name_of
from lamina.sources.payloads import parse_files
from lamina.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        def reached(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(reach(spark), sf_dir)

        _QUERIES[f.__name__], _SQL[f.__name__] = reached, sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS ship_date, CAST(l_quantity AS BIGINT) AS quantity
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS FIRST, l_partkey DESC NULLS FIRST, l_suppkey DESC NULLS FIRST, l_quantity DESC NULLS FIRST) AS rn FROM lineitem)
    WHERE rn = 1
""")
def latest_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    last = latest_by(rows, ["l_orderkey", "l_linenumber"], [newest(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity")])
    return last.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("ship_date"), F.col("l_quantity").cast("long").alias("quantity"))


@query("""
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn FROM orders) WHERE rn = 1
""")
def latest_dated(spark, sf_dir):
    last = latest_by(table(spark, sf_dir, "orders"), ["o_custkey"], [newest_dated("o_orderdate"), newest_dated("o_orderkey")])
    return last.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))


@query("SELECT min(doc_id) AS doc_id, md5(text) AS hash_key FROM documents GROUP BY md5(text)")
def content_hash_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash_key"))
    return distinct_content(docs, order=[F.col("doc_id").asc()])


@query("""
    SELECT min(doc_id) AS doc_id, md5(text) AS hash_key FROM documents
    WHERE doc_id % 2 = 1 AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 2 = 0) GROUP BY md5(text)
""")
def hash_append_delta(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash_key"))
    return new_content(docs.filter("doc_id % 2 = 1"), docs.filter("doc_id % 2 = 0"), order=[F.col("doc_id").asc()])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS state FROM orders")
def keyed_upsert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("state"))
    return upsert(orders, orders.filter("o_orderkey % 3 = 0").withColumn("state", F.lit("new")).select("o_orderkey", "state"), ["o_orderkey"])


@query("SELECT conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations")
def json_element_explode(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    packed = turns.groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct("turn", "role", "text")).alias("turns"))).alias("raw_payload"))
    return elements(packed, "turns", ["turn", "role", "text"], carry=["conv_id"]).select("conv_id", "turn", "role", "text")


_DESCRIBED = """
    SELECT event_id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS cents, event_type,
        CASE event_type WHEN 'purchase' THEN 'All Data' WHEN 'view' THEN ' changes only ' WHEN 'signup' THEN 'New' WHEN 'click' THEN 'Not an amendment' END AS description
    FROM events
"""
_KINDS = f"""
    SELECT *, CASE WHEN lower(trim(description)) IN ('all data', 'alldata', 'all') THEN 'ALL_DATA' WHEN lower(trim(description)) IN ('changes only', 'changesonly', 'changes') THEN 'CHANGES_ONLY'
        WHEN lower(trim(description)) = 'new' THEN 'NEW' WHEN description IS NULL OR trim(description) = '' THEN 'NULL_DESC' ELSE 'UNKNOWN' END AS kind
    FROM ({_DESCRIBED})
"""
_SETTLED = f"""
    SELECT * EXCLUDE (kind, n_all, n_before), CASE WHEN kind <> 'NULL_DESC' THEN kind WHEN n_all > 2 AND n_before > 0 THEN 'ALL_DATA' ELSE 'NEW' END AS kind
    FROM (SELECT *, count(*) FILTER (kind = 'NULL_DESC') OVER (PARTITION BY user_id) AS n_all,
            count(*) FILTER (kind = 'NULL_DESC') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n_before FROM ({_KINDS}))
"""


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    what = F.col("event_type")
    text = F.when(what == "purchase", "All Data").when(what == "view", " changes only ").when(what == "signup", "New").when(what == "click", "Not an amendment")
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"), "event_type", text.alias("description"))


@query(f"SELECT user_id, kind, count(*) AS n FROM ({_KINDS}) GROUP BY user_id, kind")
def amend_classify(spark, sf_dir):
    return described(spark, sf_dir).withColumn("kind", kind_of("description")).groupBy("user_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT event_id, user_id, kind FROM ({_SETTLED})")
def null_descriptor_rule(spark, sf_dir):
    rows = described(spark, sf_dir).withColumn("kind", kind_of("description"))
    return settle_undescribed(rows, ["user_id"], [F.col("ts"), F.col("event_id")]).select("event_id", "user_id", "kind")


@query(f"""
    WITH settled AS ({_SETTLED}), based AS (SELECT *, max(CASE WHEN kind IN ('NEW', 'ALL_DATA') THEN ts END) OVER (PARTITION BY user_id) AS base FROM settled),
    kept AS (SELECT * FROM based WHERE base IS NULL OR ts >= base)
    SELECT user_id, (SELECT cents FROM kept k WHERE k.user_id = g.user_id AND k.event_type <> 'click' ORDER BY ts DESC, event_id DESC LIMIT 1) AS cents,
        (SELECT event_id FROM kept k WHERE k.user_id = g.user_id ORDER BY ts DESC, event_id DESC LIMIT 1) AS last_event,
        (SELECT kind FROM kept k WHERE k.user_id = g.user_id ORDER BY ts DESC, event_id DESC LIMIT 1) AS amend_kind, CAST(count(*) AS INTEGER) AS amend_postings_applied,
        CAST(max(base) AS DATE) AS baseline_day
    FROM kept g GROUP BY user_id
""")
def amendment_fold(spark, sf_dir):
    rows = described(spark, sf_dir).withColumn("cents", F.when(F.col("event_type") != "click", F.col("cents"))).withColumn("last_event", F.col("event_id"))
    folded = fold(rows, ["user_id"], ["cents", "last_event"], "description", F.col("ts"), [F.col("event_id")])
    return folded.select("user_id", "cents", "last_event", "amend_kind", "amend_postings_applied", F.col("amend_baseline_ts").cast("date").alias("baseline_day"))


@query("""
    WITH points AS (
        SELECT CAST(l_orderkey AS VARCHAR) AS k, CAST(l_partkey AS VARCHAR) AS code, CASE l_returnflag WHEN 'R' THEN 'REC' WHEN 'A' THEN 'DEL' ELSE 'OTH' END AS purpose, CAST(l_quantity AS BIGINT) AS qty,
            l_shipdate AS ts, concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)) AS h
        FROM lineitem WHERE l_linestatus = 'F'),
    once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, code, purpose ORDER BY ts DESC NULLS FIRST, h DESC) AS rn FROM points) WHERE rn = 1)
    SELECT coalesce(r.k, d.k) AS contract_key, CASE WHEN r.k IS NULL THEN 'UNPAIRED_DELIVERY' WHEN d.k IS NULL THEN 'UNPAIRED_RECEIPT' ELSE 'PAIRED' END AS pair_status,
        r.code AS receipt_loc_code, d.code AS delivery_loc_code, r.qty AS receipt_qty, d.qty AS delivery_qty, r.h AS receipt_hash_key, d.h AS delivery_hash_key
    FROM (SELECT * FROM once WHERE purpose = 'REC') r FULL OUTER JOIN (SELECT * FROM once WHERE purpose = 'DEL') d ON r.k = d.k
""")
def rec_del_pairing(spark, sf_dir):
    flag, text = F.col("l_returnflag"), lambda c: F.col(c).cast("string")
    points = table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("firmid"), text("l_partkey").alias("loc"), F.when(flag == "R", "rec").when(flag == "A", "DEL").otherwise("oth").alias("locpurp"),
        F.col("l_quantity").cast("long").cast("string").alias("kqtyloc"), F.when(F.col("l_linestatus") == "F", "LOADED").otherwise("INVALID").alias("ingestion_status"), F.col("l_shipdate").alias("ingestion_timestamp"),
        F.concat_ws("|", *map(text, ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), F.col("l_quantity").cast("long").cast("string")).alias("hash_key"),
    )
    none = dict.fromkeys(("loc_name", "loc_zone", "loc_qti", "term_begin", "term_end", "source_system", "source_api", "pipeline_run_id"))
    paths = pair(points, Pairing("firm", none))
    return paths.select("contract_key", "pair_status", "receipt_loc_code", "delivery_loc_code", *[F.col(f"{s}_qty_dth").cast("long").alias(f"{s}_qty") for s in ("receipt", "delivery")], "receipt_hash_key", "delivery_hash_key")


def scoped_customers(spark: SparkSession, sf_dir: str, verdicts: list[tuple]) -> DataFrame:
    mapping = spark.createDataFrame(verdicts, "source string, kholdernumber string, action string")
    customers = table(spark, sf_dir, "customer").withColumn("number", F.concat(F.lit(" "), F.col("c_nationkey").cast("string")))
    return scoped(customers, mapping, "firm", "number").select("c_custkey", "c_nationkey")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (1, 2, 3)")
def scope_add_remove(spark, sf_dir):
    return scoped_customers(spark, sf_dir, [("firm", "1", "add"), (" Firms ", " 2 ", "add"), (None, "3", "add"), ("gTRAN_FIRM", "4", "add"), ("firm", "4", "remove"), ("awards", "5", "add"), ("it", "1", "remove")])


@query("SELECT c_custkey, c_nationkey FROM customer")
def scope_unconfigured(spark, sf_dir):
    return scoped_customers(spark, sf_dir, [("awards", "1", "add"), ("interruptible", "2", "remove")])


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (7, 8)")
def scope_remove_only(spark, sf_dir):
    return scoped_customers(spark, sf_dir, [("firm", "7", "remove"), (None, "8", "remove")])


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey = 9")
def scope_remove_wins(spark, sf_dir):
    return scoped_customers(spark, sf_dir, [("firm", "9", "add"), ("firm", "10", "add"), (None, "10 ", "remove")])


_ID = "l_partkey * 1000000000000 + l_suppkey * 100000000 + CAST(l_quantity AS BIGINT) * 1000000 + CAST(round(l_discount * 100) AS BIGINT) * 10000 + CAST(round(l_tax * 100) AS BIGINT) * 100 + ascii(l_returnflag)"


@query(f"""
    WITH rates AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS FIRST, {_ID} DESC NULLS FIRST) AS rn FROM lineitem) WHERE rn = 1),
    points AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_shipdate DESC NULLS FIRST, {_ID} DESC NULLS FIRST) AS rn FROM lineitem) WHERE rn = 1)
    SELECT CAST(r.l_orderkey AS VARCHAR) AS firm_id, CAST(r.l_linenumber AS VARCHAR) AS rate_unique_id, o_custkey AS tsp_duns, CAST(round(o_totalprice) AS BIGINT) AS contract_qty_dth, CAST(o_orderdate AS DATE) AS contract_begin,
        365 AS contract_term_days, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_negotiated_rate, CAST(r.l_suppkey AS VARCHAR) AS receipt_loc_code, CAST(r.l_partkey % 100 AS VARCHAR) AS delivery_loc_code,
        CAST(lr.l_quantity AS BIGINT) AS receipt_point_qty, CAST(ld.l_quantity AS BIGINT) AS delivery_point_qty, CAST(nullif(round(r.l_discount * 100), 0) AS BIGINT) AS rate_charged,
        CAST(round(r.l_discount * 100) AS BIGINT) + CAST(round(r.l_tax * 100) AS BIGINT) AS all_in_rate, CASE r.l_returnflag WHEN 'R' THEN TRUE WHEN 'N' THEN FALSE END AS is_market_based_rate
    FROM rates r JOIN orders ON o_orderkey = r.l_orderkey LEFT JOIN points lr ON lr.l_orderkey = r.l_orderkey AND lr.l_suppkey = r.l_suppkey
    LEFT JOIN points ld ON ld.l_orderkey = r.l_orderkey AND ld.l_suppkey = r.l_partkey % 100
""")
def transport_rate_star(spark, sf_dir):
    text = lambda e: F.expr(f"CAST({e} AS STRING)")
    blank = lambda *names: [F.lit("").alias(n) for n in names]
    lineage = [F.lit("x").alias(n) for n in ("source_system", "source_api", "pipeline_run_id", "hash_key")]
    loaded = F.lit("LOADED").alias("ingestion_status")
    contracts = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("firmid"), text("o_orderkey").alias("id"), F.lit("t").alias("tspname"), text("o_custkey").alias("tspduns"), text("CAST(round(o_totalprice) AS BIGINT)").alias("kqtyk"),
        text("CAST(o_orderdate AS DATE)").alias("kbegdatetime"), text("date_add(CAST(o_orderdate AS DATE), 365)").alias("kenddatetime"), F.expr("CASE o_orderstatus WHEN 'F' THEN 'y' WHEN 'O' THEN 'N' ELSE '' END").alias("ngtdrateind"),
        *blank("kholdername", "ratesch", "svcreqk", "kstat", "kstatdesc"), F.col("o_orderdate").alias("ingestion_timestamp"), F.col("o_orderkey").alias("bronze_row_id"), loaded, *lineage,
    )
    lines = table(spark, sf_dir, "lineitem")
    rates = lines.select(
        text("l_orderkey").alias("firmid"), text("l_linenumber").alias("uniqueid"), text("l_suppkey").alias("recloc"), text("l_partkey % 100").alias("delloc"),
        F.expr("coalesce(CAST(nullif(CAST(round(l_discount * 100) AS BIGINT), 0) AS STRING), '')").alias("ratechgd"), text("CAST(round(l_tax * 100) AS BIGINT)").alias("totsurchg"),
        F.expr("CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'N' THEN 'n' ELSE '' END").alias("mktbasedrateind"),
        *blank("reclocname", "recloczn", "dellocname", "delloczn", "rateformtype", "rateformtypedesc", "rateid", "maxtrfrate", "surchgind", "seasnlst", "seasnlend", "kentbegdatetime", "kentenddatetime", "posteddatetime"),
        F.col("l_shipdate").alias("ingestion_timestamp"), F.expr(_ID).alias("bronze_row_id"), loaded, *lineage,
    )
    points = lines.select(text("l_orderkey").alias("firmid"), text("l_suppkey").alias("loc"), text("CAST(l_quantity AS BIGINT)").alias("kqtyloc"), F.col("l_shipdate").alias("ingestion_timestamp"), F.expr(_ID).alias("bronze_row_id"), loaded)
    out = transport_rates(contracts, rates, points)
    whole = lambda c, n: F.col(c).cast("long").alias(n)
    return out.select(
        "firm_id", "rate_unique_id", "tsp_duns", whole("contract_qty_dth", "contract_qty_dth"), F.col("contract_begin_ts").cast("date").alias("contract_begin"), "contract_term_days", "is_negotiated_rate", "receipt_loc_code", "delivery_loc_code",
        whole("receipt_point_qty_dth", "receipt_point_qty"), whole("delivery_point_qty_dth", "delivery_point_qty"), whole("rate_charged", "rate_charged"), whole("all_in_rate", "all_in_rate"), "is_market_based_rate",
    )


_MODEL = {"key": "string", "day": "date", "quantity": "bigint", "note": "string", "source": "string"}


def model_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame | None]:
    lines = project_model(table(spark, sf_dir, "lineitem"), _MODEL, {"key": F.col("l_orderkey"), "day": F.col("l_shipdate"), "quantity": F.col("l_quantity"), "source": F.lit("L")})
    orders = project_model(table(spark, sf_dir, "orders"), _MODEL, {"key": F.col("o_orderkey"), "day": F.col("o_orderdate"), "note": F.col("o_orderpriority"), "source": F.lit("O")})
    events = project_model(table(spark, sf_dir, "events"), _MODEL, {"key": F.col("user_id"), "note": F.col("event_type"), "source": F.lit("E")})
    return {"lines": lines, "orders": orders, "none": None, "events": events}


_MAPPED = {
    "lines": "SELECT CAST(l_orderkey AS VARCHAR) AS key, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS quantity, CAST(NULL AS VARCHAR) AS note, 'L' AS source FROM lineitem",
    "orders": "SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(o_orderdate AS DATE) AS day, CAST(NULL AS BIGINT) AS quantity, o_orderpriority AS note, 'O' AS source FROM orders",
    "events": "SELECT CAST(user_id AS VARCHAR) AS key, CAST(NULL AS DATE) AS day, CAST(NULL AS BIGINT) AS quantity, event_type AS note, 'E' AS source FROM events",
}


@query(_MAPPED["orders"])
def model_map_typed_null(spark, sf_dir):
    return model_feeds(spark, sf_dir)["orders"]


@query(" UNION ALL ".join(f"SELECT '{f}' AS source_type, * FROM ({sql})" for f, sql in _MAPPED.items()))
def final_union_tagged(spark, sf_dir):
    return union_tagged(model_feeds(spark, sf_dir))


@query(f"SELECT 'orders' AS source_type, * FROM ({_MAPPED['orders']})")
def final_union_missing_feeds(spark, sf_dir):
    return union_tagged(dict.fromkeys(("lines", "none")) | {"orders": model_feeds(spark, sf_dir)["orders"]})


@query("""
    SELECT customer, CAST(update_date AS DATE) AS updated, CAST(posted_date AS DATE) AS posted
    FROM (SELECT *, row_number() OVER (PARTITION BY customer ORDER BY update_date DESC NULLS LAST, posted_date DESC NULLS LAST) AS rn
        FROM (SELECT o_custkey AS customer, CASE WHEN o_orderkey % 4 > 0 THEN date_trunc('year', o_orderdate) END AS update_date, o_orderdate AS posted_date FROM orders)) WHERE rn = 1
""")
def latest_in_model_key(spark, sf_dir):
    updated = F.when(F.col("o_orderkey") % 4 > 0, F.date_trunc("year", "o_orderdate"))  # ties and nulls that the second date decides
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), updated.alias("update_date"), F.col("o_orderdate").alias("posted_date"))
    return latest_in_model(rows, ["customer"]).select("customer", F.col("update_date").cast("date").alias("updated"), F.col("posted_date").cast("date").alias("posted"))


@query("SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS flag FROM lineitem")
def yes_no_decode(spark, sf_dir):
    letter = F.expr("CASE l_returnflag WHEN 'R' THEN 'y' WHEN 'A' THEN 'N' ELSE l_returnflag || '?' END")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", yes_no(letter).alias("flag"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS number, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS DOUBLE) + 0.25 END AS amount,
        CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_orderkey % 5 <> 0 THEN 30 END AS days, ' ' AS space
    FROM orders
""")
def nullif_cast(spark, sf_dir):
    blank = lambda e: F.expr(f"CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST({e} AS STRING) END")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", blank("o_custkey").alias("n"), blank("o_custkey || '.25'").alias("a"), blank("CAST(o_orderdate AS DATE)").alias("t"), blank("date_add(CAST(o_orderdate AS DATE), 30)").alias("u"))
    return rows.select("o_orderkey", bigint("n").alias("number"), numeric("a").cast("double").alias("amount"), date("t").alias("day"), days_between("t", "u").alias("days"), blank_to_null(F.lit(" ")).alias("space"))


@query("SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS seconds FROM orders")
def timestamp_text(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", timestamp(F.col("o_orderdate").cast("string")).cast("long").alias("seconds"))


_DOC = Feed("doc", "records", "docs", "doc_id", ("lang", "Source"), ("Batch",))
_ORDER = Feed("order", "records", "kept", "k", ())


def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload file of one record for each document, parsed by the library."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id"), F.expr("CASE WHEN lang <> 'en' THEN lang END").alias("lang"), F.expr("CASE source WHEN 'src0' THEN ' ' WHEN 'src1' THEN '\\t\\n' ELSE source END").alias("source"), F.expr("doc_id % 3 = 0").alias("even"),
        F.struct(F.col("n_chars").alias("b"), F.array("doc_id").alias("a")).alias("inner"),
    )
    record = F.struct("doc_id", "lang", "source", "even", "inner")
    payload = F.struct(F.lit("doc").alias("feedType"), F.concat(F.lit("b"), F.col("doc_id") % 2).alias("Batch"), F.array(record).alias("records"))
    return parse_files(docs.select(F.col("doc_id").cast("string").alias("file"), F.to_json(payload).alias("value")), {"doc": _DOC})


@query("""
    SELECT doc_id, concat_ws(',', CASE WHEN lang = 'en' THEN 'lang' END, CASE WHEN source IN ('src0', 'src1') THEN 'Source' END) AS missing,
        CASE WHEN lang = 'en' OR source IN ('src0', 'src1') THEN 'INVALID' ELSE 'LOADED' END AS ingestion_status
    FROM documents
""")
def validate_required(spark, sf_dir):
    status = F.when(F.size("missing") > 0, "INVALID").otherwise("LOADED").alias("ingestion_status")
    return payload_rows(spark, sf_dir).select(F.col("raw_record_id").cast("long").alias("doc_id"), F.array_join("missing", ",").alias("missing"), status)


@query("""
    SELECT doc_id, sha256('{"batch": "b' || doc_id % 2 || '", "doc_id": "' || doc_id || '", "even": "' || CASE WHEN doc_id % 3 = 0 THEN 'true' ELSE 'false' END || '", "inner": "{\\"a\\":[' || doc_id || '],\\"b\\":' || n_chars || '}"'
            || CASE WHEN lang <> 'en' THEN ', "lang": "' || lang || '"' ELSE '' END || ', "source": "' || CASE source WHEN 'src0' THEN ' ' WHEN 'src1' THEN '\\t\\n' ELSE source END || '"}') AS hash_key,
        'b' || doc_id % 2 AS batch, CASE WHEN doc_id % 3 = 0 THEN 'true' ELSE 'false' END AS even, '{"a":[' || doc_id || '],"b":' || n_chars || '}' AS inner_text
    FROM documents
""")
def payload_content(spark, sf_dir):
    value = lambda c: F.col("business").getItem(c)
    return payload_rows(spark, sf_dir).select(F.col("raw_record_id").cast("long").alias("doc_id"), "hash_key", value("batch").alias("batch"), value("even").alias("even"), value("inner").alias("inner_text"))


@query("SELECT 'docs' AS table_name, 'doc' AS feed, count(*) AS objects_read, CAST(sum(CASE WHEN lang = 'en' OR source IN ('src0', 'src1') THEN 1 ELSE 0 END) AS BIGINT) AS rows_rejected FROM documents")
def ingest_log_summary(spark, sf_dir):
    return tallies(payload_rows(spark, sf_dir)).withColumnRenamed("table", "table_name")


@query("""
    SELECT o_orderkey AS file, CASE WHEN o_orderkey % 7 = 0 THEN 'not JSON' WHEN o_orderkey % 7 = 1 THEN 'not an object' WHEN o_orderkey % 7 = 2 THEN 'unknown feed ' || chr(39) || 'x' || chr(39) WHEN o_orderkey % 7 = 3 THEN 'no feed type' END AS error,
        CASE WHEN o_orderkey % 7 = 4 THEN 'a' WHEN o_orderkey % 7 = 5 THEN 'b' WHEN o_orderkey % 7 = 6 THEN 'source/order' END AS source_api
    FROM orders
""")
def payload_errors(spark, sf_dir):
    """Bad payloads by their errors, and the interface of the others: as given, in either spelling, or made up of the feed."""
    n, given = F.col("o_orderkey") % 7, F.concat(F.lit('{"feedType":"order","records":{"k":1},'), F.expr("CASE o_orderkey % 7 WHEN 4 THEN '\"sourceApi\":\"a\",\"source_api\":\"b\"' WHEN 5 THEN '\"sourceApi\":\"\",\"source_api\":\"b\"' ELSE '\"sourceApi\":null' END"), F.lit("}"))
    text = F.when(n == 0, "{").when(n == 1, "[1]").when(n == 2, '{"feedType":"x"}').when(n == 3, "{}").otherwise(given)
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("file"), text.alias("value"))
    return parse_files(files, {"order": _ORDER}).select(F.col("file").cast("long").alias("file"), F.regexp_replace("error", "not JSON: .*", "not JSON").alias("error"), "source_api")


class DriverTables(Tables):
    """The driver's tables as a layer of the library's."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{table}.parquet"

    def list(self, layer: str) -> list[str]:
        return sorted(n.removesuffix(".parquet") for n in self._names(self.root) if n.endswith(".parquet"))


_TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part", "region", "supplier")


@query(" UNION ALL ".join(f"SELECT 'raw' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES))
def table_inventory(spark, sf_dir):
    return inventory(DriverTables(spark, sf_dir), ("raw",))


@query("""
    SELECT name, held FROM (VALUES ('orders by key', (SELECT count(*) = count(DISTINCT o_orderkey) FROM orders)), ('lineitem by order', (SELECT count(*) = count(DISTINCT l_orderkey) FROM lineitem)),
        ('events with null keys apart', (SELECT count(k) = count(DISTINCT k) FROM (SELECT CASE WHEN event_id % 2 = 0 THEN event_id END AS k FROM events))),
        ('events with null keys equal', (SELECT count(*) FILTER (k IS NULL) < 2 FROM (SELECT CASE WHEN event_id % 2 = 0 THEN event_id END AS k FROM events))),
        ('orders without nulls', (SELECT count(*) = count(o_custkey) FROM orders)), ('events with nulls', (SELECT count(*) = count(CASE WHEN event_id % 2 = 0 THEN 1 END) FROM events)),
        ('states', (SELECT count(*) = 0 FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P'))), ('fewer states', (SELECT count(*) = 0 FROM orders WHERE o_orderstatus NOT IN ('F', 'O')))) checks(name, held)
""")
def constraint_checks(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    events = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("k"))
    checks = {
        "orders by key": lambda: require_unique(orders, ["o_orderkey"]), "lineitem by order": lambda: require_unique(lines, ["l_orderkey"]), "events with null keys apart": lambda: require_unique(events, ["k"], nulls_distinct=True),
        "events with null keys equal": lambda: require_unique(events, ["k"]), "orders without nulls": lambda: require_not_null(orders, ["o_custkey", "o_orderkey"]), "events with nulls": lambda: require_not_null(events, ["k"]),
        "states": lambda: require_values(orders, "o_orderstatus", ["F", "O", "P"]), "fewer states": lambda: require_values(orders, "o_orderstatus", ["F", "O"]),
    }

    def held(check) -> bool:
        try:
            check()
        except ConstraintError:
            return False
        return True

    return spark.createDataFrame([(name, held(check)) for name, check in checks.items()], "name string, held boolean")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders")
def dense_row_ids(spark, sf_dir):
    return numbered(table(spark, sf_dir, "orders").select("o_orderkey"), [F.col("o_orderkey").asc()], "n")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN row_number() OVER (PARTITION BY o_orderkey % 3 > 0 ORDER BY o_orderkey) ELSE (SELECT count(*) FROM orders WHERE o_orderkey % 3 > 0) + row_number() OVER (PARTITION BY o_orderkey % 3 > 0 ORDER BY o_orderkey) END AS n
    FROM orders
""")
def numbers_kept(spark, sf_dir):
    """A reload with more rows: old keys keep their numbers, new ones get the next."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return renumbered(orders, renumbered(orders.filter("o_orderkey % 3 > 0"), None, ["o_orderkey"], "n"), ["o_orderkey"], "n")


@query("""
    SELECT event_id, CASE event_type WHEN 'click' THEN 'firm' WHEN 'view' THEN 'interruptible' WHEN 'purchase' THEN 'awards' WHEN 'signup' THEN 'index' ELSE '_combined' END AS feed FROM events
""")
def feed_labels(spark, sf_dir):
    label = F.expr("CASE event_type WHEN 'click' THEN ' Firms' WHEN 'view' THEN 'gTRAN_IT ' WHEN 'purchase' THEN 'AWARD' WHEN 'signup' THEN 'gindex' WHEN 'error' THEN 'something' END")
    return table(spark, sf_dir, "events").select("event_id", feed_name_of(label).alias("feed"))


@query("""
    SELECT 'it: ' || action || ' ' || number || ' n' || number AS line, row_number() OVER (ORDER BY action, 'n' || number, number) AS place FROM (SELECT n_nationkey AS number, CASE WHEN n_regionkey = 0 THEN 'remove' ELSE 'add' END AS action FROM nation WHERE n_regionkey < 2)
    UNION ALL SELECT (SELECT count(*) FROM nation WHERE n_regionkey = 1) || ' on the allow list', (SELECT count(*) + 1 FROM nation WHERE n_regionkey < 2)
""")
def report_order(spark, sf_dir):
    """The report on partners, line by line as it comes."""
    nations = table(spark, sf_dir, "nation").filter("n_regionkey < 3")
    action, source = F.when(F.col("n_regionkey") == 0, "remove").otherwise("add"), F.when(F.col("n_regionkey") < 2, "it").otherwise("firm")
    number = F.col("n_nationkey").cast("string")
    mapping = nations.select(source.alias("source"), number.alias("kholdernumber"), F.concat(F.lit("n"), number).alias("kholdername"), action.alias("action"))
    return spark.createDataFrame([(line, n) for n, line in enumerate(describe(mapping, "gtran_it"), start=1)], "line string, place long")


@query("""
    SELECT o_orderkey, '{"a":"' || o_orderstatus || '","b":{"x":' || o_custkey || ',"y":null}}' AS element_text, md5('{"a":"' || o_orderstatus || '","b":{"x":' || o_custkey || ',"y":null}}') AS hash_key FROM orders WHERE o_orderkey % 5 = 0
""")
def element_hash(spark, sf_dir):
    """Only arrays give elements: not texts that look like one, objects, nulls or nothing. Keys are sorted for the hash."""
    element = F.format_string('{"b": {"y": null, "x": %d}, "a": "%s"}', "o_custkey", "o_orderstatus")
    n = F.col("o_orderkey") % 5
    section = F.when(n == 0, F.concat(F.lit('"items": ['), element, F.lit("]"))).when(n == 1, '"items": "[1, 2]"').when(n == 2, '"items": {"a": 1}').when(n == 3, '"items": null').otherwise('"other": [1]')
    packed = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("{"), section, F.lit("}")).alias("raw_payload"))
    return elements(packed, "items", ["a"], carry=["o_orderkey"]).select("o_orderkey", canonical(F.col("element")).alias("element_text"), "hash_key")


@query("SELECT min(conv_id) AS conv_id, role, md5('{\"role\":\"' || role || '\",\"turn\":' || turn || '}') AS hash_key FROM conversations GROUP BY role, turn")
def element_dedup(spark, sf_dir):
    """Equal elements of several parents are one row, which the first parent keeps."""
    turns = table(spark, sf_dir, "conversations")
    packed = turns.groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct("turn", "role")).alias("turns"))).alias("raw_payload"))
    return distinct_content(elements(packed, "turns", ["role"], carry=["conv_id"]), order=[F.col("conv_id").asc()]).select("conv_id", "role", "hash_key")


_RUNNING = _SETTLED.replace("n_all > 2 AND n_before > 0", "n_all > 3 AND n_before > 1")


@query(f"""
    WITH settled AS ({_RUNNING}), based AS (SELECT *, max(CASE WHEN kind IN ('NEW', 'ALL_DATA') THEN ts END) OVER (PARTITION BY key) AS base FROM (SELECT *, CASE WHEN user_id % 3 > 0 THEN user_id END AS key FROM settled WHERE event_type <> 'signup')),
    kept AS (SELECT * FROM based WHERE ts >= base)
    SELECT key, (SELECT event_id FROM kept k WHERE k.key IS NOT DISTINCT FROM g.key ORDER BY ts DESC, event_id DESC LIMIT 1) AS last_event, CAST(count(*) AS INTEGER) AS amend_postings_applied FROM kept g GROUP BY key
""".replace("PARTITION BY user_id", "PARTITION BY CASE WHEN user_id % 3 > 0 THEN user_id END").replace("FROM events\n", "FROM events WHERE event_type <> 'signup'\n"))
def amendment_fold_strict(spark, sf_dir):
    """Null keys are one group, a second undescribed posting counts as new, too, and groups without a baseline are dropped."""
    rows = described(spark, sf_dir).filter("event_type <> 'signup'").withColumn("key", F.expr("CASE WHEN user_id % 3 > 0 THEN user_id END")).withColumn("last_event", F.col("event_id"))
    folded = fold(rows, ["key"], ["last_event"], "description", F.col("ts"), [F.col("event_id")], NullRule(group=3, running=2), orphans=False)
    return folded.select("key", "last_event", "amend_postings_applied")


@query("""
    WITH points AS (SELECT l_orderkey AS k, l_linenumber AS code, CAST(l_quantity AS BIGINT) AS qty, l_returnflag AS flag FROM lineitem WHERE l_returnflag IN ('R', 'A'))
    SELECT coalesce(r.k, d.k) AS contract_key, CASE WHEN r.k IS NULL THEN 'UNPAIRED_DELIVERY' WHEN d.k IS NULL THEN 'UNPAIRED_RECEIPT' ELSE 'PAIRED' END AS pair_status, r.code AS receipt_code, d.code AS delivery_code
    FROM (SELECT * FROM points WHERE flag = 'R') r FULL OUTER JOIN (SELECT * FROM points WHERE flag = 'A') d ON r.k = d.k AND r.qty >= d.qty
""")
def pairing_rule(spark, sf_dir):
    """A rule beside the contract decides on pairs; what it leaves alone is unpaired."""
    text = lambda c: F.col(c).cast("string")
    lines = table(spark, sf_dir, "lineitem").select(text("l_orderkey").alias("firmid"), text("l_linenumber").alias("loc"), F.expr("CASE l_returnflag WHEN 'R' THEN 'REC' WHEN 'A' THEN 'DEL' END").alias("locpurp"), F.col("l_quantity").cast("long").cast("string").alias("kqtyloc"), F.lit("LOADED").alias("ingestion_status"), F.lit(1).alias("ingestion_timestamp"))
    none = dict.fromkeys(("loc_name", "loc_zone", "loc_qti", "term_begin", "term_end", "source_system", "source_api", "pipeline_run_id", "hash_key"))
    paths = pair(lines, Pairing("firm", none, newest_only=False, rule=lambda r, d: r("loc_qty") >= d("loc_qty"), typed={"loc_qty": bigint}))
    return paths.select(F.col("contract_key").cast("long").alias("contract_key"), "pair_status", F.col("receipt_loc_code").cast("int").alias("receipt_code"), F.col("delivery_loc_code").cast("int").alias("delivery_code"))


_HOT = "CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE CAST(l_orderkey AS {text}) END"
_ENDS = "CASE WHEN l_returnflag = 'R' THEN 'REC' WHEN l_returnflag = 'A' AND (l_orderkey % 3 > 0 OR l_partkey % 500 = 0) THEN 'DEL' ELSE 'OTH' END"


@query(f"""
    WITH points AS (SELECT {_HOT.format(text="VARCHAR")} AS k, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS code, CAST(l_quantity AS BIGINT) AS qty, {_ENDS} AS purpose FROM lineitem)
    SELECT coalesce(r.k, d.k) AS contract_key, CASE WHEN r.k IS NULL THEN 'UNPAIRED_DELIVERY' WHEN d.k IS NULL THEN 'UNPAIRED_RECEIPT' ELSE 'PAIRED' END AS pair_status, r.code AS receipt_code, d.code AS delivery_code
    FROM (SELECT * FROM points WHERE purpose = 'REC') r FULL OUTER JOIN (SELECT * FROM points WHERE purpose = 'DEL') d ON r.k = d.k AND r.qty > d.qty
""")
def pairing_hot_contract(spark, sf_dir):
    """One contract has a third of all points, and pairs by a rule that leaves points of both sides alone."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr(_HOT.format(text="STRING")).alias("firmid"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("loc"), F.expr(_ENDS).alias("locpurp"), F.col("l_quantity").cast("long").cast("string").alias("kqtyloc"),
        F.lit("LOADED").alias("ingestion_status"), F.lit(1).alias("ingestion_timestamp"),
    )
    none = dict.fromkeys(("loc_name", "loc_zone", "loc_qti", "term_begin", "term_end", "source_system", "source_api", "pipeline_run_id", "hash_key"))
    paths = pair(lines, Pairing("firm", none, newest_only=False, rule=lambda r, d: r("loc_qty") > d("loc_qty"), typed={"loc_qty": bigint}))
    return paths.select("contract_key", "pair_status", F.col("receipt_loc_code").alias("receipt_code"), F.col("delivery_loc_code").alias("delivery_code"))


class Scratch(Tables):
    """Tables in a folder of their own beside the checkpoints, which goes once a result is computed."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark, f"{shared_dir(spark)}/tables-{uuid.uuid4().hex}")

    def last(self, result: DataFrame) -> DataFrame:
        kept = cut(result)
        fs, p = self._files(self.root)
        fs.delete(p, True)
        return kept


def raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table of firm contracts that ingestion makes of a payload for each order, its lines as nested locations."""
    text = lambda c: F.col(c).cast("string")
    line = F.struct(text("l_linenumber").alias("Index"), F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long")).alias("UniqueId"), text("l_partkey").alias("Loc"), F.expr("CASE l_returnflag WHEN 'R' THEN 'REC' ELSE 'DEL' END").alias("LocPurp"), F.col("l_quantity").cast("long").alias("KQtyLoc"), text("l_orderkey").alias("Pk"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("locations"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'")
    record = F.struct(
        text("o_orderkey").alias("id"), text("o_orderkey").alias("FIRMID"), F.col("o_custkey").alias("KHolder"), F.round("o_totalprice").cast("long").alias("KQtyK"), day.alias("KBegDateTime"), F.lit("").alias("KEndDateTime"),
        F.expr("CASE WHEN o_orderkey % 4 = 0 THEN 'All Data' ELSE 'New' END").alias("AmendRptgDesc"), day.alias("PostedDateTime"), F.col("locations"), F.lit("x").alias("unknown"),
    )
    payload = F.struct(F.lit("gTRAN_FIRM").alias("feedType"), F.lit("S").alias("sourceSystem"), F.lit(61).alias("TspDuns"), F.lit("T").alias("TspName"), F.array(record).alias("contracts"))
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    files = orders.select(text("o_orderkey").alias("file"), F.to_json(payload).alias("value"))
    return raw_rows(parse_files(files, FEEDS), "gtran_firm", "run").withColumn("bronze_row_id", F.col("file").cast("long"))


def built(tables: dict[str, DataFrame], *names: str) -> DataFrame:
    """The last of some plans of the registry, each built from the raw table and the plans before it."""
    registry = default_registry()
    for name in names:
        plan = registry[name]
        tables[plan.table] = plan.build(tables)
    return tables[plan.table]


@query("""
    SELECT o_orderkey AS file, CAST(o_orderkey AS VARCHAR) AS raw_record_id, '61' AS tspduns, CAST(o_custkey AS VARCHAR) AS kholder, 'S' AS source_system, 'source/gTRAN_FIRM' AS source_api, 'run' AS pipeline_run_id, 'LOADED' AS ingestion_status,
        CAST(NULL AS VARCHAR) AS cycle, count(*) AS n_locations
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey
""")
def raw_ingestion_rows(spark, sf_dir):
    rows = raw_contracts(spark, sf_dir)
    return rows.select(
        F.col("file").cast("long").alias("file"), "raw_record_id", "tspduns", "kholder", "source_system", "source_api", "pipeline_run_id", "ingestion_status", "cycle",
        F.size(F.from_json("locations", "array<string>")).cast("long").alias("n_locations"),
    )


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS ngh_contract_id, '61' AS pipeline_duns, 'T' AS pipeline_name, CAST(o_custkey AS VARCHAR) AS contract_holder_duns, CAST(round(o_totalprice) AS BIGINT) AS contract_quantity, CAST(o_orderdate AS DATE) AS begin_day,
        CAST(NULL AS DATE) AS end_day, 'FIRM' AS contract_type, 'gTRAN FIRM' AS source, 'firm' AS source_type, CAST(NULL AS VARCHAR) AS award_number
    FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def final_core_of_payloads(spark, sf_dir):
    """From payloads through deduplication, amendments, staging and the feed's model to the final table."""
    names = ("silver_firm_core_dedup", "silver_firm_core_amended", "silver_firm_core", "silver_firm_core_master_capacity", "silver_final_core_master_capacity")
    kept, tables = Scratch(spark), {"gtran_firm": raw_contracts(spark, sf_dir)}
    texts = dict.fromkeys(("locations", "rates", "raw_payload"), "string")  # no core table reads them
    once = built(tables, names[0])
    tables["firm_core_dedup"] = with_nulls(kept.replace("silver", "firm_core_dedup", once.drop(*texts)), texts)  # the fold reads it more than once, which would parse all files each time
    built(tables, names[1])
    tables["firm_core_amended"] = tables["firm_core_amended"].withColumn("amended_ts", F.current_timestamp())
    final = built(tables, *names[2:])
    out = final.select(
        "ngh_contract_id", "pipeline_duns", "pipeline_name", "contract_holder_duns", F.col("contract_quantity").cast("long").alias("contract_quantity"), F.col("begin_date").cast("date").alias("begin_day"),
        F.col("end_date").cast("date").alias("end_day"), "contract_type", "source", "source_type", "award_number",
    )
    return kept.last(out)


@query("""
    SELECT firmid, index, uniqueid, loc, locpurp, quantity, begin_day, tspduns FROM (
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS firmid, CAST(l_linenumber AS BIGINT) AS index, concat_ws('-', l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)) AS uniqueid, CAST(l_partkey AS VARCHAR) AS loc, CASE l_returnflag WHEN 'R' THEN 'REC' ELSE 'DEL' END AS locpurp,
            CAST(l_quantity AS BIGINT) AS quantity, CAST(o_orderdate AS DATE) AS begin_day, CAST(NULL AS VARCHAR) AS tspduns
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
""")
def staged_locations_of_payloads(spark, sf_dir):
    """Nested locations as rows, distinct by content, the newest of each key, with their contract's dates."""
    staged = built({"gtran_firm": raw_contracts(spark, sf_dir)}, "silver_firm_locations_dedup", "silver_firm_locations")
    return staged.select("firmid", "index", "uniqueid", "loc", "locpurp", F.col("kqtyloc").cast("long").alias("quantity"), F.to_date(F.substring("transactiontermbegindatetime", 1, 10)).alias("begin_day"), "tspduns")


@query("SELECT conv_id, to_json({'turn': turn, 'role': role}) AS first_text, '[1,' || turn || ']' AS list_text, role FROM conversations")
def nested_to_text(spark, sf_dir):
    """Nested columns as an export writes them."""
    turns = table(spark, sf_dir, "conversations")
    return as_text(turns.select("conv_id", F.struct("turn", "role").alias("first_text"), F.array(F.lit(1), F.col("turn")).alias("list_text"), "role"))


@query("""
    WITH d AS (SELECT doc_id, md5(text) AS hash_key, doc_id % 4 AS load FROM documents), first AS (SELECT *, row_number() OVER (PARTITION BY hash_key ORDER BY load, doc_id) AS rn FROM d)
    SELECT doc_id, hash_key, row_number() OVER (ORDER BY load, doc_id) AS bronze_row_id FROM first WHERE rn = 1 OR hash_key IS NULL
""")
def append_numbered(spark, sf_dir):
    """New content of four loads, numbered on from load to load; files that can't hold a load's hashes are not read."""
    tables, docs = Scratch(spark), table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash_key"))
    for load in range(4):
        tables.append_new("raw", "docs", docs.filter(F.col("doc_id") % 4 == load), [F.col("doc_id").asc()])
    return tables.last(tables.read("raw", "docs").select("doc_id", "hash_key", "bronze_row_id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 >= 3 THEN 'new' ELSE o_orderstatus END AS state FROM orders")
def upsert_touched_files(spark, sf_dir):
    """An upsert of known and of new keys into a table of files, of which only those with one of its keys are written anew."""
    tables, orders = Scratch(spark), table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("state"))
    tables.upsert("raw", "orders", orders.filter("o_orderkey % 5 < 4"), ["o_orderkey"])
    tables.upsert("raw", "orders", orders.filter("o_orderkey % 5 >= 3").withColumn("state", F.lit("new")), ["o_orderkey"])
    return tables.last(tables.read("raw", "orders"))


@query(_SQL["amendment_fold"])
def amendment_fold_incremental(spark, sf_dir):
    """The fold of postings that come in three batches, the last ones first."""
    tables = Scratch(spark)
    rows = described(spark, sf_dir).withColumn("cents", F.when(F.col("event_type") != "click", F.col("cents"))).withColumn("last_event", F.col("event_id"))
    kept = AmendmentFold(tables, "silver", "events", ["user_id"], ["cents", "last_event"], "description", F.col("ts"), [F.col("event_id")], NullRule())
    for batch in range(3):
        kept.add(rows.filter(F.dayofmonth("ts") % 3 == 2 - batch), ("events", batch))
    return tables.last(kept.current().select("user_id", "cents", "last_event", "amend_kind", "amend_postings_applied", F.col("amend_baseline_ts").cast("date").alias("baseline_day")))


def payload_files(spark: SparkSession, sf_dir: str, tables: Tables) -> str:
    """Files of firm contracts, an array of the orders of a thousand keys in each; where they are."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_partkey").cast("string").alias("Loc"), F.lit("REC").alias("LocPurp"))).alias("locations"))
    text, day = lambda c: F.col(c).cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'")
    record = F.struct(
        text("o_orderkey").alias("id"), text("o_orderkey").alias("FIRMID"), F.col("o_custkey").alias("KHolder"), F.round("o_totalprice").cast("long").alias("KQtyK"), day.alias("KBegDateTime"), F.lit("").alias("KEndDateTime"),
        F.expr("CASE WHEN o_orderkey % 4 = 0 THEN 'All Data' ELSE 'New' END").alias("AmendRptgDesc"), day.alias("PostedDateTime"), F.coalesce("locations", F.array()).alias("locations"), F.array().alias("rates"),
    )
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy(F.floor(F.col("o_orderkey") / 1000).alias("file")).agg(F.collect_list(record).alias("contracts"))
    payload = F.struct(F.lit("gTRAN_FIRM").alias("feedType"), F.lit("S").alias("sourceSystem"), F.lit("61").alias("TspDuns"), F.lit("T").alias("TspName"), "contracts")
    orders.select("file", F.to_json(payload).alias("value")).write.partitionBy("file").option("compression", "gzip").text(f"{tables.root}/landing")
    return f"{tables.root}/landing/*/*.txt.gz"


@query("""
    SELECT run, n AS objects_read, CASE WHEN run = 1 THEN n ELSE 0 END AS rows_written, 0 AS rows_rejected, 'Succeeded' AS pipeline_status, 'Pass' AS data_validation_status, 'S' AS source_system
    FROM (SELECT CAST(count(*) AS INTEGER) AS n FROM orders), (VALUES (1), (2)) runs(run)
""")
def ingestion_runs(spark, sf_dir):
    """What the log says of two runs over the same files: the second finds nothing new."""
    tables = Scratch(spark)
    files = payload_files(spark, sf_dir, tables)
    for _ in range(2):
        ingest(spark, files, tables, Settings(sink="parquet", layer=RAW))
    log = tables.read(RAW, "ingestion_log")
    run = F.when(F.col("rows_written") > 0, 1).otherwise(2).alias("run")
    return tables.last(log.select(run, "objects_read", "rows_written", "rows_rejected", "pipeline_status", "data_validation_status", "source_system"))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS ngh_contract_id, '61' AS pipeline_duns, CAST(o_custkey AS VARCHAR) AS contract_holder_duns, CAST(round(o_totalprice) AS BIGINT) AS contract_quantity, CAST(o_orderdate AS DATE) AS begin_day, 'firm' AS source_type
    FROM orders
""")
def final_core_of_run(spark, sf_dir):
    """From files on disk through ingestion and the runner to the published final table."""
    tables = Scratch(spark)
    ingest(spark, payload_files(spark, sf_dir, tables), tables, Settings(sink="parquet", layer=RAW))
    tables.drop("landing", "")
    registry, names = default_registry(), ["silver_firm_core_dedup", "silver_firm_core_amended", "silver_firm_core", "silver_firm_core_master_capacity", "silver_final_core_master_capacity"]
    done = run_many(registry, tables, names[:1])
    tables.drop(RAW, "gtran_firm")  # its rows are in the table without copies now
    done += run_many(registry, tables, names[1:], kept=names[-1:])
    if bad := [r for r in done if r.status != "succeeded"]:
        raise RuntimeError(f"{bad[0].name}: {bad[0].error}")
    plan = registry["silver_final_core_master_capacity"]
    final = tables.read(plan.layer, plan.table)
    return tables.last(final.select("ngh_contract_id", "pipeline_duns", "contract_holder_duns", F.col("contract_quantity").cast("long").alias("contract_quantity"), F.col("begin_date").cast("date").alias("begin_day"), "source_type"))


@query("""
    WITH t AS (SELECT o_orderkey AS bronze_row_id, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN '12x' ELSE CAST(o_custkey AS VARCHAR) END AS amount, CASE WHEN o_orderkey % 13 = 0 THEN '2024-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS posted FROM orders),
    b AS (SELECT bronze_row_id, 'amount' AS "column", amount AS value, 'no decimal(38,10)' AS reason FROM t WHERE amount <> '' AND TRY_CAST(amount AS DECIMAL(38, 10)) IS NULL
        UNION ALL SELECT bronze_row_id, 'posted', posted, 'no timestamp' FROM t WHERE TRY_CAST(posted AS TIMESTAMP) IS NULL)
    SELECT * FROM b UNION ALL SELECT bronze_row_id, NULL, NULL, NULL FROM t WHERE bronze_row_id NOT IN (SELECT bronze_row_id FROM b)
""")
def bad_cells_set_aside(spark, sf_dir):
    """Cells that do not cast, by column and reason, and the rows that go on."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("bronze_row_id"), F.expr("CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN '12x' ELSE CAST(o_custkey AS STRING) END AS amount"),
        F.expr("CASE WHEN o_orderkey % 13 = 0 THEN '2024-02-30' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS posted"),
    )
    good, bad = set_aside(rows, {"amount": "decimal(38,10)", "posted": "timestamp"})
    return bad.unionByName(good.select("bronze_row_id"), allowMissingColumns=True)
