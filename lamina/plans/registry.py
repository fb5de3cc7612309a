"""Tables that the pipeline builds: what each reads, its key, and how its rows come about."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.values import NUMERIC, bigint, timestamp
from lamina.operators.amendments import NullRule, fold
from lamina.operators.elements import elements
from lamina.operators.latest import distinct_content, latest_by, newest
from lamina.operators.model import latest_in_model, project_model, union_tagged
from lamina.operators.pairing import Pairing, pair
from lamina.operators.scope import scope_table
from lamina.operators.transport import transport_rates
from lamina.plans.models import NATURAL_KEYS, casts, mapping, model
from lamina.sources.feeds import ELEMENT_KEYS, META, PARENTS, columns_of
from lamina.sources.labels import COMBINED

#: Layers: raw, staged and curated.
RAW, STAGING, CURATED = (os.environ.get(name, default) for name, default in (("BRONZE_SCHEMA", "bronze"), ("DECOMP_SCHEMA", "silver_staging"), ("SILVER_SCHEMA", "silver")))
GRAINS = ("core", "locations", "rates")


@dataclass(frozen=True)
class Plan:
    """One table. build gets the tables that are there, by name, and returns the rows, or None for nothing to build."""

    name: str
    layer: str
    table: str
    feed: str
    group: str
    sources: tuple[tuple[str, str], ...]
    build: Callable[[Mapping[str, DataFrame]], DataFrame | None]
    key: tuple[str, ...] = ()
    nulls_distinct: bool = False
    not_null: tuple[str, ...] = ()
    stamp: str | None = None
    surrogate: str | None = None
    sources_required: bool = True
    #: Tables that are read if they are there.
    optional: tuple[tuple[str, str], ...] = ()
    #: Columns of each source, by its table, that are cast, and to what: rows with a bad cell are set aside.
    casts: Mapping[str, Mapping[str, str]] = field(default_factory=dict)


class Registry(dict[str, Plan]):
    def register(self, plan: Plan) -> Plan:
        if plan.name in self:
            raise ValueError(f"{plan.name} is registered already")
        self[plan.name] = plan
        return plan


@dataclass(frozen=True)
class FeedTables:
    """A feed's raw table, its contract's id, and the keys of its staged tables."""

    feed: str
    raw: str
    contract: str
    quantity: str
    core_key: tuple[str, ...]
    locations_key: tuple[str, ...]
    rates_key: tuple[str, ...]
    amended: bool
    pairing: Pairing


AWARD_FIELDS = {
    "contract_key": "awardnumber",
    "loc_code": "locationpropcode",
    "loc_name": "locationname",
    "loc_zone": None,
    "loc_purpose": "locationpurposecode",
    "loc_qti": "locationquantitytypeindicator",
    "loc_qty": "awardquantitylocation",
    "term_begin": "releasetermstartdate",
    "term_end": "releasetermenddate",
}

FEED_TABLES = (
    FeedTables("firm", "gtran_firm", "firmid", "kqtyloc", ("firmid", "tspduns"), ("firmid", "uniqueid"), ("firmid", "uniqueid"), True, Pairing("firm")),
    FeedTables(
        "interruptible", "gtran_it", "interruptibleid", "itqtyloc", ("interruptibleid", "tspduns"), ("interruptibleid", "uniqueid"), ("interruptibleid", "uniqueid"), True,
        Pairing("interruptible", {"contract_key": "interruptibleid", "loc_qty": "itqtyloc"}),
    ),
    FeedTables(
        "awards", "gawd", "id", "", ("id",), ("id", "locationpropcode", "locationpurposecode"), ("id", "locationpropcode", "locationpurpose"), False, Pairing("awards", AWARD_FIELDS),
    ),
)

#: Columns of staged transport locations; {contract} and {quantity} are the feed's own.
LOCATION_COLUMNS = """
    index transactiontermbegindatetime transactiontermenddatetime segment {contract} uniqueid pk {quantity} seasnlst seasnlend uniquekey id posteddatetime kentbegdatetime kentenddatetime
    captypename loc locname locpurp locpurpdesc loczn locqti locqtidesc tspduns tspname createddatetime source_system source_api pipeline_run_id hash_key ingestion_status ingestion_timestamp
"""
def _by_ingestion():
    return newest("ingestion_timestamp"), newest("bronze_row_id")


def with_nulls(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items()])


def dedup_core(f: FeedTables):
    def build(t):
        return distinct_content(scope_table(t[f.raw], t.get("shipper_mapping"), f.feed, f.raw))

    return build


def dedup_elements(f: FeedTables, section: str, lenient: bool = False):
    """Elements of the contracts in scope, one for each content; the contract that came first keeps it."""

    def build(t):
        parents, keys = PARENTS[f.feed, section], ELEMENT_KEYS[f.feed, section]
        carried = [n for n, _ in META if n not in ("hash_key", "raw_payload")]
        scoped = scope_table(t[f.raw], t.get("shipper_mapping"), f.feed, f.raw)
        own = scoped.select("bronze_row_id", "raw_payload", *[F.col(c).alias(f"_p_{c}") for c in (*parents, *carried)])
        rows = elements(own, section, keys, carry=["bronze_row_id", *[f"_p_{c}" for c in (*parents, *carried)]], lenient=lenient)
        rows = distinct_content(rows, order=[F.col("bronze_row_id").asc_nulls_last(), *[F.col(f"_p_{c}").asc_nulls_last() for c in parents]])
        meta = {"hash_key": F.col("hash_key"), "raw_payload": F.col("element")} | {c: F.col(f"_p_{c}") for c in carried}
        return rows.select("bronze_row_id", *[F.col(f"_p_{c}").alias(c) for c in parents], *[k.lower() for k in keys], *[meta[n].alias(n) for n, _ in META])

    return build


def amended_core(f: FeedTables, rule: NullRule | None = NullRule(), orphans: bool = True):
    """One row per contract; nested columns are not folded and stay null."""

    def build(t):
        columns = ["bronze_row_id", *[c for c in columns_of(f.raw) if c not in ("locations", "rates")], *[n for n, _ in META]]
        folded = fold(t[f"{f.feed}_core_dedup"], f.core_key, columns, "amendrptgdesc", timestamp("posteddatetime"), [F.col("bronze_row_id"), F.col("hash_key")], rule, orphans)
        return with_nulls(folded.select(*columns, "amend_kind", "amend_postings_applied", "amend_baseline_ts"), {"locations": "string", "rates": "string"})

    return build


def staged(source: str, key: tuple[str, ...], drop: tuple[str, ...] = ()):
    """The row ingested last for each key, with the source's columns."""
    return lambda t: latest_by(t[source], key, _by_ingestion()).drop(*drop)


def staged_locations(f: FeedTables):
    def build(t):
        names = LOCATION_COLUMNS.format(contract=f.contract, quantity=f.quantity).split()
        own = {"index": bigint("index"), "transactiontermbegindatetime": F.col("kbegdatetime"), "transactiontermenddatetime": F.col("kenddatetime")}
        return latest_by(t[f"{f.feed}_locations_dedup"], f.locations_key, _by_ingestion()).select(*[own.get(n, F.col(n)).alias(n) for n in names])

    return build


def mapped(feed: str, grain: str):
    return lambda t: latest_in_model(project_model(t[f"{feed}_{grain}"], model(grain), mapping(feed, grain)), NATURAL_KEYS[grain])


def final(grain: str, feeds: tuple[str, ...]):
    """The model's columns of all feeds that are there; numbers and times of load are their own."""
    names = {f: f"{f}_{grain}_master_capacity" for f in feeds}
    return lambda t: union_tagged({f: t[n].select(*model(grain)) for f, n in names.items() if n in t})


def default_registry() -> Registry:
    """All tables of the pipeline."""
    out, final_feeds = Registry(), ("firm", "interruptible", "awards", "index")
    mapping_table = ((RAW, "shipper_mapping"),)
    for f in FEED_TABLES:
        feed = f.feed

        def add(table, layer, group, sources, build, feed=feed, **more):
            out.register(Plan(f"silver_{table}", layer, table, feed, group, tuple(sources), build, **more))

        add(f"{feed}_core_dedup", STAGING, "stage_3/deduplication", [(RAW, f.raw)], dedup_core(f), key=("hash_key",), nulls_distinct=True, optional=mapping_table)
        for section in ("locations", "rates"):
            add(f"{feed}_{section}_dedup", STAGING, "stage_3/deduplication", [(RAW, f.raw)], dedup_elements(f, section), key=("hash_key",), nulls_distinct=True, optional=mapping_table)
        core_from = f"{feed}_core_dedup"
        if f.amended:
            core_from = f"{feed}_core_amended"
            add(core_from, STAGING, "stage_3/amendments", [(STAGING, f"{feed}_core_dedup")], amended_core(f), key=f.core_key, stamp="amended_ts", casts={f"{feed}_core_dedup": {"posteddatetime": "timestamp"}})
        dropped = ("amended_ts",) if f.amended else ("locations", "rates")
        add(f"{feed}_core", STAGING, f"stage_3/decomposition/{feed}/core", [(STAGING, core_from)], staged(core_from, f.core_key, dropped), key=f.core_key, stamp="decomp_loaded_ts")
        locations = staged_locations(f) if f.amended else staged(f"{feed}_locations_dedup", f.locations_key)
        add(f"{feed}_locations", STAGING, f"stage_3/decomposition/{feed}/locations", [(STAGING, f"{feed}_locations_dedup")], locations, key=f.locations_key, stamp="decomp_loaded_ts", casts={f"{feed}_locations_dedup": {"index": "bigint"}} if f.amended else {})
        add(f"{feed}_rates", STAGING, f"stage_3/decomposition/{feed}/rates", [(STAGING, f"{feed}_rates_dedup")], staged(f"{feed}_rates_dedup", f.rates_key), key=f.rates_key, stamp="decomp_loaded_ts")
        add(
            f"{feed}_rec_del_pair", CURATED, f"stage_4/rec_del_pairing/{feed}", [(STAGING, f"{feed}_locations")], lambda t, f=f: pair(t[f"{f.feed}_locations"], f.pairing),
            key=("contract_key", "receipt_loc_code", "delivery_loc_code"), not_null=("entity_type", "contract_key", "pair_status"), stamp="silver_loaded_ts", surrogate="rec_del_pair_id",
            casts={f"{feed}_locations": {c: k for n, k in (("loc_qty", NUMERIC), ("term_begin", "timestamp"), ("term_end", "timestamp")) if (c := f.pairing.column_of(n))}},
        )
        for grain in GRAINS:
            add(
                f"{feed}_{grain}_master_capacity", CURATED, f"stage_5/master_capacity/{feed}/{grain}", [(STAGING, f"{feed}_{grain}")], mapped(feed, grain),
                key=NATURAL_KEYS[grain], stamp="silver_loaded_ts", surrogate=f"{feed}_{grain}_id", casts={f"{feed}_{grain}": casts(feed, grain)},
            )
    for grain in GRAINS:
        table = f"final_{grain}_master_capacity"
        sources = tuple((CURATED, f"{f}_{grain}_master_capacity") for f in final_feeds)
        out.register(
            Plan(
                f"silver_{table}", CURATED, table, COMBINED, f"stage_5/master_capacity/final/{grain}", (), final(grain, final_feeds), key=("source_type", *NATURAL_KEYS[grain]),
                not_null=("source_type",), stamp="silver_loaded_ts", surrogate=f"final_{grain}_id", sources_required=False, optional=sources,
            )
        )
    transport = tuple((RAW, t) for t in ("gtran_firm", "gtran_rates", "gtran_loc"))
    out.register(
        Plan(
            "silver_firm_transport_rate", CURATED, "firm_transport_rate", "firm", "", transport, lambda t: transport_rates(t["gtran_firm"], t["gtran_rates"], t["gtran_loc"]),
            key=("firm_id", "rate_unique_id"), nulls_distinct=True, not_null=("firm_id", "rate_unique_id"), stamp="silver_loaded_ts", surrogate="firm_transport_rate_id",
        )
    )
    return out


def in_group(plan: Plan, group: str) -> bool:
    """Whether the group's folders are a run of the plan's folders; an empty group means plans outside folders."""
    want, have = group.strip("/").split("/"), plan.group.split("/")
    if want == [""]:
        return plan.group == ""
    return any(have[i : i + len(want)] == want for i in range(len(have) - len(want) + 1))
