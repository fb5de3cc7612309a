"""Rates of firm transport with their contract and the two points of their path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.values import NUMERIC, bigint, date, days_between, numeric, timestamp, yes_no
from lamina.operators.latest import latest_by, newest


def transport_rates(contracts: DataFrame, rates: DataFrame, locations: DataFrame) -> DataFrame:
    """A row for each loaded rate whose contract is loaded, with the quantities at its receipt and delivery points.

    Of each contract, rate and point the row ingested last counts. A point stands for receipt and delivery alike, whatever
    its purpose. Amounts and times are typed; the all-in rate is charge and surcharge, absent ones counted as zero.
    """

    def current(df: DataFrame, *keys: str) -> DataFrame:
        return latest_by(df.filter("ingestion_status = 'LOADED'"), keys, [newest("ingestion_timestamp"), newest("bronze_row_id")])

    f, r = current(contracts, "firmid").alias("f"), current(rates, "firmid", "uniqueid").alias("r")
    points = current(locations, "firmid", "loc").select("firmid", "loc", "kqtyloc")
    joined = r.join(f, F.col("f.firmid") == F.col("r.firmid"))
    for role, code in (("lr", "recloc"), ("ld", "delloc")):
        joined = joined.join(points.alias(role), (F.col(f"{role}.firmid") == F.col("r.firmid")) & (F.col(f"{role}.loc") == F.col(f"r.{code}")), "left")
    zero = F.lit(0).cast(NUMERIC)
    out = {
        "firm_id": F.col("r.firmid"), "rate_unique_id": F.col("r.uniqueid"), "contract_id": F.col("f.id"), "tsp_name": F.col("f.tspname"), "tsp_duns": bigint("f.tspduns"),
        "contract_holder_name": F.col("f.kholdername"), "rate_schedule": F.col("f.ratesch"), "service_request_k": F.col("f.svcreqk"), "contract_qty_dth": numeric("f.kqtyk"),
        "contract_begin_ts": timestamp("f.kbegdatetime"), "contract_end_ts": timestamp("f.kenddatetime"), "contract_term_days": days_between("f.kbegdatetime", "f.kenddatetime"),
        "contract_status_code": F.col("f.kstat"), "contract_status_desc": F.col("f.kstatdesc"), "is_negotiated_rate": yes_no("f.ngtdrateind"),
        "receipt_loc_code": F.col("r.recloc"), "receipt_loc_name": F.col("r.reclocname"), "receipt_zone": F.col("r.recloczn"), "receipt_point_qty_dth": numeric("lr.kqtyloc"),
        "delivery_loc_code": F.col("r.delloc"), "delivery_loc_name": F.col("r.dellocname"), "delivery_zone": F.col("r.delloczn"), "delivery_point_qty_dth": numeric("ld.kqtyloc"),
        "rate_form_type": F.col("r.rateformtype"), "rate_form_type_desc": F.col("r.rateformtypedesc"), "rate_id": F.col("r.rateid"), "rate_charged": numeric("r.ratechgd"),
        "max_tariff_rate": numeric("r.maxtrfrate"), "total_surcharge": numeric("r.totsurchg"),
        "all_in_rate": (F.coalesce(numeric("r.ratechgd"), zero) + F.coalesce(numeric("r.totsurchg"), zero)).cast(NUMERIC),
        "is_market_based_rate": yes_no("r.mktbasedrateind"), "has_surcharge": yes_no("r.surchgind"), "season_start_date": date("r.seasnlst"), "season_end_date": date("r.seasnlend"),
        "rate_begin_ts": timestamp("r.kentbegdatetime"), "rate_end_ts": timestamp("r.kentenddatetime"), "posted_ts": timestamp("r.posteddatetime"),
        "source_system": F.col("r.source_system"), "source_api": F.col("r.source_api"), "pipeline_run_id": F.col("r.pipeline_run_id"),
        "firm_hash_key": F.col("f.hash_key"), "rate_hash_key": F.col("r.hash_key"),
    }
    return joined.select(*[c.alias(n) for n, c in out.items()])
