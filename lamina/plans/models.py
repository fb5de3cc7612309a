"""The shared models of contracts, locations and rates, and how each feed's columns map onto them.

Each line: target column, type, expression for firm and interruptible, expression for awards. Fixed values throughout:
{contract} and {quantity} are the feed's own columns, {label} and {kind} its literals, N() and T() turn blank text into null
and cast to a number or a timestamp, and - leaves the column null.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.functions.values import NUMERIC

MODELS = {
    "core": """
        ngh_contract_id                     text       {contract}                                awardnumber
        pipeline_duns                       text       tspduns                                   -
        pipeline_name                       text       tspname                                   transportationserviceprovidername
        contract_number                     text       svcreqk                                   replacementshippercontractnumber
        award_number                        text       -                                         awardnumber
        offer_number                        text       -                                         offernumber
        bid_number                          text       -                                         bidnumber
        releaser_contract_number            text       -                                         releasercontractnumber
        posted_date                         timestamp  T(posteddatetime)                         T(postdatetime)
        begin_date                          timestamp  T(kbegdatetime)                           T(releasetermstartdate)
        end_date                            timestamp  T(kenddatetime)                           T(releasetermenddate)
        contract_quantity                   numeric    N({quantity})                             N(awardquantitycontract)
        rate_schedule                       text       ratesch                                   rateschedule
        contract_holder                     text       kholdername                               biddername
        contract_holder_duns                text       kholder                                   bidderduns
        releaser_name                       text       -                                         releasername
        releaser_duns                       text       -                                         releaserduns
        evergreen                           text       kroll                                     -
        notice_period_days                  int        -                                         -
        calculated_end_date                 timestamp  '2999-12-31 00:00:00+00'                  -
        replacement_shipper_role_indicator  text       -                                         replacementshipperroleindicator
        term_notes                          text       termsnotes                                specialtermsandmiscellaneousnotes
        contract_type                       text       {kind}                                    {kind}
        created_date                        timestamp  T(createddatetime)                        T(createddate)
        update_date                         timestamp  updated_ts                                updated_ts
        source                              text       {label}                                   {label}
    """,
    "locations": """
        ngh_contract_id                     text       {contract}                                awardnumber
        location                            text       loc                                       locationpropcode
        location_name                       text       locname                                   locationname
        zone                                text       loczn                                     -
        location_qti                        text       locqti                                    locationquantitytypeindicator
        location_purpose_code               text       locpurpdesc                               locationpurposecode
        capacity_type                       text       captypename                               capacitytypelocationindicator
        quantity                            numeric    N({quantity})                             N(awardquantitylocation)
        beg_date                            timestamp  T(kentbegdatetime)                        T(releasetermstartdate)
        end_date                            timestamp  T(kentenddatetime)                        T(releasetermenddate)
        season_beg_date                     timestamp  T(seasnlst)                               T(seasonalstartdate)
        season_end_date                     timestamp  T(seasnlend)                              T(seasonalenddate)
        transaction_term_begin_datetime     timestamp  T(transactiontermbegindatetime)           T(releasetermstartdate)
        transaction_term_end_datetime       timestamp  T(transactiontermenddatetime)             T(releasetermenddate)
        segment                             text       segment                                   -
        index                               bigint     `index`                                   -
        group                               text       -                                         -
        posted_date                         timestamp  T(posteddatetime)                         T(postdatetime)
        update_date                         timestamp  ingestion_timestamp                       updated_ts
        source                              text       {label}                                   {label}
    """,
    "rates": """
        ngh_contract_id                     text       {contract}                                awardnumber
        rate_unique_id                      text       uniqueid                                  id
        rate_identification_code            text       rateiddesc                                awardrateidentificationcode
        reporting_level                     text       rptlvldesc                                -
        rate_charged                        numeric    N(ratechgd)                               N(awardrate)
        rate_charged_reference              text       ratechgdrefdesc                           -
        maximum_tariff_rate                 numeric    N(maxtrfrate)                             N(maximumtariffrate)
        reservation_rate_basis_desc         text       resratebasisdesc                          reservationratebasis
        award_percentage_of_max_tariff      numeric    -                                         N(awardpercentageofmaximumtariffrate)
        beg_date                            timestamp  T(kentbegdatetime)                        T(releasetermstartdate)
        end_date                            timestamp  T(kentenddatetime)                        T(releasetermenddate)
        receipt_location                    text       recloc                                    REC(locationpropcode)
        receipt_location_name               text       reclocname                                REC(locationname)
        receipt_zone                        text       recloczn                                  -
        receipt_location_purpose            text       reclocpurp                                REC(locationpurposecodevalue)
        delivery_location                   text       delloc                                    DEL(locationpropcode)
        delivery_location_name              text       dellocname                                DEL(locationname)
        delivery_zone                       text       delloczn                                  -
        delivery_location_purpose           text       dellocpurp                                DEL(locationpurposecodevalue)
        discount_beg_date                   timestamp  T(discbegdatetime)                        -
        discount_end_date                   timestamp  T(discenddatetime)                        -
        season_beg_date                     timestamp  T(seasnlst)                               -
        season_end_date                     timestamp  T(seasnlend)                              -
        max_tariff_rate_reference           text       maxtrfraterefdesc                         maximumtariffrateidentificationcode
        market_based_rate_indicator         text       mktbasedrateind                           marketbasedrateindicator
        negotiated_rate_indicator           text       ngtdrateindrates                          -
        surcharge_identification_description text      surchgiddesc                              -
        surcharge_indicator                 text       surchgind                                 surchargeindicator
        surcharge_indicator_description     text       surchginddesc                             surchargeindicatorcodevalue
        posted_date                         timestamp  T(posteddatetime)                         T(postdatetime)
        update_date                         timestamp  updated_ts                                updated_ts
        source                              text       {label}                                   {label}
    """,
}

NATURAL_KEYS = {
    "core": ("ngh_contract_id",),
    "locations": ("ngh_contract_id", "location", "location_purpose_code"),
    "rates": ("ngh_contract_id", "rate_unique_id"),
}

_TYPES = {"text": "string", "timestamp": "timestamp", "numeric": NUMERIC, "int": "int", "bigint": "bigint"}
#: Each feed's contract column, quantity columns by grain, and literals.
_OWN = {
    "firm": {"contract": "firmid", "core": "kqtyk", "locations": "kqtyloc", "rates": "", "label": "'gTRAN FIRM'", "kind": "'FIRM'"},
    "interruptible": {"contract": "interruptibleid", "core": "itqtyk", "locations": "itqtyloc", "rates": "", "label": "'gTRAN IT'", "kind": "'INTERRUPTIBLE'"},
    "awards": {"contract": "awardnumber", "core": "", "locations": "", "rates": "", "label": "'gAWD'", "kind": "'AWARDS'"},
}
#: What an expression's function means in SQL.
_FUNCTIONS = {
    "N": f"CAST(nullif(%s, '') AS {NUMERIC})",
    "T": "CAST(nullif(%s, '') AS timestamp)",
    "REC": "CASE WHEN upper(locationpurpose) = 'REC' THEN %s END",
    "DEL": "CASE WHEN upper(locationpurpose) = 'DEL' THEN %s END",
}


def _lines(grain: str) -> list[list[str]]:
    return [re.split(r"\s+", line, maxsplit=2)[:2] + re.split(r"\s{2,}", line)[-2:] for line in map(str.strip, MODELS[grain].strip().splitlines())]


def model(grain: str) -> dict[str, str]:
    """Columns of a grain's model and their types, in order."""
    return {name: _TYPES[kind] for name, kind, _, _ in _lines(grain)}


def mapping(feed: str, grain: str) -> dict[str, Column]:
    """The feed's expression for each column that it fills."""
    own, out = _OWN[feed], {}
    for name, _, transport, awards in _lines(grain):
        text = (awards if feed == "awards" else transport).format(contract=own["contract"], quantity=own[grain], label=own["label"], kind=own["kind"])
        if text != "-":
            call = re.fullmatch(r"([A-Z]+)\((\w+)\)", text)
            out[name] = F.expr(_FUNCTIONS[call[1]] % call[2] if call else text)
    return out


def casts(feed: str, grain: str) -> dict[str, str]:
    """The feed's text columns that its mapping casts, and to what."""
    own, out = _OWN[feed], {}
    for _, kind, transport, awards in _lines(grain):
        text = (awards if feed == "awards" else transport).format(contract=own["contract"], quantity=own[grain], label=own["label"], kind=own["kind"])
        if call := re.fullmatch(r"([NT])\((\w+)\)", text):
            out[call[2]] = _TYPES[kind]
    return out
