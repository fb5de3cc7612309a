"""Raw feeds: their payloads, columns and nested elements. All names are fixed values of the data format."""

from __future__ import annotations

from dataclasses import dataclass, field

META = (
    ("raw_record_id", "string"), ("hash_key", "string"), ("pipeline_run_id", "string"), ("source_system", "string"), ("source_api", "string"), ("source_file_name", "string"),
    ("ingestion_timestamp", "timestamp"), ("updated_ts", "timestamp"), ("ingestion_status", "string"), ("raw_payload", "string"),
)
LOG_SCHEMA = (
    "pipeline_name string, pipeline_layer string, pipeline_run_id string, activity_name string, activity_run_id string, source_system string, source_api string, source_file_name string, "
    "triggered_by string, pipeline_start_ts timestamp, pipeline_end_ts timestamp, activity_duration_secs decimal(38,10), objects_read int, rows_written int, rows_rejected int, "
    "pipeline_status string, data_validation_status string, error_details string, logged_at_ts timestamp"
)


@dataclass(frozen=True)
class Child:
    """An array nested in a record that has a table of its own; `inherit` names keys taken over from the record."""

    array_key: str
    table: str
    id_field: str = "Id"
    required: tuple[str, ...] = ()
    inherit: tuple[str, ...] = ()


@dataclass(frozen=True)
class Feed:
    """A kind of payload: where its records are, the table they go to, and what each must have."""

    name: str
    records_key: str
    table: str
    id_field: str
    required: tuple[str, ...]
    header: tuple[str, ...] = ()
    children: tuple[Child, ...] = field(default=())


FEEDS = {
    f.name: f
    for f in (
        Feed("gTRAN_FIRM", "contracts", "gtran_firm", "Id", ("Id", "FirmId"), ("TspName", "TspDuns", "TspProp")),
        Feed("gTRAN_IT", "contracts", "gtran_it", "Id", ("Id", "InterruptibleId"), ("TspName", "TspDuns", "TspProp")),
        Feed("gINDEX", "records", "gindex", "ID", ("ID", "Pipe")),
        Feed("gAWD", "awards", "gawd", "Id", ("Id", "AwardNumber")),
    )
}

#: Source keys of each raw table's business columns, in order; a column is its key in lower case.
BUSINESS = {
    "gtran_firm": """
        Id TspName TspDuns TspProp PostedDateTime FirmId Cycle AmendRptg AmendRptgDesc KHolderName KHolder KHolderProp SvcReqK RateSch KQtyK KStat KStatDesc KBegDateTime KEndDateTime
        KEndInd NgtdRateInd NgtdRateIndDesc PkgId KRoll KRollDesc Affil AffilDesc CapType CapTypeName CapTypeLoc CapTypeLocDesc OSId Rte TermsNotes CreatedDateTime RecLocs DelLocs
        MaxRateChgd MaxTrfRate OtherRates OtherRatesDescription OtherRatesBasis locations rates
    """.split(),
    "gtran_it": """
        Id TspName TspDuns TspProp PostedDateTime InterruptibleId Cycle AmendRptg AmendRptgDesc KHolderName KHolder KHolderProp SvcReqK RateSch ITQtyK KStat KStatDesc KBegDateTime
        KEndDateTime NgtdRateInd NgtdRateIndDesc PkgId KRoll KRollDesc Affil AffilDesc TermsNotes CreatedDateTime RecLocs DelLocs MaxRateChgd MaxTrfRate OtherRates
        OtherRatesDescription OtherRatesBasis DealType locations rates
    """.split(),
    "gindex": """
        ID FercID Pipe ReportDate OrigRevised TporUOM StorUOM Contact ContactNumber Shipper ShipperDuns RateSched K KStart KExp NegRate TportMDQ StorMSQ AgentAMA AgentAMAAffiliation
        PtIDCode PtName PtIDCodeQual PtIdenCode Zone LocTportMDQ LocStorMSQ CreatedDate RateSchedID State County DUNPCE
    """.split(),
    "gawd": """
        GS_ID Id TransportationServiceProviderName TransportationServiceProviderPropCode Status StatusCodeValue OfferNumber BidNumber AwardNumber AwardQuantityContract
        IBRIndexBasedCapacityReleaseIndicator IBRIndexBasedCapacityReleaseIndicatorCodeValue RecallReputIndicator RecallReputIndicatorCodeValue AllowableReleaseIndicator
        AffiliatedIndicator AffiliatedIndicatorCodeValue RightToAmendPrimaryPointsIndicator RightToAmendPrimaryPointsIndicatorCodeValue REI_AwardingAction
        REI_StorageInventoryCondition CapacityAwardDateTime ReleaseTermStartDate ReleaseTermEndDate PostDateTime MarketBasedRateIndicator MarketBasedRateIndicatorCodeValue
        PrearrangedDealIndicator PrearrangedDealIndicatorCodeValue PreviouslyReleasedIndicator PreviouslyReleasedIndicatorCodeValue PermanentReleaseIndicator
        PermanentReleaseIndicatorCodeValue ReplacementShipperRoleIndicator ReplacementShipperRoleIndicatorCodeValue StorageInventoryConditionedReleaseIndicator
        StorageInventoryConditionedReleaseIndicatorCodeValue OverrunResponsibilityIndicator OverrunResponsibilityIndicatorCodeValue BusinessDayIndicator BidderName BidderDuns
        ReleaserName ReleaserDuns BidderPhoneNumber BidderEmailAddress RateFormTypeCode RateFormTypeCodeValue ReservationRateBasis ReservationRateBasisCodeValue RateSchedule
        UnitPrice Multiplier MonetaryAmount ReleaseDesignationAcceptableBiddingBasis ReleaseDesignationAcceptableBiddingBasisCodeValue SurchargeIndicator
        SurchargeIndicatorCodeValue ChargeIndicator CycleIndicator CycleIndicatorCodeValue IBRFormulaIdentifier IBRFormulaIdentifierCodeValue
        IBRIndexMathematicalOperatorIndicator IBRIndexMathematicalOperatorIndicatorCodeValue IBRIndexReference1 IBRIndexReference2 IBRUniqueFormulaSpecialTerms
        IBRVariableMathematicalOperatorIndicator ReplacementShipperContractNumber AgencyQualifierCode RecallReputTermRate RightToAmendPrimaryPointsTermsNote
        SpecialTermsAndMiscellaneousNotesAndObligations SpecialTermsAndMiscellaneousNotesStorageInventoryConditions SpecialTermsAndMiscellaneousNotes MeasurementBasis
        MeasurementBasisCodeValue CreatedDate ReleaserContractNumber ReleaseFullName BidderFullName Version_Status UpdatedDateTime locations rates
    """.split(),
}

#: Keys of nested elements by feed and section, in order.
ELEMENT_KEYS = {
    ("firm", "locations"): """
        Index Segment UniqueId Pk KQtyLoc SeasnlSt SeasnlEnd UniqueKey Id KEntBegDateTime KEntEndDateTime Loc LocName LocPurp LocPurpDesc LocZn LocQTI LocQTIDesc TspDuns TspName
        TspPropCode CreatedDateTime
    """.split(),
    ("firm", "rates"): """
        SeasnlSt SeasnlEnd UniqueId Pk RateFormType RateFormTypeDesc ResRateBasis ResRateBasisDesc LocKMaxPress LocKMinPress MinVolPctNonCapRel MinVolQtyNonCapRel CapType CapTypeName
        CapTypeLoc CapTypeLocDesc KQtyLoc UniqueKey Id CreatedDateTime KEntBegDateTime KEntEndDateTime RecLoc RecLocName RecLocPurp RecLocPurpDesc RecLocZn DelLoc DelLocName
        DelLocPurp DelLocPurpDesc DelLocZn LocQTI LocQTIDesc RateId RateIdDesc RateChgd RateChgdRef RateChgdRefDesc MaxTrfRate MaxTrfRateRef MaxTrfRateRefDesc MktBasedRateInd
        SurchgId SurchgIdDesc SurchgInd SurchgIndDesc TotSurchg DiscBegDateTime DiscEndDateTime RptLvl RptLvlDesc NgtdRateIndRates
    """.split(),
    ("interruptible", "locations"): """
        CapTypeName Index Segment UniqueId Pk ItQtyLoc SeasnlSt SeasnlEnd UniqueKey Id KEntBegDateTime KEntEndDateTime Loc LocName LocPurp LocPurpDesc LocZn LocQTI LocQTIDesc TspDuns
        TspName TspPropCode CreatedDateTime
    """.split(),
    ("interruptible", "rates"): """
        MaxDQ MinDQ SeasnlSt SeasnlEnd UniqueId Pk RateFormType RateFormTypeDesc ResRateBasis ResRateBasisDesc LocKMaxPress LocKMinPress MinVolPctNonCapRel MinVolQtyNonCapRel CapType
        CapTypeName CapTypeLoc CapTypeLocDesc ItQtyLoc UniqueKey Id CreatedDateTime KEntBegDateTime KEntEndDateTime RecLoc RecLocName RecLocPurp RecLocPurpDesc RecLocZn DelLoc
        DelLocName DelLocPurp DelLocPurpDesc DelLocZn LocQTI LocQTIDesc RateId RateIdDesc RateChgd RateChgdRef RateChgdRefDesc MaxTrfRate MaxTrfRateRef MaxTrfRateRefDesc
        MktBasedRateInd SurchgId SurchgIdDesc SurchgInd SurchgIndDesc TotSurchg DiscBegDateTime DiscEndDateTime RptLvl RptLvlDesc NgtdRateIndRates
    """.split(),
    ("awards", "locations"): """
        GS_ID Id OfferNumber BidNumber AwardNumber TransportationServiceProviderPropCode IBRRateFloor IBRNameVolume MaximumVolumetricCommitmentQuantity SeasonalStartDate
        SeasonalEndDate LocationPurposeCode StdLocPropPurposeCode LocationPurposeCodeValue LocationName LocationPropCode LocationQuantityTypeIndicator
        LocationQuantityTypeIndicatorCodeValue CapacityTypeLocationIndicator CapacityTypeLocationIndicatorCodeValue Route AwardQuantityLocation SeasonalDateFormat BidderDuns
        ReleaserDuns CreatedDate Version_Status UpdatedDateTime
    """.split(),
    ("awards", "rates"): """
        GS_ID Id OfferNumber BidNumber AwardNumber BidderDuns ReleaserDuns TransportationServiceProviderPropCode LocationPurpose LocationPurposeCodeValue LocationName LocationPropCode
        IdentificationCodeQualifier ReservationRateBasis MarketBasedRateIndicator SurchargeIndicatorCodeValue SurchargeIndicator ChargeInformationReferenceNumber ChargeCode ChargeRate
        AwardRate AwardRateIdentificationCode MaximumTariffRate MaximumTariffRateIdentificationCode AwardPercentageOfMaximumTariffRate
        AwardPercentageOfMaximumTariffRateIdentificationCode MinimumVolumetricCommitmentPercentage IBRAllowableDifferential IBRAllowableDifferentialRateFloor IBRBidValuePercent
        CreatedDate Version_Status UpdatedDateTime
    """.split(),
}

#: Columns of the contract that its elements carry.
PARENTS = {
    ("firm", "locations"): ("firmid", "posteddatetime", "kbegdatetime", "kenddatetime", "captypename"),
    ("firm", "rates"): ("firmid", "posteddatetime", "tspduns", "tspname"),
    ("interruptible", "locations"): ("interruptibleid", "posteddatetime", "kbegdatetime", "kenddatetime"),
    ("interruptible", "rates"): ("interruptibleid", "posteddatetime", "tspduns", "tspname"),
    ("awards", "locations"): ("postdatetime", "capacityawarddatetime", "releasetermstartdate", "releasetermenddate"),
    ("awards", "rates"): ("postdatetime", "capacityawarddatetime", "releasetermstartdate", "releasetermenddate"),
}


def columns_of(table: str) -> list[str]:
    """Business columns of a raw table."""
    return [k.lower() for k in BUSINESS[table]]


def schema_of(table: str) -> str:
    """The raw table's schema: a row number, texts, and where the row comes from."""
    return ", ".join(["bronze_row_id long", *(f"`{c}` string" for c in columns_of(table)), *(f"{n} {t}" for n, t in META)])
