"""Carrier dealer codes, the store-dealer association and carrier sales actuals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import clean as fn
from ...operators import cdc, dedup, quality, shape
from ...operators import conforming as conform
from ...sources.feeds import FeedSpec, column_or_null
from .site import Site, squash

# Header of the dealer-code feed, up to the site's own location column.
DEALER_HEADER = [
    "Dealer Code", "Loc #", "Location", "Retail IQ", "District", "ATT Mkt Abbrev", "ATT Market Name", "Market",
    "Region", "Dispute Mkt", "DF", "C&C", "WS", "WS Expires", "Footprint Level", "Business Expert", "DF Code",
    "Old Code", "Old Code 2", "ATT Location Name", "ATT Location ID", "ATT Region", "State", "Notes", "Notes2",
    "Open Date", "Close Date", "DC Origin", "Store Origin", "Acquisition Origin",
]
DEALER_TAIL = ["SMF Mapping", "SMF Market", "DC status", "Sorting Rank", "Rank Description", "Company"]
PENDING = "Pending%"
YES_WORDS, NO_WORDS = ("yes", "on", "true"), ("no", "off", "false")

# Refined dealer columns and the feed columns they come from.
DEALER_REFINED = {
    "dealercode": "dealercode",
    "companycode": None,
    "dealercodeorigin": "dcorigin",
    "dfcode": "dfcode",
    "dcstatus": "dcstatus",
    "dfindicator": None,
    "candc": "candc",
    "opendate": "opendate",
    "closedate": "closedate",
    "whitestoreindicator": None,
    "whitestoreexpirationdate": "wsexpires",
    "sortrank": "sortingrank",
    "rankdescription": "rankdescription",
    "storeorigin": "storeorigin",
    "origin": "acquisitionorigin",
    "businessexpert": "businessexpert",
    "footprintlevel": "footprintlevel",
    "attlocationextendedname": "location",
    "attlocationid": "attlocationid",
    "attlocationname": "attlocationname",
    "attdisputemarket": "disputemkt",
    "attmarketcode": "attmktabbrev",
    "attmarket": "attmarketname",
    "olddealercode": "oldcode",
    "olddealercode2": "oldcode2",
    "attregion": "attregion",
    "notes": "notes",
    "notes2": "notes2",
}

# Delivery names of the dealer table.
DEALER_DELIVERY = {
    "DLR_CD": "dealercode",
    "CO_CD": "companycode",
    "DL_CD_ORIG": "dealercodeorigin",
    "DF_CD": "dfcode",
    "DC_STAT": "dcstatus",
    "DF_IND": "dfindicator",
    "C_AND_C": "candc",
    "OPEN_DT": "opendate",
    "CLOSE_DT": "closedate",
    "WS_IND": "whitestoreindicator",
    "WS_EXP_DT": "whitestoreexpirationdate",
    "SRT_RNK": "sortrank",
    "RNK_DESC": "rankdescription",
    "STORE_ORIG": "storeorigin",
    "ORIG": "origin",
    "BUS_EXPRT": "businessexpert",
    "FTPRT_LVL": "footprintlevel",
    "ATT_LOC_EXT_NM": "attlocationextendedname",
    "ATT_LOC_ID": "attlocationid",
    "ATT_LOC_NM": "attlocationname",
    "ATT_DSPT_MKT": "attdisputemarket",
    "cdc_ind_cd": "cdc_ind_cd",
}


# The day of a report stands in the name of its file, or of the folder that holds its parts.
DEALER_FILE_DATE = (r"DealerCodes[^/]*?(\d{8})", "yyyyMMdd", "reportdate", "file_path")


def dealer_required(site: Site = Site()) -> list[str]:
    return [*DEALER_HEADER, f"{site.code} Loc", *DEALER_TAIL]


def dealer_feed(site: Site = Site()) -> FeedSpec:
    """All text; companies outside the business and pending codes are left out at ingest."""
    names = {c: squash(c.replace("&", "and")) for c in dealer_required(site)}
    names["Loc #"], names[f"{site.code} Loc"] = "loc", "ownloc"
    noise = {"Rank Description": [PENDING]}
    if site.excluded_companies:
        noise["Company"] = list(site.excluded_companies)
    return FeedSpec("dealer_codes", columns=names, noise=noise, file_date=DEALER_FILE_DATE, landed_at=True)


def newest_report(raw: DataFrame) -> DataFrame:
    """Of each dealer code the rows of its newest report: by the date in the file's name, then by when it landed."""
    dated = raw.withColumn("__age", F.struct(*(column_or_null(raw, c, t) for c, t in (("reportdate", "date"), ("landed_at", "timestamp")))))
    return dedup.keep_latest(dated, ["dealercode"], ["__age"], ties="all").drop("__age")


def refine_dealer(raw: DataFrame, site: Site = Site()) -> DataFrame:
    made = {
        "companycode": F.lit(site.company_cd),
        "dfindicator": fn.to_flag("df", (*YES_WORDS, "df"), NO_WORDS),
        "whitestoreindicator": fn.to_flag("ws", YES_WORDS, NO_WORDS),
    }
    rows = conform.project(newest_report(raw), {n: made.get(n) if c is None else c for n, c in DEALER_REFINED.items()})
    return dedup.drop_key_duplicates(rows.filter(quality.not_blank("dealercode")), ["dealercode"])


def dealer_delta(prev: DataFrame | None, curr: DataFrame) -> DataFrame:
    return conform.project(cdc.delta(prev, curr, ["dealercode"], method="except"), DEALER_DELIVERY)


# Rank descriptions that create an association.
MAPPED_ONLY = "SMF Only"
ACTIVE_RANKS = ("SMF Only", "Open Standard", "Bulk")

ASSOCIATION_KEYS = ["StoreNumber", "DealerCode", "AssociationType"]

# Delivery names of the association table.
ASSOCIATION_DELIVERY = {
    "STORE_NUM": "StoreNumber",
    "DLR_CD": "DealerCode",
    "CO_CD": "CompanyCode",
    "ASSOC_TYP": "AssociationType",
    "ASSOC_STAT": "AssociationStatus",
    "cdc_ind_cd": "cdc_ind_cd",
}


def refine_association(raw: DataFrame, site: Site = Site(), open_only: bool = False) -> DataFrame:
    """Store-dealer associations: a retail row for the own location and a mapped row for the mapped one.

    ``open_only`` limits the extra mapped row to open standard codes.
    """
    rank = F.col("rankdescription")
    kept = newest_report(raw).filter((rank.isin(*ACTIVE_RANKS) | rank.like("%Close%")) & F.col("company").like(f"{site.own}%"))
    mapped_only = rank == MAPPED_ONLY
    status = F.when(rank.isin(*ACTIVE_RANKS), "Active").otherwise("Closed")

    def role(store: str, kind: str, state) -> dict:
        return {
            "StoreNumber": F.col(store).try_cast("int"),
            "DealerCode": F.col("dealercode"),
            "CompanyCode": F.lit(site.company_cd),
            "AssociationType": F.lit(kind),
            "AssociationStatus": state,
        }

    extra = rank == "Open Standard" if open_only else ~mapped_only
    roles = [
        (mapped_only, role("smfmapping", "SMF", status)),
        (~mapped_only, role("ownloc", "Retail", status)),
        (extra, role("smfmapping", "SMF", F.lit("Active"))),
    ]
    return shape.expand_roles(kept, [], roles).distinct()


def association_delta(prev: DataFrame | None, curr: DataFrame) -> DataFrame:
    """Delta keyed on the dealer code."""

    def deliverable(df: DataFrame) -> DataFrame:
        return df.filter(quality.not_blank("DealerCode"))

    rows = cdc.delta(
        None if prev is None else deliverable(prev), deliverable(curr), ["DealerCode"], method="except"
    )
    return conform.project(rows, ASSOCIATION_DELIVERY)


# Columns of the carrier actuals report by position; the header carries a month name.
ACTUALS_SCHEMA = (
    "attlocationname string, locid string, dealercode string, kpiname string, kpiid string, "
    "actual_value string, projected_value string, target_value string"
)
ACTUALS_FILE_DATE = (r"\.(\d{8})", "yyyyMMdd")


def actuals_feed(site: Site = Site()) -> FeedSpec:
    # First words of title, header and footer rows.
    noise = ["Histori%", "AT&T MyRe%", "Generated%", "Locat%"]
    if site.report_area is not None:
        noise.append(f"AR : {site.report_area}%")
    return FeedSpec(
        "carrier_actuals",
        schema=ACTUALS_SCHEMA,
        noise={"attlocationname": noise},
        file_date=ACTUALS_FILE_DATE,
    )


def actual_values(df: DataFrame) -> DataFrame:
    """Text values to numbers; a percentage becomes a fraction."""
    values = {
        f"{n}value": fn.parse_percent(f"{n}_value", "decimal(18,4)") for n in ("actual", "projected", "target")
    }
    return df.withColumns(values).drop("actual_value", "projected_value", "target_value")


def refine_actuals(
    history: DataFrame, report: DataFrame, stores: DataFrame, bridge: DataFrame, dealers: DataFrame, site: Site = Site()
) -> DataFrame:
    """History rows flagged when the current report has them, placed through the active retail association."""
    rows = conform.flag_present(history, report, ["dealercode", "kpiname", "reportdate"], "currentkpiindicator")
    rows = conform.bridge_lookup(
        rows,
        conform.active_bridge(bridge),
        {"dealercode": "DealerCode"},
        {"StoreNumber": "storenumber"},
        dim=stores,
        dim_on={"storenumber": "StoreNumber"},
        dim_columns={"LocationName": "locationname", **site.geography()},
        how="inner",
    )
    rows = conform.enrich(
        rows, dealers, ["dealercode"], ["attlocationid", "attmarket", "attregion"], how="inner"
    )
    rows = rows.withColumn("companycode", F.lit(site.company_cd)).select(
        "attlocationname", "dealercode", "kpiname", "actualvalue", "projectedvalue", "storenumber", "companycode",
        *site.geography().values(), "reportdate", "attlocationid", "attmarket", "attregion", "locationname",
        "currentkpiindicator",
    )
    return dedup.drop_key_duplicates(rows, ["dealercode", "kpiname", "reportdate"])


# Delivery names of the actuals table.
ACTUALS_DELIVERY = {
    "RPT_DT": "reportdate",
    "STORE_NUM": "storenumber",
    "DLR_CD": "dealercode",
    "CO_CD": "companycode",
    "KPI_NM": "kpiname",
    "ACTL_VAL": "actualvalue",
    "PROJ_VAL": "projectedvalue",
    "CRNT_KPI_IND": "currentkpiindicator",
}


def deliver_actuals(rows: DataFrame) -> DataFrame:
    return conform.project(rows, ACTUALS_DELIVERY).distinct()
