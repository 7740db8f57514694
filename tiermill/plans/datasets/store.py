"""Store dimension, store hierarchy and management hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import clean as fn
from ...operators import cdc, dedup, hierarchy, quality
from ...operators import conforming as conform
from ...sources.feeds import FeedSpec
from .site import Site

# Columns every file of a feed must carry.
LOCATION_REQUIRED = [
    "StoreID", "StoreName", "Disabled", "Abbreviation", "ManagerEmployeeID", "ManagerCommissionable", "Address",
    "City", "StateProv", "ZipPostal", "Country", "PhoneNumber", "FaxNumber", "DistrictName", "RegionName",
    "ChannelName", "StoreType", "GLCode", "SquareFootage", "LocationCode", "Latitude", "Longitude",
    "AddressVerified", "TimeZone", "AdjustDST", "CashPolicy", "MaxCashDrawer", "Serial_on_OE", "Phone_on_OE",
    "PAW_on_OE", "Comment_on_OE", "HideCustomerAddress", "EmailAddress", "GeneralLocationNotes",
    "SaleInvoiceComment", "StaffLevel", "BankDetails", "Taxes", "LeaseStartDate", "LeaseEndDate", "Rent",
    "PropertyTaxes", "InsuranceAmount", "OtherCharges", "DepositTaken", "LeaseNotes", "InsuranceCompany",
    "LandlordNotes", "LandlordName", "RelocationDate", "UseLocationEmail", "LocationEntityID",
    "DateLastStatusChanged", "UpdatedDate",
]
EXPERT_REQUIRED = ["Store Number", "Location", "Market", "Region", "District", "BAEWorkdayID", "BSISWorkdayID"]
STORE_LIST_REQUIRED = [
    "Store #", "Store Name", "Hyperion Store #", "Open Date", "Closed Date", "Status", "Comp", "AcquisitionName",
    "Region", "Market", "District", "Region VP", "Market Director", "District Manager", "RVP ID", "MDIR ID", "DM ID",
    "Store Tier", "SqFtRange", "State", "Zip", "Attribute", "Base", "Classification", "Same", "Address", "City",
    "Sq Ft",
]
TV_REQUIRED = ["Location", "DTV Now Location"]
REAL_ESTATE_HEADER_LINE = 2
HEADER_REPLACE = {" ": "", "#": "", ",": "", "/": "", "&": "_"}

# yes/no words of the location master and of the store lists.
TRUE_WORDS, FALSE_WORDS = ("true",), ("false",)
MARK_WORDS = ("x", "yes", "true")
LICENSE_MARKER = "License #"


def real_estate_required(site: Site) -> list[str]:
    own = site.own
    return [
        "Formula Link", "AT&T Region", "AT&T Market", f"{own} Region", f"{own} Market", f"{own} District", "Loc",
        "Store Name", "Street Address", "City, State, Zip", "Square Feet", "Total Monthly Rent", "Lease Expiration",
        "Average Last 12 Months Ops", "Average Traffic Count Last 12 Months", "Dealer Code", "Exterior Photo",
        "Interior Photo", "Build Type", "Store Type", "C&C Designation", "Remodel or Open Date", "Signage Type",
        "Pylon/Monument Panels", "Selling Walls", "Memorable Accessory Wall", "Cash Wrap Expansion",
        "Window Wrap Grpahics", "Live DTV", "Learning Tables", "Community Table", "Diamond Displays", "C Fixtures",
        "TIO Kiosk", "Approved for Flex Blade", "Cap Index Score", "Authorized Retailer Tag Line",
        "Selling Walls Notes",
    ]


def location_feed() -> FeedSpec:
    return FeedSpec("location", multiline=True)


def expert_feed() -> FeedSpec:
    return FeedSpec("expert", columns={"Store Number": "StoreNumber"}, multiline=True)


def store_list_feed() -> FeedSpec:
    names = {c: c.replace(" ", "").replace("#", "").replace("/", "") for c in STORE_LIST_REQUIRED}
    return FeedSpec("store_list", columns=names, multiline=True)


def tv_feed() -> FeedSpec:
    return FeedSpec("tv", columns={"DTV Now Location": "DTVNowLocation"}, multiline=True)


def split_sources(
    location: DataFrame, expert: DataFrame, real_estate: DataFrame, store_list: DataFrame, tv: DataFrame
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(good, bad) per source; every rule set is one pass."""
    store, name = fn.split_key_label("StoreName")
    location = location.withColumns({"StoreNumber": store, "LocationLabel": name})
    tv = tv.withColumn("StoreNumber", fn.split_key_label("Location")[0])
    checks = {
        "location": (location, {"store_number": quality.numeric("StoreNumber")}),
        "expert": (expert, {"store_number": quality.numeric("StoreNumber")}),
        "real_estate": (real_estate, {"store_number": quality.numeric("Loc")}),
        "store_list": (
            store_list,
            {
                "store_number": quality.numeric("Store"),
                "open_date": quality.us_date("OpenDate"),
                "close_date": quality.us_date("ClosedDate", optional=True),
            },
        ),
        "tv": (tv, {"store_number": quality.numeric("StoreNumber")}),
    }
    split = {n: quality.split_stored(df, rules) for n, (df, rules) in checks.items()}
    return {n: s[0] for n, s in split.items()}, {n: s[1] for n, s in split.items()}


def refine_store(sources: dict[str, DataFrame], site: Site = Site()) -> DataFrame:
    """The conformed store dimension from good source rows, one row per store number."""
    own = site.own
    base = sources["location"]
    estate = {
        "StreetAddress": "d_address", "SquareFeet": "d_sqft", "TotalMonthlyRent": "d_rent", "StoreType": "d_type",
        "LeaseExpiration": "LeaseExpiration", "BuildType": "BuildTypeCode", "C_CDesignation": "C_CDesignation",
        "AuthorizedRetailerTagLine": "d_tagline", "PylonMonumentPanels": "d_pylon", "SellingWalls": "d_walls",
        "MemorableAccessoryWall": "d_accessory", "CashWrapExpansion": "CashWrapExpansion",
        "WindowWrapGrpahics": "WindowWrapGraphics", "LiveDTV": "LiveDTV", "LearningTables": "d_tables",
        "CommunityTable": "d_community", "DiamondDisplays": "d_diamond", "CFixtures": "d_fixtures",
        "TIOKiosk": "d_kiosk", "ApprovedforFlexBlade": "d_blade", "CapIndexScore": "d_cap",
        "SellingWallsNotes": "SellingWallNotes", "RemodelorOpenDate": "d_remodel", f"{own}Region": "d_region",
        f"{own}Market": "d_market", f"{own}District": "d_district",
    }
    listed = {
        "Address": "e_address", "City": "e_city", "State": "e_state", "Zip": "e_zip", "SqFtRange": "SquareFootRange",
        "OpenDate": "e_open", "ClosedDate": "e_close", "StoreTier": "StoreTier", "AcquisitionName": "AcquisitionName",
        "Base": "e_base", "Comp": "e_comp", "Same": "e_same", "RegionVP": f"{own}RegionVP",
        "MarketDirector": f"{own}MarketDirector", "DistrictManager": f"{own}DistrictManager",
    }
    wide = conform.conform(
        base,
        [
            conform.Lookup(
                sources["expert"],
                {"StoreNumber": "StoreNumber"},
                {"BAEWorkdayID": "BAEWorkDayId", "BSISWorkdayID": "BSISWorkDayId"},
            ),
            conform.Lookup(sources["real_estate"], {"StoreNumber": "Loc"}, estate),
            conform.Lookup(sources["store_list"], {"StoreNumber": "Store"}, listed),
            conform.Lookup(
                sources["tv"].filter(quality.not_blank("Location")),
                {"StoreName": "Location"},
                {"DTVNowLocation": "f_tv"},
            ),
        ],
    )

    def yes_no(c: str):
        return fn.to_flag(c, TRUE_WORDS, FALSE_WORDS).cast("boolean")

    def marked(c: str):
        return fn.to_flag(c, MARK_WORDS).cast("boolean")

    def whole(c: str):
        return F.col(c).try_cast("int")

    def us_date(c: str):
        return F.try_to_date(F.col(c), "M/d/yyyy")

    def money(c):
        return fn.parse_money(c)

    comment, license_number = fn.split_on_marker(
        F.regexp_replace("SaleInvoiceComment", r"[\r\n]", " "), LICENSE_MARKER
    )
    store = wide.select(
        whole("StoreNumber").alias("StoreNumber"),
        F.lit(site.company_cd).alias("CompanyCd"),
        whole("StoreID").alias("SourceStoreIdentifier"),
        F.col("LocationLabel").alias("LocationName"),
        "Abbreviation",
        "GLCode",
        F.coalesce(F.lit(1) - fn.to_flag("Disabled", ("1", "true")), F.lit(1)).alias("StoreStatus"),
        whole("ManagerEmployeeID").alias("StoreManagerEmployeeId"),
        yes_no("ManagerCommissionable").alias("ManagerCommisionableIndicator"),
        fn.first_filled("Address", "d_address", "e_address").alias("Address"),
        fn.first_filled("City", "e_city").alias("City"),
        fn.first_filled("StateProv", "e_state").alias("StateProvince"),
        fn.first_filled("ZipPostal", "e_zip").alias("PostalCode"),
        "Country",
        F.col("PhoneNumber").cast("string").alias("Phone"),
        F.col("FaxNumber").cast("string").alias("Fax"),
        "StoreType",
        F.col("StaffLevel").try_cast("decimal(10,0)").alias("StaffLevel"),
        "SquareFootRange",
        F.coalesce(money("d_sqft"), money("SquareFootage")).cast("int").alias("SquareFoot"),
        F.col("Latitude").try_cast("decimal(20,10)").alias("Lattitude"),
        F.col("Longitude").try_cast("decimal(20,10)").alias("Longitude"),
        F.col("TimeZone").alias("Timezone"),
        yes_no("AdjustDST").alias("AdjustDST"),
        "CashPolicy",
        money("MaxCashDrawer").alias("MaxCashDrawer"),
        yes_no("Serial_on_OE").alias("SerialOnOEIndicator"),
        yes_no("Phone_on_OE").alias("PhoneOnOEIndicator"),
        yes_no("PAW_on_OE").alias("PAWOnOEIndicator"),
        yes_no("Comment_on_OE").alias("CommentOnOEIndicator"),
        yes_no("HideCustomerAddress").alias("HideCustomerAddressIndicator"),
        "EmailAddress",
        license_number.alias("ConsumerLicenseNumber"),
        comment.alias("SaleInvoiceComment"),
        "Taxes",
        F.coalesce(money("d_rent"), money("Rent")).alias("Rent"),
        money("PropertyTaxes").alias("PropertyTaxes"),
        money("InsuranceAmount").alias("InsuranceAmount"),
        money("OtherCharges").alias("OtherCharges"),
        money("DepositTaken").alias("Deposit"),
        "LandlordName",
        yes_no("UseLocationEmail").alias("UseLocationEmailIndicator"),
        F.col("d_type").alias("LocationType"),
        F.col("LandlordNotes").alias("LandlordNote"),
        us_date("LeaseStartDate").alias("LeaseStartDate"),
        us_date("LeaseEndDate").alias("LeaseEndDate"),
        "LeaseNotes",
        us_date("e_open").alias("StoreOpenDate"),
        us_date("e_close").alias("StoreCloseDate"),
        us_date("RelocationDate").alias("RelocationDate"),
        "StoreTier",
        *[c.alias(n) for n, c in fn.parse_hours("GeneralLocationNotes").items()],
        "AcquisitionName",
        marked("e_base").alias("BaseStoreIndicator"),
        marked("e_comp").alias("CompStoreIndicator"),
        marked("e_same").alias("SameStoreIndicator"),
        F.lit(None).cast("boolean").alias("FranchiseStoreIndicator"),
        "LeaseExpiration",
        "BuildTypeCode",
        "C_CDesignation",
        yes_no("d_tagline").alias("AuthorizedRetailedTagLineStatusIndicator"),
        whole("d_pylon").alias("PylonMonumentPanels"),
        whole("d_walls").alias("SellingWalls"),
        whole("d_accessory").alias("MemorableAccessoryWall"),
        "CashWrapExpansion",
        "WindowWrapGraphics",
        "LiveDTV",
        whole("d_tables").alias("LearningTables"),
        yes_no("d_community").alias("CommunityTableIndicator"),
        whole("d_diamond").alias("DiamondDisplays"),
        whole("d_fixtures").alias("CFixtures"),
        yes_no("d_kiosk").alias("TIOKioskIndicator"),
        yes_no("d_blade").alias("ApprovedforFlexBladeIndicator"),
        whole("d_cap").alias("CapIndexScore"),
        "SellingWallNotes",
        fn.later_date(us_date("d_remodel"), us_date("e_open")).alias("RemodelDate"),
        F.coalesce("RegionName", "d_market").alias(f"{own}Market"),
        F.coalesce("ChannelName", "d_region").alias(f"{own}Region"),
        F.coalesce("DistrictName", "d_district").alias(f"{own}District"),
        marked("f_tv").alias("DTVNowIndicator"),
        "BAEWorkDayId",
        "BSISWorkDayId",
        f"{own}RegionVP",
        f"{own}MarketDirector",
        f"{own}DistrictManager",
    )
    # Members every store dimension carries.
    members = [
        {"StoreNumber": 0, "SourceStoreIdentifier": 0, "LocationName": "General Location", "CompanyCd": site.company_cd},
        {"StoreNumber": -2, "SourceStoreIdentifier": -2, "LocationName": "Unknown", "CompanyCd": site.company_cd},
    ]
    return dedup.keep_latest(
        conform.with_special_members(store, members), ["StoreNumber"], ["SourceStoreIdentifier"]
    )


# Delivery names of the store table.
STORE_DELIVERY = {
    "store_num": "StoreNumber",
    "co_cd": "CompanyCd",
    "src_store_id": "SourceStoreIdentifier",
    "loc_nm": "LocationName",
    "abbr": "Abbreviation",
    "gl_cd": "GLCode",
    "store_stat": "StoreStatus",
    "sm_emp_id": "StoreManagerEmployeeId",
    "mgr_cmsnble_ind": "ManagerCommisionableIndicator",
    "addr": "Address",
    "cty": "City",
    "st_prv": "StateProvince",
    "pstl_cd": "PostalCode",
    "cntry": "Country",
    "ph": "Phone",
    "fax": "Fax",
    "store_typ": "StoreType",
    "staff_lvl": "StaffLevel",
    "s_ft_rng": "SquareFootRange",
    "sq_ft": "SquareFoot",
    "lattd": "Lattitude",
    "lngtd": "Longitude",
    "tz": "Timezone",
    "adj_dst_ind": "AdjustDST",
    "email": "EmailAddress",
    "cnsmr_lic_nbr": "ConsumerLicenseNumber",
    "taxes": "Taxes",
    "rnt": "Rent",
    "use_loc_email_ind": "UseLocationEmailIndicator",
    "loc_typ": "LocationType",
    "lndlrd_nt": "LandlordNote",
    "lease_start_dt": "LeaseStartDate",
    "lease_end_dt": "LeaseEndDate",
    "store_open_dt": "StoreOpenDate",
    "store_close_dt": "StoreCloseDate",
    "reloc_dt": "RelocationDate",
    "store_tier": "StoreTier",
    **{f"{d[:3].lower()}_{k.lower()}_tm": f"{d}{k}Time" for d in fn.DAY_CODES for k in ("Open", "Close")},
    "acn_nm": "AcquisitionName",
    "base_store_ind": "BaseStoreIndicator",
    "comp_store_ind": "CompStoreIndicator",
    "same_store_ind": "SameStoreIndicator",
    "frnchs_store_ind": "FranchiseStoreIndicator",
    "lease_exp": "LeaseExpiration",
    "build_type_cd": "BuildTypeCode",
    "c_and_c_dsgn": "C_CDesignation",
    "auth_rtl_tag_line_stat_ind": "AuthorizedRetailedTagLineStatusIndicator",
    "pylon_monmnt_panels": "PylonMonumentPanels",
    "sell_walls": "SellingWalls",
    "memorable_acc_wall": "MemorableAccessoryWall",
    "csh_wrap_expnd": "CashWrapExpansion",
    "wndw_wrap_grphc": "WindowWrapGraphics",
    "lve_dtv": "LiveDTV",
    "lrn_tbl": "LearningTables",
    "comnty_tbl_ind": "CommunityTableIndicator",
    "dmnd_dsp": "DiamondDisplays",
    "c_fixtures": "CFixtures",
    "tio_ksk_ind": "TIOKioskIndicator",
    "aprv_for_flex_bld": "ApprovedforFlexBladeIndicator",
    "cap_idx_score": "CapIndexScore",
    "sell_wall_nt": "SellingWallNotes",
    "remdl_dt": "RemodelDate",
    "dtv_now_ind": "DTVNowIndicator",
    "bae_wrkday_id": "BAEWorkDayId",
    "bsis_wrkday_id": "BSISWorkDayId",
    "store_hier_id": "store_hier_id",
    "att_hier_id": "att_hier_id",
    "cdc_ind_cd": "cdc_ind_cd",
}


def store_delta(
    prev: DataFrame | None, curr: DataFrame, bridge: DataFrame, dealers: DataFrame, site: Site = Site()
) -> DataFrame:
    """New and changed stores with both hierarchy ids, under delivery names."""
    rows = cdc.delta(prev, curr, ["StoreNumber"], method="except")
    rows = hierarchy.with_hierarchy_id(rows, site.levels, "store_hier_id")
    carriers = hierarchy.with_hierarchy_id(dealers, ["attregion", "attmarket"], "att_hier_id")
    rows = conform.bridge_lookup(
        rows,
        bridge,
        ["StoreNumber"],
        {"DealerCode": "__dealer"},
        active=(F.col("AssociationType") == "Retail") & (F.col("AssociationStatus") == "Active"),
        dim=carriers,
        dim_on={"__dealer": "dealercode"},
        dim_columns=["att_hier_id"],
    )
    return conform.project(rows, STORE_DELIVERY).distinct()


def store_hierarchy(stores: DataFrame, dealers: DataFrame, site: Site = Site()) -> DataFrame:
    return hierarchy.level_hierarchy(
        [
            hierarchy.LevelSource(dealers, "ATT Hierarchy", ["attregion", "attmarket"]),
            hierarchy.LevelSource(stores, site.hierarchy, site.levels),
        ]
    )


def store_hierarchy_delta(
    curr: tuple[DataFrame, DataFrame], prev: tuple[DataFrame, DataFrame] | None, site: Site = Site()
) -> DataFrame:
    """Delta of the hierarchy from current and previous (stores, dealers)."""
    before = None if prev is None else store_hierarchy(*prev, site)
    return cdc.delta(before, store_hierarchy(*curr, site), ["hier_id", "hier_nm"], method="except")


MANAGER_ROLES = ["RVPID", "MDIRID", "DMID"]


def management_sources(store_list: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) store-list rows by numeric manager ids; good keeps open stores only."""
    good, bad = quality.split_stored(store_list, {r.lower(): quality.numeric(r) for r in MANAGER_ROLES})
    return good.filter(F.col("Status") == "Open"), bad


def management_hierarchy(
    stores: DataFrame, store_list: DataFrame, employees: DataFrame, site: Site = Site()
) -> DataFrame:
    listed = store_list.withColumn("Store", F.col("Store").try_cast("int"))
    rows = conform.enrich(stores, listed, {"StoreNumber": "Store"}, MANAGER_ROLES, unique=False)
    return hierarchy.manager_hierarchy(rows, site.levels, MANAGER_ROLES, employees)


def management_hierarchy_delta(prev: DataFrame | None, curr: DataFrame) -> DataFrame:
    """Delta of two full outputs, so a change of manager without a change of store is seen."""
    return cdc.delta(prev, curr, ["hier_id"], method="except")
