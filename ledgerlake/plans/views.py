"""The view layer (V1-V14): master, SEA, clean and reporting views.

Each view is a function ``RawZone -> DataFrame``; stacked views call the
function they stack on, so Catalyst sees one plan.  Join matrix:

=========================  ====  ====  ======  ====  ====  ====  ======  ====
dimension                  V1    V3    V5,V7   V13   V2    V4    V6,V8   V14
=========================  ====  ====  ======  ====  ====  ====  ======  ====
store / customer           L     I     I       I     L     I     I       I
product                    L     I     I       I     L     I     I       I
date (timestamp = date)    L     I     I       I     L     I     I       I
channel / currency         L     I     I       -/I   L     I     I       I
promotion                  L     I     I       -     -     -     -       -
geography (of store/cust)  L     L     L       L     L     L     L       L
employee (store manager)   L     L     L       L     -     -     -       -
subcategory, category      -     -     L       L     -     -     L       L
=========================  ====  ====  ======  ====  ====  ====  ======  ====
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import money, text
from ledgerlake.operators.dedup import keep_latest
from ledgerlake.operators.joins import SHUFFLED, WIDE, DimJoin, prefixed, star_join
from ledgerlake.sources.zone import RawZone

KEEP, DROP = "keep", "drop"


# ---------------------------------------------------------------------------
# Conformed (enriched) dimensions: outriggers joined onto the dimension.
# ---------------------------------------------------------------------------
def _dimension(z: RawZone, table: str, df: DataFrame, outriggers: list[tuple[str, DataFrame, str, str]],
               fact_key: str, key: str, how: str, early: bool = False) -> DimJoin:
    """A dimension of a star with its outriggers (table, frame, parent key, key).

    They are joined onto the dimension, unless it is too large to broadcast and they are not: then the fact takes their
    keys through its shuffles and meets them last.  ``early``: a filter on an outrigger is to cut the dimension."""
    names = [t for t, *_ in outriggers]
    if not early and z.size(table) is not None and not z.bounded(table, *names) and all(z.bounded(t) for t in names):
        return DimJoin(z.hint(df, table), fact_key, key, how, SHUFFLED, [o[1:] for o in outriggers], z.copied(table))
    for _, o, parent_key, own_key in outriggers:
        df = df.join(o, F.col(parent_key) == F.col(own_key), "left")
    if z.bounded(table, *names):
        return DimJoin(z.hint(df, table, *names), fact_key, key, how, WIDE)
    return DimJoin(z.hint(df, table, *names), fact_key, key, how, SHUFFLED, rows=z.copied(table, *names))


def _geography(z: RawZone, parent_key: str) -> tuple[str, DataFrame, str, str]:
    g = prefixed(z.dim("RAW_DIMGEOGRAPHY"), "g_",
                 ["GeographyKey", "RegionCountryName", "ContinentName"])
    return "RAW_DIMGEOGRAPHY", g, parent_key, "g_GeographyKey"


def _store_join(z: RawZone, how: str, early: bool = False) -> DimJoin:
    s = prefixed(z["RAW_DIMSTORE"], "s_",
                 ["StoreKey", "GeographyKey", "StoreManager", "StoreName", "StoreType", "Status"])
    e = prefixed(z.dim("RAW_DIMEMPLOYEE"), "e_", ["EmployeeKey", "FirstName", "LastName"])
    return _dimension(z, "RAW_DIMSTORE", s, [_geography(z, "s_GeographyKey"),
                                             ("RAW_DIMEMPLOYEE", e, "s_StoreManager", "e_EmployeeKey")],
                      "StoreKey", "s_StoreKey", how, early)


def _customer_join(z: RawZone, how: str, early: bool = False) -> DimJoin:
    # the name is built here: one text a row travels with the fact, not two
    c = z["RAW_DIMCUSTOMER"].select(
        F.col("CustomerKey").alias("c_CustomerKey"), F.col("GeographyKey").alias("c_GeographyKey"),
        text.full_name(F.col("FirstName"), F.col("LastName")).alias("c_Name"), F.col("Gender").alias("c_Gender"))
    return _dimension(z, "RAW_DIMCUSTOMER", c, [_geography(z, "c_GeographyKey")], "CustomerKey", "c_CustomerKey", how, early)


def _product_join(z: RawZone, hierarchy: bool, how: str, early: bool = False) -> DimJoin:
    p = prefixed(z["RAW_DIMPRODUCT"], "p_",
                 ["ProductKey", "ProductName", "BrandName", "ProductSubcategoryKey"])
    outriggers = []
    if hierarchy:
        sub = prefixed(z.dim("RAW_DIMPRODUCTSUBCATEGORY"), "sub_",
                       ["ProductSubcategoryKey", "ProductSubcategoryName", "ProductCategoryKey"])
        cat = prefixed(z.dim("RAW_DIMPRODUCTCATEGORY"), "cat_",
                       ["ProductCategoryKey", "ProductCategoryName"])
        outriggers = [("RAW_DIMPRODUCTSUBCATEGORY", sub, "p_ProductSubcategoryKey", "sub_ProductSubcategoryKey"),
                      ("RAW_DIMPRODUCTCATEGORY", cat, "sub_ProductCategoryKey", "cat_ProductCategoryKey")]
    return _dimension(z, "RAW_DIMPRODUCT", p, outriggers, "ProductKey", "p_ProductKey", how, early)


def store_dim(z: RawZone) -> DataFrame:
    return _store_join(z, "inner", early=True).dim


def customer_dim(z: RawZone) -> DataFrame:
    return _customer_join(z, "inner", early=True).dim


def product_dim(z: RawZone, hierarchy: bool) -> DataFrame:
    return _product_join(z, hierarchy, "inner", early=True).dim


def date_dim(z: RawZone) -> DataFrame:
    # The fact key is a zone-less timestamp, the dimension key a DATE: widen the
    # date to midnight on the (small) dimension side, so a fact row with a time
    # of day never matches -- and the fact column stays untouched.
    d = z.dim("RAW_DIMDATE").select(
        F.col("DateKey").cast("timestamp_ntz").alias("d_DateKey"),
        F.col("CalendarYear").alias("d_CalendarYear"))
    return z.hint(d, "RAW_DIMDATE")


def _keys(z: RawZone, table: str, key: str, prefix: str) -> DataFrame:
    return z.hint(z[table].select(F.col(key).alias(prefix + key)), table)


def currency_dim(z: RawZone) -> DataFrame:
    return z.hint(prefixed(z["RAW_DIMCURRENCY"], "cur_", ["CurrencyKey", "CurrencyName"]),
                  "RAW_DIMCURRENCY")


# ---------------------------------------------------------------------------
# Store-channel star
# ---------------------------------------------------------------------------
# ``texts``, here and below: whether the caller wants the dimensions' columns, or only counts rows and sums the fact's.
def _store_star(z: RawZone, orphans: str, hierarchy: bool, early: bool = False, texts: bool = True):
    how = "left" if orphans == KEEP else "inner"
    return star_join(z["RAW_FACTSALES"], [
        _store_join(z, how, early),
        _product_join(z, hierarchy, how),
        DimJoin(date_dim(z), "DateKey", "d_DateKey", how, WIDE),
        DimJoin(_keys(z, "RAW_DIMCHANNEL", "ChannelKey", "ch_"), "channelKey", "ch_ChannelKey", how),
        DimJoin(_keys(z, "RAW_DIMPROMOTION", "PromotionKey", "pro_"),
                "PromotionKey", "pro_PromotionKey", how),
    ], texts)


def _store_ids_v12(j: DataFrame) -> DataFrame:
    return j.select(
        "SalesKey", "DateKey", "StoreKey", "ProductKey", "SalesQuantity", "UnitPrice",
        F.col("s_StoreName").alias("StoreName"),
        F.col("g_RegionCountryName").alias("RegionCountryName"),
        F.col("p_ProductName").alias("ProductName"),
        F.col("p_BrandName").alias("BrandName"),
        F.col("d_CalendarYear").alias("CalendarYear"),
        text.full_name(F.col("e_FirstName"), F.col("e_LastName")).alias("StoreManagerName"))


def master_sales_v1_left(z: RawZone) -> DataFrame:
    """V1: every fact row kept (LEFT JOIN to all seven dimensions)."""
    return _store_ids_v12(_store_star(z, KEEP, hierarchy=False))


def master_sales_v2_inner(z: RawZone) -> DataFrame:
    """V3: orphans dropped by inner joins; geography and employee stay left."""
    return _store_ids_v12(_store_star(z, DROP, hierarchy=False))


def _store_business(j: DataFrame, with_revenue: bool) -> DataFrame:
    cols = ["SalesKey", "DateKey", "SalesQuantity", "UnitPrice"]
    if with_revenue:
        cols.append(money.revenue().alias("TotalRevenue"))
    return j.select(
        *cols,
        F.col("s_StoreName").alias("Store"),
        F.col("s_StoreType").alias("StoreType"),
        F.col("g_RegionCountryName").alias("Country"),
        F.col("g_ContinentName").alias("Continent"),
        F.col("p_ProductName").alias("Product"),
        F.col("p_BrandName").alias("Brand"),
        F.col("cat_ProductCategoryName").alias("Category"),
        F.col("sub_ProductSubcategoryName").alias("SubCategory"),
        F.col("d_CalendarYear").alias("Year"),
        text.full_name(F.col("e_FirstName"), F.col("e_LastName")).alias("StoreManagerName"))


def master_sales_v3_hierarchy(z: RawZone) -> DataFrame:
    """V5: business names plus category / subcategory / continent."""
    return _store_business(_store_star(z, DROP, hierarchy=True), with_revenue=False)


def master_sales(z: RawZone, texts: bool = True) -> DataFrame:
    """V7 (final VIEW_MASTER_SALES): V5 plus TotalRevenue."""
    return _store_business(_store_star(z, DROP, hierarchy=True, texts=texts), with_revenue=True)


# ---------------------------------------------------------------------------
# Online star
# ---------------------------------------------------------------------------
def _online_star(z: RawZone, orphans: str, hierarchy: bool, early: bool = False, texts: bool = True):
    how = "left" if orphans == KEEP else "inner"
    return star_join(z["RAW_FACT_ONLINESALES"], [
        _customer_join(z, how, early),
        _product_join(z, hierarchy, how),
        DimJoin(date_dim(z), "DateKey", "d_DateKey", how, WIDE),
        DimJoin(currency_dim(z), "CurrencyKey", "cur_CurrencyKey", how, WIDE),
    ], texts)


def _customer_name(trimmed: bool = False):
    n = F.col("c_Name")
    return (F.trim(n) if trimmed else n).alias("CustomerName")


def _online_ids_v12(j: DataFrame) -> DataFrame:
    return j.select(
        "OnlineSalesKey", "DateKey", "CustomerKey", "ProductKey", "SalesQuantity", "UnitPrice",
        _customer_name(),
        F.col("g_RegionCountryName").alias("RegionCountryName"),
        F.col("p_ProductName").alias("ProductName"),
        F.col("p_BrandName").alias("BrandName"),
        F.col("d_CalendarYear").alias("CalendarYear"),
        F.col("cur_CurrencyName").alias("CurrencyName"))


def master_online_v1_left(z: RawZone) -> DataFrame:
    """V2: every online fact row kept."""
    return _online_ids_v12(_online_star(z, KEEP, hierarchy=False))


def master_online_v2_inner(z: RawZone) -> DataFrame:
    """V4: customer, product, date, currency inner; geography left."""
    return _online_ids_v12(_online_star(z, DROP, hierarchy=False))


def _online_business(j: DataFrame, with_revenue: bool) -> DataFrame:
    cols = ["OnlineSalesKey", "DateKey", "SalesQuantity", "UnitPrice"]
    if with_revenue:
        cols.append(money.revenue().alias("TotalRevenue"))
    return j.select(
        *cols,
        _customer_name(),
        F.col("g_RegionCountryName").alias("Country"),
        F.col("g_ContinentName").alias("Continent"),
        F.col("p_ProductName").alias("Product"),
        F.col("p_BrandName").alias("Brand"),
        F.col("cat_ProductCategoryName").alias("Category"),
        F.col("sub_ProductSubcategoryName").alias("SubCategory"),
        F.col("d_CalendarYear").alias("Year"),
        F.col("cur_CurrencyName").alias("CurrencyName"))


def master_online_v3_hierarchy(z: RawZone) -> DataFrame:
    """V6."""
    return _online_business(_online_star(z, DROP, hierarchy=True), with_revenue=False)


def master_online(z: RawZone, texts: bool = True) -> DataFrame:
    """V8 (final VIEW_MASTER_ONLINESALES)."""
    return _online_business(_online_star(z, DROP, hierarchy=True, texts=texts), with_revenue=True)


# ---------------------------------------------------------------------------
# Regional, clean and reporting views
# ---------------------------------------------------------------------------
def sea_performance(z: RawZone) -> DataFrame:
    """V9: master sales in the four South-East-Asian countries.  The filter is
    on the nullable side of a left join, so Catalyst makes that join inner and
    pushes the IN list down to the geography rows."""
    return _store_business(_store_star(z, DROP, hierarchy=True, early=True), with_revenue=True).where(F.col("Country").isin(text.SEA_COUNTRIES))


def sea_online_performance(z: RawZone) -> DataFrame:
    """V10."""
    return _online_business(_online_star(z, DROP, hierarchy=True, early=True), with_revenue=True).where(F.col("Country").isin(text.SEA_COUNTRIES))


def clean_sales(z: RawZone) -> DataFrame:
    """V11: latest row per SalesKey, with its RowRank (always 1)."""
    return keep_latest(master_sales(z), "SalesKey")


def clean_online(z: RawZone) -> DataFrame:
    """V12: latest row per OnlineSalesKey."""
    return keep_latest(master_online(z), "OnlineSalesKey")


def rpt_sales_master(z: RawZone, texts: bool = True) -> DataFrame:
    """V13 (VIEW_RPT_SALES_MASTER): cost, profit, cleaned attributes.  No
    channel / promotion joins, so it may keep rows the master view drops."""
    j = star_join(z["RAW_FACTSALES"], [
        _store_join(z, "inner"),
        _product_join(z, True, "inner"),
        DimJoin(date_dim(z), "DateKey", "d_DateKey", "inner", WIDE),
    ], texts)
    return j.select(
        "SalesKey", "DateKey", "StoreKey", "ProductKey", "SalesQuantity", "UnitPrice", "UnitCost",
        money.revenue().alias("TotalRevenue"),
        money.cost().alias("TotalCost"),
        money.profit().alias("NetProfit"),
        text.blank_to_null(F.col("s_StoreName")).alias("StoreName"),
        text.null_if_in(F.col("s_Status"), text.REPORT_STORE_STATUS_NULLS).alias("StoreStatus"),
        F.col("s_StoreType").alias("StoreType"),
        F.trim(F.col("g_RegionCountryName")).alias("CountryName"),
        F.trim(F.col("g_ContinentName")).alias("ContinentName"),
        F.trim(F.col("p_ProductName")).alias("ProductName"),
        F.trim(F.col("p_BrandName")).alias("BrandName"),
        F.trim(F.col("cat_ProductCategoryName")).alias("CategoryName"),
        F.trim(F.col("sub_ProductSubcategoryName")).alias("SubCategoryName"),
        F.trim(text.full_name(F.col("e_FirstName"), F.col("e_LastName"))).alias("StoreManagerName"),
        F.col("d_CalendarYear").alias("CalendarYear"))


def rpt_online_master(z: RawZone, texts: bool = True) -> DataFrame:
    """V14 (VIEW_RPT_ONLINESALES_MASTER): OnlineSalesKey renamed SalesKey;
    subcategory joined only to reach the category."""
    j = _online_star(z, DROP, hierarchy=True, texts=texts)
    return j.select(
        F.col("OnlineSalesKey").alias("SalesKey"),
        "DateKey", "CustomerKey", "ProductKey", "SalesQuantity", "UnitPrice", "UnitCost",
        money.revenue().alias("TotalRevenue"),
        money.cost().alias("TotalCost"),
        money.profit().alias("NetProfit"),
        _customer_name(trimmed=True),
        text.null_if_in(F.col("c_Gender"), text.REPORT_GENDER_NULLS).alias("Gender"),
        F.trim(F.col("g_RegionCountryName")).alias("CountryName"),
        F.trim(F.col("g_ContinentName")).alias("ContinentName"),
        F.trim(F.col("p_ProductName")).alias("ProductName"),
        F.trim(F.col("p_BrandName")).alias("BrandName"),
        F.trim(F.col("cat_ProductCategoryName")).alias("CategoryName"),
        F.col("d_CalendarYear").alias("CalendarYear"),
        F.col("cur_CurrencyName").alias("CurrencyName"))


VIEWS = {
    "master_sales_v1_left": master_sales_v1_left,
    "master_online_v1_left": master_online_v1_left,
    "master_sales_v2_inner": master_sales_v2_inner,
    "master_online_v2_inner": master_online_v2_inner,
    "master_sales_v3_hierarchy": master_sales_v3_hierarchy,
    "master_online_v3_hierarchy": master_online_v3_hierarchy,
    "master_sales": master_sales,
    "master_online": master_online,
    "sea_performance": sea_performance,
    "sea_online_performance": sea_online_performance,
    "clean_sales": clean_sales,
    "clean_online": clean_online,
    "rpt_sales_master": rpt_sales_master,
    "rpt_online_master": rpt_online_master,
}
