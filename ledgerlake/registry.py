"""Query registry: one entry per operator of the inventory.

``QUERIES[name](zone) -> DataFrame`` is the Spark implementation;
``ORACLE[name]`` the equivalent DuckDB SQL over the same driver tables.
Ingest and streaming entries (which need a file round trip) are registered by
``ledgerlake.plans.ingest_queries``.
"""

from __future__ import annotations

from functools import partial
from typing import Callable

from pyspark.sql import DataFrame

from ledgerlake import oracle, schemas
from ledgerlake.plans import quality as q
from ledgerlake.plans import views
from ledgerlake.sources.zone import RawZone

ZoneQuery = Callable[[RawZone], DataFrame]

QUERIES: dict[str, ZoneQuery] = {}
ORACLE: dict[str, str] = {}

VIEW_NAMES = {
    "master_sales_v1_left": "VIEW_MASTER_SALES_V1",
    "master_online_v1_left": "VIEW_MASTER_ONLINESALES_V1",
    "master_sales_v2_inner": "VIEW_MASTER_SALES_V2",
    "master_online_v2_inner": "VIEW_MASTER_ONLINESALES_V2",
    "master_sales_v3_hierarchy": "VIEW_MASTER_SALES_V3",
    "master_online_v3_hierarchy": "VIEW_MASTER_ONLINESALES_V3",
    "master_sales": "VIEW_MASTER_SALES",
    "master_online": "VIEW_MASTER_ONLINESALES",
    "sea_performance": "VIEW_SEA_PERFORMANCE",
    "sea_online_performance": "VIEW_SEA_ONLINE_PERFORMANCE",
    "clean_sales": "VIEW_CLEAN_SALES_DATA",
    "clean_online": "VIEW_CLEAN_ONLINESALES_DATA",
    "rpt_sales_master": "VIEW_RPT_SALES_MASTER",
    "rpt_online_master": "VIEW_RPT_ONLINESALES_MASTER",
}


def register(name: str, fn: ZoneQuery, sql: str | None) -> None:
    QUERIES[name] = fn
    if sql is not None:
        ORACLE[name] = sql


def _order_all(table_cols: list[str], key: str) -> str:
    rest = [c for c in table_cols if c != key]
    return ", ".join([f"{key} ASC NULLS LAST"] + [f"{c} ASC NULLS LAST" for c in rest])


def _cols(table: str) -> list[str]:
    return [f.name for f in schemas.RAW_TABLES[table].fields]


def _hits(**tests: str) -> str:
    """Columns that count the rows passing each test; NULL over an empty relation, as a sum would be."""
    return ", ".join(f"if(count(*) > 0, count_if(coalesce({t}, FALSE))::BIGINT, NULL) AS {n}" for n, t in tests.items())


def _blank(column: str) -> str:
    return f"coalesce(length(trim({column})), 0) = 0"


def _repeated(relation: str, key: str) -> str:
    """How many keys (NULL is one) stand on several rows: every such key has one second row."""
    return f"(SELECT count(*) FROM (SELECT row_number() OVER (PARTITION BY {key}) AS nth FROM {relation}) WHERE nth = 2)"


def _stacked(rows: list[str]) -> str:
    return "\nUNION ALL BY NAME\n".join(rows)


# --- views V1-V14 ---------------------------------------------------------------
for _name, _fn in views.VIEWS.items():
    register(_name, _fn, oracle.with_prelude(f"SELECT * FROM {VIEW_NAMES[_name]}"))

# --- Q1 row counts, Q8 uniqueness, Q9 ordered samples ------------------------------
for _short, _table in q.SHORT.items():
    register(f"row_count_{_short}", partial(q.row_count, table=_table),
             oracle.with_prelude(f"SELECT COUNT(*) AS total_rows FROM {_table}"))

for _short in ["store", "geography", "category", "subcategory", "channel", "currency",
               "employee", "promotion", "date"]:
    _table = q.SHORT[_short]
    _key = schemas.TABLE_KEYS[_table]
    _alias = "distinct_dates" if _short == "date" else "distinct_keys"
    register(f"key_uniqueness_{_short}", partial(q.key_uniqueness, table=_table),
             oracle.with_prelude(f"SELECT COUNT(*) AS total_rows, COUNT(DISTINCT {_key}) AS {_alias} "
                                 f"FROM {_table}"))

for _short, _n in [("category", 20), ("subcategory", 30), ("channel", 20), ("currency", 20),
                   ("employee", 20), ("promotion", 20), ("date", 20)]:
    _table = q.SHORT[_short]
    _key = schemas.TABLE_KEYS[_table]
    register(f"ordered_sample_{_short}", partial(q.ordered_sample, table=_table, n=_n),
             oracle.with_prelude(f"SELECT * FROM {_table} ORDER BY {_order_all(_cols(_table), _key)} "
                                 f"LIMIT {_n}"))

# --- Q6 samples ---------------------------------------------------------------------
_SAMPLES = [
    ("sample_product", "RAW_DIMPRODUCT", 10),
    ("sample_store", "RAW_DIMSTORE", 10),
    ("sample_geography", "RAW_DIMGEOGRAPHY", 20),
]
for _name, _table, _n in _SAMPLES:
    _key = schemas.TABLE_KEYS[_table]
    register(_name, (lambda t, k, n: lambda z: q.sample_rows(z[t], k, n))(_table, _key, _n),
             oracle.with_prelude(f"SELECT * FROM {_table} ORDER BY {_order_all(_cols(_table), _key)} "
                                 f"LIMIT {_n}"))

_SEA_SALES_COLS = ["SalesKey", "DateKey", "SalesQuantity", "UnitPrice", "TotalRevenue", "Store",
                   "StoreType", "Country", "Continent", "Product", "Brand", "Category",
                   "SubCategory", "Year", "StoreManagerName"]
_SEA_ONLINE_COLS = ["OnlineSalesKey", "DateKey", "SalesQuantity", "UnitPrice", "TotalRevenue",
                    "CustomerName", "Country", "Continent", "Product", "Brand", "Category",
                    "SubCategory", "Year", "CurrencyName"]
register("sample_sea_sales", lambda z: q.sample_rows(views.sea_performance(z), "SalesKey", 100),
         oracle.with_prelude("SELECT * FROM VIEW_SEA_PERFORMANCE ORDER BY "
                             f"{_order_all(_SEA_SALES_COLS, 'SalesKey')} LIMIT 100"))
register("sample_sea_online",
         lambda z: q.sample_rows(views.sea_online_performance(z), "OnlineSalesKey", 100),
         oracle.with_prelude("SELECT * FROM VIEW_SEA_ONLINE_PERFORMANCE ORDER BY "
                             f"{_order_all(_SEA_ONLINE_COLS, 'OnlineSalesKey')} LIMIT 100"))

# Labels of the checks below are fixed values: result rows carry them.

# --- Q2-Q5, Q7 profiles ----------------------------------------------------------------
_PRODUCT_PROFILE = {
    "Total_Rows": "count(*)",
    "Unique_Keys": "len(list_distinct(list(ProductKey)))",
    "Duplicate_Keys": "count(*) - len(list_distinct(list(ProductKey)))",
    "First_Sale_Date": "min(AvailableForSaleDate)",
    "Last_Sale_Date": "max(AvailableForSaleDate)",
    "Null_Names": "count(*) - count(ProductName)",
    "Invalid_Prices": "count_if(least(coalesce(UnitPrice, 0), coalesce(UnitCost, 0)) < 0)",
}


def _product_profile(*names: str) -> str:
    counts = ("Total_Rows", "Unique_Keys", "Duplicate_Keys", "Null_Names", "Invalid_Prices")
    return oracle.with_prelude("SELECT " + ", ".join(
        f"({_PRODUCT_PROFILE[n]}){'::BIGINT' if n in counts else ''} AS {n}" for n in names) + " FROM RAW_DIMPRODUCT")


register("product_key_profile", q.product_key_profile, _product_profile("Total_Rows", "Unique_Keys", "Duplicate_Keys"))
register("product_date_range", q.product_date_range, _product_profile("First_Sale_Date", "Last_Sale_Date"))
register("product_null_names", q.product_null_names, _product_profile("Null_Names"))
register("product_invalid_prices", q.product_invalid_prices, _product_profile("Invalid_Prices"))
register("product_profile_suite", q.product_profile_suite, _product_profile(*_PRODUCT_PROFILE))
_missing = {f"null_{c}": f"count_if({c} IS NULL)::BIGINT" for c in ("CustomerKey", "GeographyKey", "YearlyIncome")}
register("customer_profile", q.customer_profile, oracle.with_prelude("SELECT " + ", ".join(f"{e} AS {n}" for n, e in {
    "total_rows": "count(*)", "unique_customer_keys": "len(list_distinct(list(CustomerKey)))::BIGINT",
    "oldest_customer_birth": "min(BirthDate)", "youngest_customer_birth": "max(BirthDate)", **_missing,
    "min_income": "min(YearlyIncome)", "max_income": "max(YearlyIncome)"}.items()) + " FROM RAW_DIMCUSTOMER"))

# --- Q10-Q13 blank / NULL checks -----------------------------------------------------------
for _name, _table, _tests in [
    ("category_blank_check", "RAW_DIMPRODUCTCATEGORY",
     {"null_key_rows": "ProductCategoryKey IS NULL", "blank_name_rows": _blank("ProductCategoryName")}),
    ("subcategory_blank_check", "RAW_DIMPRODUCTSUBCATEGORY",
     {"null_subcat_key_rows": "ProductSubcategoryKey IS NULL", "null_cat_key_rows": "ProductCategoryKey IS NULL",
      "blank_name_rows": _blank("ProductSubcategoryName")}),
    ("promotion_blank_check", "RAW_DIMPROMOTION",
     {"null_key_rows": "PromotionKey IS NULL", "blank_name_rows": _blank("PromotionName")}),
    ("date_null_check", "RAW_DIMDATE",
     {"null_datekey": "DateKey IS NULL", "null_calendaryear": "CalendarYear IS NULL"}),
]:
    register(_name, getattr(q, _name), oracle.with_prelude(f"SELECT {_hits(**_tests)} FROM {_table}"))

# --- Q14-Q19 relationships, region, audit, inventory ----------------------------------------
register("orphan_subcategories", q.orphan_subcategories, oracle.with_prelude("""
SELECT ProductCategoryKey, count(*) AS orphan_subcategory_rows
FROM RAW_DIMPRODUCTSUBCATEGORY ANTI JOIN RAW_DIMPRODUCTCATEGORY USING (ProductCategoryKey)
GROUP BY ALL ORDER BY 2 DESC"""))
register("subcategories_per_category", q.subcategories_per_category, oracle.with_prelude("""
SELECT ProductCategoryKey, ProductCategoryName, sum(coalesce(held, 0))::BIGINT AS subcategory_count
FROM RAW_DIMPRODUCTCATEGORY
LEFT JOIN (SELECT ProductCategoryKey, count(ProductSubcategoryKey) AS held
           FROM RAW_DIMPRODUCTSUBCATEGORY GROUP BY ALL) USING (ProductCategoryKey)
GROUP BY ALL ORDER BY 1"""))
register("sea_country_lookup", q.sea_country_lookup, oracle.with_prelude("""
SELECT RegionCountryName, GeographyKey FROM RAW_DIMGEOGRAPHY
WHERE regexp_matches(RegionCountryName, 'Sing|Malay|Thai|Viet') GROUP BY ALL"""))
register("non_sea_leak_check", q.non_sea_leak_check, oracle.with_prelude(
    f"SELECT count_if(NOT list_contains({oracle.SEA}, Country))::BIGINT AS Non_SEA_Rows FROM VIEW_SEA_PERFORMANCE"))
register("orphan_key_audit", q.orphan_key_audit, oracle.with_prelude(_stacked([
    f"SELECT '{label}' AS Issue_Type, count(*) AS Fail_Count FROM {fact} ANTI JOIN {dim} USING ({key})"
    for label, fact, dim, key in [
        ("Orphan Product Keys Offline", "RAW_FACTSALES", "o_item", "ProductKey"),
        ("Orphan Product Keys Online", "RAW_FACT_ONLINESALES", "o_item", "ProductKey"),
        ("Orphan Store Keys", "RAW_FACTSALES", "o_store", "StoreKey"),
        ("Orphan Date Keys", "RAW_FACTSALES", "o_day", "DateKey"),
    ]])))
register("table_inventory", q.table_inventory, oracle.with_prelude(
    _stacked([f"SELECT '{t}' AS TABLE_NAME, count(*) AS ROW_COUNT FROM {t}" for t in sorted(schemas.RAW_TABLES)])
    + "\nORDER BY TABLE_NAME"))


def _placeholders(column: str, null_name: str) -> str:
    return _hits(Count_NA=f"upper({column}) = 'N/A'", Count_Unknown=f"upper({column}) = 'UNKNOWN'",
                 Count_Empty=f"trim({column}) = ''", **{null_name: f"{column} IS NULL"})


register("placeholder_inventory_raw", q.placeholder_inventory_raw, oracle.with_prelude(_stacked([
    f"SELECT '{t}' AS Source_Table, '{c}' AS Column_Name, '{use}' AS Channel_Usage, {_placeholders(c, 'Count_NULL')} FROM {t}"
    for t, c, use in [("RAW_DIMPRODUCT", "BrandName", "Shared (Online & Store)"),
                      ("RAW_DIMSTORE", "StoreType", "Physical Sales Only"),
                      ("RAW_DIMCUSTOMER", "Education", "Online Sales Only")]])))
register("placeholder_check_views", q.placeholder_check_views, oracle.with_prelude(_stacked([
    f"SELECT '{v}' AS Reporting_View, 'Brand' AS Column_Name, {_placeholders('Brand', 'Count_Clean_NULL')} FROM {v}"
    for v in ("VIEW_MASTER_SALES", "VIEW_MASTER_ONLINESALES")])))
register("store_name_rule_preview", q.store_name_rule_preview, oracle.with_prelude("""
SELECT StoreName AS Original_Value,
       if(rule = 'Valid Data', bare, NULL) AS Cleaned_Value, rule AS Rule_Applied
FROM (SELECT *, trim(StoreName) AS bare,
             coalesce(map {'': 'Empty String Rule', 'n/a': 'Placeholder Rule', 'unknown': 'Placeholder Rule',
                           'null': 'Placeholder Rule', '0': 'Placeholder Rule'}[lower(trim(StoreName))], 'Valid Data') AS rule
      FROM RAW_DIMSTORE)
WHERE list_contains(['', ' ', 'N/A', '0', 'Unknown'], StoreName) OR list_contains(['N/A', '0'], Status)
ORDER BY StoreKey NULLS LAST, StoreName NULLS LAST, Status NULLS LAST
LIMIT 100"""))

# --- Q23-Q28 duplicates -------------------------------------------------------------------------
_ENTITIES = [("Store Sales", "VIEW_MASTER_SALES", "SalesKey"), ("Online Sales", "VIEW_MASTER_ONLINESALES", "OnlineSalesKey"),
             ("Product", "RAW_DIMPRODUCT", "ProductKey"), ("Customer", "RAW_DIMCUSTOMER", "CustomerKey")]


def _verdict(head: str, relation: str, key: str, passed: str) -> str:
    return (f"SELECT {head}, '{key}' AS Criteria, n AS Duplicate_Count, if(n > 0, 'FAILED', '{passed}') AS Status "
            f"FROM (SELECT {_repeated(relation, key)} AS n)")


register("duplicate_suite", q.duplicate_suite, oracle.with_prelude(_stacked([
    _verdict(f"'{entity}' AS Entity", rel, key, "PASSED (No Examples Available)") for entity, rel, key in _ENTITIES])))
register("dedup_before_after", q.dedup_before_after, oracle.with_prelude(_stacked([
    f"SELECT '{label}' AS View_Type, count(*) AS Row_Count FROM {v}"
    for label, v in [("Original (Master)", "VIEW_MASTER_SALES"), ("Cleaned (Deduplicated)", "VIEW_CLEAN_SALES_DATA")]])))
for _name, _view, _key in [("clean_sales_validation", "VIEW_CLEAN_SALES_DATA", "SalesKey"),
                           ("clean_online_validation", "VIEW_CLEAN_ONLINESALES_DATA", "OnlineSalesKey")]:
    register(_name, getattr(q, _name), oracle.with_prelude(
        _verdict(f"'{_view}' AS Checked_View", _view, _key, "PASSED (0 Duplicates)")))
register("duplicate_key_listing", q.duplicate_key_listing, oracle.with_prelude(_stacked([
    f"SELECT DISTINCT '{label}' AS Test_Type, {key} AS Key_ID, size AS Count "
    f"FROM (SELECT {key}, count(*) OVER (PARTITION BY {key}) AS size FROM {rel}) WHERE size > 1"
    for label, rel, key in [("Physical Sales Duplicates", "VIEW_MASTER_SALES", "SalesKey"),
                            ("Online Sales Duplicates", "VIEW_MASTER_ONLINESALES", "OnlineSalesKey")]])))

# --- Q27, Q29-Q31 reconciliation ------------------------------------------------------------------
_CHANNELS = [("Physical Sales", "RAW_FACTSALES", "VIEW_MASTER_SALES"), ("Online Sales", "RAW_FACT_ONLINESALES", "VIEW_MASTER_ONLINESALES")]
_D = "DECIMAL(38,2)"
_AMOUNT = f"sum(SalesQuantity * UnitPrice)::{_D}"


def _compared(head: str, raw_name: str, raw: str, view_name: str, view: str, raw_agg: str, view_agg: str) -> str:
    return (f"SELECT {head}, {raw_name}, {view_name}, {view_name} - {raw_name} AS Difference "
            f"FROM (SELECT {raw_agg} AS {raw_name} FROM {raw}), (SELECT {view_agg} AS {view_name} FROM {view})")


register("rowcount_reconciliation", q.rowcount_reconciliation, oracle.with_prelude(_stacked([
    _compared(f"'{c}' AS Source", "Raw_Count", raw, "View_Count", view, "count(*)", "count(*)") for c, raw, view in _CHANNELS])))
register("revenue_reconciliation", q.revenue_reconciliation, oracle.with_prelude(
    f"SELECT Dataset, Raw_Revenue_Calc, View_Revenue_Total, Difference::{_D} AS Difference FROM (" + _stacked([
        _compared(f"'{c}' AS Dataset", "Raw_Revenue_Calc", raw, "View_Revenue_Total", view, _AMOUNT, f"sum(TotalRevenue)::{_D}")
        for c, raw, view in _CHANNELS]) + ")"))


def _bridge(raw_label: str, raw: str, less_label: str, keys: dict[str, str], view_label: str, view: str) -> str:
    lost = " OR ".join(f"{k} <> ALL (SELECT {k} FROM {dim})" for k, dim in keys.items())
    return oracle.with_prelude(_stacked([
        f"SELECT '{raw_label}' AS Category, {_AMOUNT} AS Revenue FROM {raw}",
        f"SELECT '{less_label}' AS Category, (0 - {_AMOUNT})::{_D} AS Revenue FROM {raw} WHERE {lost}",
        f"SELECT '{view_label}' AS Category, sum(TotalRevenue)::{_D} AS Revenue FROM {view}"]))


register("revenue_bridge_sales", q.revenue_bridge_sales, _bridge(
    "Raw Source For Physical Sales", "RAW_FACTSALES", "Physical: Less Orphans (Invalid Products)",
    {"ProductKey": "RAW_DIMPRODUCT", "StoreKey": "RAW_DIMSTORE"}, "Final View For Physical Sales (Actual)", "VIEW_MASTER_SALES"))
register("revenue_bridge_online", q.revenue_bridge_online, _bridge(
    "Raw Source For Online Sales", "RAW_FACT_ONLINESALES", "Online: Less Orphans (Invalid Products)",
    {"ProductKey": "RAW_DIMPRODUCT"}, "Final View For Online Sales (Actual)", "VIEW_MASTER_ONLINESALES"))

# --- Q23-Q31 in one pass: the rows of the separate queries, by check and measure ---------------------
for _short, _raw, _view, _clean, _key, _lost in [
    ("sales", "RAW_FACTSALES", "VIEW_MASTER_SALES", "VIEW_CLEAN_SALES_DATA", "SalesKey",
     "ProductKey <> ALL (SELECT ProductKey FROM RAW_DIMPRODUCT) OR StoreKey <> ALL (SELECT StoreKey FROM RAW_DIMSTORE)"),
    ("online", "RAW_FACT_ONLINESALES", "VIEW_MASTER_ONLINESALES", "VIEW_CLEAN_ONLINESALES_DATA", "OnlineSalesKey",
     "ProductKey <> ALL (SELECT ProductKey FROM RAW_DIMPRODUCT)"),
]:
    _c = "Physical" if _short == "sales" else "Online"
    _rows, _shown = f"(SELECT count(*) FROM {_raw})", f"(SELECT count(*) FROM {_view})"
    _worth, _seen = f"(SELECT {_AMOUNT} FROM {_raw})", f"(SELECT sum(TotalRevenue)::{_D} FROM {_view})"
    register(f"master_checks_{_short}", getattr(q, f"master_checks_{_short}"), oracle.with_prelude(_stacked([
        f"SELECT '{check}' AS Check_Name, '{measure}' AS Measure, ({value})::{_D} AS Value" for check, measure, value in [
            ("duplicate_suite", "Duplicate_Count", _repeated(_view, _key)),
            ("dedup_before_after", "Original (Master)", _shown),
            ("dedup_before_after", "Cleaned (Deduplicated)", f"(SELECT count(*) FROM {_clean})"),
            ("rowcount_reconciliation", "Raw_Count", _rows), ("rowcount_reconciliation", "View_Count", _shown),
            ("rowcount_reconciliation", "Difference", f"{_shown} - {_rows}"),
            ("revenue_reconciliation", "Raw_Revenue_Calc", _worth), ("revenue_reconciliation", "View_Revenue_Total", _seen),
            ("revenue_reconciliation", "Difference", f"{_seen} - {_worth}"),
            ("revenue_bridge", f"Raw Source For {_c} Sales", _worth),
            ("revenue_bridge", f"{_c}: Less Orphans (Invalid Products)", f"SELECT 0 - {_AMOUNT} FROM {_raw} WHERE {_lost}"),
            ("revenue_bridge", f"Final View For {_c} Sales (Actual)", _seen)]])))

# --- Q32-Q39 reporting-view validation -------------------------------------------------------------
for _short, _raw, _raw_label, _view, _view_label, _failed in [
    ("sales", "RAW_FACTSALES", "Raw Fact Table", "VIEW_RPT_SALES_MASTER", "Final Reporting View",
     "list_contains(['', 'N/A'], StoreName) OR list_contains(['N/A', 'Unknown'], StoreStatus)"),
    ("online", "RAW_FACT_ONLINESALES", "Raw Online Table", "VIEW_RPT_ONLINESALES_MASTER", "Final Online View",
     "list_contains(['N/A', 'Unknown', '0'], Gender) OR length(CustomerName) = 0"),
]:
    register(f"rpt_{_short}_rowcount", getattr(q, f"rpt_{_short}_rowcount"), oracle.with_prelude(_stacked([
        f"SELECT '{label}' AS Source, count(*) AS Row_Count FROM {rel}" for label, rel in [(_raw_label, _raw), (_view_label, _view)]])))
    register(f"rpt_{_short}_failed_cleaning", getattr(q, f"rpt_{_short}_failed_cleaning"), oracle.with_prelude(
        f"SELECT count_if(coalesce({_failed}, FALSE))::BIGINT AS Failed_Cleaning_Rows FROM {_view}"))
    register(f"rpt_{_short}_missing_revenue", getattr(q, f"rpt_{_short}_missing_revenue"), oracle.with_prelude(
        f"SELECT count(*) - count(TotalRevenue) AS Missing_Revenue_Rows FROM {_view}"))
    register(f"rpt_{_short}_fanout", getattr(q, f"rpt_{_short}_fanout"), oracle.with_prelude(
        f"SELECT DISTINCT SalesKey, row_count FROM (SELECT SalesKey, count(*) OVER (PARTITION BY SalesKey) AS row_count FROM {_view}) "
        "WHERE row_count > 1"))

    _again = "(row_number() OVER (PARTITION BY SalesKey)) = 2"
    register(f"rpt_{_short}_suite", getattr(q, f"rpt_{_short}_suite"), oracle.with_prelude(
        f"SELECT count(*) AS Row_Count, count_if(coalesce({_failed}, FALSE))::BIGINT AS Failed_Cleaning_Rows, "
        "count_if(TotalRevenue IS NULL)::BIGINT AS Missing_Revenue_Rows, count_if(second)::BIGINT AS Fanout_Keys "
        f"FROM (SELECT *, {_again} AS second FROM {_view})"))

# --- B4 exports -----------------------------------------------------------------------------------------
register("export_rpt_sales", q.export_rpt_sales,
         oracle.with_prelude("SELECT * FROM VIEW_RPT_SALES_MASTER"))
register("export_dim_date", q.export_dim_date, oracle.with_prelude("SELECT * FROM RAW_DIMDATE"))
register("export_rpt_online", q.export_rpt_online,
         oracle.with_prelude("SELECT * FROM VIEW_RPT_ONLINESALES_MASTER"))
