"""Profiling, data-quality and reconciliation checks (Q1-Q39).

Every check is a function ``RawZone -> DataFrame``.  Multi-row reports are
unions of 1-row aggregates (one aggregation pass per input); orphan and
``NOT IN`` checks aggregate the fact to one row per key value before any
join, so hot keys (-1, NULL) collapse map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions import money, text
from ledgerlake.operators.aggregates import (cond_count, count_of, duplicate_groups, labelled,
                                             union_all)
from ledgerlake.operators.joins import key_flags, not_in_true, orphan_count
from ledgerlake.plans import views
from ledgerlake.sources.zone import RawZone

# Short names used in query keys -> raw table.
SHORT = {
    "product": "RAW_DIMPRODUCT", "customer": "RAW_DIMCUSTOMER",
    "factsales": "RAW_FACTSALES", "onlinesales": "RAW_FACT_ONLINESALES",
    "store": "RAW_DIMSTORE", "geography": "RAW_DIMGEOGRAPHY",
    "category": "RAW_DIMPRODUCTCATEGORY", "subcategory": "RAW_DIMPRODUCTSUBCATEGORY",
    "channel": "RAW_DIMCHANNEL", "currency": "RAW_DIMCURRENCY",
    "employee": "RAW_DIMEMPLOYEE", "promotion": "RAW_DIMPROMOTION", "date": "RAW_DIMDATE",
}


def full_order(df: DataFrame, key: str) -> list:
    """Key first, then every other column: a total order for LIMIT reports."""
    return [F.col(key).asc_nulls_last()] + \
        [F.col(c).asc_nulls_last() for c in df.columns if c != key]


# --- Q1 / Q8 / Q9: per-table counts, uniqueness, ordered samples ------------
def row_count(z: RawZone, table: str) -> DataFrame:
    return count_of(z[table], "total_rows")


def key_uniqueness(z: RawZone, table: str) -> DataFrame:
    key = schemas.TABLE_KEYS[table]
    distinct_alias = "distinct_dates" if table == "RAW_DIMDATE" else "distinct_keys"
    return z[table].agg(F.count(F.lit(1)).alias("total_rows"),
                        F.count_distinct(F.col(key)).alias(distinct_alias))


def ordered_sample(z: RawZone, table: str, n: int) -> DataFrame:
    """``SELECT * ... ORDER BY key LIMIT n`` (top-k; ties broken on the row)."""
    df = z[table]
    return df.orderBy(*full_order(df, schemas.TABLE_KEYS[table])).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, ordered: bool = True) -> DataFrame:
    """``n`` rows: the first by key, so the sample is the same each time, or, with
    ``ordered=False``, any rows, which stops early instead of ranking the whole table."""
    return (df.orderBy(*full_order(df, key)) if ordered else df).limit(n)


# --- Q2-Q5, Q7: product and customer profiles ---------------------------------
def product_key_profile(z: RawZone) -> DataFrame:
    return (z["RAW_DIMPRODUCT"]
            .agg(F.count(F.lit(1)).alias("Total_Rows"),
                 F.count_distinct("ProductKey").alias("Unique_Keys"))
            .withColumn("Duplicate_Keys", F.col("Total_Rows") - F.col("Unique_Keys")))


def product_date_range(z: RawZone) -> DataFrame:
    p = z["RAW_DIMPRODUCT"]
    return p.agg(F.min("AvailableForSaleDate").alias("First_Sale_Date"),
                 F.max("AvailableForSaleDate").alias("Last_Sale_Date"))


def product_null_names(z: RawZone) -> DataFrame:
    return count_of(z["RAW_DIMPRODUCT"].where(F.col("ProductName").isNull()), "Null_Names")


def product_invalid_prices(z: RawZone) -> DataFrame:
    bad = (F.col("UnitPrice") < 0) | (F.col("UnitCost") < 0)
    return count_of(z["RAW_DIMPRODUCT"].where(bad), "Invalid_Prices")


def product_profile_suite(z: RawZone) -> DataFrame:
    """Q2-Q5 in one pass over the product table (the reference runs four
    scans): volume and key check, sale-date range, NULL names, bad prices."""
    n = F.count(F.lit(1))
    return (z["RAW_DIMPRODUCT"].agg(
        n.alias("Total_Rows"),
        F.count_distinct("ProductKey").alias("Unique_Keys"),
        F.min("AvailableForSaleDate").alias("First_Sale_Date"),
        F.max("AvailableForSaleDate").alias("Last_Sale_Date"),
        F.count_if(F.col("ProductName").isNull()).alias("Null_Names"),
        F.count_if((F.col("UnitPrice") < 0) | (F.col("UnitCost") < 0)).alias("Invalid_Prices"))
        .withColumn("Duplicate_Keys", F.col("Total_Rows") - F.col("Unique_Keys")))


def customer_profile(z: RawZone) -> DataFrame:
    n = F.count(F.lit(1))
    return z["RAW_DIMCUSTOMER"].agg(
        n.alias("total_rows"),
        F.count_distinct("CustomerKey").alias("unique_customer_keys"),
        F.min("BirthDate").alias("oldest_customer_birth"),
        F.max("BirthDate").alias("youngest_customer_birth"),
        (n - F.count("CustomerKey")).alias("null_CustomerKey"),
        (n - F.count("GeographyKey")).alias("null_GeographyKey"),
        (n - F.count("YearlyIncome")).alias("null_YearlyIncome"),
        F.min("YearlyIncome").alias("min_income"),
        F.max("YearlyIncome").alias("max_income"))


# --- Q10-Q13: NULL / blank checks ---------------------------------------------
def _null_or_blank(col: str):
    return F.col(col).isNull() | text.is_blank(F.col(col))


def category_blank_check(z: RawZone) -> DataFrame:
    return z["RAW_DIMPRODUCTCATEGORY"].agg(
        cond_count(F.col("ProductCategoryKey").isNull()).alias("null_key_rows"),
        cond_count(_null_or_blank("ProductCategoryName")).alias("blank_name_rows"))


def subcategory_blank_check(z: RawZone) -> DataFrame:
    return z["RAW_DIMPRODUCTSUBCATEGORY"].agg(
        cond_count(F.col("ProductSubcategoryKey").isNull()).alias("null_subcat_key_rows"),
        cond_count(F.col("ProductCategoryKey").isNull()).alias("null_cat_key_rows"),
        cond_count(_null_or_blank("ProductSubcategoryName")).alias("blank_name_rows"))


def promotion_blank_check(z: RawZone) -> DataFrame:
    return z["RAW_DIMPROMOTION"].agg(
        cond_count(F.col("PromotionKey").isNull()).alias("null_key_rows"),
        cond_count(_null_or_blank("PromotionName")).alias("blank_name_rows"))


def date_null_check(z: RawZone) -> DataFrame:
    return z["RAW_DIMDATE"].agg(
        cond_count(F.col("DateKey").isNull()).alias("null_datekey"),
        cond_count(F.col("CalendarYear").isNull()).alias("null_calendaryear"))


# --- Q14-Q17: relationships and region -----------------------------------------
def orphan_subcategories(z: RawZone) -> DataFrame:
    """Subcategories whose category key is missing, counted per missing key
    (the NULL key is one group)."""
    s, c = z["RAW_DIMPRODUCTSUBCATEGORY"], z.dim("RAW_DIMPRODUCTCATEGORY")
    missing = s.join(c.select(F.col("ProductCategoryKey").alias("_ck")),
                     F.col("ProductCategoryKey") == F.col("_ck"), "left_anti")
    return (missing.groupBy("ProductCategoryKey")
            .agg(F.count(F.lit(1)).alias("orphan_subcategory_rows"))
            .orderBy(F.desc("orphan_subcategory_rows")))


def subcategories_per_category(z: RawZone) -> DataFrame:
    c = z["RAW_DIMPRODUCTCATEGORY"]
    s = z.dim("RAW_DIMPRODUCTSUBCATEGORY").select(
        F.col("ProductCategoryKey").alias("_sck"), "ProductSubcategoryKey")
    return (c.join(s, F.col("ProductCategoryKey") == F.col("_sck"), "left")
            .groupBy("ProductCategoryKey", "ProductCategoryName")
            .agg(F.count("ProductSubcategoryKey").alias("subcategory_count"))
            .orderBy(F.asc_nulls_last("ProductCategoryKey")))


def sea_country_lookup(z: RawZone) -> DataFrame:
    g = z["RAW_DIMGEOGRAPHY"]
    cond = None
    for pat in text.SEA_PATTERNS:
        c = F.col("RegionCountryName").like(pat)
        cond = c if cond is None else (cond | c)
    return g.where(cond).select("RegionCountryName", "GeographyKey").distinct()


def non_sea_leak_check(z: RawZone) -> DataFrame:
    v = views.sea_performance(z)
    return count_of(v.where(~F.col("Country").isin(text.SEA_COUNTRIES)), "Non_SEA_Rows")


# --- Q18, Q19: referential audit and table inventory -------------------------
def orphan_key_audit(z: RawZone) -> DataFrame:
    """Fact rows without a partner, by key.  Where the dimensions are known to be
    small, one pass over each fact meets their distinct keys; else each
    key is counted on its own, the fact reduced to its key values first."""
    day = F.col("DateKey").cast("timestamp_ntz")
    checks = [
        ("Orphan Product Keys Offline", "RAW_FACTSALES", "ProductKey", "RAW_DIMPRODUCT", F.col("ProductKey")),
        ("Orphan Product Keys Online", "RAW_FACT_ONLINESALES", "ProductKey", "RAW_DIMPRODUCT", F.col("ProductKey")),
        ("Orphan Store Keys", "RAW_FACTSALES", "StoreKey", "RAW_DIMSTORE", F.col("StoreKey")),
        ("Orphan Date Keys", "RAW_FACTSALES", "DateKey", "RAW_DIMDATE", day),
    ]
    if not all(z.bounded(dim) for *_, dim, _ in checks):
        return union_all([labelled(orphan_count(z[fact], F.col(key), z.dim(dim), dim_key), Issue_Type=label)
                          for label, fact, key, dim, dim_key in checks])
    parts = []
    for fact in ("RAW_FACTSALES", "RAW_FACT_ONLINESALES"):
        own = [(label, key, z[dim].select(dim_key.alias("_k")).distinct())
               for label, f, key, dim, dim_key in checks if f == fact]
        rows = z[fact].select(*[key for _, key, _ in own])
        for i, (_, key, keys) in enumerate(own):
            known = F.broadcast(keys.where("_k is not null").select(F.col("_k").alias(f"_k{i}")))
            rows = rows.join(known, F.col(key) == F.col(f"_k{i}"), "left")
        sums = rows.agg(*[F.count_if(F.col(f"_k{i}").isNull()).alias(f"n{i}") for i in range(len(own))])
        stack = ", ".join(f"'{label}', n{i}" for i, (label, _, _) in enumerate(own))
        parts.append(sums.select(F.expr(f"stack({len(own)}, {stack}) as (Issue_Type, Fail_Count)")))
    return union_all(parts)


def table_inventory(z: RawZone) -> DataFrame:
    """TABLE_NAME, ROW_COUNT for every raw table, by name."""
    frames = [labelled(count_of(z[n], "ROW_COUNT"), TABLE_NAME=n) for n in sorted(z.tables)]
    return union_all(frames).orderBy("TABLE_NAME")


# --- Q20-Q22: placeholders and the cleaning-rule preview ---------------------
def _placeholder_counts(df: DataFrame, col: str, null_alias: str = "Count_NULL") -> DataFrame:
    c = F.col(col)
    return df.agg(cond_count(F.upper(c) == "N/A").alias("Count_NA"),
                  cond_count(F.upper(c) == "UNKNOWN").alias("Count_Unknown"),
                  cond_count(text.is_blank(c)).alias("Count_Empty"),
                  cond_count(c.isNull()).alias(null_alias))


def placeholder_inventory_raw(z: RawZone) -> DataFrame:
    rows = [
        ("RAW_DIMPRODUCT", "BrandName", "Shared (Online & Store)"),
        ("RAW_DIMSTORE", "StoreType", "Physical Sales Only"),
        ("RAW_DIMCUSTOMER", "Education", "Online Sales Only"),
    ]
    return union_all([
        labelled(_placeholder_counts(z[t], c), Source_Table=t, Column_Name=c, Channel_Usage=u)
        for t, c, u in rows])


def placeholder_check_views(z: RawZone) -> DataFrame:
    return union_all([
        labelled(_placeholder_counts(views.master_sales(z), "Brand", "Count_Clean_NULL"),
                 Reporting_View="VIEW_MASTER_SALES", Column_Name="Brand"),
        labelled(_placeholder_counts(views.master_online(z), "Brand", "Count_Clean_NULL"),
                 Reporting_View="VIEW_MASTER_ONLINESALES", Column_Name="Brand"),
    ])


def store_name_rule_preview(z: RawZone, n: int = 100) -> DataFrame:
    """First ``n`` candidate stores (by key) with the preview cleaning rule."""
    s = z["RAW_DIMSTORE"]
    cand = (F.col("StoreName").isin(text.PREVIEW_STORE_NAME_CANDIDATES)
            | F.col("Status").isin(text.PREVIEW_STORE_STATUS_CANDIDATES))
    top = s.where(cand).orderBy(F.asc_nulls_last("StoreKey"), F.asc_nulls_last("StoreName"),
                                F.asc_nulls_last("Status")).limit(n)
    name = F.col("StoreName")
    return top.select(name.alias("Original_Value"),
                      text.preview_cleaned(name).alias("Cleaned_Value"),
                      text.preview_rule(name).alias("Rule_Applied"))


# --- Q23-Q28: duplicates and dedup -----------------------------------------------
def _dup_count(df: DataFrame, key: str, alias: str) -> DataFrame:
    return count_of(duplicate_groups(df, key), alias)


def _status(cnt_col: str, passed: str):
    return F.when(F.col(cnt_col) == 0, F.lit(passed)).otherwise(F.lit("FAILED"))


def duplicate_suite(z: RawZone) -> DataFrame:
    checks = [
        ("Store Sales", "SalesKey", views.master_sales(z, texts=False)),
        ("Online Sales", "OnlineSalesKey", views.master_online(z, texts=False)),
        ("Product", "ProductKey", z["RAW_DIMPRODUCT"]),
        ("Customer", "CustomerKey", z["RAW_DIMCUSTOMER"]),
    ]
    frames = [labelled(_dup_count(df, key, "Duplicate_Count"), Entity=e, Criteria=key)
              for e, key, df in checks]
    return union_all(frames).withColumn(
        "Status", _status("Duplicate_Count", "PASSED (No Examples Available)"))


def dedup_before_after(z: RawZone) -> DataFrame:
    return union_all([
        labelled(count_of(views.master_sales(z, texts=False), "Row_Count"), View_Type="Original (Master)"),
        labelled(count_of(views.clean_sales(z), "Row_Count"), View_Type="Cleaned (Deduplicated)"),
    ])


def _clean_validation(df: DataFrame, view_name: str, key: str) -> DataFrame:
    return labelled(_dup_count(df, key, "Duplicate_Count"), Checked_View=view_name,
                    Criteria=key).withColumn(
        "Status", _status("Duplicate_Count", "PASSED (0 Duplicates)"))


def clean_sales_validation(z: RawZone) -> DataFrame:
    return _clean_validation(views.clean_sales(z), "VIEW_CLEAN_SALES_DATA", "SalesKey")


def clean_online_validation(z: RawZone) -> DataFrame:
    return _clean_validation(views.clean_online(z), "VIEW_CLEAN_ONLINESALES_DATA", "OnlineSalesKey")


def duplicate_key_listing(z: RawZone) -> DataFrame:
    def listing(df, key, label):
        return duplicate_groups(df, key).select(
            F.lit(label).alias("Test_Type"), F.col(key).alias("Key_ID"),
            F.col("_cnt").alias("Count"))
    return union_all([
        listing(views.master_sales(z, texts=False), "SalesKey", "Physical Sales Duplicates"),
        listing(views.master_online(z, texts=False), "OnlineSalesKey", "Online Sales Duplicates"),
    ])


# --- Q27, Q29-Q31: reconciliation --------------------------------------------------
def rowcount_reconciliation(z: RawZone) -> DataFrame:
    def one(label, raw, view):
        r = count_of(raw, "Raw_Count")
        v = count_of(view, "View_Count")
        return labelled(r.crossJoin(v), Source=label).withColumn(
            "Difference", F.col("View_Count") - F.col("Raw_Count"))
    return union_all([
        one("Physical Sales", z["RAW_FACTSALES"], views.master_sales(z, texts=False)),
        one("Online Sales", z["RAW_FACT_ONLINESALES"], views.master_online(z, texts=False)),
    ])


def revenue_reconciliation(z: RawZone) -> DataFrame:
    def one(label, raw, view):
        r = raw.agg(money.total(money.revenue(), "Raw_Revenue_Calc"))
        v = view.agg(money.total(F.col("TotalRevenue"), "View_Revenue_Total"))
        return labelled(r.crossJoin(v), Dataset=label).withColumn(
            "Difference",
            (F.col("View_Revenue_Total") - F.col("Raw_Revenue_Calc")).cast("decimal(38,2)"))
    return union_all([
        one("Physical Sales", z["RAW_FACTSALES"], views.master_sales(z, texts=False)),
        one("Online Sales", z["RAW_FACT_ONLINESALES"], views.master_online(z, texts=False)),
    ])


def _bridge_totals(z: RawZone, fact: DataFrame,
                   checks: list[tuple[str, str, str]]) -> tuple[DataFrame, DataFrame]:
    """Raw revenue and ``-SUM(qty * price) WHERE k1 NOT IN (dim1) OR ...``.

    The fact is reduced once to one row per combination of the tested keys
    (partial aggregation; hot keys collapse map-side).  The raw total sums all
    groups; for the orphan total each key gets a present flag from a left join
    to the dimension's distinct keys, and the SQL NULL rules come from two
    scalar guards per dimension.  Both totals share the one aggregation.
    """
    keys = [fk for fk, _, _ in checks]
    agg = fact.groupBy(*keys).agg(F.sum(money.revenue()).alias("_rev"))
    raw = agg.agg(F.sum("_rev").cast("decimal(38,2)").alias("Revenue"))
    flagged, cond = agg, None
    for fk, table, dk in checks:
        tag = "k_" + fk
        present, empty, has_null = key_flags(z[table], dk, tag)
        flagged = flagged.join(z.hint(present, table), F.col(fk) == F.col(f"{tag}_key"), "left")
        c = not_in_true(F.col(fk), F.col(f"{tag}_present"), empty, has_null)
        cond = c if cond is None else (cond | c)
    less = flagged.where(cond).agg((-F.sum("_rev")).cast("decimal(38,2)").alias("Revenue"))
    return raw, less


def revenue_bridge_sales(z: RawZone) -> DataFrame:
    raw, less = _bridge_totals(z, z["RAW_FACTSALES"],
                               [("ProductKey", "RAW_DIMPRODUCT", "ProductKey"),
                                ("StoreKey", "RAW_DIMSTORE", "StoreKey")])
    final = views.master_sales(z, texts=False).agg(money.total(F.col("TotalRevenue"), "Revenue"))
    return union_all([
        labelled(raw, Category="Raw Source For Physical Sales"),
        labelled(less, Category="Physical: Less Orphans (Invalid Products)"),
        labelled(final, Category="Final View For Physical Sales (Actual)"),
    ])


def revenue_bridge_online(z: RawZone) -> DataFrame:
    raw, less = _bridge_totals(z, z["RAW_FACT_ONLINESALES"],
                               [("ProductKey", "RAW_DIMPRODUCT", "ProductKey")])
    final = views.master_online(z, texts=False).agg(money.total(F.col("TotalRevenue"), "Revenue"))
    return union_all([
        labelled(raw, Category="Raw Source For Online Sales"),
        labelled(less, Category="Online: Less Orphans (Invalid Products)"),
        labelled(final, Category="Final View For Online Sales (Actual)"),
    ])


# --- Q23-Q31 in one pass over a fact -------------------------------------------------
def _master_checks(z: RawZone, fact: str, key: str, dims: list[tuple], lost_by: list[str], labels: dict[str, str]) -> DataFrame:
    """Duplicates, rows before and after dedup, row counts, revenue and the bridge of one master view from one scan of its fact.

    A dimension (outriggers joined on) is reduced to how many rows it has for each key, so the fact meets one row a
    dimension and never multiplies: the product of those counts is the number of view rows of a fact row, 0 for an
    orphan.  The fact is then reduced to one row a key and to one row of totals.  ``dims``: (frame, fact key, dimension key,
    raw table, its key)."""
    rows, weight, lost = z[fact], F.lit(1).cast("decimal(9,0)"), F.lit(False)
    for i, (dim, fact_key, dim_key, table, table_key) in enumerate(dims):
        per_key = dim.groupBy(F.col(dim_key).alias(f"_k{i}")).agg(F.count(F.lit(1)).alias(f"_n{i}")).where(F.col(f"_k{i}").isNotNull())
        rows = rows.join(z.hint(per_key, table), F.col(fact_key) == F.col(f"_k{i}"), "left")
        weight = (weight * F.coalesce(F.col(f"_n{i}"), F.lit(0)).cast("decimal(9,0)")).cast("decimal(9,0)")
        if fact_key in lost_by:
            _, empty, has_null = key_flags(z[table], table_key, f"m{i}")
            lost = lost | not_in_true(F.col(fact_key), F.col(f"_n{i}"), empty, has_null)
    rows = rows.select(F.col(key).alias("_key"), money.revenue().alias("_rev"), weight.alias("_w"), lost.alias("_lost"))
    worth = F.when(F.col("_w") > 0, (F.col("_rev").cast("decimal(28,2)") * F.col("_w")).cast("decimal(38,2)"))
    per_key = rows.groupBy("_key").agg(
        F.count(F.lit(1)).alias("raw"), F.sum("_w").alias("view"), F.sum("_rev").alias("raw_rev"), F.sum(worth).alias("view_rev"),
        F.sum(F.when(F.col("_lost"), F.col("_rev"))).alias("lost_rev"))
    amount = lambda c: F.sum(c).cast("decimal(38,2)")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(38,2)")
    one = per_key.agg(
        number(F.sum("raw")).alias("raw"), number(F.sum("view")).alias("view"), number(F.count_if(F.col("view") > 1)).alias("repeated"),
        number(F.count_if(F.col("view") > 0)).alias("clean"), amount("raw_rev").alias("raw_rev"), amount("view_rev").alias("view_rev"),
        (-amount("lost_rev")).cast("decimal(38,2)").alias("less"))
    measures = [
        ("duplicate_suite", "Duplicate_Count", "repeated"),
        ("dedup_before_after", "Original (Master)", "view"), ("dedup_before_after", "Cleaned (Deduplicated)", "clean"),
        ("rowcount_reconciliation", "Raw_Count", "raw"), ("rowcount_reconciliation", "View_Count", "view"),
        ("rowcount_reconciliation", "Difference", "cast(view - raw as decimal(38,2))"),
        ("revenue_reconciliation", "Raw_Revenue_Calc", "raw_rev"), ("revenue_reconciliation", "View_Revenue_Total", "view_rev"),
        ("revenue_reconciliation", "Difference", "cast(view_rev - raw_rev as decimal(38,2))"),
        ("revenue_bridge", labels["raw"], "raw_rev"), ("revenue_bridge", labels["less"], "less"), ("revenue_bridge", labels["final"], "view_rev")]
    stack = ", ".join(f"'{check}', '{measure}', {value}" for check, measure, value in measures)
    return one.select(F.expr(f"stack({len(measures)}, {stack}) as (Check_Name, Measure, Value)"))


def master_checks_sales(z: RawZone) -> DataFrame:
    return _master_checks(z, "RAW_FACTSALES", "SalesKey", [
        (views.store_dim(z), "StoreKey", "s_StoreKey", "RAW_DIMSTORE", "StoreKey"),
        (views.product_dim(z, True), "ProductKey", "p_ProductKey", "RAW_DIMPRODUCT", "ProductKey"),
        (views.date_dim(z), "DateKey", "d_DateKey", "RAW_DIMDATE", "DateKey"),
        (z["RAW_DIMCHANNEL"], "channelKey", "ChannelKey", "RAW_DIMCHANNEL", "ChannelKey"),
        (z["RAW_DIMPROMOTION"], "PromotionKey", "PromotionKey", "RAW_DIMPROMOTION", "PromotionKey"),
    ], ["ProductKey", "StoreKey"], {"raw": "Raw Source For Physical Sales", "less": "Physical: Less Orphans (Invalid Products)",
                                    "final": "Final View For Physical Sales (Actual)"})


def master_checks_online(z: RawZone) -> DataFrame:
    return _master_checks(z, "RAW_FACT_ONLINESALES", "OnlineSalesKey", [
        (views.customer_dim(z), "CustomerKey", "c_CustomerKey", "RAW_DIMCUSTOMER", "CustomerKey"),
        (views.product_dim(z, True), "ProductKey", "p_ProductKey", "RAW_DIMPRODUCT", "ProductKey"),
        (views.date_dim(z), "DateKey", "d_DateKey", "RAW_DIMDATE", "DateKey"),
        (views.currency_dim(z), "CurrencyKey", "cur_CurrencyKey", "RAW_DIMCURRENCY", "CurrencyKey"),
    ], ["ProductKey"], {"raw": "Raw Source For Online Sales", "less": "Online: Less Orphans (Invalid Products)",
                        "final": "Final View For Online Sales (Actual)"})


# --- Q32-Q39: reporting-view validation suite ------------------------------------
def _rowcount_pair(raw: DataFrame, view: DataFrame, raw_label: str, view_label: str) -> DataFrame:
    return union_all([labelled(count_of(raw, "Row_Count"), Source=raw_label),
                      labelled(count_of(view, "Row_Count"), Source=view_label)])


def rpt_sales_rowcount(z: RawZone) -> DataFrame:
    return _rowcount_pair(z["RAW_FACTSALES"], views.rpt_sales_master(z, texts=False),
                          "Raw Fact Table", "Final Reporting View")


def _unclean_sales():
    return ((F.col("StoreName") == "") | (F.col("StoreName") == "N/A")
            | (F.col("StoreStatus") == "N/A") | (F.col("StoreStatus") == "Unknown"))


def _unclean_online():
    return F.col("Gender").isin(text.REPORT_GENDER_NULLS) | (F.col("CustomerName") == "")


def _report_suite(view: DataFrame, unclean) -> DataFrame:
    """All checks of a reporting view in one pass over it: rows are reduced to
    one a key, and those to one row of counts."""
    per_key = view.groupBy("SalesKey").agg(F.count(F.lit(1)).alias("n"), F.count_if(unclean).alias("bad"),
                                           F.count_if(F.col("TotalRevenue").isNull()).alias("lost"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
    return per_key.agg(total("n", "Row_Count"), total("bad", "Failed_Cleaning_Rows"), total("lost", "Missing_Revenue_Rows"),
                       F.count_if(F.col("n") > 1).alias("Fanout_Keys"))


def rpt_sales_suite(z: RawZone) -> DataFrame:
    return _report_suite(views.rpt_sales_master(z), _unclean_sales())


def rpt_online_suite(z: RawZone) -> DataFrame:
    return _report_suite(views.rpt_online_master(z), _unclean_online())


def rpt_sales_failed_cleaning(z: RawZone) -> DataFrame:
    return count_of(views.rpt_sales_master(z).where(_unclean_sales()), "Failed_Cleaning_Rows")


def rpt_sales_missing_revenue(z: RawZone) -> DataFrame:
    return count_of(views.rpt_sales_master(z, texts=False).where(F.col("TotalRevenue").isNull()),
                    "Missing_Revenue_Rows")


def _fanout(df: DataFrame, key: str) -> DataFrame:
    return duplicate_groups(df, key).select(key, F.col("_cnt").alias("row_count"))


def rpt_sales_fanout(z: RawZone) -> DataFrame:
    return _fanout(views.rpt_sales_master(z, texts=False), "SalesKey")


def rpt_online_rowcount(z: RawZone) -> DataFrame:
    return _rowcount_pair(z["RAW_FACT_ONLINESALES"], views.rpt_online_master(z, texts=False),
                          "Raw Online Table", "Final Online View")


def rpt_online_failed_cleaning(z: RawZone) -> DataFrame:
    return count_of(views.rpt_online_master(z).where(_unclean_online()), "Failed_Cleaning_Rows")


def rpt_online_missing_revenue(z: RawZone) -> DataFrame:
    return count_of(views.rpt_online_master(z, texts=False).where(F.col("TotalRevenue").isNull()),
                    "Missing_Revenue_Rows")


def rpt_online_fanout(z: RawZone) -> DataFrame:
    return _fanout(views.rpt_online_master(z, texts=False), "SalesKey")


# --- B4: full read-outs for dashboards ----------------------------------------------
def export_rpt_sales(z: RawZone) -> DataFrame:
    return views.rpt_sales_master(z)


def export_dim_date(z: RawZone) -> DataFrame:
    return z["RAW_DIMDATE"]


def export_rpt_online(z: RawZone) -> DataFrame:
    return views.rpt_online_master(z)
