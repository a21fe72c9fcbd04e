"""Profiles observed while a table is written (Q1-Q5, Q7, Q10-Q13).

``observed`` names aggregates that ``DataFrame.observe`` takes along with the write, so the
profile of a load costs no scan of its own.  Observed aggregates can't be distinct, so
key uniqueness comes from one narrow pass over the key column of what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions import text

Metric = Callable[[Column], Column]


def _null(c: str) -> Metric:
    return lambda good: F.count_if(good & F.col(c).isNull())


def _blank(c: str) -> Metric:
    return lambda good: F.count_if(good & F.coalesce(text.is_blank(F.col(c)), F.lit(True)))


def _least(c: str) -> Metric:
    return lambda good: F.min(F.when(good, F.col(c)))


def _most(c: str) -> Metric:
    return lambda good: F.max(F.when(good, F.col(c)))


#: Table -> metric -> aggregate over the rows that are good; metrics are the output names of the separate checks.
METRICS: dict[str, dict[str, Metric]] = {
    "RAW_DIMPRODUCT": {
        "First_Sale_Date": _least("AvailableForSaleDate"), "Last_Sale_Date": _most("AvailableForSaleDate"), "Null_Names": _null("ProductName"),
        "Invalid_Prices": lambda good: F.count_if(good & ((F.col("UnitPrice") < 0) | (F.col("UnitCost") < 0)))},
    "RAW_DIMCUSTOMER": {
        "oldest_customer_birth": _least("BirthDate"), "youngest_customer_birth": _most("BirthDate"),
        "null_CustomerKey": _null("CustomerKey"), "null_GeographyKey": _null("GeographyKey"), "null_YearlyIncome": _null("YearlyIncome"),
        "min_income": _least("YearlyIncome"), "max_income": _most("YearlyIncome")},
    "RAW_DIMPRODUCTCATEGORY": {"null_key_rows": _null("ProductCategoryKey"), "blank_name_rows": _blank("ProductCategoryName")},
    "RAW_DIMPRODUCTSUBCATEGORY": {"null_subcat_key_rows": _null("ProductSubcategoryKey"), "null_cat_key_rows": _null("ProductCategoryKey"),
                                  "blank_name_rows": _blank("ProductSubcategoryName")},
    "RAW_DIMPROMOTION": {"null_key_rows": _null("PromotionKey"), "blank_name_rows": _blank("PromotionName")},
    "RAW_DIMDATE": {"null_datekey": _null("DateKey"), "null_calendaryear": _null("CalendarYear")},
}


def observed(table: str, good: Column | None = None) -> list[Column]:
    """All metrics of a table: the row count and its own, named; rows that aren't ``good`` don't count."""
    good = F.lit(True) if good is None else good
    return [F.count_if(good).alias("total_rows"), *[m(good).alias(n) for n, m in METRICS.get(table, {}).items()]]


def as_text(values: dict) -> dict[str, str | None]:
    """Observed values as text: whole numbers, ISO dates and times, doubles in full."""
    return {n: None if v is None else str(v) for n, v in values.items()}
