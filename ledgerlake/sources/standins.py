"""Stand-ins for the 13 raw tables, derived from the driver's Parquet tables.

The reference ships no data, so its raw zone is rebuilt from the TPC-H-like
driver tables with defects injected by arithmetic on keys (orphans, NULL keys,
placeholders, duplicate dimension rows).  Each column is one SQL expression
that Spark and DuckDB evaluate identically; the row sources are DataFrame code
here and SQL text in ``ledgerlake.oracle`` so both engines see the same input.

Columns the views and checks never read hold values of every declared type too, so that each
conversion of a load is exercised; store-sales columns after the quantity are
NULL where a short record leaves them out (return flag N).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas

# --------------------------------------------------------------------------
# Fixed values of the fixture design (FIXTURES.md section 2).
# --------------------------------------------------------------------------
# Unit price in integer cents, so both engines derive identical decimals.
UNIT_CENTS = "CAST(floor(round(l_extendedprice * 100) / l_quantity) AS BIGINT)"


def money(cents_sql: str) -> str:
    """Integer cents -> DECIMAL(10,2) without ever casting a double quotient."""
    return (f"CAST(CAST({cents_sql} AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2))"
            f" AS DECIMAL(10,2))")


PRODUCT_KEY = ("CASE WHEN l_orderkey % 89 = 0 THEN NULL "
               "WHEN l_orderkey % 83 = 0 THEN -1 ELSE l_partkey END")

FACTSALES = {
    "SalesKey": "l_orderkey * 10 + l_linenumber",
    "DateKey": ("CASE WHEN l_orderkey % 101 = 0 THEN l_shipdate + INTERVAL '1' HOUR "
                "ELSE l_shipdate END"),
    "channelKey": ("CAST(CASE WHEN l_orderkey % 103 = 0 THEN 9 "
                   "WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 "
                   "WHEN l_returnflag = 'R' THEN 3 END AS BIGINT)"),
    "StoreKey": "CASE WHEN l_orderkey % 97 = 0 THEN -1 ELSE l_suppkey END",
    "ProductKey": PRODUCT_KEY,
    "PromotionKey": "CAST(round(l_discount * 100) AS BIGINT)",
    "UnitCost": money("floor(uc * 43 / 100)"),
    "UnitPrice": money("uc"),
    "SalesQuantity": "CAST(l_quantity AS INT)",
    "CurrencyKey": "CAST(l_suppkey % 5 AS BIGINT)",
    "ReturnQuantity": "CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS INT) END",
    "ReturnAmount": f"CASE WHEN l_returnflag <> 'N' THEN {money('uc * l_linenumber')} END",
    "DiscountQuantity": "CASE WHEN l_returnflag <> 'N' AND l_linenumber > 2 THEN 1 END",
    "DiscountAmount": f"CASE WHEN l_returnflag = 'A' THEN {money('floor(uc / 10)')} END",
    "TotalCost": f"CASE WHEN l_returnflag <> 'N' THEN {money('floor(uc * 43 / 100) * CAST(l_quantity AS BIGINT)')} END",
    "SalesAmount": f"CASE WHEN l_returnflag <> 'N' THEN {money('uc * CAST(l_quantity AS BIGINT)')} END",
}

FACT_ONLINESALES = {
    "OnlineSalesKey": "l_orderkey * 10 + l_linenumber",
    "DateKey": "o_orderdate",
    "ProductKey": PRODUCT_KEY,
    "CurrencyKey": ("CAST(CASE WHEN l_orderkey % 107 = 0 THEN 77 "
                    "ELSE l_suppkey % 5 END AS BIGINT)"),
    "CustomerKey": "CASE WHEN o_orderkey % 109 = 0 THEN -1 ELSE o_custkey END",
    "SalesOrderNumber": "'SO' || CAST(l_orderkey AS STRING)",
    "SalesOrderLineNumber": "l_linenumber",
    "SalesQuantity": "CAST(l_quantity AS INT)",
    "UnitCost": money("floor(uc * 43 / 100)"),
    "UnitPrice": money("uc"),
    "StoreKey": "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_suppkey END",
    "PromotionKey": "CAST(round(l_discount * 100) AS BIGINT)",
    "SalesAmount": money("uc * CAST(l_quantity AS BIGINT)"),
    "ReturnQuantity": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "ReturnAmount": f"CASE WHEN l_returnflag = 'R' THEN {money('uc')} END",
    "DiscountQuantity": "CAST(l_linenumber - 1 AS INT)",
    "DiscountAmount": money("uc * (l_linenumber - 1)"),
    "TotalCost": money("floor(uc * 43 / 100) * CAST(l_quantity AS BIGINT)"),
}

DIMPRODUCT = {
    "ProductKey": "p_partkey",
    "ProductName": "CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE ' ' || p_name END",
    "ProductSubcategoryKey": "CAST(p_size AS BIGINT)",
    "BrandName": ("CASE WHEN p_partkey % 11 = 0 THEN ' n/a ' "
                  "WHEN p_partkey % 13 = 0 THEN 'N/A' "
                  "WHEN p_partkey % 17 = 0 THEN 'unknown' "
                  "WHEN p_partkey % 19 = 0 THEN '  ' "
                  "WHEN p_partkey % 23 = 0 THEN NULL ELSE p_brand END"),
    "UnitPrice": "CASE WHEN p_partkey % 47 = 0 THEN CAST(-1 AS DOUBLE) ELSE p_retailprice END",
    "AvailableForSaleDate": ("CAST(CAST('2000-01-01' AS DATE) + CAST(p_partkey % 1000 AS INT)"
                             " AS {TS})"),
    "ProductDescription": "CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE 'About ' || p_name || ', ' || p_type END",
    "Manufacturer": "'Maker of ' || p_brand",
    "ClassID": "CAST(p_size % 3 AS STRING)",
    "ClassName": "CASE p_size % 3 WHEN 0 THEN 'Economy' WHEN 1 THEN 'Regular' ELSE 'Deluxe' END",
    "StyleID": "CAST(p_size % 4 AS STRING)",
    "StyleName": "'Style ' || CAST(p_size % 4 AS STRING)",
    "ColorID": "CAST(p_partkey % 7 AS STRING)",
    "ColorName": "'Colour ' || CAST(p_partkey % 7 AS STRING)",
    "Weight": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 4 END",
    "WeightUnitMeasureID": "'ounces'",
    "UnitOfMeasureID": "'1'",
    "UnitOfMeasureName": "'each'",
    "StockTypeID": "CAST(p_size % 2 + 1 AS STRING)",
    "StockTypeName": "CASE WHEN p_size % 2 = 0 THEN 'High' ELSE 'Mid' END",
    "UnitCost": "CAST(p_partkey % 100 AS DOUBLE) / 2",
    "Status": "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE 'On' END",
}
PRODUCT_COPY_FILTER = "p_partkey % 500 = 7"   # these part rows appear twice

DIMSUBCATEGORY = {
    "ProductSubcategoryKey": "CAST(p_size AS BIGINT)",
    "ProductSubcategoryName": ("CASE WHEN p_size % 9 = 0 THEN ' ' "
                               "ELSE 'Subcategory ' || CAST(p_size AS STRING) END"),
    "ProductCategoryKey": "CAST(p_size % 6 AS BIGINT)",
}

DIMCATEGORY = {
    "ProductCategoryKey": "CAST(r_regionkey AS BIGINT)",
    "ProductCategoryName": "'Category ' || r_name",
}
CATEGORY_EXTRA = {"ProductCategoryKey": "CAST(6 AS BIGINT)",
                  "ProductCategoryName": "'Category unused'"}   # key 5 stays missing

DIMSTORE = {
    "StoreKey": "s_suppkey",
    "GeographyKey": "CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CAST(s_nationkey AS BIGINT) END",
    "StoreManager": "s_suppkey % 40",
    "StoreType": ("CASE s_suppkey % 8 WHEN 0 THEN 'N/A' WHEN 1 THEN 'unknown' "
                  "WHEN 2 THEN ' ' WHEN 3 THEN NULL ELSE 'Store' END"),
    "StoreName": ("CASE s_suppkey % 10 WHEN 0 THEN 'N/A' WHEN 1 THEN ' ' "
                  "WHEN 2 THEN 'Unknown' WHEN 3 THEN NULL WHEN 4 THEN '0' "
                  "ELSE ' ' || s_name || ' ' END"),
    "Status": ("CASE s_suppkey % 7 WHEN 0 THEN 'N/A' WHEN 1 THEN 'Off' WHEN 2 THEN '0' "
               "WHEN 3 THEN ' Unknown' WHEN 4 THEN 'Unknown' ELSE 'On' END"),
    "OpenDate": "CAST('2001-01-01' AS DATE) + CAST(s_suppkey % 3000 AS INT)",
    "CloseDate": "CASE WHEN s_suppkey % 7 = 1 THEN CAST('2012-02-29' AS DATE) + CAST(s_suppkey % 900 AS INT) END",
    "EntityKey": "s_suppkey + 1000000000000",
    "StorePhone": "'555-' || CAST(s_suppkey AS STRING)",
    "StoreFax": "CASE WHEN s_suppkey % 2 = 0 THEN '556-' || CAST(s_suppkey AS STRING) END",
    "CloseReason": "CASE WHEN s_suppkey % 7 = 1 THEN 'Moved, \"for good\"' END",
    "EmployeeCount": "CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(s_suppkey % 90 AS INT) END",
    "SellingAreaSize": "CAST(s_suppkey % 90 * 20 AS INT)",
    "LastRemodelDate": "CAST(CAST('2005-01-01' AS DATE) + CAST(s_suppkey % 1000 AS INT) AS {TS}) + INTERVAL '90' MINUTE",
    "EmployeeKey": "s_suppkey % 40",
}

DIMGEOGRAPHY = {
    "GeographyKey": "CAST(n_nationkey AS BIGINT)",
    "ContinentName": "r_name",
    "RegionCountryName": ("CASE n_nationkey WHEN 0 THEN 'Singapore' WHEN 1 THEN 'Malaysia' "
                          "WHEN 2 THEN 'Thailand' WHEN 3 THEN 'Vietnam' "
                          "WHEN 4 THEN ' ' || n_name || ' ' ELSE n_name END"),
    "GeographyType": "'Country'",
    "CityName": "CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'City of ' || n_name END",
    "StateProvinceName": "n_name || ' (state), ' || r_name",
}
GEOGRAPHY_FILTER = "n_nationkey < 24"         # key 24 missing on purpose

DIMEMPLOYEE = {
    "EmployeeKey": "s_suppkey",
    "FirstName": "'First' || CAST(s_suppkey AS STRING)",
    "LastName": "CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'Last' || CAST(s_suppkey AS STRING) END",
    "ParentEmployeeKey": "CASE WHEN s_suppkey = 1 THEN NULL ELSE CAST(floor(s_suppkey / 2) AS BIGINT) END",
    "Title": "CASE WHEN s_suppkey % 10 = 0 THEN 'Head, region' ELSE 'Clerk' END",
    "HireDate": "CAST('1999-05-01' AS DATE) + CAST(s_suppkey % 4000 AS INT)",
    "BirthDate": "CAST('1955-01-31' AS DATE) + CAST(s_suppkey % 9000 AS INT)",
    "EmailAddress": "'first' || CAST(s_suppkey AS STRING) || '@example.com'",
    "Phone": "'555-01' || CAST(s_suppkey AS STRING)",
    "EmergencyContactName": "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END",
    "EmergencyContactPhone": "'555-02' || CAST(s_suppkey AS STRING)",
    "Gender": "CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "PayFrequency": "CAST(s_suppkey % 2 + 1 AS INT)",
    "BaseRate": "CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE CAST(s_suppkey AS DOUBLE) / 8 END",
    "VacationHours": "CAST(s_suppkey % 99 AS INT)",
    "DepartmentName": "'Department ' || CAST(s_suppkey % 5 AS STRING)",
    "StartDate": "CAST('2000-02-29' AS DATE) + CAST(s_suppkey % 4000 AS INT)",
    "Status": "'Current'",
    "SalaryStatus": "CAST(s_suppkey % 2 AS STRING)",
    "IsSalesPerson": "CASE WHEN s_suppkey % 4 = 0 THEN 'TRUE' ELSE 'FALSE' END",
    "IsMarried": "CASE WHEN s_suppkey % 3 = 0 THEN 'M' ELSE 'S' END",
}
EMPLOYEE_FILTER = "s_suppkey < 35"            # managers 35..39 are orphans

DIMCUSTOMER = {
    "CustomerKey": "c_custkey",
    "GeographyKey": "CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END",
    "FirstName": "c_mktsegment",
    "LastName": "CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_name END",
    "BirthDate": "CAST('1950-01-01' AS DATE) + CAST(c_custkey % 9000 AS INT)",
    "YearlyIncome": "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_acctbal END",
    "Gender": ("CASE c_custkey % 7 WHEN 0 THEN 'N/A' WHEN 1 THEN 'Unknown' WHEN 2 THEN '0' "
               "WHEN 3 THEN ' unknown' WHEN 4 THEN 'M' ELSE 'F' END"),
    "Education": ("CASE c_custkey % 9 WHEN 0 THEN 'n/a' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN ' ' "
                  "WHEN 3 THEN NULL ELSE 'Bachelors' END"),
    "MaritalStatus": "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'S' END",
    "TotalChildren": "CAST(c_custkey % 6 AS INT)",
    "NumberChildrenAtHome": "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey % 3 AS INT) END",
    "Occupation": "'Works in ' || c_mktsegment",
    "HouseOwnerFlag": "CAST(c_custkey % 2 AS INT)",
    "NumberCarsOwned": "CAST(c_custkey % 5 AS INT)",
}

DIMDATE = {
    "DateKey": "d",
    "CalendarYear": "CAST(extract(year FROM d) AS INT)",
    "CalendarYearLabel": "'CY ' || CAST(CAST(extract(year FROM d) AS INT) AS STRING)",
    "MonthNumber": "CAST(extract(month FROM d) AS INT)",
    "CalendarHalfYearLabel": "CASE WHEN extract(month FROM d) < 7 THEN 'H1' ELSE 'H2' END",
    "CalendarQuarterLabel": "'Q' || CAST(CAST(floor((extract(month FROM d) + 2) / 3) AS INT) AS STRING)",
    "CalendarMonthLabel": "'Month ' || CAST(CAST(extract(month FROM d) AS INT) AS STRING)",
    "CalendarWeekLabel": "'Week ' || CAST(CAST(floor((extract(day FROM d) + 6) / 7) AS INT) AS STRING)",
    "CalendarDayOfWeekLabel": "'Day ' || CAST(CAST(extract(day FROM d) AS INT) % 7 AS STRING)",
    "FiscalYear": "CAST(extract(year FROM d) + CASE WHEN extract(month FROM d) > 6 THEN 1 ELSE 0 END AS INT)",
    "FiscalYearLabel": "'FY ' || CAST(CAST(extract(year FROM d) AS INT) AS STRING)",
    "FiscalHalfYearLabel": "CASE WHEN extract(month FROM d) < 7 THEN 'FH2' ELSE 'FH1' END",
    "FiscalQuarterLabel": "CASE WHEN extract(month FROM d) % 3 = 0 THEN NULL ELSE 'FQ' END",
    "FiscalMonthLabel": "'Fiscal month, ' || CAST(CAST(extract(month FROM d) AS INT) AS STRING)",
    "IsWorkDay": "CASE WHEN CAST(extract(day FROM d) AS INT) % 7 < 5 THEN 'WorkDay' ELSE 'WeekEnd' END",
    "IsHoliday": "CASE WHEN extract(day FROM d) = 1 THEN '1' ELSE '0' END",
    "EuropeSeason": "CASE WHEN extract(month FROM d) = 12 THEN 'Holiday' ELSE 'None' END",
    "NorthAmericaSeason": "CASE WHEN extract(month FROM d) = 11 THEN 'Thanksgiving' END",
    "AsiaSeason": "'None'",
    "CalendarDayOfWeekNumber": "CAST(extract(day FROM d) AS INT) % 7",
}
DATE_FILTER = "extract(day FROM d) <> 29"     # 29th of each month missing on purpose

DIMCHANNEL = {
    "ChannelKey": "CAST(r_regionkey + 1 AS BIGINT)",
    "ChannelName": "'Channel ' || r_name",
    "ChannelDescription": "CASE WHEN r_regionkey = 1 THEN NULL ELSE 'Sold in ' || r_name || ', directly' END",
}
CHANNEL_FILTER = "r_regionkey < 3"

DIMCURRENCY = {
    "CurrencyKey": "CAST(r_regionkey AS BIGINT)",
    "CurrencyName": "'Currency ' || r_name",
    "CurrencyDescription": "'Money of ' || r_name",
}

DIMPROMOTION = {
    "PromotionKey": "CAST(n_nationkey AS BIGINT)",
    "PromotionName": "CASE WHEN n_nationkey = 3 THEN ' ' ELSE 'Promo ' || n_name END",
    "DiscountPercent": "CASE WHEN n_nationkey = 5 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) / 16 END",
    "PromotionType": "CASE WHEN n_nationkey % 2 = 0 THEN 'Seasonal Discount' ELSE 'No Discount' END",
    "PromotionCategory": "CASE WHEN n_nationkey % 2 = 0 THEN 'Store' END",
}
PROMOTION_FILTER = "n_nationkey < 10"         # key 10 (a 10 % discount) missing


# --------------------------------------------------------------------------
# Expression rendering shared by both engines.
# --------------------------------------------------------------------------
def _duck_type(spark_type: str) -> str:
    return {"timestamp_ntz": "TIMESTAMP", "string": "VARCHAR"}.get(spark_type, spark_type.upper())


def select_list(table: str, exprs: dict[str, str], engine: str) -> list[str]:
    """Full declared column list of ``table``: given expressions, else typed NULL."""
    ts = "TIMESTAMP_NTZ" if engine == "spark" else "TIMESTAMP"
    out = []
    for f in schemas.RAW_TABLES[table].fields:
        typ = f.dataType.simpleString()
        if f.name in exprs:
            e = exprs[f.name].replace("{TS}", ts)
            out.append(f"CAST({e} AS {typ if engine == 'spark' else _duck_type(typ)}) AS {f.name}")
        else:
            out.append(f"CAST(NULL AS {typ if engine == 'spark' else _duck_type(typ)}) AS {f.name}")
    return out


@dataclass(frozen=True)
class StandIn:
    table: str
    exprs: dict[str, str]
    spark_source: Callable[["DriverTables"], DataFrame]
    duck_source: str
    extra: dict[str, str] | None = None            # one literal row appended
    made: tuple[str, ...] = ()                     # columns that the Spark source holds already, as _name


@dataclass
class DriverTables:
    spark: SparkSession
    sf_dir: str
    _cache: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._cache[name]


def _li(d: DriverTables) -> DataFrame:
    return d["lineitem"].withColumn("uc", F.expr(UNIT_CENTS))


#: Columns of the online fact that need no order and are narrower than what they are made of: Spark makes them before the join.
BEFORE_ORDERS = ("CurrencyKey",)


def _li_orders(d: DriverTables) -> DataFrame:
    o = d["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    li = _li(d).selectExpr("*", *[f"{FACT_ONLINESALES[c]} AS _{c}" for c in BEFORE_ORDERS])
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")


def _part_with_copies(d: DriverTables) -> DataFrame:
    p = d["part"]
    return p.unionByName(p.where(PRODUCT_COPY_FILTER))


def _sizes(d: DriverTables) -> DataFrame:
    return d["part"].select("p_size").distinct()


def _nation_region(d: DriverTables) -> DataFrame:
    return (d["nation"].where(GEOGRAPHY_FILTER)
            .join(d["region"], F.col("n_regionkey") == F.col("r_regionkey"), "inner"))


def _days(d: DriverTables) -> DataFrame:
    od = d["orders"].select(F.col("o_orderdate").cast("date").alias("d"))
    sd = d["lineitem"].select(F.col("l_shipdate").cast("date").alias("d"))
    # union + distinct: partial aggregation leaves one row per day per task.
    return od.union(sd).distinct().where(DATE_FILTER)


_LI_SQL = f"(SELECT *, {UNIT_CENTS} AS uc FROM lineitem)"

STANDINS: dict[str, StandIn] = {
    "RAW_FACTSALES": StandIn("RAW_FACTSALES", FACTSALES, _li, f"{_LI_SQL} li"),
    "RAW_FACT_ONLINESALES": StandIn(
        "RAW_FACT_ONLINESALES", FACT_ONLINESALES, _li_orders,
        f"{_LI_SQL} li JOIN orders ON l_orderkey = o_orderkey", made=BEFORE_ORDERS),
    "RAW_DIMPRODUCT": StandIn(
        "RAW_DIMPRODUCT", DIMPRODUCT, _part_with_copies,
        f"(SELECT * FROM part UNION ALL SELECT * FROM part WHERE {PRODUCT_COPY_FILTER}) p"),
    "RAW_DIMPRODUCTSUBCATEGORY": StandIn(
        "RAW_DIMPRODUCTSUBCATEGORY", DIMSUBCATEGORY, _sizes,
        "(SELECT DISTINCT p_size FROM part) ps"),
    "RAW_DIMPRODUCTCATEGORY": StandIn(
        "RAW_DIMPRODUCTCATEGORY", DIMCATEGORY, lambda d: d["region"], "region",
        extra=CATEGORY_EXTRA),
    "RAW_DIMSTORE": StandIn("RAW_DIMSTORE", DIMSTORE, lambda d: d["supplier"], "supplier"),
    "RAW_DIMGEOGRAPHY": StandIn(
        "RAW_DIMGEOGRAPHY", DIMGEOGRAPHY, _nation_region,
        f"nation JOIN region ON n_regionkey = r_regionkey WHERE {GEOGRAPHY_FILTER}"),
    "RAW_DIMEMPLOYEE": StandIn(
        "RAW_DIMEMPLOYEE", DIMEMPLOYEE, lambda d: d["supplier"].where(EMPLOYEE_FILTER),
        f"supplier WHERE {EMPLOYEE_FILTER}"),
    "RAW_DIMCUSTOMER": StandIn("RAW_DIMCUSTOMER", DIMCUSTOMER, lambda d: d["customer"], "customer"),
    "RAW_DIMDATE": StandIn(
        "RAW_DIMDATE", DIMDATE, _days,
        "(SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION "
        f"SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem) days WHERE {DATE_FILTER}"),
    "RAW_DIMCHANNEL": StandIn(
        "RAW_DIMCHANNEL", DIMCHANNEL, lambda d: d["region"].where(CHANNEL_FILTER),
        f"region WHERE {CHANNEL_FILTER}"),
    "RAW_DIMCURRENCY": StandIn("RAW_DIMCURRENCY", DIMCURRENCY, lambda d: d["region"], "region"),
    "RAW_DIMPROMOTION": StandIn(
        "RAW_DIMPROMOTION", DIMPROMOTION, lambda d: d["nation"].where(PROMOTION_FILTER),
        f"nation WHERE {PROMOTION_FILTER}"),
}


def build_spark(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazily derive the 13 raw frames from the driver Parquet in ``sf_dir``."""
    d = DriverTables(spark, sf_dir)
    out: dict[str, DataFrame] = {}
    for name, si in STANDINS.items():
        exprs = {**si.exprs, **{c: f"_{c}" for c in si.made}}
        df = si.spark_source(d).selectExpr(*select_list(name, exprs, "spark"))
        if si.extra:
            lit_row = spark.range(1).selectExpr(*select_list(name, si.extra, "spark"))
            df = df.unionByName(lit_row)
        out[name] = df
    return out


def duck_cte(table: str) -> str:
    """``SELECT ...`` text producing the same stand-in in DuckDB."""
    si = STANDINS[table]
    sql = f"SELECT {', '.join(select_list(table, si.exprs, 'duck'))} FROM {si.duck_source}"
    if si.extra:
        sql += f" UNION ALL SELECT {', '.join(select_list(table, si.extra, 'duck'))}"
    return sql
