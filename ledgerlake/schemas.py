"""Declared schemas of the 13 raw tables.

Keys are ``LongType`` so scale-up cannot overflow; counts stay ``IntegerType``;
the source's 8-byte FLOAT is ``DoubleType``; DATETIME / TIMESTAMP are zone-less
(``TimestampNTZType``).  ``max_length`` metadata marks a VARCHAR(n) column whose
over-long values are load errors.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
DT, TS = T.DateType(), T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)


def _schema(*fields) -> T.StructType:
    out = []
    for f in fields:
        name, typ = f[0], f[1]
        meta = f[2] if len(f) > 2 else {}
        out.append(T.StructField(name, typ, True, meta))
    return T.StructType(out)


def varchar(n: int) -> dict:
    return {"max_length": n}


RAW_DIMPRODUCT = _schema(
    ("ProductKey", L), ("ProductName", S), ("ProductDescription", S),
    ("ProductSubcategoryKey", L), ("Manufacturer", S), ("BrandName", S),
    ("ClassID", S), ("ClassName", S), ("StyleID", S), ("StyleName", S),
    ("ColorID", S), ("ColorName", S), ("Weight", D), ("WeightUnitMeasureID", S),
    ("UnitOfMeasureID", S), ("UnitOfMeasureName", S), ("StockTypeID", S),
    ("StockTypeName", S), ("UnitCost", D), ("UnitPrice", D),
    ("AvailableForSaleDate", TS), ("Status", S))

RAW_DIMCUSTOMER = _schema(
    ("CustomerKey", L), ("GeographyKey", L), ("FirstName", S), ("LastName", S),
    ("BirthDate", DT), ("MaritalStatus", S), ("Gender", S), ("YearlyIncome", D),
    ("TotalChildren", I), ("NumberChildrenAtHome", I), ("Education", S),
    ("Occupation", S), ("HouseOwnerFlag", I), ("NumberCarsOwned", I))

RAW_FACTSALES = _schema(
    ("SalesKey", L), ("DateKey", TS), ("channelKey", L), ("StoreKey", L),
    ("ProductKey", L), ("PromotionKey", L), ("CurrencyKey", L),
    ("UnitCost", MONEY), ("UnitPrice", MONEY), ("SalesQuantity", I),
    ("ReturnQuantity", I), ("ReturnAmount", MONEY), ("DiscountQuantity", I),
    ("DiscountAmount", MONEY), ("TotalCost", MONEY), ("SalesAmount", MONEY))

RAW_FACT_ONLINESALES = _schema(
    ("OnlineSalesKey", L), ("DateKey", TS), ("StoreKey", L), ("ProductKey", L),
    ("PromotionKey", L), ("CurrencyKey", L), ("CustomerKey", L),
    ("SalesOrderNumber", S, varchar(50)), ("SalesOrderLineNumber", I),
    ("SalesQuantity", I), ("SalesAmount", MONEY), ("ReturnQuantity", I),
    ("ReturnAmount", MONEY), ("DiscountQuantity", I), ("DiscountAmount", MONEY),
    ("TotalCost", MONEY), ("UnitCost", MONEY), ("UnitPrice", MONEY))

RAW_DIMSTORE = _schema(
    ("StoreKey", L), ("GeographyKey", L), ("StoreManager", L), ("StoreType", S),
    ("StoreName", S), ("Status", S), ("OpenDate", DT), ("CloseDate", DT),
    ("EntityKey", L), ("StorePhone", S), ("StoreFax", S), ("CloseReason", S),
    ("EmployeeCount", I), ("SellingAreaSize", I), ("LastRemodelDate", TS),
    ("EmployeeKey", L))

RAW_DIMGEOGRAPHY = _schema(
    ("GeographyKey", L), ("GeographyType", S), ("ContinentName", S),
    ("CityName", S), ("StateProvinceName", S), ("RegionCountryName", S))

RAW_DIMPRODUCTCATEGORY = _schema(
    ("ProductCategoryKey", L), ("ProductCategoryName", S))

RAW_DIMPRODUCTSUBCATEGORY = _schema(
    ("ProductSubcategoryKey", L), ("ProductSubcategoryName", S),
    ("ProductCategoryKey", L))

RAW_DIMCHANNEL = _schema(
    ("ChannelKey", L), ("ChannelName", S), ("ChannelDescription", S))

RAW_DIMCURRENCY = _schema(
    ("CurrencyKey", L), ("CurrencyName", S), ("CurrencyDescription", S))

RAW_DIMEMPLOYEE = _schema(
    ("EmployeeKey", L), ("ParentEmployeeKey", L), ("FirstName", S),
    ("LastName", S), ("Title", S), ("HireDate", DT), ("BirthDate", DT),
    ("EmailAddress", S), ("Phone", S), ("EmergencyContactName", S),
    ("EmergencyContactPhone", S), ("Gender", S), ("PayFrequency", I),
    ("BaseRate", D), ("VacationHours", I), ("DepartmentName", S),
    ("StartDate", DT), ("Status", S), ("SalaryStatus", S),
    ("IsSalesPerson", S), ("IsMarried", S))

RAW_DIMPROMOTION = _schema(
    ("PromotionKey", L), ("PromotionName", S), ("DiscountPercent", D),
    ("PromotionType", S), ("PromotionCategory", S))

RAW_DIMDATE = _schema(
    ("DateKey", DT), ("CalendarYear", I), ("CalendarYearLabel", S),
    ("CalendarHalfYearLabel", S), ("CalendarQuarterLabel", S),
    ("CalendarMonthLabel", S), ("CalendarWeekLabel", S),
    ("CalendarDayOfWeekLabel", S), ("FiscalYear", I), ("FiscalYearLabel", S),
    ("FiscalHalfYearLabel", S), ("FiscalQuarterLabel", S),
    ("FiscalMonthLabel", S), ("IsWorkDay", S), ("IsHoliday", S),
    ("EuropeSeason", S), ("NorthAmericaSeason", S), ("AsiaSeason", S),
    ("MonthNumber", I), ("CalendarDayOfWeekNumber", I))

RAW_TABLES: dict[str, T.StructType] = {
    "RAW_DIMPRODUCT": RAW_DIMPRODUCT,
    "RAW_DIMCUSTOMER": RAW_DIMCUSTOMER,
    "RAW_FACTSALES": RAW_FACTSALES,
    "RAW_FACT_ONLINESALES": RAW_FACT_ONLINESALES,
    "RAW_DIMSTORE": RAW_DIMSTORE,
    "RAW_DIMGEOGRAPHY": RAW_DIMGEOGRAPHY,
    "RAW_DIMPRODUCTCATEGORY": RAW_DIMPRODUCTCATEGORY,
    "RAW_DIMPRODUCTSUBCATEGORY": RAW_DIMPRODUCTSUBCATEGORY,
    "RAW_DIMCHANNEL": RAW_DIMCHANNEL,
    "RAW_DIMCURRENCY": RAW_DIMCURRENCY,
    "RAW_DIMEMPLOYEE": RAW_DIMEMPLOYEE,
    "RAW_DIMPROMOTION": RAW_DIMPROMOTION,
    "RAW_DIMDATE": RAW_DIMDATE,
}

# Key column each check treats as the table's identity.
TABLE_KEYS: dict[str, str] = {
    "RAW_DIMPRODUCT": "ProductKey",
    "RAW_DIMCUSTOMER": "CustomerKey",
    "RAW_FACTSALES": "SalesKey",
    "RAW_FACT_ONLINESALES": "OnlineSalesKey",
    "RAW_DIMSTORE": "StoreKey",
    "RAW_DIMGEOGRAPHY": "GeographyKey",
    "RAW_DIMPRODUCTCATEGORY": "ProductCategoryKey",
    "RAW_DIMPRODUCTSUBCATEGORY": "ProductSubcategoryKey",
    "RAW_DIMCHANNEL": "ChannelKey",
    "RAW_DIMCURRENCY": "CurrencyKey",
    "RAW_DIMEMPLOYEE": "EmployeeKey",
    "RAW_DIMPROMOTION": "PromotionKey",
    "RAW_DIMDATE": "DateKey",
}

# Columns loaded with a declared date pattern (customer file, DD/MM/YYYY).
DATE_FORMATS: dict[str, dict[str, str]] = {
    "RAW_DIMCUSTOMER": {"BirthDate": "dd/MM/yyyy"},
}


def ddl(schema: T.StructType) -> str:
    """``name type, ...`` text for a schema (used for NULL-typed free columns)."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
