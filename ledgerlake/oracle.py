"""DuckDB oracle SQL for the correctness gate.

Each oracle query is self-contained.  Its ``WITH`` prelude derives the 13 raw
tables from the pre-registered driver views (same expressions as
``sources.standins``) and computes the views in a way of their own, so that an
error in the join layer cannot hide in both engines:

* conformed dimensions first: outriggers are attached to their dimension, and
  every dimension carries a flag column that is true on each of its rows;
* one wide relation for each star, outer-joined to all its dimensions, so the
  flags say which keys were matched and rows repeat as often as matches do;
* a view is a projection of a wide relation, and its inner joins are a filter
  on the flags of the dimensions that must match;
* the deduplicated views take one row for each key by ``DISTINCT ON``.

Which view needs which match, and what it outputs, is the table ``VIEWS``.
Results are cast to the types that Spark produces (INT x DECIMAL(10,2) is
DECIMAL(21,2) in Spark, DECIMAL(18,2) in DuckDB).
"""

from __future__ import annotations

from ledgerlake import schemas
from ledgerlake.sources import standins

# -- conformed dimensions: key columns, attributes under short names, a flag -------
_PERSON = "FirstName || ' ' || LastName"
_DIMENSIONS = {
    "o_place": "SELECT GeographyKey, RegionCountryName AS country, ContinentName AS continent FROM RAW_DIMGEOGRAPHY",
    "o_boss": f"SELECT EmployeeKey AS StoreManager, {_PERSON} AS boss FROM RAW_DIMEMPLOYEE",
    "o_store": "SELECT StoreKey, StoreName, StoreType, Status, country, continent, boss, TRUE AS store_ok "
               "FROM RAW_DIMSTORE LEFT JOIN o_place USING (GeographyKey) LEFT JOIN o_boss USING (StoreManager)",
    "o_customer": f"SELECT CustomerKey, {_PERSON} AS customer, Gender, country, continent, TRUE AS customer_ok "
                  "FROM RAW_DIMCUSTOMER LEFT JOIN o_place USING (GeographyKey)",
    "o_item": "SELECT ProductKey, ProductName, BrandName, ProductSubcategoryKey AS shelf, TRUE AS product_ok FROM RAW_DIMPRODUCT",
    "o_shelf": "SELECT s.ProductSubcategoryKey AS shelf, s.ProductSubcategoryName AS subcategory, k.ProductCategoryName AS category "
               "FROM RAW_DIMPRODUCTSUBCATEGORY AS s LEFT JOIN RAW_DIMPRODUCTCATEGORY AS k USING (ProductCategoryKey)",
    "o_product": "SELECT * FROM o_item LEFT JOIN o_shelf USING (shelf)",
    "o_day": "SELECT CAST(DateKey AS TIMESTAMP) AS DateKey, CalendarYear, TRUE AS day_ok FROM RAW_DIMDATE",
    "o_channel": "SELECT ChannelKey AS channelKey, TRUE AS channel_ok FROM RAW_DIMCHANNEL",
    "o_promotion": "SELECT PromotionKey, TRUE AS promotion_ok FROM RAW_DIMPROMOTION",
    "o_currency": "SELECT CurrencyKey, CurrencyName, TRUE AS currency_ok FROM RAW_DIMCURRENCY",
}

# -- wide relations: fact, then (dimension, key) --------------------------------------
_WIDE = {
    "w_store_flat": ("RAW_FACTSALES", [("o_store", "StoreKey"), ("o_item", "ProductKey"), ("o_day", "DateKey"),
                                       ("o_channel", "channelKey"), ("o_promotion", "PromotionKey")]),
    "w_store": ("RAW_FACTSALES", [("o_store", "StoreKey"), ("o_product", "ProductKey"), ("o_day", "DateKey"),
                                  ("o_channel", "channelKey"), ("o_promotion", "PromotionKey")]),
    "w_store_report": ("RAW_FACTSALES", [("o_store", "StoreKey"), ("o_product", "ProductKey"), ("o_day", "DateKey")]),
    "w_online_flat": ("RAW_FACT_ONLINESALES", [("o_customer", "CustomerKey"), ("o_item", "ProductKey"), ("o_day", "DateKey"),
                                               ("o_currency", "CurrencyKey")]),
    "w_online": ("RAW_FACT_ONLINESALES", [("o_customer", "CustomerKey"), ("o_product", "ProductKey"), ("o_day", "DateKey"),
                                          ("o_currency", "CurrencyKey")]),
}

_STORE_KEPT = ("store", "product", "day", "channel", "promotion")
_ONLINE_KEPT = ("customer", "product", "day", "currency")


def _money(amount: str, digits: int) -> str:
    return f"CAST({amount} AS DECIMAL({digits},2))"


_REVENUE = _money("SalesQuantity * UnitPrice", 21)

# -- outputs: name -> expression over a wide relation ------------------------------------
_SAME = lambda *names: {n: n for n in names}
_FLAT = {"RegionCountryName": "country", **_SAME("ProductName", "BrandName", "CalendarYear")}
_TREE = {"Country": "country", "Continent": "continent", "Product": "ProductName", "Brand": "BrandName",
         "Category": "category", "SubCategory": "subcategory", "Year": "CalendarYear"}
_STORE_FLAT = {**_SAME("SalesKey", "DateKey", "StoreKey", "ProductKey", "SalesQuantity", "UnitPrice", "StoreName"),
               **_FLAT, "StoreManagerName": "boss"}
_ONLINE_FLAT = {**_SAME("OnlineSalesKey", "DateKey", "CustomerKey", "ProductKey", "SalesQuantity", "UnitPrice"),
                "CustomerName": "customer", **_FLAT, **_SAME("CurrencyName")}
_STORE_TREE = {**_SAME("SalesKey", "DateKey", "SalesQuantity", "UnitPrice"), "Store": "StoreName", **_SAME("StoreType"),
               **_TREE, "StoreManagerName": "boss"}
_ONLINE_TREE = {**_SAME("OnlineSalesKey", "DateKey", "SalesQuantity", "UnitPrice"), "CustomerName": "customer",
                **_TREE, **_SAME("CurrencyName")}
_TIDY = {"CountryName": "trim(country)", "ContinentName": "trim(continent)", "ProductName": "trim(ProductName)",
         "BrandName": "trim(BrandName)", "CategoryName": "trim(category)"}
_AMOUNTS = {"TotalRevenue": _REVENUE, "TotalCost": _money("SalesQuantity * UnitCost", 21),
            "NetProfit": _money("SalesQuantity * UnitPrice - SalesQuantity * UnitCost", 22)}


def _unless(column: str, *tokens: str) -> str:
    """The column, NULL where it is one of the tokens."""
    return f"if(list_contains({list(tokens)}, {column}), NULL, {column})"


_STORE_REPORT = {**_SAME("SalesKey", "DateKey", "StoreKey", "ProductKey", "SalesQuantity", "UnitPrice", "UnitCost"), **_AMOUNTS,
                 "StoreName": "if(length(trim(StoreName)) = 0, NULL, trim(StoreName))",
                 "StoreStatus": _unless("Status", "N/A", "Unknown", "Off", "0"), **_SAME("StoreType"), **_TIDY,
                 "SubCategoryName": "trim(subcategory)", "StoreManagerName": "trim(boss)", **_SAME("CalendarYear")}
_ONLINE_REPORT = {"SalesKey": "OnlineSalesKey", **_SAME("DateKey", "CustomerKey", "ProductKey", "SalesQuantity", "UnitPrice", "UnitCost"),
                  **_AMOUNTS, "CustomerName": "trim(customer)", "Gender": _unless("Gender", "N/A", "Unknown", "0"), **_TIDY,
                  **_SAME("CalendarYear", "CurrencyName")}

#: view -> (wide relation, dimensions that must match, outputs)
VIEWS = {
    "VIEW_MASTER_SALES_V1": ("w_store_flat", (), _STORE_FLAT),
    "VIEW_MASTER_ONLINESALES_V1": ("w_online_flat", (), _ONLINE_FLAT),
    "VIEW_MASTER_SALES_V2": ("w_store_flat", _STORE_KEPT, _STORE_FLAT),
    "VIEW_MASTER_ONLINESALES_V2": ("w_online_flat", _ONLINE_KEPT, _ONLINE_FLAT),
    "VIEW_MASTER_SALES_V3": ("w_store", _STORE_KEPT, _STORE_TREE),
    "VIEW_MASTER_ONLINESALES_V3": ("w_online", _ONLINE_KEPT, _ONLINE_TREE),
    "VIEW_MASTER_SALES": ("w_store", _STORE_KEPT, {**_STORE_TREE, "TotalRevenue": _REVENUE}),
    "VIEW_MASTER_ONLINESALES": ("w_online", _ONLINE_KEPT, {**_ONLINE_TREE, "TotalRevenue": _REVENUE}),
    "VIEW_RPT_SALES_MASTER": ("w_store_report", ("store", "product", "day"), _STORE_REPORT),
    "VIEW_RPT_ONLINESALES_MASTER": ("w_online", _ONLINE_KEPT, _ONLINE_REPORT),
}

SEA = ["Singapore", "Malaysia", "Thailand", "Vietnam"]

#: Columns of the master views in the order in which ties of the latest date are broken.
_TIES = {
    "SalesKey": ["SalesQuantity", "UnitPrice", "TotalRevenue", "Store", "StoreType", "Country", "Continent", "Product",
                 "Brand", "Category", "SubCategory", "Year", "StoreManagerName"],
    "OnlineSalesKey": ["SalesQuantity", "UnitPrice", "TotalRevenue", "CustomerName", "Country", "Continent", "Product",
                       "Brand", "Category", "SubCategory", "Year", "CurrencyName"],
}


def _latest(view: str, key: str) -> str:
    ties = ", ".join(f"{c} NULLS LAST" for c in _TIES[key])
    return (f"SELECT *, CAST(1 AS INTEGER) AS RowRank FROM "
            f"(SELECT DISTINCT ON ({key}) * FROM {view} ORDER BY {key}, DateKey DESC NULLS FIRST, {ties})")


def _relations() -> dict[str, str]:
    out = dict(_DIMENSIONS)
    for name, (fact, dims) in _WIDE.items():
        out[name] = f"SELECT * FROM {fact}" + "".join(f" LEFT JOIN {d} USING ({k})" for d, k in dims)
    for name, (wide, needed, columns) in VIEWS.items():
        chosen = ", ".join(f"{e} AS {n}" for n, e in columns.items())
        out[name] = f"SELECT {chosen} FROM {wide}" + (" WHERE " + " AND ".join(f"{d}_ok" for d in needed) if needed else "")
    for name, master in (("VIEW_SEA_PERFORMANCE", "VIEW_MASTER_SALES"), ("VIEW_SEA_ONLINE_PERFORMANCE", "VIEW_MASTER_ONLINESALES")):
        out[name] = f"SELECT * FROM {master} WHERE list_contains({SEA}, Country)"
    out["VIEW_CLEAN_SALES_DATA"] = _latest("VIEW_MASTER_SALES", "SalesKey")
    out["VIEW_CLEAN_ONLINESALES_DATA"] = _latest("VIEW_MASTER_ONLINESALES", "OnlineSalesKey")
    return out


def prelude() -> str:
    """``WITH`` clause defining the 13 raw tables, the helpers and every view."""
    parts = [f"{name} AS ({standins.duck_cte(name)})" for name in schemas.RAW_TABLES]
    parts += [f"{name} AS ({sql})" for name, sql in _relations().items()]
    return "WITH " + ",\n".join(parts) + "\n"


def with_prelude(body: str) -> str:
    """Oracle query: the prelude, then the body."""
    return prelude().rstrip("\n") + "\n" + body.strip()
