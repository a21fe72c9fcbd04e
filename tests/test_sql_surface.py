"""SQL over the registered views agrees with the DataFrame checks."""

from ledgerlake.plans import quality, views
from ledgerlake.plans.catalog import register_views


def test_registered_views_are_the_frames(spark, zone):
    register_views(spark, zone)
    per_year = "SELECT CalendarYear, count(*), sum(NetProfit) FROM VIEW_RPT_SALES_MASTER GROUP BY CalendarYear"
    want = views.rpt_sales_master(zone).groupBy("CalendarYear").agg({"*": "count", "NetProfit": "sum"})
    assert sorted(map(tuple, spark.sql(per_year).collect())) == sorted(map(tuple, want.select("CalendarYear", "count(1)", "sum(NetProfit)").collect()))


def test_sql_users_find_the_same_duplicates(spark, zone):
    register_views(spark, zone)
    twice = {}
    for label, view, key in (("Physical Sales Duplicates", "VIEW_MASTER_SALES", "SalesKey"),
                             ("Online Sales Duplicates", "VIEW_MASTER_ONLINESALES", "OnlineSalesKey")):
        for r in spark.table(view).groupBy(key).count().collect():
            if r["count"] > 1:
                twice[label, r[key]] = r["count"]
    assert twice == {(r["Test_Type"], r["Key_ID"]): r["Count"] for r in quality.duplicate_key_listing(zone).collect()}


def test_bridge_is_the_revenue_of_unknown_keys(spark, zone):
    register_views(spark, zone)
    known = [{r[0] for r in spark.table(t).select(k).collect()} for t, k in (("RAW_DIMPRODUCT", "ProductKey"), ("RAW_DIMSTORE", "StoreKey"))]
    lost = 0
    for r in spark.table("RAW_FACTSALES").select("ProductKey", "StoreKey", "SalesQuantity", "UnitPrice").collect():
        gone = [None not in have and key is not None and key not in have for key, have in zip(r[:2], known)]
        if any(gone) and None not in r[2:]:
            lost += r["SalesQuantity"] * r["UnitPrice"]
    ours = {r["Category"]: r["Revenue"] for r in quality.revenue_bridge_sales(zone).collect()}
    assert ours["Physical: Less Orphans (Invalid Products)"] == -lost
