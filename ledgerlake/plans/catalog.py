"""SQL surface: the raw zone and the views as named temp views.

Users who query the reporting layer with SQL keep their statements: the 13
raw tables are registered under their table names and the final definition of
every view under its view name, each backed by the DataFrame plan of
``plans.views`` (so ``SELECT ... FROM VIEW_RPT_SALES_MASTER`` gets the same
pruned, broadcast-joined plan as the DataFrame call).

For the revenue bridge prefer ``plans.quality.revenue_bridge_sales``: written
as ``NOT IN (...) OR NOT IN (...)`` in SQL, Spark plans nested-loop joins.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerlake.plans import views
from ledgerlake.sources.zone import RawZone

VIEW_NAMES = {
    "VIEW_MASTER_SALES": views.master_sales,
    "VIEW_MASTER_ONLINESALES": views.master_online,
    "VIEW_SEA_PERFORMANCE": views.sea_performance,
    "VIEW_SEA_ONLINE_PERFORMANCE": views.sea_online_performance,
    "VIEW_CLEAN_SALES_DATA": views.clean_sales,
    "VIEW_CLEAN_ONLINESALES_DATA": views.clean_online,
    "VIEW_RPT_SALES_MASTER": views.rpt_sales_master,
    "VIEW_RPT_ONLINESALES_MASTER": views.rpt_online_master,
}


def register_views(spark: SparkSession, zone: RawZone) -> list[str]:
    """Create or replace temp views for the raw tables and the final views."""
    names = []
    for name, df in zone.tables.items():
        df.createOrReplaceTempView(name)
        names.append(name)
    for name, fn in VIEW_NAMES.items():
        fn(zone).createOrReplaceTempView(name)
        names.append(name)
    return names
