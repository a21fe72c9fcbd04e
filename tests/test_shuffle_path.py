"""The path beyond the size check: with no proven bounds and broadcasting
disabled, the views and checks run as shuffle joins and give the same rows."""

import pytest

from ledgerlake.registry import QUERIES
from ledgerlake.sources.zone import RawZone

NAMES = ["rpt_sales_master", "rpt_online_master", "master_sales_v1_left", "clean_sales",
         "orphan_key_audit", "revenue_bridge_sales", "duplicate_key_listing"]


@pytest.fixture(scope="module")
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    yield keys
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_without_broadcast(spark, zone, no_broadcast, name):
    expected = sorted(map(tuple, QUERIES[name](zone).collect()), key=repr)
    for k in no_broadcast:
        spark.conf.set(k, "-1")
    try:
        unbounded = RawZone(zone.tables, {})            # nothing proven -> no hints
        df = QUERIES[name](unbounded)
        got = sorted(map(tuple, df.collect()), key=repr)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in no_broadcast:
            spark.conf.unset(k)
    assert got == expected
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
