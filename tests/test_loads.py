"""Loads with a history: what is skipped, read again, kept in quarantine and made visible."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.keybitmaps import KeyBitmaps
from ledgerlake.operators.merge import MergedView
from ledgerlake.plans import load_queries, quality, views
from ledgerlake.session import local_path
from ledgerlake.sinks.commitlog import CommitLog, Conflict, LoadedTable, put_if_absent
from ledgerlake.sinks.parquet import publish, republish
from ledgerlake.sources import csv as ingest
from ledgerlake.sources.footers import footer_counts
from ledgerlake.sources.loads import copy_into
from ledgerlake.sources.zone import RawZone

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.StringType()), T.StructField("q", T.IntegerType())])


def drop(stage, name, text):
    os.makedirs(local_path(stage), exist_ok=True)
    with open(f"{local_path(stage)}/{name}", "w") as fh:
        fh.write(text)
    return f"{local_path(stage)}/{name}"


def keys(df):
    return sorted(r["k"] for r in df.collect())


def test_history_skips_what_it_has_and_reads_changed_files(spark, tmp_stage):
    table = LoadedTable(spark, f"{tmp_stage}/t", SCHEMA)
    assert table.snapshot().schema == SCHEMA and table.snapshot().count() == 0 and table.history().count() == 0
    one = drop(f"{tmp_stage}/in", "a.csv", "k,n,q\n1,x,1\n2,y,z\n")
    drop(f"{tmp_stage}/in", "b.csv", "k,n,q\n3,x,1\n")
    first = copy_into(table, f"{tmp_stage}/in")
    assert first["number"] == 0 and first["parsed"] == 3 and first["rejected"] == 1
    assert copy_into(table, f"{tmp_stage}/in") is None
    assert keys(table.snapshot()) == [1, 3]
    drop(f"{tmp_stage}/in", "a.csv", "k,n,q\n4,x,1\n5,x,1\n")
    os.utime(one, (2_000_000_000, 2_000_000_000))
    assert copy_into(table, f"{tmp_stage}/in")["number"] == 1
    assert copy_into(table, f"{tmp_stage}/in") is None
    assert keys(table.snapshot()) == [1, 3, 4, 5] and keys(table.snapshot(up_to=0)) == [1, 3] and keys(table.increment(1)) == [4, 5]
    report = {(r["commit"], os.path.basename(r["path"])): r for r in table.history().collect()}
    assert set(report) == {(0, "a.csv"), (0, "b.csv"), (1, "a.csv")}
    a = report[0, "a.csv"]
    assert (a["parsed"], a["loaded"], a["rejected"], a["first_reason"], a["first_record"]) == (2, 1, 1, "q: cannot convert to int", 2)
    assert [tuple(r["_fields"]) for r in table.quarantine().collect()] == [("2", "y", "z")]


def test_an_aborted_or_torn_load_is_invisible(spark, tmp_stage):
    table = LoadedTable(spark, f"{tmp_stage}/t", SCHEMA)
    drop(f"{tmp_stage}/in", "a.csv", "k,n,q\n1,x,1\n")
    copy_into(table, f"{tmp_stage}/in", on_error="abort")
    drop(f"{tmp_stage}/in", "b.csv", "k,n,q\n2,x,bad\n")
    with pytest.raises(Exception, match="load aborted"):
        copy_into(table, f"{tmp_stage}/in", on_error="abort")
    spark.createDataFrame([(9, "torn", 9)], SCHEMA).write.parquet(f"{table.new_folder()}/verdict=good")
    assert keys(table.snapshot()) == [1] and table.history().count() == 1
    drop(f"{tmp_stage}/in", "empty.csv", "k,n,q\n")
    done = copy_into(table, f"{tmp_stage}/in", on_error="continue")
    assert done["parsed"] == 1 and len(done["files"]) == 2 and keys(table.snapshot()) == [1]


def test_two_loads_of_one_file_commit_once(spark, tmp_stage):
    table = LoadedTable(spark, f"{tmp_stage}/t", SCHEMA)
    files = [{"path": "f", "size": 1, "modified": 1, "parsed": 1, "loaded": 1, "rejected": 0, "first_reason": None, "first_record": None}]
    assert table.commit("one", files) == 0
    with pytest.raises(Conflict):
        table.commit("two", files)
    assert table.commit("three", [{**files[0], "size": 2}]) == 1


def test_log_numbers_are_taken_once(spark, tmp_stage):
    assert put_if_absent(spark, f"{tmp_stage}/log/1.json", "{}") and not put_if_absent(spark, f"{tmp_stage}/log/1.json", "[]")
    log = CommitLog(spark, f"{tmp_stage}/entries")
    assert [log.append({"x": i}) for i in range(3)] == [0, 1, 2]
    assert [e["x"] for e in log.entries()] == [0, 1, 2]
    assert sorted(f for f in os.listdir(local_path(f"{tmp_stage}/entries")) if not f.startswith(".")) == [f"{i:012d}.json" for i in range(3)]


def test_first_record_counts_over_splits(spark, tmp_stage):
    lines = [f"{i},name {i},1" for i in range(1, 4001)]
    lines[3210] = "3211,bad,x"
    drop(f"{tmp_stage}/in", "long.csv", "k,n,q\n" + "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        table = LoadedTable(spark, f"{tmp_stage}/t", SCHEMA)
        files = copy_into(table, f"{tmp_stage}/in")["files"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (files[0]["parsed"], files[0]["rejected"], files[0]["first_record"]) == (4000, 1, 3211)


def test_quotes_are_judged_on_the_record(spark, tmp_stage):
    text = ('k,n,q\n1,"""abc",3\n2,5" pipe,4\n3,"a ""b"", c",5\n4,"left open,6\n5,"""",7\n6,"",8\n7,"x"y,9\n')
    drop(f"{tmp_stage}/in", "a.csv", text + '8,5" pipe,3,extra\n9,"open"",1,extra\n')
    rows = lambda ragged: ingest.load_csv(spark, f"{tmp_stage}/in", SCHEMA, ingest.CsvFormat(ragged=ragged))
    good = {r["k"]: r["n"] for r in rows(True).good.collect()}
    assert {k: good[k] for k in (1, 2, 3, 5, 8)} == {1: '"abc', 2: '5" pipe', 3: 'a "b", c', 5: '"', 8: '5" pipe'}
    assert 4 not in good and 9 not in good and good[6] is None
    strict = rows(False)
    assert {1, 2, 3, 5, 6} <= {r["k"] for r in strict.good.collect()}
    reasons = {r["k"]: r["_reject_reason"] for r in strict.rejected.collect()}
    assert reasons["4"] == "quote left open" and reasons["8"] == "column count mismatch"


def test_quote_rule_with_another_escape(spark):
    fmt = ingest.CsvFormat(sep="|", quote="'", escape="\\")
    rows = [("1|'a|b'|2", False), ("1|'a\\'b'|2", False), ("1|'a\\'b|2", True), ("'", True), ("it's|x", False), ("''|'x'", False)]
    df = spark.createDataFrame(rows, "r string, want boolean")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", ingest.quote_left_open(F.col("r"), fmt)).collect())


def test_merge_rewrites_touched_buckets_only(spark, tmp_stage):
    schema = T.StructType([T.StructField("SalesKey", T.LongType()), T.StructField("DateKey", T.TimestampNTZType()), T.StructField("x", T.IntegerType())])
    row = lambda k, day, x: f"({k}, TIMESTAMP_NTZ'2020-01-{day:02d}', {x})"
    frame = lambda *rows: spark.sql(f"SELECT CAST(SalesKey AS BIGINT) AS SalesKey, DateKey, x FROM VALUES {', '.join(rows)} AS t(SalesKey, DateKey, x)")
    view = MergedView(spark, f"{tmp_stage}/m", schema, "SalesKey", width=10)
    assert view.read().count() == 0 and view.read().columns == ["SalesKey", "DateKey", "x", "RowRank"]
    first = [row(k, 5, k) for k in (1, 2, 15, 16, 33, -4)] + [row("NULL", 5, 0), row("NULL", 6, 1), row(2, 4, 9)]
    assert view.merge(frame(*first)) == ["-1", "0", "1", "3", "null"]
    before = view.folders()
    second = [row(1, 9, 100), row(2, 1, 200), row(41, 1, 41), row("NULL", 7, 2)]
    assert view.merge(frame(*second), key="day 2") == ["0", "4", "null"]
    assert view.merge(frame(*second), key="day 2") == []
    after = view.folders()
    assert all(after[b] == before[b] for b in ("-1", "1", "3")) and after["0"] != before["0"]
    got = {(r["SalesKey"], r["x"]) for r in view.read().collect()}
    assert got == {(1, 100), (2, 2), (15, 15), (16, 16), (33, 33), (-4, -4), (41, 41), (None, 2)}
    assert view.vacuum() == 2 and view.vacuum() == 0 and view.read().count() == 8


def test_merge_starts_again_when_overtaken(spark, tmp_stage, monkeypatch):
    schema = T.StructType([T.StructField("SalesKey", T.LongType()), T.StructField("DateKey", T.DateType())])
    rows = lambda day, *ks: spark.createDataFrame([(k,) for k in ks], "SalesKey long").withColumn("DateKey", F.to_date(F.lit(day)))
    mine, other = (MergedView(spark, f"{tmp_stage}/m", schema, "SalesKey", width=100) for _ in range(2))
    mine.merge(rows("2020-01-01", 1, 2))
    append, once = mine.log.append, []

    def overtaken(entry, allowed):
        if not once:
            once.append(other.merge(rows("2020-01-03", 2, 3)))
        return append(entry, allowed)
    monkeypatch.setattr(mine.log, "append", overtaken)
    mine.merge(rows("2020-01-02", 1, 2))
    assert {(r[0], str(r[1])) for r in mine.read().drop("RowRank").collect()} == {(1, "2020-01-02"), (2, "2020-01-03"), (3, "2020-01-03")}


def test_footer_counts_read_no_column(spark, zone, tmp_stage):
    names = ["RAW_DIMSTORE", "RAW_DIMPRODUCT", "RAW_DIMDATE"]
    for n in names[:2]:
        zone[n].write.parquet(f"{tmp_stage}/{n}")
    schemas = {n: zone[n].schema for n in names}
    out = footer_counts(spark, {**{n: [f"{tmp_stage}/{n}"] for n in names[:2]}, "RAW_DIMDATE": []}, schemas)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(") == 2 and "StoreKey" not in plan
    assert {r[0]: r[1] for r in out.collect()} == {"RAW_DIMSTORE": zone["RAW_DIMSTORE"].count(), "RAW_DIMPRODUCT": zone["RAW_DIMPRODUCT"].count(), "RAW_DIMDATE": 0}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != footer_counts.__doc__ and "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_republish_keeps_the_files_of_other_years(spark, zone, tmp_stage):
    path = f"{tmp_stage}/rpt"
    first, second, _ = load_queries.drops(zone["RAW_FACTSALES"])
    view = lambda fact: views.rpt_sales_master(load_queries.with_fact(zone, "RAW_FACTSALES", fact))
    publish(view(first), path)
    files = lambda: {f"{d}/{f}" for d, _, fs in os.walk(local_path(path)) for f in fs if f.endswith(".parquet")}
    before = files()
    touched = republish(view(first.unionByName(second)), view(second), path)
    assert touched == [1998, 1999] and before <= files()
    assert spark.read.parquet(path).count() == view(first.unionByName(second)).count()
    one = republish(view(first), view(first.where(F.year("DateKey") == 1996)), path)
    assert one == [1996] and {f for f in before if "1995" in f} <= files() and not {f for f in before if "1996" in f} & files()


def test_master_checks_scan_each_fact_once(zone):
    for check, fact in ((quality.master_checks_sales, "RAW_FACTSALES"), (quality.master_checks_online, "RAW_FACT_ONLINESALES")):
        plan = check(zone)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_extendedprice#") and plan.count("Relation [l_orderkey") == 2  # the fact, and the days of DimDate


def test_preview_stops_after_the_first_rows(spark, zone):
    df = load_queries.QUERIES["csv_preview_store"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CollectLimit 10" in plan and "Sort" not in plan


def test_loaded_zone_reports_and_profiles(spark, zone, tmp_stage):
    zone.write(f"{tmp_stage}/zone")
    profile = {(r["TABLE_NAME"], r["METRIC"]): r["VALUE"] for r in RawZone.profile(spark, f"{tmp_stage}/zone").collect()}
    want = quality.product_profile_suite(zone).first()
    assert profile["RAW_DIMPRODUCT", "total_rows"] == str(want["Total_Rows"])
    assert profile["RAW_DIMPRODUCT", "distinct_keys"] == str(want["Unique_Keys"])
    assert profile["RAW_DIMPRODUCT", "Invalid_Prices"] == str(want["Invalid_Prices"])


def test_key_bitmaps_count_exactly(spark, tmp_stage, monkeypatch):
    monkeypatch.setattr("ledgerlake.operators.keybitmaps.PART", 2)
    big = 2**63 - 1
    loads = [[1, 2, 2, None, 32768, 32769, -5, big, -big], [2, 3, 1, None, -5, 0, 70000], [], [100000, 100000, 3, -40000]]
    bitmaps, so_far = KeyBitmaps(spark, f"{tmp_stage}/b"), []
    assert bitmaps.counts() == {"rows": 0, "distinct": 0, "repeated": 0, "nulls": 0}
    for i, ks in enumerate(loads):
        so_far += ks
        df = spark.createDataFrame([(k,) for k in ks], "k long")
        got = bitmaps.add(df, "k", f"load {i}")
        want = {"rows": len(so_far), "distinct": len({k for k in so_far if k is not None}),
                "repeated": sum(so_far.count(k) > 1 for k in set(so_far)), "nulls": so_far.count(None)}
        assert got == want == bitmaps.add(df, "k", f"load {i}")
    untouched = [p for p, x in KeyBitmaps._parts(bitmaps.log.entries()).items() if x in bitmaps.log.entries()[0]["parts"].values()]
    assert untouched


def test_catalog_tables_are_replaced_whole(spark, zone, tmp_stage):
    small = {n: zone[n].limit(5) if n.startswith("RAW_FACT") else zone[n] for n in zone.tables}
    RawZone(small).write_tables("swap_test", f"{tmp_stage}/db", 2)
    rows = lambda n: spark.table(f"swap_test.{n}").count()
    assert rows("RAW_FACTSALES") == 5
    broken = dict(small)
    broken["RAW_DIMDATE"] = small["RAW_DIMDATE"].where(F.raise_error(F.lit("lost")).isNull())
    broken["RAW_FACTSALES"] = zone["RAW_FACTSALES"].limit(9)
    with pytest.raises(Exception, match="lost"):
        RawZone(broken).write_tables("swap_test", f"{tmp_stage}/db", 2)
    assert rows("RAW_FACTSALES") == 5 and rows("RAW_DIMDATE") == zone["RAW_DIMDATE"].count()
    RawZone({**small, "RAW_FACTSALES": zone["RAW_FACTSALES"].limit(9)}).write_tables("swap_test", f"{tmp_stage}/db", 2)
    assert rows("RAW_FACTSALES") == 9
    RawZone(small).write_tables("swap_test", f"{tmp_stage}/db", 3)  # another layout
    assert rows("RAW_FACTSALES") == 5
    assert sorted(t.name.upper() for t in spark.catalog.listTables("swap_test")) == sorted(small)


def test_no_stand_in_column_is_empty(zone):
    for name, df in zone.tables.items():
        empty = df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()
        assert all(empty.values()), (name, empty)
