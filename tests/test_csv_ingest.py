"""CSV ingest: bad-row verdicts, NULL tokens, patterns, abort, types."""

import os

import pytest
from pyspark.sql import types as T

from ledgerlake.session import local_path
from ledgerlake.sources import csv as ingest

SAMPLE = (
    "k,n,d,q\n"
    '1,"a, b",01/02/2003,5\n'
    "2,NULL,2003-02-01,x\n"
    "3,,31/12/1999\n"
    "4,null,15/06/2001,7,extra\n"
    '5," ",,8\n'
)
SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("n", T.StringType()),
                       T.StructField("d", T.DateType()), T.StructField("q", T.IntegerType())])


def _write(path, name, text):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "w") as fh:
        fh.write(text)
    return os.path.join(path, name)


def _load(spark, path, ragged, on_error="continue"):
    fmt = ingest.CsvFormat(ragged=ragged, date_formats={"d": "dd/MM/yyyy"})
    return ingest.load_csv(spark, path, SCHEMA, fmt, on_error=on_error)


def test_strict_verdicts(spark, tmp_stage):
    path = _write(tmp_stage, "sample.csv", SAMPLE)
    res = _load(spark, path, ragged=False)
    good = {r["k"]: r for r in res.good.collect()}
    assert sorted(good) == [1, 5]
    assert good[1]["n"] == "a, b" and str(good[1]["d"]) == "2003-02-01" and good[1]["q"] == 5
    assert good[5]["n"] == " " and good[5]["d"] is None and good[5]["q"] == 8
    rej = {r["k"]: r["_reject_reason"] for r in res.rejected.collect()}
    assert sorted(rej) == ["2", "3", "4"]
    assert rej["2"].startswith("d:")                      # first failing column
    assert rej["3"] == "column count mismatch"
    assert rej["4"] == "column count mismatch"


def test_ragged_verdicts(spark, tmp_stage):
    path = _write(tmp_stage, "sample.csv", SAMPLE)
    good = {r["k"]: r for r in _load(spark, path, ragged=True).good.collect()}
    assert sorted(good) == [1, 3, 4, 5]
    assert good[3]["n"] is None and good[3]["q"] is None and str(good[3]["d"]) == "1999-12-31"
    assert good[4]["n"] is None and good[4]["q"] == 7       # 'null' token, extra field ignored


def test_good_plus_rejected_is_everything(spark, tmp_stage):
    path = _write(tmp_stage, "sample.csv", SAMPLE)
    for ragged in (False, True):
        res = _load(spark, path, ragged=ragged)
        assert res.good.count() + res.rejected.count() == 5


def test_count_after_projection_sees_field_count(spark, tmp_stage):
    """A narrow projection must not hide a field-count mismatch."""
    path = _write(tmp_stage, "sample.csv", SAMPLE)
    res = _load(spark, path, ragged=False)
    assert res.good.select("k").count() == 2
    assert sorted(r["k"] for r in res.good.select("k").collect()) == [1, 5]


def test_abort_raises_on_bad_row(spark, tmp_stage):
    path = _write(tmp_stage, "sample.csv", SAMPLE)
    with pytest.raises(Exception) as err:
        _load(spark, path, ragged=False, on_error="abort").good.collect()
    assert "load aborted" in str(err.value)


def test_abort_passes_clean_file(spark, tmp_stage):
    path = _write(tmp_stage, "clean.csv", "k,n,d,q\n1,a,01/01/2000,2\n")
    assert _load(spark, path, ragged=False, on_error="abort").good.count() == 1


def test_pattern_selects_store_sales_only(spark, tmp_stage):
    header = "k,n,d,q\n"
    _write(tmp_stage, "FactSales_1.csv", header + "1,a,01/01/2000,1\n")
    _write(tmp_stage + "/sub", "FactSales_2.csv", header + "2,b,02/01/2000,2\n")
    _write(tmp_stage, "FactOnlineSales_1.csv", header + "3,c,03/01/2000,3\n")
    fmt = ingest.CsvFormat(date_formats={"d": "dd/MM/yyyy"})
    res = ingest.load_csv(spark, tmp_stage, SCHEMA, fmt, pattern=".*FactSales_.*.csv")
    assert sorted(r["k"] for r in res.good.collect()) == [1, 2]
    res = ingest.load_csv(spark, tmp_stage, SCHEMA, fmt, glob="*FactSales_*csv")
    assert sorted(r["k"] for r in res.good.collect()) == [1, 2]


def test_decimal_rounding_overflow_and_varchar(spark, tmp_stage):
    schema = T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("amt", T.DecimalType(10, 2)),
        T.StructField("code", T.StringType(), True, {"max_length": 5})])
    text = "id,amt,code\n1,12.345,abc\n2,123456789012.5,abc\n3,1.5,abcdef\n4,-0.005,\n"
    path = _write(tmp_stage, "d.csv", text)
    res = ingest.load_csv(spark, path, schema, ingest.NAMED_FORMAT)
    good = {r["id"]: r for r in res.good.collect()}
    assert sorted(good) == [1, 4]
    assert str(good[1]["amt"]) == "12.35"                    # half-up on cast
    assert good[4]["code"] is None
    reasons = {r["id"]: r["_reject_reason"] for r in res.rejected.collect()}
    assert reasons["2"].startswith("amt:") and reasons["3"].startswith("code:")


def test_raw_preview_positional(spark, tmp_stage):
    path = _write(tmp_stage, "p.csv", "a,b,c\n3,x,1\n1,y,2\n2,z,3\n")
    rows = ingest.raw_preview(spark, path, ["First", "Second"], n=2, ordered=True).collect()
    assert [tuple(r) for r in rows] == [("1", "y"), ("2", "z")]


def test_scheduled_preset_is_stricter_than_bulk(spark, tmp_stage):
    """The scheduled load spells no NULL tokens and no mismatch tolerance:
    'NULL' in a number column and a short row are errors there, not in bulk."""
    path = _write(tmp_stage, "f.csv", "k,n,d,q\n1,a,01/01/2000,NULL\n2,b,02/01/2000\n3,\\N,,4\n")
    dates = {"d": "dd/MM/yyyy"}
    strict = ingest.SCHEDULED_STRICT_FORMAT.with_dates(**dates)
    bulk = ingest.FACT_BULK_FORMAT.with_dates(**dates)
    got_strict = ingest.load_csv(spark, path, SCHEMA, strict).good.collect()
    got_bulk = ingest.load_csv(spark, path, SCHEMA, bulk).good.collect()
    assert [r["k"] for r in got_strict] == [3] and got_strict[0]["n"] is None
    assert sorted(r["k"] for r in got_bulk) == [1, 2, 3]


def test_strict_rows_do_not_depend_on_the_session(spark, tmp_stage):
    import pyspark.sql.types as T
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    os.makedirs(local_path(tmp_stage), exist_ok=True)
    with open(f"{local_path(tmp_stage)}/f.csv", "w") as fh:
        fh.write("k,a,b\n1,x,1\n2,x\n3,x,1,9\n")
    good = ingest.load_csv(spark, f"{tmp_stage}/f.csv", schema).good
    for flag in ("true", "false"):
        spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", flag)
        try:
            assert [r["k"] for r in good.select("k").collect()] == [1] and good.count() == 1
        finally:
            spark.conf.unset("spark.sql.csv.parser.columnPruning.enabled")


def test_torn_rows_are_rejected_or_read_whole(spark, tmp_stage):
    import pyspark.sql.types as T
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    os.makedirs(local_path(tmp_stage), exist_ok=True)
    with open(f"{local_path(tmp_stage)}/f.csv", "w") as fh:
        fh.write('k,a,b\n1,"line one\nline two",1\n2,plain,2\n3,"""said"" he",3\n')
    for ragged in (True, False):
        lines = ingest.load_csv(spark, f"{tmp_stage}/f.csv", schema, ingest.CsvFormat(ragged=ragged))
        assert {r["k"] for r in lines.good.collect()} == {2, 3}
        whole = ingest.load_csv(spark, f"{tmp_stage}/f.csv", schema, ingest.CsvFormat(ragged=ragged, multi_line=True))
        assert [tuple(r) for r in whole.good.orderBy("k").collect()] == [(1, "line one\nline two", 1), (2, "plain", 2), (3, '"said" he', 3)]


def test_scratch_needs_a_shared_folder_off_one_machine():
    from ledgerlake.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
