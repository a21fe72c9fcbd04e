"""Incremental load: new files only, rejects quarantined, re-runs idempotent."""

import os

from ledgerlake import schemas
from ledgerlake.session import local_path
from ledgerlake.sources import csv as ingest
from ledgerlake.streaming.incremental import read_loaded, run_incremental_load

HEADER = ",".join(f.name for f in schemas.RAW_FACTSALES.fields)


def _drop(folder, name, lines):
    p = local_path(folder)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "w") as fh:
        fh.write(HEADER + "\n" + "\n".join(lines) + "\n")


def _row(key, qty="3"):
    return f"{key},2000-01-01 00:00:00,1,1,1,1,NULL,1.00,2.50,{qty},,,,,,"


def test_incremental_runs(spark, tmp_stage):
    landing, target, ckpt, rej = (f"{tmp_stage}/{x}" for x in ("landing", "t", "ck", "rej"))
    kw = dict(fmt=ingest.FACT_BULK_FORMAT, pattern=".*FactSales_.*.csv", quarantine=rej)
    _drop(landing, "FactSales_20240101.csv", [_row(1), _row(2), _row(3, "x")])
    run_incremental_load(spark, landing, schemas.RAW_FACTSALES, target, ckpt, **kw)
    assert read_loaded(spark, target, schemas.RAW_FACTSALES).count() == 2
    _drop(landing, "FactSales_20240102.csv", [_row(4)])
    _drop(landing, "FactOnlineSales_20240102.csv", [_row(99)])      # other pattern
    run_incremental_load(spark, landing, schemas.RAW_FACTSALES, target, ckpt, **kw)
    run_incremental_load(spark, landing, schemas.RAW_FACTSALES, target, ckpt, **kw)
    loaded = read_loaded(spark, target, schemas.RAW_FACTSALES)
    assert sorted(r["SalesKey"] for r in loaded.collect()) == [1, 2, 4]
    assert spark.read.parquet(rej).count() == 1


def test_new_checkpoint_adds_to_the_table(spark, tmp_stage):
    landing, target = f"{tmp_stage}/landing", f"{tmp_stage}/t"
    kw = dict(fmt=ingest.FACT_BULK_FORMAT, pattern=".*FactSales_.*.csv", glob="*FactSales_*")
    _drop(landing, "FactSales_1.csv", [_row(1), _row(2)])
    run_incremental_load(spark, landing, schemas.RAW_FACTSALES, target, f"{tmp_stage}/c1", **kw)
    os.remove(f"{local_path(landing)}/FactSales_1.csv")
    _drop(landing, "FactSales_2.csv", [_row(3)])
    run_incremental_load(spark, landing, schemas.RAW_FACTSALES, target, f"{tmp_stage}/c2", **kw)
    assert sorted(r["SalesKey"] for r in read_loaded(spark, target, schemas.RAW_FACTSALES).collect()) == [1, 2, 3]
