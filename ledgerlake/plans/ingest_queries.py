"""Registered ingest and streaming queries (A1-A8, T1).

Each query stages raw tables derived from the driver data as CSV extracts in
a fresh folder under the shared checkpoint folder (``spark.checkpoint.dir``),
then loads them back through the ingest operator under test.  Its oracle is the
typed stand-in itself (minus the rows a defect rule makes unloadable), so a
lossy or over-tolerant load shows up as a mismatch.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import oracle, schemas
from ledgerlake.session import scratch_path, shuffles_removed
from ledgerlake.sinks.csv import as_text, rotating_null_token, write_csv, write_lines
from ledgerlake.sources import csv as ingest
from ledgerlake.plans import views
from ledgerlake.sinks.parquet import publish
from ledgerlake.sources.zone import LOADS, RawZone
from ledgerlake.streaming.incremental import read_loaded, run_incremental_load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The reference's fact file pattern (an unescaped dot, matched on the whole path).
FACTSALES_PATTERN = ".*FactSales_.*.csv"


def _zone(spark: SparkSession, sf_dir: str) -> RawZone:
    return RawZone.derived(spark, sf_dir)


def _stage_table(z: RawZone, table: str, path: str, fmt: ingest.CsvFormat,
                 overrides: dict | None = None, gzipped: bool = False) -> None:
    key = schemas.TABLE_KEYS[table]
    token = rotating_null_token(fmt.null_tokens, key) if fmt.null_tokens else None
    write_csv(as_text(z[table], fmt, token, overrides), path, fmt, gzipped=gzipped)


def _register(name: str, fn, sql: str | None) -> None:
    QUERIES[name] = fn
    if sql is not None:
        ORACLE[name] = sql


# A1 -- single-file typed load (named format, abort on error)
def csv_load_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_path(spark, "stage")
    _stage_table(_zone(spark, sf_dir), "RAW_DIMSTORE", f"{stage}/DimStore.csv", ingest.NAMED_FORMAT)
    return ingest.load_csv(spark, f"{stage}/DimStore.csv", schemas.RAW_DIMSTORE,
                           ingest.NAMED_FORMAT, on_error="abort").good


# A2 -- declared date pattern DD/MM/YYYY (customer file)
def csv_load_date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_path(spark, "stage")
    fmt = ingest.CUSTOMER_FORMAT
    _stage_table(_zone(spark, sf_dir), "RAW_DIMCUSTOMER", f"{stage}/DimCustomer.csv", fmt)
    return ingest.load_csv(spark, f"{stage}/DimCustomer.csv", schemas.RAW_DIMCUSTOMER, fmt,
                           on_error="continue").good


# A3 -- many files selected by a path regex; online files in the same stage
def csv_load_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = _zone(spark, sf_dir)
    stage = scratch_path(spark, "stage")
    fmt = ingest.FACT_BULK_FORMAT
    fs = z["RAW_FACTSALES"]
    # Two store-sales extracts (split by channel) and one online extract.
    _stage_fact(fs.where(F.col("channelKey") <= 2), f"{stage}/FactSales_1", fmt)
    _stage_fact(fs.where(~(F.col("channelKey") <= 2) | F.col("channelKey").isNull()),
                f"{stage}/FactSales_2", fmt)
    _stage_fact(z["RAW_FACT_ONLINESALES"], f"{stage}/FactOnlineSales_1", fmt)
    return ingest.load_csv(spark, stage, schemas.RAW_FACTSALES, fmt, on_error="continue",
                           pattern=FACTSALES_PATTERN).good


def _stage_fact(df: DataFrame, path: str, fmt: ingest.CsvFormat, gzipped: bool = False) -> None:
    write_csv(as_text(df, fmt), path, fmt, gzipped=gzipped)


# A4 -- every NULL token ('NULL', 'null', empty) in every column
def csv_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_path(spark, "stage")
    _stage_table(_zone(spark, sf_dir), "RAW_DIMPRODUCT", f"{stage}/DimProduct.csv",
                 ingest.NAMED_FORMAT)
    return ingest.load_csv(spark, f"{stage}/DimProduct.csv", schemas.RAW_DIMPRODUCT,
                           ingest.NAMED_FORMAT, on_error="continue").good


# A5 -- skip bad rows, keep good ones.  Defect: the extract writes negative
# prices in accounting notation "(1.00)", which does not convert to a number.
def _stage_product_with_bad_prices(spark: SparkSession, sf_dir: str) -> str:
    stage = scratch_path(spark, "stage")
    price = F.col("UnitPrice")
    bad_price = F.when(price < 0, F.concat(F.lit("("), F.format_number(-price, 2), F.lit(")"))) \
                 .otherwise(price.cast("string"))
    _stage_table(_zone(spark, sf_dir), "RAW_DIMPRODUCT", f"{stage}/DimProduct.csv",
                 ingest.NAMED_FORMAT, overrides={"UnitPrice": bad_price})
    return f"{stage}/DimProduct.csv"


def csv_on_error_continue(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stage_product_with_bad_prices(spark, sf_dir)
    return ingest.load_csv(spark, path, schemas.RAW_DIMPRODUCT, ingest.NAMED_FORMAT,
                           on_error="continue").good


def csv_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine of the same load: raw key text and the failing rule."""
    path = _stage_product_with_bad_prices(spark, sf_dir)
    rej = ingest.load_csv(spark, path, schemas.RAW_DIMPRODUCT, ingest.NAMED_FORMAT,
                          on_error="continue").rejected
    return rej.select("ProductKey", "UnitPrice", F.col(ingest.REASON).alias("reject_reason"))


# A6 -- abort on the first bad row (clean file loads completely)
def csv_on_error_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_path(spark, "stage")
    _stage_table(_zone(spark, sf_dir), "RAW_DIMGEOGRAPHY", f"{stage}/DimGeography.csv",
                 ingest.NAMED_FORMAT)
    return ingest.load_csv(spark, f"{stage}/DimGeography.csv", schemas.RAW_DIMGEOGRAPHY,
                           ingest.NAMED_FORMAT, on_error="abort").good


# A7 -- ragged rows: short rows (trailing empty fields cut) and long rows
# (an extra field) load under the tolerant fact format.
def _stage_ragged(spark: SparkSession, sf_dir: str) -> str:
    z = _zone(spark, sf_dir)
    stage = scratch_path(spark, "stage")
    fmt = ingest.FACT_BULK_FORMAT
    fs = z["RAW_FACTSALES"]
    names = fs.columns
    # Columns after SalesQuantity (returns, discounts, source totals) are NULL
    # for return flag N, which is channel 2, so a short row simply omits them.
    keep = names[:names.index("SalesQuantity") + 1]
    t = as_text(fs, fmt)
    fields = [F.coalesce(F.col(c), F.lit("")) for c in names]
    full = F.concat_ws(",", *fields)
    short = F.concat_ws(",", *fields[:len(keep)])
    line = (F.when(F.col("channelKey") == "2", short)
             .when(F.col("channelKey") == "3", F.concat(full, F.lit(",extra")))
             .otherwise(full))
    write_lines(t.select(line.alias("line")), ",".join(names), f"{stage}/FactSales_ragged")
    return f"{stage}/FactSales_ragged"


def csv_ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.load_csv(spark, _stage_ragged(spark, sf_dir), schemas.RAW_FACTSALES, ingest.FACT_BULK_FORMAT,
                           on_error="continue").good


# A8 -- positional preview of a staged file
DATE_PREVIEW = ["DateKey", "CalendarYear", "CalendarYearLabel"]


def csv_raw_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_path(spark, "stage")
    _stage_table(_zone(spark, sf_dir), "RAW_DIMDATE", f"{stage}/DimDate.csv", ingest.NAMED_FORMAT)
    return ingest.raw_preview(spark, f"{stage}/DimDate.csv", DATE_PREVIEW, n=10, ordered=True)


# A1 -- quoted text with line breaks, in a format that reads rows whole
def csv_quoted_newline(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_path(spark, "stage")
    fmt = LOADS["RAW_DIMPRODUCT"][1]
    _stage_table(_zone(spark, sf_dir), "RAW_DIMPRODUCT", f"{stage}/DimProduct.csv", fmt,
                 overrides={"ProductName": F.concat(F.col("ProductName"), F.lit("\nsecond line, \"quoted\""))})
    return ingest.load_csv(spark, f"{stage}/DimProduct.csv", schemas.RAW_DIMPRODUCT, fmt).good


# A7 -- a strict format drops short and long rows, however few columns are read
def csv_strict_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stage_ragged(spark, sf_dir)
    return ingest.load_csv(spark, path, schemas.RAW_FACTSALES, ingest.SCHEDULED_STRICT_FORMAT).good.select("SalesKey", "channelKey")


def stage_extracts(z: RawZone, stage: str, overrides: dict[str, dict] | None = None, gzipped: bool = False) -> None:
    """All 13 tables as the CSV extracts that ``LOADS`` expects; ``overrides``: other text for columns of dimensions;
    ``gzipped``: packed, as a stage does to files it receives."""
    with shuffles_removed(next(iter(z.tables.values())).sparkSession):
        for table, (where, fmt, _) in LOADS.items():
            if where.startswith(".*"):
                _stage_fact(z[table], f"{stage}/{where.strip('.*').split('_')[0]}_1", fmt, gzipped)
            else:
                _stage_table(z, table, f"{stage}/{where}", fmt, (overrides or {}).get(table), gzipped)


# A1-A7, B1 -- 13 extracts to a raw zone to the reporting view
def rpt_sales_master_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "extracts")
    stage_extracts(_zone(spark, sf_dir), f"{base}/stage", gzipped=True)
    return views.rpt_sales_master(RawZone.from_csv(spark, f"{base}/stage", f"{base}/zone", gzipped=True))


# B4 -- the published table, read back
def publish_rpt_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "published")
    view = views.rpt_sales_master(_zone(spark, sf_dir))
    publish(view, path)
    return spark.read.schema(view.schema).parquet(path).select(*view.columns)


# T1 -- incremental load: two daily drops, one run after each
def incremental_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = _zone(spark, sf_dir)
    base = scratch_path(spark, "incremental")
    landing, target, ckpt = f"{base}/landing", f"{base}/table", f"{base}/checkpoint"
    fmt = ingest.FACT_BULK_FORMAT
    fs = z["RAW_FACTSALES"]
    year = F.year(F.col("DateKey"))
    cutoff = 1996
    first, second = fs.where(year < cutoff), fs.where((year >= cutoff) | F.col("DateKey").isNull())
    _stage_fact(first, f"{landing}/FactSales_day1", fmt)
    run_incremental_load(spark, landing, schemas.RAW_FACTSALES, target, ckpt, fmt,
                         pattern=FACTSALES_PATTERN, quarantine=f"{base}/rejected")
    _stage_fact(second, f"{landing}/FactSales_day2", fmt)
    run_incremental_load(spark, landing, schemas.RAW_FACTSALES, target, ckpt, fmt,
                         pattern=FACTSALES_PATTERN, quarantine=f"{base}/rejected")
    # A third run finds nothing new and must not add rows.
    run_incremental_load(spark, landing, schemas.RAW_FACTSALES, target, ckpt, fmt,
                         pattern=FACTSALES_PATTERN, quarantine=f"{base}/rejected")
    return read_loaded(spark, target, schemas.RAW_FACTSALES)


_register("csv_load_typed", csv_load_typed, oracle.with_prelude("SELECT * FROM RAW_DIMSTORE"))
_register("csv_load_date_format", csv_load_date_format,
          oracle.with_prelude("SELECT * FROM RAW_DIMCUSTOMER"))
_register("csv_load_pattern", csv_load_pattern, oracle.with_prelude("SELECT * FROM RAW_FACTSALES"))
_register("csv_null_tokens", csv_null_tokens, oracle.with_prelude("SELECT * FROM RAW_DIMPRODUCT"))
_register("csv_on_error_continue", csv_on_error_continue,
          oracle.with_prelude("SELECT * FROM RAW_DIMPRODUCT WHERE NOT (UnitPrice < 0)"))
_register("csv_rejected_rows", csv_rejected_rows, oracle.with_prelude("""
SELECT CAST(ProductKey AS VARCHAR) AS ProductKey,
       '(' || format('{:,.2f}', -UnitPrice) || ')' AS UnitPrice,
       'UnitPrice: cannot convert to double' AS reject_reason
FROM RAW_DIMPRODUCT WHERE UnitPrice < 0"""))
_register("csv_on_error_abort", csv_on_error_abort,
          oracle.with_prelude("SELECT * FROM RAW_DIMGEOGRAPHY"))
_register("csv_ragged_rows", csv_ragged_rows, oracle.with_prelude("SELECT * FROM RAW_FACTSALES"))
_register("csv_raw_preview", csv_raw_preview, oracle.with_prelude("""
SELECT CAST(DateKey AS VARCHAR) AS DateKey, CAST(CalendarYear AS VARCHAR) AS CalendarYear,
       CalendarYearLabel
FROM RAW_DIMDATE ORDER BY 1, 2, 3 LIMIT 10"""))
_register("incremental_file_load", incremental_file_load,
          oracle.with_prelude("SELECT * FROM RAW_FACTSALES"))

_register("csv_quoted_newline", csv_quoted_newline, oracle.with_prelude(
    "SELECT * REPLACE (ProductName || chr(10) || 'second line, \"quoted\"' AS ProductName) FROM RAW_DIMPRODUCT"))
_register("csv_strict_projection", csv_strict_projection, oracle.with_prelude(
    "SELECT SalesKey, channelKey FROM RAW_FACTSALES WHERE coalesce(channelKey, 0) NOT IN (2, 3)"))
_register("rpt_sales_master_from_csv", rpt_sales_master_from_csv, oracle.with_prelude("SELECT * FROM VIEW_RPT_SALES_MASTER"))
_register("publish_rpt_sales", publish_rpt_sales, oracle.with_prelude("SELECT * FROM VIEW_RPT_SALES_MASTER"))
