"""Registered queries of loads with a history: ledgers, increments that reach the views, reports.

Like ``ingest_queries``, each stages extracts derived from the driver data in a fresh folder under the shared
checkpoint folder, runs the operator under test, and has the typed stand-in or view as its oracle.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import oracle, schemas
from ledgerlake.operators.keybitmaps import KeyBitmaps
from ledgerlake.operators.merge import MergedView
from ledgerlake.plans import ingest_queries as staging
from ledgerlake.plans import views
from ledgerlake.session import scratch_path, shuffles_removed
from ledgerlake.sinks.commitlog import LoadedTable
from ledgerlake.sinks.csv import as_text, stage_named, write_csv
from ledgerlake.sinks.parquet import publish, republish
from ledgerlake.sources import csv as ingest
from ledgerlake.sources.footers import footer_counts
from ledgerlake.sources.loads import CODEC, FIELDS, copy_into
from ledgerlake.sources.zone import RawZone
from ledgerlake.streaming.incremental import read_loaded, run_incremental_load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Years that cut the facts into drops; the rest of the rows (NULL dates too) come last.
FIRST, SECOND = 1998, 2000


def drops(fact: DataFrame) -> list[DataFrame]:
    """Three increments of a fact by the year of its date."""
    year = F.year("DateKey")
    late = F.coalesce(year >= SECOND, F.lit(True))
    return [fact.where(year < FIRST), fact.where((year >= FIRST) & (year < SECOND)), fact.where(late)]


def with_fact(z: RawZone, name: str, fact: DataFrame) -> RawZone:
    """The zone with other rows in one fact."""
    return RawZone({**z.tables, name: fact}, z.row_bounds, increment=True)


# A1, A3, T1 -- a load history: the scheduled extract keeps its name, so only what changed is read again
def csv_reload_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, fmt = scratch_path(spark, "reload"), ingest.SCHEDULED_STRICT_FORMAT
    first, second, third = drops(staging._zone(spark, sf_dir)["RAW_FACTSALES"])
    table = LoadedTable(spark, f"{base}/table", schemas.RAW_FACTSALES)
    copy = lambda: copy_into(table, f"{base}/landing", fmt, pattern=".*FactSales.*.csv.gz")
    for rows, stem in ((first, "FactSales"), (second, "FactSalesToday")):
        stage_named(as_text(rows, fmt), f"{base}/landing", stem, fmt)
    copy()
    copy()  # everything is in the history: adds nothing
    stage_named(as_text(third, fmt), f"{base}/landing", "FactSalesToday", fmt)  # overwritten under its name
    copy()
    copy()
    return table.snapshot()


def csv_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger itself after a load, a repeated load and an overwritten file: records by commit."""
    base, fmt = scratch_path(spark, "history"), ingest.FACT_BULK_FORMAT
    first, second, third = drops(staging._zone(spark, sf_dir)["RAW_FACTSALES"])
    table = LoadedTable(spark, f"{base}/table", schemas.RAW_FACTSALES)
    for rows, stem in ((first, "FactSales_1"), (second, "FactSales_2"), (None, ""), (third, "FactSales_2")):
        if rows is not None:
            stage_named(as_text(rows, fmt), f"{base}/landing", stem, fmt, compression="none")
        copy_into(table, f"{base}/landing", fmt, pattern=staging.FACTSALES_PATTERN)
    return table.history().groupBy(F.col("commit").alias("load")).agg(
        F.sum("parsed").alias("parsed"), F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected"))


# B1, B3, T1 -- bulk load and two increments, read together by the views; a torn increment is invisible
def _increments(spark: SparkSession, sf_dir: str, name: str, stem: str) -> RawZone:
    base, z = scratch_path(spark, "increments"), staging._zone(spark, sf_dir)
    fmt = ingest.FACT_BULK_FORMAT
    bulk, *later = drops(z[name])
    staging.stage_extracts(with_fact(z, name, bulk), f"{base}/stage", gzipped=True)
    RawZone.from_csv(spark, f"{base}/stage", f"{base}/zone", gzipped=True)
    table = RawZone.loaded(spark, f"{base}/zone", name)
    for k, rows in enumerate(later):
        with shuffles_removed(spark):
            write_csv(as_text(rows, fmt), f"{base}/stage/{stem}_day{k}", fmt, gzipped=True)
            # rows of a load that broke off before its commit
            rows.write.option("compression", CODEC).parquet(f"{table.new_folder()}/verdict=good")
        # the stage still holds the bulk files: the history skips them
        copy_into(table, f"{base}/stage", fmt, pattern=ingest.gzipped_names(f".*{stem}_.*.csv"))
    return RawZone.current(spark, f"{base}/zone")


def rpt_sales_master_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.rpt_sales_master(_increments(spark, sf_dir, "RAW_FACTSALES", "FactSales"))


def rpt_online_master_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.rpt_online_master(_increments(spark, sf_dir, "RAW_FACT_ONLINESALES", "FactOnlineSales"))


# V11, V12 -- the clean views kept by merging increments, keys delivered again among them
def _merged(spark: SparkSession, sf_dir: str, name: str, view: Callable[[RawZone], DataFrame], key: str) -> DataFrame:
    z = staging._zone(spark, sf_dir)
    first, second, third = drops(z[name])
    again = first.where(F.year("DateKey") == FIRST - 1)
    schema = view(z).schema
    kept = MergedView(spark, scratch_path(spark, "merged"), schema, key, width=1 << 16)
    for k, rows in enumerate((first, second.unionByName(again), third, third)):
        kept.merge(view(with_fact(z, name, rows)), key=f"day {min(k, 2)}")  # the last one again under its name
    return kept.read()


def clean_sales_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "RAW_FACTSALES", views.master_sales, "SalesKey")


def clean_online_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "RAW_FACT_ONLINESALES", views.master_online, "OnlineSalesKey")


# E3, Q8, Q23 -- key uniqueness of the grown views, from bitmaps that increments extend
def _uniqueness(spark: SparkSession, sf_dir: str, name: str, view: Callable[[RawZone], DataFrame], key: str) -> DataFrame:
    z = staging._zone(spark, sf_dir)
    first, second, third = drops(z[name])
    again = first.where(F.year("DateKey") == FIRST - 1)
    bitmaps, out = KeyBitmaps(spark, scratch_path(spark, "bitmaps")), []
    for k, rows in enumerate((first, second.unionByName(again), third)):
        seen = bitmaps.add(view(with_fact(z, name, rows)), key, f"day {k}")
        out.append((k, seen["rows"], seen["distinct"], seen["repeated"], seen["nulls"]))
    return spark.createDataFrame(out, "after_drop int, total_rows long, distinct_keys long, duplicate_count long, null_keys long")


def key_bitmaps_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _uniqueness(spark, sf_dir, "RAW_FACTSALES", views.master_sales, "SalesKey")


def key_bitmaps_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _uniqueness(spark, sf_dir, "RAW_FACT_ONLINESALES", views.master_online, "OnlineSalesKey")


# A5 -- what each load parsed, loaded and rejected; the quarantine that it keeps
def _bad_prices() -> Column:
    price = F.col("UnitPrice")
    return F.when(price < 0, F.concat(F.lit("("), F.format_number(-price, 2), F.lit(")"))).otherwise(price.cast("string"))


def _defective_zone(spark: SparkSession, sf_dir: str) -> str:
    base, z = scratch_path(spark, "report"), staging._zone(spark, sf_dir)
    staging.stage_extracts(z, f"{base}/stage", {"RAW_DIMPRODUCT": {"UnitPrice": _bad_prices()}})
    RawZone.from_csv(spark, f"{base}/stage", f"{base}/zone")
    return f"{base}/zone"


def csv_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = RawZone.load_report(spark, _defective_zone(spark, sf_dir))
    return files.groupBy(F.col("table").alias("TABLE_NAME")).agg(
        F.sum("parsed").alias("parsed"), F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected"),
        F.min("first_reason").alias("first_reason"), F.count(F.when((F.col("rejected") > 0) != F.col("first_record").isNotNull(), 1)).alias("unplaced_errors"))


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = RawZone.loaded(spark, _defective_zone(spark, sf_dir), "RAW_DIMPRODUCT").quarantine()
    at = {f.name: i for i, f in enumerate(schemas.RAW_DIMPRODUCT.fields)}
    return kept.select(F.col(FIELDS)[at["ProductKey"]].alias("ProductKey"), F.col(FIELDS)[at["UnitPrice"]].alias("UnitPrice"),
                       F.col(ingest.REASON).alias("reject_reason"))


# T1 -- the stream of the scheduled load as the source spells it: gzipped, strict format
def incremental_strict_gz(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, fmt = scratch_path(spark, "strict"), ingest.SCHEDULED_STRICT_FORMAT
    for k, rows in enumerate(drops(staging._zone(spark, sf_dir)["RAW_FACTSALES"])):
        stage_named(as_text(rows, fmt), f"{base}/landing", f"FactSales_{k}", fmt)
        run_incremental_load(spark, f"{base}/landing", schemas.RAW_FACTSALES, f"{base}/table", f"{base}/checkpoint", fmt, glob="*.csv.gz")
    return read_loaded(spark, f"{base}/table", schemas.RAW_FACTSALES)


# A1, A7 -- quotes as text: at a field's start, inside one, and in long rows
def _quoted(name: Column) -> Column:
    k = F.col("ProductKey") % 4
    return F.when(k == 0, F.concat(F.lit('"'), name)).when(k == 1, F.concat(name, F.lit(' 5" pipe'))).when(k == 2, F.concat(F.lit('a "b", '), name)).otherwise(name)


def _load_quoted(spark: SparkSession, sf_dir: str, fmt: ingest.CsvFormat, extra: bool) -> DataFrame:
    base, schema = scratch_path(spark, "quoted"), schemas.RAW_DIMPRODUCT
    rows = as_text(staging._zone(spark, sf_dir)["RAW_DIMPRODUCT"], fmt, overrides={"ProductName": _quoted(F.col("ProductName"))})
    if extra:
        # unquoted text with an inch mark, and a field too many
        fields = [F.concat(F.coalesce(F.regexp_replace(f.name, '[,"]', ""), F.lit("")), F.lit(' 5" pipe' if f.name == "ProductName" else "")) for f in schema.fields]
        staging.write_lines(rows.select(F.concat_ws(",", *fields, F.lit("extra")).alias("line")), ",".join(schema.names), f"{base}/DimProduct.csv")
    else:
        write_csv(rows, f"{base}/DimProduct.csv", fmt)
    return ingest.load_csv(spark, f"{base}/DimProduct.csv", schema, fmt).good.select("ProductKey", "ProductName", "BrandName")


def csv_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_quoted(spark, sf_dir, ingest.NAMED_FORMAT, False)


def csv_quoted_text_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_quoted(spark, sf_dir, ingest.FACT_BULK_FORMAT, True)


# Q19 -- row counts of the loaded zone from file footers, Q1-Q13 -- the profile observed while it was written
def _written_zone(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "zone")
    staging._zone(spark, sf_dir).write(path)
    return path


def table_inventory_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_zone(spark, sf_dir)
    return footer_counts(spark, {n: [f"{path}/{n}"] for n in schemas.RAW_TABLES}, schemas.RAW_TABLES)


def load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RawZone.profile(spark, _written_zone(spark, sf_dir))


# B4 -- the published table after increments: only the years they touch are written again
def publish_rpt_sales_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    z, path = staging._zone(spark, sf_dir), scratch_path(spark, "years")
    first, second, third = drops(z["RAW_FACTSALES"])
    so_far = first
    publish(views.rpt_sales_master(with_fact(z, "RAW_FACTSALES", so_far)), path)
    for rows in (second, third):
        so_far = so_far.unionByName(rows)
        republish(views.rpt_sales_master(with_fact(z, "RAW_FACTSALES", so_far)), views.rpt_sales_master(with_fact(z, "RAW_FACTSALES", rows)), path)
    view = views.rpt_sales_master(z)
    return spark.read.schema(view.schema).parquet(path).select(*view.columns)


# A8 -- the first records of each dimension extract by position; stops after the first rows of the file
PREVIEWS = {"store": ("RAW_DIMSTORE", 4), "geography": ("RAW_DIMGEOGRAPHY", 6), "category": ("RAW_DIMPRODUCTCATEGORY", 2),
            "subcategory": ("RAW_DIMPRODUCTSUBCATEGORY", 3), "channel": ("RAW_DIMCHANNEL", 3), "currency": ("RAW_DIMCURRENCY", 3),
            "employee": ("RAW_DIMEMPLOYEE", 21), "promotion": ("RAW_DIMPROMOTION", 5), "date": ("RAW_DIMDATE", 20)}


def _preview(table: str, n: int) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, fmt = f"{scratch_path(spark, 'preview')}/extract.csv", ingest.NAMED_FORMAT
        names = schemas.RAW_TABLES[table].names
        rows = staging._zone(spark, sf_dir)[table]
        # an extract in the order of its key; dimensions are small
        write_csv(as_text(rows.orderBy(*[F.asc_nulls_last(c) for c in [schemas.TABLE_KEYS[table], *names]]), fmt).coalesce(1), path, fmt)
        return ingest.raw_preview(spark, path, names[:n])
    return run


def register(name: str, fn: Callable[[SparkSession, str], DataFrame], sql: str) -> None:
    QUERIES[name] = fn
    ORACLE[name] = oracle.with_prelude(sql)


register("csv_reload_history", csv_reload_history, "SELECT * FROM RAW_FACTSALES")
_DROP = f"CASE WHEN year(DateKey) < {FIRST} THEN 0 WHEN year(DateKey) < {SECOND} THEN 1 ELSE 2 END"
register("csv_load_history", csv_load_history, f"""
SELECT part::BIGINT AS load, sum(n)::BIGINT AS parsed, sum(n)::BIGINT AS loaded, 0::BIGINT AS rejected
FROM (SELECT {_DROP} AS part, count(*) AS n FROM RAW_FACTSALES GROUP BY ALL) GROUP BY ALL""")
register("rpt_sales_master_increments", rpt_sales_master_increments, "SELECT * FROM VIEW_RPT_SALES_MASTER")
register("rpt_online_master_increments", rpt_online_master_increments, "SELECT * FROM VIEW_RPT_ONLINESALES_MASTER")
register("clean_sales_merged", clean_sales_merged, "SELECT * FROM VIEW_CLEAN_SALES_DATA")
register("clean_online_merged", clean_online_merged, "SELECT * FROM VIEW_CLEAN_ONLINESALES_DATA")
for _short, _view, _key in (("sales", "VIEW_MASTER_SALES", "SalesKey"), ("online", "VIEW_MASTER_ONLINESALES", "OnlineSalesKey")):
    register(f"key_bitmaps_{_short}", {"sales": key_bitmaps_sales, "online": key_bitmaps_online}[_short], f"""
, delivered AS (SELECT {_key} AS k, {_DROP} AS d FROM {_view} UNION ALL SELECT {_key}, 1 FROM {_view} WHERE year(DateKey) = {FIRST - 1}),
per_key AS (SELECT n::INTEGER AS after_drop, k, count(*) AS m FROM delivered JOIN range(3) AS r(n) ON d <= n GROUP BY ALL)
SELECT after_drop, sum(m)::BIGINT AS total_rows, count(k) AS distinct_keys, count_if(m > 1)::BIGINT AS duplicate_count,
       coalesce(sum(m) FILTER (k IS NULL), 0)::BIGINT AS null_keys
FROM per_key GROUP BY after_drop""")
_BAD = "count_if(UnitPrice < 0)"
register("csv_load_report", csv_load_report, "\nUNION ALL\n".join(
    f"SELECT '{t}' AS TABLE_NAME, count(*)::BIGINT AS parsed, (count(*) - {bad})::BIGINT AS loaded, ({bad})::BIGINT AS rejected, "
    f"if({bad} > 0, 'UnitPrice: cannot convert to double', NULL) AS first_reason, 0::BIGINT AS unplaced_errors FROM {t}"
    for t, bad in ((t, _BAD if t == "RAW_DIMPRODUCT" else "0") for t in schemas.RAW_TABLES)))
register("csv_quarantine", csv_quarantine, """
SELECT ProductKey::VARCHAR AS ProductKey, '(' || format('{:,.2f}', -UnitPrice) || ')' AS UnitPrice,
       'UnitPrice: cannot convert to double' AS reject_reason
FROM RAW_DIMPRODUCT WHERE UnitPrice < 0""")
register("incremental_strict_gz", incremental_strict_gz, "SELECT * FROM RAW_FACTSALES")
register("csv_quoted_text", csv_quoted_text, """
SELECT ProductKey, BrandName,
       CASE ProductKey % 4 WHEN 0 THEN '"' || ProductName WHEN 1 THEN ProductName || ' 5" pipe'
                           WHEN 2 THEN 'a "b", ' || ProductName ELSE ProductName END AS ProductName
FROM RAW_DIMPRODUCT""")
register("csv_quoted_text_tolerant", csv_quoted_text_tolerant, """
SELECT ProductKey, BrandName,
       coalesce(regexp_replace(CASE ProductKey % 4 WHEN 0 THEN '"' || ProductName WHEN 1 THEN ProductName || ' 5" pipe'
                           WHEN 2 THEN 'a "b", ' || ProductName ELSE ProductName END, '[,"]', '', 'g'), '') || ' 5" pipe' AS ProductName
FROM RAW_DIMPRODUCT""")
register("table_inventory_footers", table_inventory_footers, "\nUNION ALL\n".join(
    f"SELECT '{t}' AS TABLE_NAME, count(*) AS ROW_COUNT FROM {t}" for t in sorted(schemas.RAW_TABLES)))

_PROFILE = {
    "RAW_DIMPRODUCT": {"First_Sale_Date": "min(AvailableForSaleDate)", "Last_Sale_Date": "max(AvailableForSaleDate)",
                       "Null_Names": "count(*) - count(ProductName)", "Invalid_Prices": "count_if(least(coalesce(UnitPrice, 0), coalesce(UnitCost, 0)) < 0)"},
    "RAW_DIMCUSTOMER": {"oldest_customer_birth": "min(BirthDate)", "youngest_customer_birth": "max(BirthDate)",
                        "null_CustomerKey": "count_if(CustomerKey IS NULL)", "null_GeographyKey": "count_if(GeographyKey IS NULL)",
                        "null_YearlyIncome": "count_if(YearlyIncome IS NULL)", "min_income": "min(YearlyIncome)", "max_income": "max(YearlyIncome)"},
    "RAW_DIMPRODUCTCATEGORY": {"null_key_rows": "count_if(ProductCategoryKey IS NULL)",
                               "blank_name_rows": "count_if(coalesce(trim(ProductCategoryName), '') = '')"},
    "RAW_DIMPRODUCTSUBCATEGORY": {"null_subcat_key_rows": "count_if(ProductSubcategoryKey IS NULL)",
                                  "null_cat_key_rows": "count_if(ProductCategoryKey IS NULL)",
                                  "blank_name_rows": "count_if(coalesce(trim(ProductSubcategoryName), '') = '')"},
    "RAW_DIMPROMOTION": {"null_key_rows": "count_if(PromotionKey IS NULL)", "blank_name_rows": "count_if(coalesce(trim(PromotionName), '') = '')"},
    "RAW_DIMDATE": {"null_datekey": "count_if(DateKey IS NULL)", "null_calendaryear": "count_if(CalendarYear IS NULL)"},
}
register("load_profile", load_profile, "\nUNION ALL\n".join(
    f"SELECT '{t}' AS TABLE_NAME, '{m}' AS METRIC, ({e})::VARCHAR AS VALUE FROM {t}"
    for t in schemas.RAW_TABLES
    for m, e in {"total_rows": "count(*)", **_PROFILE.get(t, {}),
                 **({"distinct_keys": f"count(DISTINCT {schemas.TABLE_KEYS[t]})"} if t.startswith("RAW_DIM") else {})}.items()))
register("publish_rpt_sales_years", publish_rpt_sales_years, "SELECT * FROM VIEW_RPT_SALES_MASTER")
for _short, (_table, _n) in PREVIEWS.items():
    _names = schemas.RAW_TABLES[_table].names
    _key = schemas.TABLE_KEYS[_table]
    register(f"csv_preview_{_short}", _preview(_table, _n),
             f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _names[:_n])} FROM {_table} "
             f"ORDER BY {', '.join(f'{_table}.{c} NULLS LAST' for c in [_key, *_names])} LIMIT 10")
