"""The raw zone: the 13 typed raw tables as DataFrames, plus what is known
about their sizes.

A dimension is broadcast by an explicit hint only when its size was counted:
rows, and the most rows that share a key.  A dimension with its outriggers
joined on is hinted only if its rows times the outriggers' most rows a key stay
under the limit, since repeated outrigger keys multiply it.  Counts come from
the loader's manifest, or from the stand-in itself on first use.  A counted dimension above
that is hinted as the hashed side of a shuffle join if a task's share of it is
small, so the fact is shuffled but never sorted (nor spilled by a sort).  Every other
dimension is left to the planner, which broadcasts below
``spark.sql.autoBroadcastJoinThreshold`` (re-checked by AQE at runtime) and
joins by shuffle above it.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Union

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.plans import profiles
from ledgerlake.sources import standins
from ledgerlake.sinks.commitlog import LoadedTable
from ledgerlake.sources.csv import CUSTOMER_FORMAT, FACT_BULK_FORMAT, NAMED_FORMAT, CsvFormat, gzipped_names
from ledgerlake.sources.loads import copy_into

# A dimension with at most this many rows, and as many bytes at ROW_BYTES a row,
# may be hinted for broadcast: the pruned columns of a view (short texts and
# keys) stay well under 100 MB per executor.
BROADCAST_MAX_ROWS = 500_000
# A shuffle join hashes a dimension if a partition's share has at most this many rows
# and no key more than HASHED_MAX_SAME; the fact's side then needs no sort.
HASHED_MAX_ROWS, HASHED_MAX_SAME = 250_000, 1_000

MANIFEST = "_ledgerlake_manifest.json"
FACTS = ("RAW_FACTSALES", "RAW_FACT_ONLINESALES")

Size = tuple[int, int]                       # rows, most rows of one key
Bound = Union[Size, Callable[[], Size]]


def measure(df: DataFrame, key: str) -> Size:
    """Rows of a table and the most rows that share a key (NULL is one)."""
    r = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    return int(r["rows"] or 0), int(r["most"] or 0)


# The load matrix of the CSV extracts: file name or whole-path pattern, format, on_error.
_FREE_TEXT = CsvFormat(multi_line=True)
LOADS: dict[str, tuple[str, CsvFormat, str]] = {
    "RAW_DIMPRODUCT": ("DimProduct.csv", _FREE_TEXT, "continue"),
    "RAW_DIMCUSTOMER": ("DimCustomer.csv", CUSTOMER_FORMAT, "continue"),
    "RAW_FACTSALES": (".*FactSales_.*.csv", FACT_BULK_FORMAT, "continue"),
    "RAW_FACT_ONLINESALES": (".*FactOnlineSales_.*.csv", FACT_BULK_FORMAT, "continue"),
    "RAW_DIMSTORE": ("DimStore.csv", _FREE_TEXT, "abort"),
    "RAW_DIMGEOGRAPHY": ("DimGeography.csv", NAMED_FORMAT, "abort"),
    "RAW_DIMPRODUCTCATEGORY": ("DimProductCategory.csv", NAMED_FORMAT, "abort"),
    "RAW_DIMPRODUCTSUBCATEGORY": ("DimProductSubcategory.csv", NAMED_FORMAT, "abort"),
    "RAW_DIMCHANNEL": ("DimChannel.csv", NAMED_FORMAT, "abort"),
    "RAW_DIMCURRENCY": ("DimCurrency.csv", NAMED_FORMAT, "abort"),
    "RAW_DIMEMPLOYEE": ("DimEmployee.csv", NAMED_FORMAT, "abort"),
    "RAW_DIMPROMOTION": ("DimPromotion.csv", NAMED_FORMAT, "abort"),
    "RAW_DIMDATE": ("DimDate.csv", NAMED_FORMAT, "abort"),
}
CURRENT = "_current"
LOADS_AT_ONCE = 4
#: Derived zones by session object: a dead session's identity can't be mistaken for a new one's.
_DERIVED: dict[SparkSession, dict[str, "RawZone"]] = {}


@dataclass
class RawZone:
    tables: dict[str, DataFrame]
    row_bounds: dict[str, Bound] = field(default_factory=dict)
    increment: bool = False     # a fact holds few of its rows: its shuffle may cost less than copies of a dimension

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def size(self, name: str) -> Size | None:
        b = self.row_bounds.get(name)
        if callable(b):
            b = self.row_bounds[name] = b()
        return b

    def bounded(self, name: str, *outriggers: str) -> bool:
        """Whether the table, joined to outriggers by their keys, is known to be small."""
        size = self.size(name)
        if size is None or size[0] > BROADCAST_MAX_ROWS:
            return False
        rows = size[0]
        for o in outriggers:
            more = self.size(o)
            if more is None:
                return False
            rows *= max(1, more[1])
        return rows <= BROADCAST_MAX_ROWS

    def joined(self, name: str, *outriggers: str) -> Size | None:
        """At most how many rows, and rows of one key, the table has when joined to outriggers by their keys."""
        sizes = [self.size(t) for t in (name, *outriggers)]
        if None in sizes:
            return None
        (rows, same), more = sizes[0], 1
        for _, most in sizes[1:]:
            more *= max(1, most)
        return rows * more, same * more

    def hashable(self, name: str, *outriggers: str) -> bool:
        """Whether a shuffle partition's share of the table, joined to outriggers by their keys, is known to be small."""
        size = self.joined(name, *outriggers)
        partitions = int(self.tables[name].sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return size is not None and size[1] <= HASHED_MAX_SAME and size[0] <= HASHED_MAX_ROWS * partitions

    def copied(self, name: str, *outriggers: str) -> int | None:
        """At most how many rows the table has so joined, if a whole fact may meet copies of its parts; else None."""
        size = self.joined(name, *outriggers)
        return None if self.increment or size is None or size[1] > HASHED_MAX_SAME else size[0]

    def dim(self, name: str) -> DataFrame:
        """The table, hinted for broadcast iff its size is known to be small."""
        df = self.tables[name]
        return F.broadcast(df) if self.bounded(name) else df

    def hint(self, df: DataFrame, name: str, *outriggers: str) -> DataFrame:
        """Hint a frame of dimension ``name`` with outriggers joined on: broadcast iff that is known to be small,
        else the hashed side of a shuffle join iff a partition's share is."""
        if self.bounded(name, *outriggers):
            return F.broadcast(df)
        return df.hint("shuffle_hash") if self.hashable(name, *outriggers) else df

    # -- construction -----------------------------------------------------
    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "RawZone":
        tables = standins.build_spark(spark, sf_dir)
        sizes = {n: (lambda n=n: measure(tables[n], schemas.TABLE_KEYS[n])) for n in tables if n not in FACTS}
        return cls(tables, sizes)

    @classmethod
    def derived(cls, spark: SparkSession, sf_dir: str) -> "RawZone":
        """``from_driver``, once for each session and folder; a stopped session's frames go with it."""
        for old in [s for s in _DERIVED if s is not spark and s.sparkContext._jsc is None]:
            del _DERIVED[old]
        zones = _DERIVED.setdefault(spark, {})
        folder = sf_dir.rstrip("/")
        if folder not in zones:
            zones[folder] = cls.from_driver(spark, folder)
        return zones[folder]

    @classmethod
    def from_csv(cls, spark: SparkSession, stage: str, target: str, gzipped: bool = False) -> "RawZone":
        """Load the 13 extracts of a folder by ``LOADS`` and open the result.  ``gzipped``: the files that the patterns
        name are packed, with ``.gz`` behind the name (packed files of the other extracts are read anyway).

        All tables go to a new version folder under ``target``, each as a table of committed
        loads with its history and quarantine; only when every
        load has ended well is that folder made the current one.  A load that
        aborts leaves the zone as it was, readable by :meth:`current`.
        """
        version = f"{target.rstrip('/')}/version={uuid.uuid4().hex}"

        def load(name: str) -> None:
            where, fmt, on_error = LOADS[name]
            many = where.startswith(".*")
            pattern = gzipped_names(where) if many and gzipped else where if many else None
            copy_into(LoadedTable(spark, f"{version}/{name}", schemas.RAW_TABLES[name]), stage if many else f"{stage}/{where}", fmt,
                      on_error, pattern=pattern, metrics=lambda good: profiles.observed(name, good))
        # the loads don't depend on each other: the small ones run beside the facts
        with ThreadPoolExecutor(LOADS_AT_ONCE) as pool:
            for done in [pool.submit(inheritable_thread_target(spark)(load), name) for name in sorted(LOADS, key=lambda n: n not in FACTS)]:
                done.result()
        spark.createDataFrame([(version,)], "path string").coalesce(1).write.mode("overwrite").text(f"{target.rstrip('/')}/{CURRENT}")
        return cls.current(spark, target)

    @classmethod
    def current(cls, spark: SparkSession, target: str) -> "RawZone":
        """The zone that :meth:`from_csv` last completed under ``target``, with all loads committed to its tables since."""
        tables = {n: cls.loaded(spark, target, n) for n in schemas.RAW_TABLES}
        frames = {n: t.snapshot() for n, t in tables.items()}
        sizes = {n: (lambda n=n: measure(frames[n], schemas.TABLE_KEYS[n])) for n in frames if n not in FACTS}
        return cls(frames, sizes)

    @staticmethod
    def loaded(spark: SparkSession, target: str, name: str) -> LoadedTable:
        """One table of the current version with its load history: ``copy_into`` it and the next :meth:`current` has the rows."""
        version = spark.read.text(f"{target.rstrip('/')}/{CURRENT}").first()[0]
        return LoadedTable(spark, f"{version}/{name}", schemas.RAW_TABLES[name])

    @classmethod
    def load_report(cls, spark: SparkSession, target: str) -> DataFrame:
        """One row for each loaded file of the 13 tables: what was parsed, loaded and rejected, and the first error."""
        frames = [cls.loaded(spark, target, n).history().select(F.lit(n).alias("table"), "*") for n in schemas.RAW_TABLES]
        return reduce(DataFrame.unionByName, frames)

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str) -> "RawZone":
        """Open a zone written by :meth:`write` (row counts from its manifest)."""
        base = path.rstrip("/")
        tables = {n: spark.read.schema(s).parquet(f"{base}/{n}")
                  for n, s in schemas.RAW_TABLES.items()}
        manifest = json.loads(spark.read.text(f"{base}/{MANIFEST}").first()[0])  # a zone without one is incomplete
        return cls(tables, {k: (int(r), int(m)) for k, (r, m) in manifest["sizes"].items()})

    @staticmethod
    def profile(spark: SparkSession, path: str) -> DataFrame:
        """TABLE_NAME, METRIC, VALUE (text) of a zone written by :meth:`write`, from its manifest alone."""
        kept = spark.read.text(f"{path.rstrip('/')}/{MANIFEST}")
        tables = F.from_json("value", "profile map<string, map<string, string>>")["profile"]
        metrics = kept.select(F.explode(tables).alias("TABLE_NAME", "metrics"))
        return metrics.select("TABLE_NAME", F.explode("metrics").alias("METRIC", "VALUE"))

    def write(self, path: str, facts_partitions: int | None = None) -> dict[str, int]:
        """Full-refresh write of every raw table as Parquet (B1), then a manifest
        of the rows and the profile of all tables, observed during the write, and the
        most rows a key of the dimensions."""
        spark = next(iter(self.tables.values())).sparkSession
        base = path.rstrip("/")
        counts, sizes, profile = {}, {}, {}
        for name, df in self.tables.items():
            out = df
            if facts_partitions and name in ("RAW_FACTSALES", "RAW_FACT_ONLINESALES"):
                out = df.repartition(facts_partitions)
            seen = Observation()
            # counted and profiled as it is written; only the keys of dimensions are read again
            out.observe(seen, *profiles.observed(name)).write.mode("overwrite").parquet(f"{base}/{name}")
            profile[name] = profiles.as_text(seen.get)
            counts[name] = seen.get["total_rows"]
            if name not in FACTS:
                key = schemas.TABLE_KEYS[name]
                keys = spark.read.schema(df.schema).parquet(f"{base}/{name}").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                r = keys.agg(F.max("n").alias("most"), F.count(key).alias("distinct")).first()
                sizes[name] = (counts[name], int(r["most"] or 0))
                profile[name]["distinct_keys"] = str(r["distinct"])
        spark.createDataFrame([(json.dumps({"row_counts": counts, "sizes": sizes, "profile": profile}),)], "j string").coalesce(1) \
            .write.mode("overwrite").text(f"{base}/{MANIFEST}")
        return counts

    # -- catalog tables, facts bucketed by their key ------------------------
    def write_tables(self, database: str, location: str, buckets: int,
                     files_per_bucket: int = 1) -> dict[str, Size]:
        """Full-refresh the raw zone as catalog tables under ``location``.

        Facts are bucketed (and sorted) by their key into ``buckets`` files:
        a later ``ROW_NUMBER() OVER (PARTITION BY key)`` or ``GROUP BY key``
        over a view that joins the fact to broadcast dimensions then needs no
        shuffle of the fact at all.  Dimensions are plain Parquet.

        Size ``buckets * files_per_bucket`` to about fact bytes / 256 MB: the
        fact is repartitioned into that many tasks by the same hash, so each
        task holds exactly one bucket and writes one file of it.

        Every table is first written whole to a folder of this run and registered aside; only when all are there does each
        name move to its new folder (an existing table by its location, so it is never missing).  A run that
        fails leaves the tables as they were.
        """
        spark = next(iter(self.tables.values())).sparkSession
        base, run = location.rstrip("/"), uuid.uuid4().hex
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}'")
        aside = {name: f"{database}.{name}__{run}" for name in self.tables}
        try:
            for name, df in self.tables.items():
                w = df
                if name in FACTS:
                    key = schemas.TABLE_KEYS[name]
                    w = df.repartition(buckets * files_per_bucket, key)
                    writer = w.write.format("parquet").bucketBy(buckets, key).sortBy(key)
                else:
                    writer = w.write.format("parquet")
                writer.option("path", f"{base}/run={run}/{name}").saveAsTable(aside[name])
            sizes = {n: measure(spark.table(aside[n]), schemas.TABLE_KEYS[n]) for n in self.tables if n not in FACTS}
            for name in self.tables:
                own = f"{database}.{name}"
                if spark.catalog.tableExists(own) and self._same_layout(spark, own, aside[name]):
                    spark.sql(f"ALTER TABLE {own} SET LOCATION '{base}/run={run}/{name}'")
                    spark.catalog.refreshTable(own)
                else:
                    spark.sql(f"DROP TABLE IF EXISTS {own}")
                    spark.sql(f"ALTER TABLE {aside[name]} RENAME TO {own}")
        finally:
            for name in aside.values():
                spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files belong to the folder, not to this entry
        return sizes

    @staticmethod
    def _same_layout(spark: SparkSession, one: str, other: str) -> bool:
        """Whether two tables agree in columns and buckets, so that one may take the other's folder."""
        def layout(table: str) -> list:
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
            kept = ("Num Buckets", "Bucket Columns", "Sort Columns")
            return [r["data_type"] for k in kept for r in rows if r["col_name"] == k]
        return spark.table(one).schema == spark.table(other).schema and layout(one) == layout(other)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str,
                     sizes: dict[str, Size] | None = None) -> "RawZone":
        tables = {n: spark.table(f"{database}.{n}") for n in schemas.RAW_TABLES}
        return cls(tables, dict(sizes or {}))
