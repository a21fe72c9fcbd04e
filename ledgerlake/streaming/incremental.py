"""Incremental file load (T1): the reference's scheduled daily COPY as a stream.

A Structured Streaming file source lists the landing folder and picks up only
files it has not seen (remembered by path in the checkpoint).  Each micro-batch
goes through the same text -> typed rules as the bulk load and is parsed once: good rows
and rejects are written in one job, and the batch becomes visible by one entry of the table's commit log.
``trigger(availableNow=True)`` drains whatever has landed and stops, so an
external scheduler (the reference's cron) simply re-runs it.

Fault tolerance: an entry carries the checkpoint's query id and the batch number. A batch
replayed after a lost executor or driver finds its entry and adds nothing; one that was torn has none, so
nothing of it was visible; and a new checkpoint on the same table adds to what earlier ones loaded.
The file source remembers *paths*: a file overwritten under the same name is
not read again here.  ``sources.loads.copy_into`` is the load that compares sizes and
times, for extracts that keep their name (``FactSales.csv.gz``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sinks.commitlog import LoadedTable
from ledgerlake.sources.csv import FACT_BULK_FORMAT, FILE, PLACE, REASON, CsvFormat, read_text
from ledgerlake.sources.loads import file_report, write_flagged


def run_incremental_load(spark: SparkSession, landing: str, schema: T.StructType,
                         target: str, checkpoint: str, fmt: CsvFormat = FACT_BULK_FORMAT,
                         pattern: str | None = None, quarantine: str | None = None,
                         glob: str | None = None, max_bytes_per_trigger: int = 64 << 30) -> None:
    """Drain newly landed files into the table of committed loads at ``target``, which keeps its rejects; with
    ``quarantine`` they are copied there too.

    ``max_bytes_per_trigger`` bounds a micro-batch, so a large backlog is
    drained in several batches rather than one; ``glob`` keeps foreign files of the
    landing folder out of the listing."""
    raw = read_text(spark, landing, schema, fmt, pattern=pattern, glob=glob, streaming=True,
                    max_bytes_per_trigger=max_bytes_per_trigger, places=True)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        load = session.read.json(f"{checkpoint}/metadata").first()["id"]
        table = LoadedTable(session, target, schema)
        key = f"{load}/{batch_id}"
        if table.has(key):
            return
        folder = table.new_folder()
        write_flagged(batch.withColumn(PLACE, F.monotonically_increasing_id()), schema, fmt, folder)
        files = [{**r.asDict(), "size": None, "modified": None} for r in file_report(session, folder).collect()]  # a row a file
        if quarantine and any(f["rejected"] for f in files):
            session.read.parquet(f"{folder}/verdict=bad").select("_fields", REASON, FILE) \
                .write.mode("overwrite").parquet(f"{quarantine}/load={load}/batch={batch_id}")
        table.commit(folder, [{**f, "path": f"{key}:{f['path']}"} for f in files], key)

    (raw.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination())


def read_loaded(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The loaded table (all committed batches), in its declared schema; no rows before the first."""
    return LoadedTable(spark, target, schema).snapshot()
