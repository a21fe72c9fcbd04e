"""CSV writer for staging files (the reverse of ``sources.csv``).

Used to stage the raw zone as the CSV extracts the loads expect: declared
column order, header, RFC-4180 quoting, optional per-column date pattern, and
NULLs rendered with one of the format's NULL tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources.csv import CsvFormat, NAMED_FORMAT

#: A file has at most this many records: gzipped files, and those of ``multi_line`` formats, are read by one task each.
MAX_RECORDS = 500_000
#: Gzipped files of bulk extracts have fewer: a task takes as many files as fit its bytes, and packed ones hold more records a byte.
GZIPPED_RECORDS = 100_000


def rotating_null_token(tokens: tuple[str, ...], *seed_cols: str) -> "callable":
    """NULL -> one of ``tokens``, chosen by a hash of the row and the column,
    so every token occurs in every column."""
    arr = F.array(*[F.lit(t) for t in tokens])

    def token_for(col_name: str) -> Column:
        h = F.pmod(F.xxhash64(*[F.col(c) for c in seed_cols], F.lit(col_name)), F.lit(len(tokens)))
        return F.element_at(arr, (h + 1).cast("int"))
    return token_for


def as_text(df: DataFrame, fmt: CsvFormat = NAMED_FORMAT, null_token=None,
            overrides: dict[str, Column] | None = None) -> DataFrame:
    """Every column rendered as the text a CSV extract would carry."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if overrides and f.name in overrides:
            s = overrides[f.name]
        elif isinstance(f.dataType, T.DateType) and f.name in fmt.date_formats:
            s = F.date_format(c, fmt.date_formats[f.name])
        elif isinstance(f.dataType, T.StringType):
            s = c
        else:
            s = c.cast("string")
        if null_token is not None and not (overrides and f.name in overrides):
            s = F.when(c.isNull(), null_token(f.name)).otherwise(s)
        cols.append(s.alias(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, fmt: CsvFormat = NAMED_FORMAT, mode: str = "overwrite", gzipped: bool = False) -> None:
    """``gzipped``: files are named ``.csv.gz``, about a third of the size."""
    records = min(MAX_RECORDS, GZIPPED_RECORDS) if gzipped else MAX_RECORDS
    (df.write.mode(mode).option("header", fmt.header).option("sep", fmt.sep)
       .option("quote", fmt.quote).option("escape", fmt.escape)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("nullValue", "").option("emptyValue", '""').option("maxRecordsPerFile", records)
       .option("compression", "gzip" if gzipped else "none").csv(path))


def write_lines(lines: DataFrame, header: str, path: str, mode: str = "overwrite") -> None:
    """Write pre-formatted CSV lines (one string column) with a header per file.
    The writer's separator is a control character absent from the lines, so
    nothing is re-quoted."""
    col = lines.columns[0]
    (lines.select(F.col(col).alias(header)).write.mode(mode)
          .option("header", True).option("sep", "\u0001").option("quote", "\u0000")
          .option("escape", "\u0000").option("quoteAll", False).option("escapeQuotes", False)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))


def stage_named(text: DataFrame, folder: str, stem: str, fmt: CsvFormat = NAMED_FORMAT, compression: str = "gzip") -> int:
    """Write an extract as files with stable names, ``<stem>_<part>.csv[.gz]``: an extract staged again
    under its stem overwrites files of the same name, as a nightly export does.  Returns the number of files."""
    spark, aside = text.sparkSession, f"{folder}/.{stem}-{uuid.uuid4().hex}"
    (text.write.option("header", fmt.header).option("sep", fmt.sep).option("quote", fmt.quote).option("escape", fmt.escape)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("nullValue", "").option("emptyValue", '""').option("compression", compression).option("maxRecordsPerFile", MAX_RECORDS).csv(aside))
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(f.getPath().getName() for f in files.listStatus(path(aside)) if f.getPath().getName().startswith("part-"))
    for i, name in enumerate(parts):
        target = path(f"{folder}/{stem}_{i:05d}.csv{'.gz' if compression == 'gzip' else ''}")
        files.delete(target, False)
        files.rename(path(f"{aside}/{name}"), target)
    files.delete(path(aside), True)
    return len(parts)
