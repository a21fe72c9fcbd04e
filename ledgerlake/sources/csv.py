"""Typed, fault-tolerant CSV ingest (A1-A8).

A load reads every field as text (plus Spark's corrupt-record column), applies
the NULL tokens, converts each column to its declared type with ``try_cast`` /
``try_to_date``, and flags a row *bad* when

* a non-NULL text fails its conversion (bad number, date off its pattern,
  decimal overflow),
* a text exceeds its declared VARCHAR length, or
* (strict presets only) the row has too few or too many fields.

* (formats that read line by line) a quote is left open: the row is a torn
  piece of one whose quoted text holds a line break.  That is judged on the raw
  record by the format's quoting rules: a quote opens at a field's start only, and
  within quotes an escaped one is text.  Formats with
  ``multi_line`` read such rows whole; their files aren't split over tasks, so
  it is meant for dimensions with free text, not for fact extracts.

``on_error="continue"`` keeps the good rows and returns the bad ones as a
quarantine frame; ``"abort"`` fails the job on the first bad row.  Line-by-line formats
read whole records and split each once with ``from_csv``, so the raw record is
at hand for every row.  The bad-row
predicate reads the corrupt-record column, so every reader switches column pruning
of the CSV parser off for itself (a parser that tokenizes only the projected
fields does not see a field-count mismatch); session settings don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
RECORD = "_record"                           # the raw record, of line-by-line formats
FILE = "_source_file"
REASON = "_reject_reason"
BLOCK = "_file_block"                        # where the record's split of the file starts
PLACE = "_place"                             # ascending within a split
# No extract holds this: records are read as one field.
_NO_SEPARATOR = "\u0001\u0002\u0001"


@dataclass(frozen=True)
class CsvFormat:
    """Reader options of one file format (the reference's named and inline formats)."""
    sep: str = ","
    quote: str = '"'
    escape: str = '"'
    header: bool = True
    null_tokens: tuple[str, ...] = ("NULL", "null", "")
    ragged: bool = False                     # tolerate column-count mismatch
    date_formats: dict[str, str] = field(default_factory=dict)
    encoding: str = "UTF-8"
    multi_line: bool = False                 # quoted text may hold line breaks

    def with_dates(self, **fmts: str) -> "CsvFormat":
        return replace(self, date_formats={**self.date_formats, **fmts})


# Presets mirroring the reference's loads.
NAMED_FORMAT = CsvFormat()                               # shared named file format
FACT_BULK_FORMAT = CsvFormat(ragged=True)                # fact loads: mismatch tolerated
CUSTOMER_FORMAT = CsvFormat(ragged=True, date_formats={"BirthDate": "dd/MM/yyyy"})
# The scheduled load spells only type, quoting and header: default NULL token
# and a column-count mismatch is an error.
SCHEDULED_STRICT_FORMAT = CsvFormat(null_tokens=("\\N", ""), ragged=False)


@dataclass
class LoadResult:
    good: DataFrame          # typed rows, declared schema
    rejected: DataFrame      # raw text of bad rows + reason + source file


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields]
                        + [T.StructField(CORRUPT, T.StringType(), True)])


def _split_once(lines: DataFrame, schema: T.StructType, fmt: CsvFormat) -> DataFrame:
    """Records split into the declared columns and the corrupt-record column.  A generator keeps
    the optimizer from repeating the split for every column."""
    fields = ", ".join(f"`{f.name}` string" for f in _text_schema(schema).fields)
    options = {"sep": fmt.sep, "quote": fmt.quote, "escape": fmt.escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rest = [c for c in lines.columns if c != RECORD]
    return lines.select(F.inline(F.array(F.from_csv(F.col(RECORD), fields, options))), RECORD, *rest)


def read_text(spark: SparkSession, path: str | list[str], schema: T.StructType,
              fmt: CsvFormat = NAMED_FORMAT, pattern: str | None = None,
              glob: str | None = None, streaming: bool = False,
              max_bytes_per_trigger: int | None = None, places: bool = False) -> DataFrame:
    """All-text frame of the declared columns, the corrupt-record column, the raw record (NULL in
    ``multi_line`` formats) and
    the source file.  ``pattern`` is a regular expression that must match the
    whole file path (the reference's ``PATTERN``); ``glob`` optionally prunes
    the listing by file name first; ``places`` adds where in its file a record stands."""
    reader = spark.readStream if streaming else spark.read
    # a pruned parse would silently accept short and long rows
    reader = (reader.option("header", fmt.header).option("mode", "PERMISSIVE").option("encoding", fmt.encoding)
              .option("multiLine", fmt.multi_line).option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if fmt.multi_line:
        reader = reader.schema(_text_schema(schema)).option("sep", fmt.sep).option("quote", fmt.quote).option("escape", fmt.escape)
    else:
        reader = reader.schema(f"{RECORD} string, {CORRUPT} string").option("sep", _NO_SEPARATOR).option("quote", "")
    if streaming and max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if pattern or glob:
        reader = reader.option("recursiveFileLookup", True)
    df = reader.csv(path)
    df = df.withColumn(FILE, F.col("_metadata.file_path"))
    if places:
        df = df.withColumn(BLOCK, F.col("_metadata.file_block_start"))
        if not streaming:  # a stream's batches get theirs when they are written
            df = df.withColumn(PLACE, F.monotonically_increasing_id())
    if pattern:
        df = df.where(F.col(FILE).rlike(f"^(?:{pattern})$"))
    if fmt.multi_line:
        return df.withColumn(RECORD, F.lit(None).cast("string"))
    return _split_once(df.withColumn(RECORD, F.coalesce(CORRUPT, RECORD)).drop(CORRUPT), schema, fmt)


def gzipped_names(pattern: str) -> str:
    """The pattern of the same files packed: ``.gz`` behind the name, by which the reader knows them."""
    return rf"(?:{pattern})\.gz"


def quote_left_open(record: Column, fmt: CsvFormat) -> Column:
    """Whether a quote opens at a field's start of the record and is not closed in it."""
    plain = lambda c: f"\\{c}" if not c.isalnum() else c
    q, e, sep = plain(fmt.quote), plain(fmt.escape), f"\\Q{fmt.sep}\\E"
    inner = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+" if fmt.escape == fmt.quote else f"[^{q}{e}]*+(?:{e}.[^{q}{e}]*+)*+"
    rest = F.regexp_replace(record, f"(^|{sep}){q}{inner}{q}", "$1")
    return F.when(record.contains(fmt.quote), rest.rlike(f"(?:^|{sep}){q}")).otherwise(F.lit(False))


def _nullify(c: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c) if tokens else c


def _convert(text: Column, f: T.StructField, fmt: CsvFormat) -> Column:
    if isinstance(f.dataType, T.StringType):
        return text
    if isinstance(f.dataType, T.DateType) and f.name in fmt.date_formats:
        return F.try_to_date(text, fmt.date_formats[f.name])
    return text.try_cast(f.dataType)


def reject_reason(schema: T.StructType, fmt: CsvFormat, converted: dict[str, Column] | None = None) -> Column:
    """First failing rule of a raw row as text; NULL when the row is good.  ``converted``: where the columns stand
    already as :func:`typed_columns` makes them, by name.

    The rules are filtered as an array: as one nested condition of all columns they make a generated method
    too long for the JIT compiler, which then interprets its bytecode for every row."""
    reasons = []
    for f in schema.fields:
        t = _nullify(F.col(f.name), fmt.null_tokens)
        if not isinstance(f.dataType, T.StringType):
            value = converted[f.name] if converted else _convert(t, f, fmt)
            # few values are NULL, so few texts are compared with the tokens
            reasons.append(F.when(value.isNull() & t.isNotNull(),
                                  F.lit(f"{f.name}: cannot convert to {f.dataType.simpleString()}")))
        max_len = f.metadata.get("max_length")
        if max_len:
            reasons.append(F.when(F.length(t) > max_len, F.lit(f"{f.name}: longer than {max_len}")))
    if not fmt.multi_line:
        reasons.append(F.when(quote_left_open(F.col(RECORD), fmt), F.lit("quote left open")))
    if not fmt.ragged:
        reasons.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("column count mismatch")))
    reasons.append(F.lit(None).cast("string"))
    return F.get(F.filter(F.array(*reasons), lambda r: r.isNotNull()), F.lit(0))


def typed_columns(schema: T.StructType, fmt: CsvFormat) -> list[Column]:
    return [_convert(_nullify(F.col(f.name), fmt.null_tokens), f, fmt).alias(f.name)
            for f in schema.fields]


def apply_schema(raw: DataFrame, schema: T.StructType, fmt: CsvFormat,
                 on_error: str = "continue") -> LoadResult:
    """Split a raw text frame into typed good rows and a quarantine."""
    flagged = raw.withColumn(REASON, reject_reason(schema, fmt))
    if on_error == "continue":
        good = flagged.where(F.col(REASON).isNull())
    elif on_error == "abort":
        guard = F.when(F.col(REASON).isNotNull(),
                       F.raise_error(F.concat(F.lit("load aborted: "), F.col(REASON),
                                              F.lit(" in "), F.col(FILE)))
                       ).otherwise(F.lit(True))
        good = flagged.where(guard)
    else:
        raise ValueError(f"on_error must be 'continue' or 'abort', not {on_error!r}")
    rejected = flagged.where(F.col(REASON).isNotNull()).select(
        *[f.name for f in schema.fields], CORRUPT, REASON, FILE)
    return LoadResult(good.select(*typed_columns(schema, fmt)), rejected)


def load_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             fmt: CsvFormat = NAMED_FORMAT, on_error: str = "continue",
             pattern: str | None = None, glob: str | None = None) -> LoadResult:
    """``COPY INTO <table> FROM <path> [PATTERN] FILE_FORMAT ON_ERROR``."""
    raw = read_text(spark, path, schema, fmt, pattern=pattern, glob=glob)
    return apply_schema(raw, schema, fmt, on_error)


def raw_preview(spark: SparkSession, path: str, aliases: list[str],
                fmt: CsvFormat = NAMED_FORMAT, n: int = 10, ordered: bool = False) -> DataFrame:
    """The first fields of a staged file by position, as text, header skipped, no schema applied.

    Any ``n`` rows, so the read stops early; ``ordered`` takes the first by all
    shown fields instead, which reads the whole file but gives the same rows each time."""
    df = (spark.read.option("header", fmt.header).option("sep", fmt.sep)
          .option("quote", fmt.quote).option("escape", fmt.escape)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))
    first = df.columns[:len(aliases)]
    out = df.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(first, aliases)])
    return (out.orderBy(*[F.col(a).asc_nulls_last() for a in aliases]) if ordered else out).limit(n)
