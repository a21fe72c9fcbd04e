"""Rule statistics of whole texts, one row of counts per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import textblocks as tb

#: Counts of a text, all long.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_chars", "n_lines", "n_upper", "n_digits", "n_marks"]
WINDOW = 5


def _bytes_in(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOLS = _bytes_in(b"#*$%&|<>")
_MARKS = _bytes_in(b"!?.,;:")
_UPPER = _bytes_in(bytes(range(65, 91)))
_DIGITS = _bytes_in(bytes(range(48, 58)))
_CONTINUED = np.zeros(256, dtype=bool)
_CONTINUED[0x80:0xC0] = True


def _repeats(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of entries that occur again in their row, and of those that aren't the first."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = hashes ^ tb.mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    again = np.r_[False, same]
    return order[again | np.r_[same, False]], order[again]


def counts(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """COUNTS of each row of a block."""
    rows = len(off) - 1
    per_row = lambda mask: np.diff(np.searchsorted(np.flatnonzero(mask[buf]), off))
    starts, ends, first = tb.word_spans(buf, off)
    words = np.diff(first)
    chars = np.diff(off) - per_row(_CONTINUED)

    breaks = np.flatnonzero(buf == 10)
    line_start = np.sort(np.r_[off[:-1], breaks + 1], kind="stable")
    line_end = np.sort(np.r_[breaks, off[1:]], kind="stable")
    full = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[full], line_end[full]
    line_row = np.searchsorted(off, line_start, "right") - 1
    _, later = _repeats(line_row, tb.span_hashes(buf, line_start, line_end))
    dup_lines = np.bincount(line_row[later], minlength=rows)

    at, row = tb.window_rows(first, WINDOW)
    hashes = tb.window_hashes(tb.span_hashes(buf, starts, ends), WINDOW)
    both, _ = _repeats(row, hashes[at] if len(at) else hashes)
    edge = np.bincount(at[both], minlength=len(starts) + 1)
    edge[WINDOW:] -= edge[:-WINDOW].copy()
    covered = np.r_[0, np.cumsum(np.cumsum(edge) > 0)]
    repeated = np.diff(covered[first])

    lines = np.diff(np.searchsorted(breaks, off)) + 1
    return [words, chars - per_row(tb.SPACE), per_row(_SYMBOLS), dup_lines, repeated,
            chars, lines, per_row(_UPPER), per_row(_DIGITS), per_row(_MARKS)]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = batch.schema.names[1:]
        for lo, hi, buf, off in tb.text_blocks(batch.column(0)):
            found = [pa.array(c.astype(np.int64)) for c in counts(buf, off)]
            yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[1:]), *found], names=[*rest, *COUNTS])


def with_counts(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns in keep and COUNTS of each row's text; null texts count as empty."""
    kept = rows.select(*keep)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    return tb.map_batches(rows.select(F.col("text").cast("string").alias("text"), *keep),
                          _run, fields + "".join(f", {c} long" for c in COUNTS))


def features() -> dict[str, Column]:
    """Rates of COUNTS, between rows of different length comparable."""
    over = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "log_words": F.log1p(F.col("n_words")),
        "word_length": over("word_chars", "n_words"),
        "symbol_rate": over("n_symbols", "n_words"),
        "dup_line_rate": over("n_dup_lines", "n_lines"),
        "repeat_rate": over("n_repeat_words", "n_words"),
        "line_words": over("n_words", "n_lines"),
        "upper_rate": over("n_upper", "word_chars"),
        "digit_rate": over("n_digits", "word_chars"),
        "mark_rate": over("n_marks", "n_words"),
    }
