"""Vectorised word, line and window tables over Arrow text columns.

Operators that need every word of every text run inside ``mapInArrow`` tasks and
work on the UTF-8 bytes of a whole block of rows at once.  Words are maximal
runs of bytes other than blank and 0x09-0x0D, which on UTF-8 is the same as
``[^\\x20\\x09-\\x0D]+`` on code points.  Blocks hold about ``BLOCK_BYTES`` of
text (one text if it is longer).  Batches come by ``map_batches``, which bounds them
in bytes: Spark's default is 10,000 rows or 64 MB, held by the JVM, its socket buffer and
the Python worker at once, for every task.  So memory follows the longest text, never the
number of rows or the partition.

Hashes are 64-bit: a polynomial over randomised bytes with an odd multiplier,
finished by an avalanche step.  They depend on content only, so they are equal
in every task and in every retry.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

BLOCK_BYTES = 1 << 20
#: Bytes of an Arrow batch (one row if it is longer).
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_PIECE = 1 << 17

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_STEP = 0x9E3779B97F4A7C15 | 1
_WORD_STEP = 0xD1342543DE82EF95 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(step: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """step**i and step**-i modulo 2**64 for i below n at least."""
    have = _POWERS.get(step)
    if have is None or len(have[0]) < n:
        size = max(n, _PIECE + 64)
        both = []
        for s in (step, pow(step, -1, 1 << 64)):
            p = np.full(size, s, dtype=np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = (both[0], both[1])
        if n <= 4 * _PIECE:
            _POWERS[step] = have
    return have


def map_batches(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``rows.mapInArrow(run, schema)`` on batches of BATCH_BYTES or so.

    Spark reads the bound when a result is computed, so it is set for the session and stays; a lower one is kept.
    """
    conf = rows.sparkSession.conf
    size = re.fullmatch(r"(\d+)([kmgt]?)b?", conf.get(_BATCH).strip().lower())
    if not size or int(size[1]) << 10 * " kmgt".index(size[2] or " ") > BATCH_BYTES:
        conf.set(_BATCH, str(BATCH_BYTES))
    return rows.mapInArrow(run, schema)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in them); null texts are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (one more at the end)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    space = SPACE[buf]
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, space[1:]
    full = off[:-1] < off[1:]
    before[off[:-1][full]] = True
    after[off[1:][full] - 1] = True
    word = ~space
    starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; starts and ends ascend."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + _PIECE, "right")))
        hi = int(ends[j - 1])
        p, inverse = _powers(_BYTE_STEP, hi - lo + 1)
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        values = _BYTE_VALUE[buf[lo:hi]]
        values *= p[:hi - lo]
        np.cumsum(values, out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def window_hashes(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of every k consecutive words; index i covers words i to i + k - 1."""
    if len(words) < k:
        return np.zeros(0, dtype=np.uint64)
    words = words if not salt else mix(words + np.uint64(salt))
    if k <= 8:
        out = words[:len(words) - k + 1].copy()
        for d in range(1, k):
            out *= np.uint64(_WORD_STEP)
            out += words[d:len(words) - k + 1 + d]
        return mix(out)
    out = np.empty(len(words) - k + 1, dtype=np.uint64)
    for lo in range(0, len(out), _PIECE):
        hi = min(len(out), lo + _PIECE)
        part = words[lo:hi + k - 1]
        p, inverse = _powers(_WORD_STEP, len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * p[:len(part)], out=sums[1:])
        out[lo:hi] = (sums[k:] - sums[:-k]) * inverse[:hi - lo]
    return mix(out)


def window_rows(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the windows of k words that lie in one row, and that row of each."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    return first[:-1][row] + _within(counts), row


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each of the groups of these sizes."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All indices of the ranges starts[i] .. starts[i] + counts[i] - 1, one range after the other."""
    return np.repeat(starts, counts) + _within(counts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
