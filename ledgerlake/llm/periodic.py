"""Runs: stretches of words that repeat with a period, found by recursive frequency splitting.

Every word of a run with smallest period q and length >= max(12, 2 * q) occurs at least twice in it.
So a word that occurs once within its segment (at first, the text) can't join a run and splits
the segment; the parts are counted again, and so on until nothing splits.  Parts shorter than a run are dropped.
What survives is scanned by lags: lags are taken in octaves, and words at lag q agree over
max(12 - q, q) positions at least, which hold an aligned window of half the octave's first lag.  So the aligned
windows alone are compared, with all lags of the octave at once, and an agreement is extended both ways by
longest common extensions.  Windows of 2, 4, 8, .. words carry exact names (ranks of pairs of
names), so nothing depends on hashes of windows.  A segment of m words costs
O(m log(m)) comparisons whatever it holds, a text of one repeated word included.

Texts are taken whole, in blocks of about 1 MB (or one longer text); tables follow the block's surviving words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import textblocks as tb

#: Least length of a run, in words; twice its period if that is more.
SHORTEST = 12
#: Rounds of splitting after which segments that lose under 1 word in 100 a round go to the scan as they are (the result is the same).
ROUNDS = 40
_CELLS = 1 << 20


def split(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of surviving words, ascending, and the segment of each: no segment holds a word that occurs once in it."""
    done_at, done_segment, named = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    at = np.flatnonzero(np.bincount(row)[row] >= SHORTEST) if len(row) else np.zeros(0, np.int64)
    segment, rounds = row[at].astype(np.int64), 0
    while len(at):
        rounds += 1
        key = words[at] ^ tb.mix(segment.astype(np.uint64) + np.uint64(1))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        often = np.zeros(len(at), dtype=bool)
        often[order] = np.r_[False, same] | np.r_[same, False]
        lost = np.unique(segment[~often])
        slow = rounds > ROUNDS and 100 * int((~often).sum()) < len(at)
        stable = np.ones(len(at), dtype=bool) if slow else ~np.isin(segment, lost)
        if stable.any():
            kept, number = np.unique(segment[stable], return_inverse=True)
            done_at.append(at[stable])
            done_segment.append(number + named)
            named += len(kept)
        go = often & ~stable
        at, segment = at[go], segment[go]
        if len(at):
            segment = np.cumsum(np.r_[True, (np.diff(at) != 1) | (np.diff(segment) != 0)]) - 1
            long = np.bincount(segment)[segment] >= SHORTEST
            at, segment = at[long], segment[long]
    at, segment = np.concatenate(done_at), np.concatenate(done_segment)
    order = np.argsort(at, kind="stable")
    return at[order], segment[order]


def _names(x: np.ndarray, longest: int) -> list[np.ndarray]:
    """names[j][i] is the exact name of the 2**j words from i on; the last level that holds a repeat, or that longest needs, comes last."""
    names, j = [x], 0
    while (1 << (j + 1)) <= min(longest, len(x)):
        last, half = names[-1], 1 << j
        pair = last[:-half].astype(np.int64) * (int(last.max()) + 1) + last[half:]
        distinct, name = np.unique(pair, return_inverse=True)
        names.append(name)
        j += 1
        if len(distinct) == len(pair):
            break
    return names


def _agree(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the windows from a and b on are equal; windows that leave the words aren't."""
    inside = (a >= 0) & (b < len(names))
    return inside & (names[np.where(inside, a, 0)] == names[np.where(inside, b, 0)])


def _extended(names: list[np.ndarray], g: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretch with period q around each position g whose word equals the one q on."""
    ahead, back = np.zeros(len(g), np.int64), np.zeros(len(g), np.int64)
    for j in range(len(names) - 1, -1, -1):
        ahead += _agree(names[j], g + ahead, g + ahead + q).astype(np.int64) << j
        back += _agree(names[j], g - back - (1 << j), g - back - (1 << j) + q).astype(np.int64) << j
    return g - back, g + ahead + q


def _octaves(longest: int) -> Iterator[tuple[int, int, int, int]]:
    """First lag, last lag + 1, level of the windows' names, step of the aligned windows."""
    yield 1, 8, 2, 3  # 6 positions agree at least: a window of 4 in steps of 3
    k = 3
    while 2 << k <= longest:
        yield 1 << k, 2 << k, k - 1, 1 << (k - 1)
        k += 1


def lag_scan(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of all runs in the segments of x; a number that occurs nowhere else follows each segment."""
    longest = int((ends - starts).max())
    names = _names(x, longest)
    found = [np.zeros((3, 0), np.int64)]
    for low, high, level, step in _octaves(longest):
        if level >= len(names):
            break
        name, wide = names[level], 1 << level
        grid = np.maximum((ends - starts - wide - low) // step + 1, 0)
        g = np.repeat(starts, grid) + step * (np.arange(int(grid.sum())) - np.repeat(np.cumsum(grid) - grid, grid))
        of = np.repeat(np.arange(len(starts)), grid)
        often = np.bincount(name)[name[g]] > 1
        g, of = g[often], of[often]
        lag = np.arange(low, high)
        hits = []
        for lo in range(0, len(g), max(1, _CELLS // len(lag))):
            part, own = g[lo:lo + max(1, _CELLS // len(lag))], of[lo:lo + max(1, _CELLS // len(lag))]
            other = part[:, None] + lag[None, :]
            inside = other + wide <= ends[own][:, None]
            i, q = np.nonzero(inside & (name[np.where(inside, other, 0)] == name[part][:, None]))
            hits.append(np.stack([part[i], lag[q], own[i]]))
        if not hits:
            continue
        at, q, own = np.concatenate(hits, axis=1)
        order = np.lexsort((at, q))
        at, q, own = at[order], q[order], own[order]
        # neighbouring windows that agree at one lag lie in one stretch
        head = np.r_[True, (q[1:] != q[:-1]) | (own[1:] != own[:-1]) | (at[1:] - at[:-1] != step)] if len(at) else np.zeros(0, bool)
        at, q = at[head], q[head]
        start, end = _extended(names, at, q)
        run = end - start >= np.maximum(SHORTEST, 2 * q)
        found.append(np.stack([start[run], end[run], q[run]]))
    start, end, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    # a stretch with several periods runs with the smallest
    first = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else np.zeros(0, bool)
    return start[first], end[first], q[first]


def runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of a block, by start and period; words are hashes, first the index of each text's first word."""
    at, segment = split(words, tb.rows_of(first))
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    begin = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    size = np.diff(np.r_[begin, len(at)])
    number = np.unique(words[at], return_inverse=True)[1].astype(np.int64)
    out = [np.zeros((3, 0), np.int64)]
    # segments of like length together, so that short ones don't pay for the levels of a long one
    octave = np.frexp(size.astype(float))[1]
    for o in np.unique(octave):
        own = np.flatnonzero(octave == o)
        take = tb.ranges(begin[own], size[own])
        starts = np.cumsum(size[own] + 1) - size[own] - 1
        x = np.zeros(len(take) + len(own), dtype=np.int64)
        inner = np.ones(len(x), dtype=bool)
        inner[starts + size[own]] = False
        x[inner] = number[take]
        x[~inner] = number.max() + 1 + np.arange(len(own))
        place = np.zeros(len(x), dtype=np.int64)
        place[inner] = at[take]
        s, e, q = lag_scan(x, starts, starts + size[own])
        out.append(np.stack([place[s], place[s] + (e - s), q]))
    start, end, q = np.concatenate(out, axis=1)
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, off in tb.text_blocks(batch.column(0)):
            starts, ends, first = tb.word_spans(buf, off)
            start, end, period = runs(tb.span_hashes(buf, starts, ends), first)
            edge = np.bincount(start + period, minlength=len(starts) + 1) - np.bincount(end, minlength=len(starts) + 1)
            gone = np.cumsum(edge)[:len(starts)] > 0
            dropped = np.diff(np.r_[0, np.cumsum(gone)][first])
            raw, text = buf.tobytes(), []
            for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
                kept = raw[a:b].split()  # at blank and 0x09-0x0D
                if dropped[i]:
                    kept = [kept[k] for k in np.flatnonzero(~gone[first[i]:first[i + 1]]).tolist()]
                text.append(b" ".join(kept))
            row = np.searchsorted(first, start, "right") - 1
            own = pa.StructArray.from_arrays([pa.array(start - first[row]), pa.array(end - start), pa.array(period)], names=["start", "length", "period"])
            bounds = np.searchsorted(row, np.arange(hi - lo + 1))
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(lo, hi - lo) for c in batch.columns[1:]), pa.array(np.diff(first)), pa.array(dropped),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), own), pa.array(text, pa.binary()).cast(pa.string())],
                names=[*batch.schema.names[1:], "n_words", "n_dropped", "runs", "kept_text"])


def find_runs(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text, ..) -> doc_id, n_words, n_dropped, runs (start, length, period; by start, then period), kept_text.

    One row for each input row; starts are word numbers from 0.  kept_text has the words that no run holds beyond its first period, joined by
    one blank.  Null and empty texts have no words, no runs and an empty kept_text.  Null and repeated doc_ids are
    kept as they are: each text is judged alone.  Other columns are ignored.
    """
    rows = documents.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(_run, "doc_id long, n_words long, n_dropped long, runs array<struct<start: long, length: long, period: long>>, kept_text string")
