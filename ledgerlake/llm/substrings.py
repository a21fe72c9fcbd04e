"""Removal of long passages that repeat across documents, by level-wise doubling.

Windows repeated at one length are extended to twice that length, and only they: a
window can repeat only if both its halves do.  The first level looks at windows of half ``WORDS``, one chosen for each
window of ``WORDS`` (the smallest hash inside it, so equal windows choose alike): those that occur
in one document only end there.  Each further level hashes (128 bits) and groups only windows around what repeated
at the level before, until no candidate survives or the length asked for is reached.

Removal asks for the level of ``WORDS`` words, which decides it: a longer repeat is covered by its
windows of that length.  A window then belongs to the smallest doc_id it starts in;
everywhere else its words go.  ``passages`` lets the doubling run until nothing repeats, and returns the
repeated stretches of every level.

Exact copies are settled before level 1 by a 128-bit digest of the word
sequence: a copy of a smaller doc_id loses all words if it has a whole window,
and adds nothing for others to repeat.  Per level one row a candidate is
shuffled by content; the smallest document of a hot passage is found with
map-side combine, and its occurrences meet it in a join that adaptive execution
may split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import textblocks as tb
from ledgerlake.llm.scratch import Scratch

WORDS = 50

def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _choices(hashes: np.ndarray, first: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each full window inside a row: its first word, its row and the smallest half-length hash in it."""
    at, row = tb.window_rows(first, words)
    if not len(at):
        return at, row, np.zeros(0, np.uint64)
    half = max(1, words // 2)
    least = _least_in(tb.window_hashes(hashes, half), words - half + 1)
    return at, row, least[at]


def _sequence_digest(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of the word sequence of each row."""
    out = []
    for salt in (0x1357, 0x2468ACE):
        words = tb.mix(hashes + np.uint64(salt))
        n = np.diff(first)
        place = (np.arange(len(words)) - np.repeat(first[:-1], n)).astype(np.uint64)
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(tb.mix(words + tb.mix(place + np.uint64(salt))))]
        out.append(tb.mix(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64)))
    return out[0], out[1]


def tag(row: np.ndarray) -> np.ndarray:
    """Tells the hashes of one row from those of another."""
    return tb.mix(row.astype(np.uint64) + np.uint64(1))


def _first_pass(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, buf, off in tb.text_blocks(batch.column(1)):
                starts, ends, first = tb.word_spans(buf, off)
                hashes = tb.span_hashes(buf, starts, ends)
                one, two = _sequence_digest(hashes, first)
                _, row, least = _choices(hashes, first, words)
                new = np.r_[True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])] if len(row) else np.zeros(0, bool)
                seeds = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row[new], np.arange(hi - lo + 1)), pa.int32()), pa.array(tb.signed(least[new])))
                raw = buf.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest()
                       for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(tb.signed(one)), pa.array(tb.signed(two)), pa.array(sha), seeds],
                    names=["doc_id", "same", "n_words", "d1", "d2", "words_sha256", "seeds"])
    return run


def _second_pass(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, variant = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for lo, hi, buf, off in tb.text_blocks(batch.column(2)):
                starts, ends, first = tb.word_spans(buf, off)
                hashes = tb.span_hashes(buf, starts, ends)
                at, row, least = _choices(hashes, first, words)
                seeds = batch.column(3).slice(lo, hi - lo)
                repeated = seeds.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                owner = np.repeat(np.arange(hi - lo), np.asarray(seeds.value_lengths().fill_null(0)))
                keep = np.isin(least ^ tag(row), repeated ^ tag(owner))
                at, row = at[keep], row[keep]
                one = tb.window_hashes(hashes, words)
                # a window that a text holds many times is one row
                once = np.unique(one[at] ^ tag(row), return_index=True)[1] if len(at) else at
                at, row = at[once], row[once]
                two = tb.window_hashes(hashes, words, 0x7F4A7C15)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb.signed(one[at])), pa.array(tb.signed(two[at])), pa.array(ids[lo:hi][row]), pa.array(variant[lo:hi][row])],
                    names=["h1", "h2", "doc_id", "variant"])
    return run


def _longer(length: int):
    """Rows with the hashes of their repeated windows of ``length`` words -> the windows of twice that length whose halves both repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, variant = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for lo, hi, buf, off in tb.text_blocks(batch.column(2)):
                starts, ends, first = tb.word_spans(buf, off)
                hashes = tb.span_hashes(buf, starts, ends)
                begin, _ = _marked(hashes, first, length, batch.column(3).slice(lo, hi - lo))
                again = np.zeros(len(starts) + 1, dtype=bool)
                again[begin] = True
                at, row = tb.window_rows(first, 2 * length)
                keep = again[at] & again[at + length]
                at, row = at[keep], row[keep]
                one, two = tb.window_hashes(hashes, 2 * length), tb.window_hashes(hashes, 2 * length, 0x7F4A7C15)
                once = np.unique(one[at] ^ tag(row), return_index=True)[1] if len(at) else at
                at, row = at[once], row[once]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb.signed(one[at])), pa.array(tb.signed(two[at])), pa.array(ids[lo:hi][row]), pa.array(variant[lo:hi][row])],
                    names=["h1", "h2", "doc_id", "variant"])
    return run


def _marked(hashes: np.ndarray, first: np.ndarray, length: int, marks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """First words and rows of the windows whose hashes are among their row's marks."""
    at, row = tb.window_rows(first, length)
    owner = np.repeat(np.arange(len(marks)), np.asarray(marks.value_lengths().fill_null(0)))
    known = marks.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    keep = np.isin(tb.window_hashes(hashes, length)[at] ^ tag(row), known ^ tag(owner)) if len(at) else np.zeros(0, bool)
    return at[keep], row[keep]


def _stretches(length: int):
    """Rows with the hashes of their repeated windows -> the stretches of words that those cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for lo, hi, buf, off in tb.text_blocks(batch.column(1)):
                starts, ends, first = tb.word_spans(buf, off)
                begin, row = _marked(tb.span_hashes(buf, starts, ends), first, length, batch.column(2).slice(lo, hi - lo))
                # a window that starts beyond the end of the one before opens a stretch
                opens = np.r_[True, (row[1:] != row[:-1]) | (begin[1:] > begin[:-1] + length)] if len(begin) else np.zeros(0, bool)
                closes = np.r_[opens[1:], True] if len(begin) else opens
                own = first[row[opens]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi][row[opens]]), pa.array(np.full(int(opens.sum()), length)), pa.array(begin[opens] - own),
                     pa.array(begin[closes] + length - own)], names=["doc_id", "length", "start", "end"])
    return run


def _cut(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in tb.text_blocks(batch.column(0)):
                starts, ends, first = tb.word_spans(buf, off)
                hashes = tb.span_hashes(buf, starts, ends)
                at, row = tb.window_rows(first, words)
                marks = batch.column(1).slice(lo, hi - lo)
                owner = np.repeat(np.arange(hi - lo), np.asarray(marks.value_lengths().fill_null(0)))
                foreign = marks.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                begin = at[np.isin(tb.window_hashes(hashes, words)[at] ^ tag(row), foreign ^ tag(owner))]
                edge = np.bincount(begin, minlength=len(starts) + 1) - np.bincount(begin + words, minlength=len(starts) + 1)
                gone = np.cumsum(edge)[:-1] > 0
                raw, kept = buf.tobytes(), []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    left = a + np.flatnonzero(~gone[a:b])
                    kept.append(b" ".join([raw[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist(), strict=True)]))
                removed = np.diff(np.r_[0, np.cumsum(gone)][first])
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns[2:]), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=[*batch.schema.names[2:], "n_removed", "kept_text"])
    return run


def _texts(documents: DataFrame, words: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What every text is (one row for each input row), the first doc_id of each text, and the texts with their repeated half windows."""
    every = scratch.table(documents.select("doc_id", "text", "same").mapInArrow(
        _first_pass(words), "doc_id long, same long, n_words long, d1 long, d2 long, words_sha256 string, seeds array<long>"))
    whole = every.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= words))
    first = scratch.table(whole.groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id")))

    # repeated halves of the texts that aren't copies
    halves = whole.join(first, ["doc_id", "d1", "d2"], "left_semi").select("doc_id", F.explode("seeds").alias("seed"))
    repeated = halves.groupBy("seed").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")) \
        .where("least <> most").select("seed")
    found = halves.join(repeated, "seed", "left_semi").groupBy("doc_id").agg(F.collect_set("seed").alias("seeds"))

    texts = documents.where(F.col("doc_id").isNotNull()).join(found, "doc_id")
    if every.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        texts = texts.dropDuplicates(["doc_id", "same"]) \
            .withColumn("variant", F.row_number().over(Window.partitionBy("doc_id").orderBy("same")).cast("long"))
    else:
        texts = texts.withColumn("variant", F.lit(1).cast("long"))
    return every, first, scratch.table(texts.select("doc_id", "variant", "same", "text", "seeds"))


def _levels(texts: DataFrame, words: int, until: int | None, scratch: Scratch) -> Iterator[tuple[int, DataFrame, DataFrame]]:
    """Lengths from ``words`` on, doubling, with the windows that may repeat and those (h1, h2, least: the first doc_id) that do.

    Ends at the length ``until``, or when no candidate survives."""
    length, candidates = words, texts.select("doc_id", "variant", "text", "seeds").mapInArrow(
        _second_pass(words), "h1 long, h2 long, doc_id long, variant long")
    while True:
        repeated = candidates.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")) \
            .where("least <> most").select("h1", "h2", "least")
        yield length, candidates, repeated
        if until is not None and 2 * length > until:
            return
        marks = candidates.join(repeated, ["h1", "h2"], "left_semi").groupBy("doc_id", "variant").agg(F.collect_list("h1").alias("marks"))
        longer = scratch.table(texts.join(marks, ["doc_id", "variant"]).select("doc_id", "variant", "text", "marks")
                               .mapInArrow(_longer(length), "h1 long, h2 long, doc_id long, variant long"))
        if not longer.limit(1).count():
            return
        length, candidates = 2 * length, longer


def remove_repeats(spark: SparkSession, documents: DataFrame, words: int = WORDS) -> DataFrame:
    """documents (doc_id, text, ..) -> doc_id, n_words, n_removed, words_sha256, kept_text.

    One row for each input row.  n_removed counts the words covered by a window
    of ``words`` words whose sequence also starts in a row with a smaller
    doc_id; kept_text has the other words joined by one blank, and is null where
    nothing is removed (the text stays as it is).  words_sha256 is that of all words joined by
    one blank.  Null and empty texts have no words.  Rows that share a doc_id don't
    repeat each other.  A row with a null doc_id is never cut and
    cuts no other.  Other columns are ignored.
    """
    scratch = Scratch(spark, "substrings")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("same", F.xxhash64("text"))
    every, first, texts = _texts(documents, words, scratch)
    # the level of ``words`` words decides
    _, windows, owners = next(_levels(texts, words, words, scratch))
    marks = windows.join(owners, ["h1", "h2"]).where("doc_id > least") \
        .groupBy("doc_id", "variant").agg(F.collect_list("h1").alias("marks"))
    cut = texts.join(marks, ["doc_id", "variant"]).select("text", "marks", "doc_id", "same") \
        .mapInArrow(_cut(words), "doc_id long, same long, n_removed long, kept_text string")
    cut = scratch.table(cut.dropDuplicates(["doc_id", "same"]))

    owner = first.withColumnRenamed("doc_id", "owner")
    out = every.drop("seeds").join(owner, ["d1", "d2"], "left").join(cut, ["doc_id", "same"], "left")
    copy = F.col("doc_id") > F.col("owner")
    return out.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        "words_sha256", F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))


def passages(spark: SparkSession, documents: DataFrame, words: int = WORDS, until: int | None = None) -> DataFrame:
    """documents (doc_id, text, ..) -> doc_id, length, start, end: at each length (``words``, doubled until nothing repeats or ``until`` is
    reached), the stretches of words that are covered by windows of that length which also start in another document.

    Starts are word numbers from 0, ends exclusive.  Exact copies of a text are one document here, its smallest
    doc_id: what only they share is no passage.  Rows that share a doc_id don't repeat each other and are given with its stretches each;
    null doc_ids, null and empty texts and texts shorter than ``words`` have none.  Other columns are ignored.
    """
    scratch = Scratch(spark, "passages")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("same", F.xxhash64("text"))
    _, _, texts = _texts(documents, words, scratch)
    out = spark.createDataFrame([], "doc_id long, length long, start long, end long")
    for length, windows, repeated in _levels(texts, words, until, scratch):
        marks = windows.join(repeated, ["h1", "h2"], "left_semi").groupBy("doc_id", "variant").agg(F.collect_list("h1").alias("marks"))
        out = out.union(scratch.table(texts.join(marks, ["doc_id", "variant"]).select("doc_id", "text", "marks")
                                      .mapInArrow(_stretches(length), "doc_id long, length long, start long, end long")))
    return out
