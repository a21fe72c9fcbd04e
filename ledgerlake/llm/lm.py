"""Language-model scores by deleted interpolation.

P(w | v) = a(b) c(v w) / c(v) + u(b) c(w) / N + z(b) / (V + 1), with weights a, u, z for
each bucket b of the context's frequency c(v).  Counts are exact and taken over all
training documents.  The weights come from expectation-maximisation on held-out
counts: one fold of the training documents is deleted from the counts, and its
tokens are what the mixture of the remaining counts has to predict.

Texts become chunks of about ``CHUNK`` tokens: a chunk is one row that holds its
distinct words (64-bit hashes) and its token sequence as indices of them.  For
counting, a chunk sends each of its distinct words and word pairs once, with a
count, to the slice of the hash range that owns it, packed as sorted deltas; a
slice adds up what all chunks sent and answers each chunk with the totals, in the
order asked.  A frequent word is thus one entry a chunk, slices hold about
``SLICE`` entries whatever the input, and no table of counts passes through the
driver or a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import textblocks as tb
from ledgerlake.llm.scratch import Scratch

CHUNK = 1_000_000
SLICE = 1_000_000
ROUNDS = 200
#: Context frequencies 0, 1, 2-3, 4-7, ..
BUCKETS = 28
#: Steps an octave in which likelihood ratios are counted for the expectation step.
FINE = 8

_END = tb.mix(np.array([0xE4D0F7E81], dtype=np.uint64))[0]


def _packed(x: np.ndarray, width: int) -> bytes:
    """Unsigned integers as compressed byte planes."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int, width: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=n * width, codec="zstd", asbytes=True), dtype=np.uint8)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = planes.reshape(width, n).T
    return out.view("<u8").ravel()


def _width(words: int) -> int:
    """Bytes of a token's index: three, or more where one text alone has more distinct words than those tell apart."""
    return max(3, (max(words - 1, 0).bit_length() + 7) // 8)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)), 8)


def _unpacked_keys(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpacked(blob, n, 8))


_CHUNK_SCHEMA = ("chunk long, deleted boolean, doc_ids array<long>, train array<boolean>, sizes array<int>, "
                 "n_words int, words binary, n_tokens int, tokens binary")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    chunk = TaskContext.get().partitionId() << 24
    held: dict[bool, list] = {False: [], True: []}
    size = {False: 0, True: 0}

    def flush(deleted: bool) -> pa.RecordBatch:
        nonlocal chunk
        ids, train, sizes, hashes = (np.concatenate(x) for x in zip(*held[deleted], strict=True))
        words, tokens = np.unique(hashes, return_inverse=True)
        row = [chunk, deleted, ids.tolist(), train.tolist(), sizes.tolist(), len(words), _packed_keys(words), len(tokens), _packed(tokens, _width(len(words)))]
        types = [pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
        names = ["chunk", "deleted", "doc_ids", "train", "sizes", "n_words", "words", "n_tokens", "tokens"]
        chunk += 1
        held[deleted], size[deleted] = [], 0
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

    for batch in batches:
        ids, fold, deleted = (np.asarray(batch.column(i)) for i in (1, 2, 3))
        missing = np.asarray(batch.column(1).is_null())
        ids = np.where(missing, np.iinfo(np.int64).min, np.asarray(batch.column(1).fill_null(0)))
        for lo, hi, buf, off in tb.text_blocks(batch.column(0)):
            buf = tb.LOWER[buf]
            starts, ends, first = tb.word_spans(buf, off)
            hashes = np.insert(tb.span_hashes(buf, starts, ends), first[1:], _END)
            sizes = (np.diff(first) + 1).astype(np.int32)
            row = np.repeat(np.arange(hi - lo), sizes)
            for kind in (False, True):
                rows = deleted[lo:hi] == kind
                if rows.any():
                    held[kind].append((ids[lo:hi][rows], fold[lo:hi][rows], sizes[rows], hashes[rows[row]]))
                    size[kind] += int(sizes[rows].sum())
                    if size[kind] >= CHUNK:
                        yield flush(kind)
    for kind in (False, True):
        if held[kind]:
            yield flush(kind)


class _Chunk:
    """A chunk's words, tokens and word pairs."""

    def __init__(self, row: dict):
        self.sizes = np.asarray(row["sizes"], dtype=np.int64)
        self.train = np.asarray(row["train"], dtype=bool)
        self.words = _unpacked_keys(row["words"], row["n_words"])
        self.tokens = _unpacked(row["tokens"], row["n_tokens"], _width(row["n_words"])).astype(np.int64)
        end = int(np.searchsorted(self.words, _END))
        # a document's first word follows the end of another
        self.contexts = np.r_[end, self.tokens[:-1]]
        keys = tb.mix(self.words[self.contexts] * np.uint64(0x9E3779B97F4A7C15) + tb.mix(self.words[self.tokens] + np.uint64(1)))
        self.pairs, self.pair_of = np.unique(keys, return_inverse=True)
        self.in_train = np.repeat(self.train, self.sizes)


def _slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(slice, first, last + 1) of ascending keys by their first bits."""
    owner = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else [0]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(owner[lo]), int(lo), int(hi)


_ASK_SCHEMA = "kind int, slice int, chunk long, deleted boolean, n int, keys binary, counts binary"


def _asks(bits: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                c, out = _Chunk(row), []
                for kind, keys, of in ((1, c.words, c.tokens), (2, c.pairs, c.pair_of)):
                    counts = np.bincount(of[c.in_train], minlength=len(keys))
                    out += [(kind, s, row["chunk"], row["deleted"], hi - lo, _packed_keys(keys[lo:hi]), _packed(counts[lo:hi], 4))
                            for s, lo, hi in _slices(keys, bits[kind])]
                types = [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=["kind", "slice", "chunk", "deleted", "n", "keys", "counts"])
    return run


_ANSWER_SCHEMA = "chunk long, kind int, slice int, n int, totals binary, deleted_totals binary, tokens long, deleted_tokens long, known long"


def _answer(asked: pa.Table) -> pa.Table:
    """Totals of a slice for all that asked; and, in a row for no chunk, the slice's sums."""
    rows = asked.to_pylist()
    keys = np.concatenate([_unpacked_keys(r["keys"], r["n"]) for r in rows])
    counts = np.concatenate([_unpacked(r["counts"], r["n"], 4) for r in rows]).astype(np.int64)
    gone = np.repeat([r["deleted"] for r in rows], [r["n"] for r in rows])
    distinct, of = np.unique(keys, return_inverse=True)
    total = np.bincount(of, weights=counts, minlength=len(distinct)).astype(np.int64)
    deleted = np.bincount(of[gone], weights=counts[gone], minlength=len(distinct)).astype(np.int64)
    out, at = [], 0
    for r in rows:
        mine = of[at:at + r["n"]]
        at += r["n"]
        out.append((r["chunk"], r["kind"], r["slice"], r["n"], _packed(total[mine], 6),
                    _packed(deleted[mine], 6) if r["deleted"] else None, None, None, None))
    out.append((-1, rows[0]["kind"], rows[0]["slice"], 0, None, None, int(total.sum()), int(deleted.sum()), int((total > 0).sum())))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in _ANSWER_SCHEMA.split(", ")]
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _bucket(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(counts.astype(float))[1], BUCKETS - 1)


def _totals(answers: list[dict], kind: int, column: str) -> np.ndarray:
    mine = sorted((a for a in answers if a["kind"] == kind), key=lambda a: a["slice"])
    return np.concatenate([_unpacked(a[column], a["n"], 6) for a in mine]).astype(np.int64)


_FINE_SCHEMA = "bucket int, pair int, word int, n long"
_NONE = -(1 << 20)


def _steps(ratio: np.ndarray) -> np.ndarray:
    out = np.full(len(ratio), _NONE, dtype=np.int64)
    some = ratio > 0
    out[some] = np.rint(np.log2(ratio[some]) * FINE)
    return out


def _held_out(n_left: int, known: int):
    """Of a deleted chunk's training tokens, how many have each context bucket and likelihood ratios."""
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        c, a = _Chunk(chunk.to_pylist()[0]), answers.to_pylist()
        left = [_totals(a, k, "totals") - _totals(a, k, "deleted_totals") for k in (1, 2)]
        t = c.in_train
        context = left[0][c.contexts[t]]
        uniform = 1.0 / (known + 1)
        pair = np.where(context > 0, left[1][c.pair_of[t]] / np.maximum(context, 1), 0.0) / uniform
        word = left[0][c.tokens[t]] / max(n_left, 1) / uniform
        kinds, n = np.unique(np.stack([_bucket(context), _steps(pair), _steps(word)], axis=1), axis=0, return_counts=True)
        return pa.Table.from_arrays([*(pa.array(kinds[:, i], pa.int32()) for i in range(3)), pa.array(n, pa.int64())],
                                    names=["bucket", "pair", "word", "n"])
    return run


def weights(fine: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """(BUCKETS, 3) weights of pair, word and uniform estimates, by expectation-maximisation over rows (bucket, pair, word, n)."""
    out = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    for b in range(BUCKETS):
        rows = fine[fine[:, 0] == b] if len(fine) else fine
        if not len(rows):
            continue
        p = np.stack([np.where(rows[:, 1] == _NONE, 0.0, 2.0 ** (rows[:, 1] / FINE)),
                      np.where(rows[:, 2] == _NONE, 0.0, 2.0 ** (rows[:, 2] / FINE)), np.ones(len(rows))], axis=1)
        n = rows[:, 3].astype(float)
        w = np.array([0.4, 0.4, 0.2]) if b else np.array([0.0, 0.7, 0.3])
        for _ in range(rounds):
            share = p * w
            share *= (n / share.sum(axis=1))[:, None]
            w = (share.sum(axis=0) + [0, 0.5, 0.5] if not b else share.sum(axis=0) + 0.5)
            w /= w.sum()
        out[b] = w
    # a bucket without held-out tokens takes the weights of the next rarer one that has some
    for b in range(2, BUCKETS):
        if not len(fine) or not (fine[:, 0] == b).any():
            out[b] = out[b - 1]
    return out


_SCORE_SCHEMA = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(n: int, known: int, mix: np.ndarray):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        c, a = _Chunk(row), answers.to_pylist()
        words, pairs = _totals(a, 1, "totals"), _totals(a, 2, "totals")
        count, context = words[c.tokens], words[c.contexts]
        w = mix[_bucket(context)]
        p = w[:, 0] * np.where(context > 0, pairs[c.pair_of] / np.maximum(context, 1), 0.0) + w[:, 1] * count / max(n, 1) + w[:, 2] / (known + 1)
        begin = np.cumsum(c.sizes) - c.sizes
        base = np.add.reduceat(np.log10((count + 1) / (n + known + 1)), begin)
        score = np.add.reduceat(np.log10(p), begin)
        ids = np.asarray(row["doc_ids"], dtype=np.int64)
        return pa.Table.from_arrays(
            [pa.array(ids, mask=ids == np.iinfo(np.int64).min), pa.array(c.train), pa.array(c.sizes),
             pa.array(np.add.reduceat((count > 0).astype(np.int64), begin)), pa.array(base), pa.array(score)],
            names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])
    return run


def interpolated(spark: SparkSession, documents: DataFrame, train: Column, deleted: Column) -> DataFrame:
    """documents (doc_id, text, ..) -> doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    One row for each input row.  Tokens are the words of the text with A-Z lower-cased, and one end.
    ``train`` (over doc_id; null counts as true) names the rows that are
    counted, ``deleted`` those of them whose tokens the mixture weights are learned on.
    base_score adds up log10((c + 1) / (N + V + 1)) over the tokens; score is log10 of
    the text's probability.  A null or empty text is its end alone.
    Repeated rows are counted as often as they stand.  Rows with a null doc_id
    are scored like others.  Without training rows N and V are 0 and scores those of
    the uniform estimate.  Other columns are ignored.
    """
    scratch = Scratch(spark, "lm")
    rows = documents.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")) \
        .withColumn("train", F.coalesce(train, F.lit(True))) \
        .withColumn("deleted", F.coalesce(F.col("train") & deleted, F.lit(False)))
    chunks = scratch.table(rows.mapInArrow(_chunks, _CHUNK_SCHEMA))
    sizes = chunks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    bits = {k: max(0, int(np.ceil(np.log2(max(1, (n or 0) / SLICE))))) for k, n in ((1, sizes["words"]), (2, sizes["tokens"]))}
    asks = chunks.mapInArrow(_asks(bits), _ASK_SCHEMA)
    answers = scratch.table(asks.groupBy("kind", "slice").applyInArrow(_answer, _ANSWER_SCHEMA))
    totals = answers.where("chunk = -1 and kind = 1").agg(
        F.sum("tokens").alias("n"), F.sum("deleted_tokens").alias("gone"), F.sum("known").alias("known")).first()
    n, gone, known = (int(totals[c] or 0) for c in ("n", "gone", "known"))

    def per_chunk(which: DataFrame, run, schema: str) -> DataFrame:
        # a chunk and its answers, of bounded size, meet in one group
        return which.groupBy("chunk").cogroup(answers.where("chunk >= 0").join(which.select("chunk"), "chunk", "left_semi")
                                              .groupBy("chunk")).applyInArrow(run, schema)

    fine = per_chunk(chunks.where("deleted"), _held_out(n - gone, known), _FINE_SCHEMA) \
        .groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n")).collect()  # bounded by buckets and steps, not rows
    mix = weights(np.array([list(r) for r in fine], dtype=np.int64).reshape(-1, 4))
    return per_chunk(chunks, _scores(n, known, mix), _SCORE_SCHEMA).withColumn("train_tokens", F.lit(n).cast("long"))
