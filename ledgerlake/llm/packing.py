"""Packing documents into token sequences by cutting-stock column generation.

A document's ids are cut into full pieces of ``SIZE`` ids, each a sequence of its own,
and one rest.  Rests are stock items.  Only the histogram of rest lengths, in
classes of ``GRAIN`` ids, reaches the driver.  A linear program over patterns
(how many rests of each class share a sequence) is solved by column generation:
a knapsack dynamic program over the dual prices finds the pattern to add, until none
improves.  The solution is rounded down; what is left over is packed largest
first.  Every pattern then owns a range of ranks of each of its classes, and the
documents, ranked within their class, find their sequence by a join on rank
ranges.  Ranks come from counts per (class, shard) and a window within a shard,
so no class passes through one task.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import textblocks as tb
from ledgerlake.llm.scratch import Scratch

SIZE = 1024
GRAIN = 8
END_ID = 0
#: Distinct tokenised units kept by a worker before it starts anew.
CACHE = 1_500_000
#: Ranks within a class are counted in shards of about so many rests.
SHARD_ROWS = 200_000

# White space outside ASCII (and the rarer controls) can join a unit with the next; such texts,
# and texts that may hold a special token, are tokenised whole.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " ", " ", " ", " ", " ", "　",
        *map(chr, range(0x2000, 0x200B)))


def _joins_well(unit: bytes) -> bool:
    """One blank, then no white space at either end: such units are cut apart again whatever stands next to them."""
    text = unit.decode()
    return len(text) > 1 and text[0] == " " and not text[1].isspace() and not text[-1].isspace()


class Units:
    """Ids of texts from the ids of their units.

    A unit is a word with the white space before it (or the white space at the end).
    The tokenizer splits a text at such places before it merges bytes, so a text's ids are its
    units' ids one after the other.  Each distinct unit is tokenised once, and
    is known by a 64-bit hash afterwards; the table starts anew beyond ``CACHE`` units.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # one character stands for one byte
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.start = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, units: list[bytes]) -> None:
        """Tokenise new units in one string a few thousand at a time; ids end where their units' bytes end."""
        counts, ids = [], []
        good = [_joins_well(u) for u in units]
        plain = [i for i, g in enumerate(good) if g]
        other = [i for i, g in enumerate(good) if not g]
        for lo in range(0, len(plain), 2000):
            part = plain[lo:lo + 2000]
            got = self.encode([b"".join(units[i] for i in part).decode()])[0]
            ends = np.cumsum(self.bytes_of[got])
            cut = np.searchsorted(ends, np.cumsum([len(units[i]) for i in part])) + 1
            counts.append(np.diff(np.r_[0, cut]))
            ids.append(got)
        if other:
            got = self.encode([units[i].decode() for i in other])
            counts.append(np.array([len(g) for g in got], dtype=np.int64))
            ids += got
        order = np.array(plain + other, dtype=np.int64)
        count = np.concatenate(counts)
        start = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, *ids])
        keys, at = np.r_[self.keys, keys[order]], np.argsort(np.r_[self.keys, keys[order]], kind="stable")
        self.keys, self.start, self.count = keys[at], np.r_[self.start, start][at], np.r_[self.count, count][at]

    def block(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a block and the place where each row's ids begin (one more at the end)."""
        rows = len(off) - 1
        _, end, _ = tb.word_spans(buf, off)
        # white space before a word belongs to it; what follows the last word is a unit too
        u_end = np.sort(np.r_[end, off[1:]], kind="stable")
        u_start = np.r_[0, u_end[:-1]] if len(u_end) else u_end
        full = u_end > u_start
        u_start, u_end = u_start[full], u_end[full]
        row_first = np.searchsorted(u_start, off)
        hashes = tb.span_hashes(buf, u_start, u_end)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            if len(self.keys) + len(new) > CACHE:
                self.clear()
                new = np.arange(len(distinct))
            raw = buf.tobytes()
            self._learn(distinct[new], [raw[s:e] for s, e in zip(u_start[at[new]].tolist(), u_end[at[new]].tolist(), strict=True)])
            place = np.searchsorted(self.keys, distinct)
        count, start = self.count[place][inverse], self.start[place][inverse]
        ids = self.ids[tb.ranges(start, count)]
        return ids, np.r_[0, np.cumsum(count)][row_first] if rows else np.zeros(1, np.int64)

    def odd(self, text: str) -> bool:
        return any(c in text for c in _ODD) or any(s in text for s in self.special)


def _pieces(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(path)
        tail = np.array([end_id], dtype="<u4")
        for batch in batches:
            for lo, hi, buf, off in tb.text_blocks(batch.column(0)):
                ids, at = units.block(buf, off)
                raw = buf.tobytes()
                row, start, length, crc, whole = [], [], [], [], []
                ascii_only = raw.isascii() and not any(s.encode() in raw for s in units.special) and not any(c in raw for c in (b"\x1c", b"\x1d", b"\x1e", b"\x1f"))
                for k in range(hi - lo):
                    own = ids[at[k]:at[k + 1]]
                    if not ascii_only and units.odd(text := raw[off[k]:off[k + 1]].decode()):
                        own = units.encode([text])[0]
                    own = np.concatenate([own, tail])
                    for s in range(0, len(own), size):
                        row.append(lo + k)
                        start.append(s)
                        length.append(min(size, len(own) - s))
                        crc.append(zlib.crc32(own[s:s + size].astype("<u4", copy=False)))
                        whole.append(len(own))
                take = pa.array(np.array(row, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(take) for c in batch.columns[1:]), *(pa.array(x, pa.int64()) for x in (start, length, crc, whole))],
                    names=[*batch.schema.names[1:], "start", "length", "ids_crc32", "doc_tokens"])
    return run


def best_pattern(price: np.ndarray, width: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of classes that fits: unbounded knapsack, one step for each unit of room."""
    value, pick = np.zeros(room + 1), np.full(room + 1, -1, dtype=np.int64)
    for c in range(1, room + 1):
        fits = np.flatnonzero(width <= c)
        total = value[c - width[fits]] + price[fits]
        value[c], pick[c] = value[c - 1], -1
        if len(total) and total.max() > value[c] + 1e-12:
            k = int(total.argmax())
            value[c], pick[c] = total[k], fits[k]
    pattern, c = np.zeros(len(width), dtype=np.int64), room
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            pattern[pick[c]] += 1
            c -= width[pick[c]]
    return float(value[room]), pattern


def largest_first(width: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Patterns filled with the largest rests that fit, each repeated while the rests last; every one uses up a class."""
    left, order, out = demand.copy(), np.argsort(-width, kind="stable"), []
    while left.any():
        pattern, free = np.zeros(len(width), dtype=np.int64), room
        for i in order:
            n = min(int(left[i]), free // int(width[i]))
            pattern[i], free = n, free - n * int(width[i])
        used = pattern > 0
        n = int((left[used] // pattern[used]).min())
        left -= n * pattern
        out.append((pattern, n))
    return out


def _first_basis(width: np.ndarray, demand: np.ndarray, room: int) -> list[np.ndarray]:
    """Patterns that hold every rest, as many as classes and independent: largest first, with fractions."""
    left, order, basis = demand.astype(float), np.argsort(-width, kind="stable"), []
    while (left > 0).any():
        pattern, free = np.zeros(len(width), dtype=np.int64), room
        for i in order:
            if left[i] > 0:
                pattern[i] = min(int(np.ceil(left[i])), free // int(width[i]))
                free -= int(pattern[i]) * int(width[i])
        used = pattern > 0
        ratio = np.where(used, left / np.maximum(pattern, 1), np.inf)
        n = ratio.min()
        spent = np.flatnonzero(used & (ratio <= n * (1 + 1e-12)))
        left = np.where(used, left - n * pattern, left)
        left[spent] = 0.0
        basis.append(pattern)
        # classes used up together: a column of its own for all but one
        basis += [np.where(np.arange(len(width)) == i, room // width[i], 0) for i in spent[1:]]
    return basis


def cutting_stock(width: np.ndarray, demand: np.ndarray, room: int, rounds: int = 4000) -> list[tuple[np.ndarray, int]]:
    """Patterns over the classes and how many sequences use each; together they hold every rest.

    Revised simplex with column generation, from the patterns of ``largest_first``, until the
    dual bound shows that half a sequence or 1 in 10,000 is left to gain.
    """
    live = np.flatnonzero(demand > 0)
    if not len(live):
        return []
    w, d = width[live], demand[live].astype(float)
    basis, cost = _first_basis(w, demand[live], room), np.ones(len(w))
    inverse = np.linalg.inv(np.stack(basis, axis=1).astype(float))
    for k in range(rounds):
        if k % 200 == 199:
            inverse = np.linalg.inv(np.stack(basis, axis=1).astype(float))
        price = cost @ inverse
        worst = int(price.argmin())
        if price[worst] < -1e-9:  # holding one more of a class must not pay
            column, c = np.where(np.arange(len(w)) == worst, -1, 0), 0.0
        else:
            price = np.maximum(price, 0.0)
            value, column = best_pattern(price, w, room)
            c, total = 1.0, float(price @ d)
            if total * (1 - 1 / max(value, 1.0)) < max(0.5, 1e-4 * total):
                break
        direction, level = inverse @ column, inverse @ d
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.where(up, np.maximum(level, 0.0) / np.where(up, direction, 1.0), np.inf)
        out = int(ratio.argmin())
        basis[out], cost[out] = column, c
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
    level = np.linalg.solve(np.stack(basis, axis=1).astype(float), d)
    left, result = demand[live].copy(), {}
    for i in np.argsort(-level, kind="stable"):
        used, n = basis[i] > 0, int(np.floor(level[i] + 1e-7))
        if cost[i] and n > 0:
            n = min(n, int((left[used] // basis[i][used]).min()))
        if cost[i] and n > 0:
            left -= n * basis[i]
            result[tuple(basis[i].tolist())] = result.get(tuple(basis[i].tolist()), 0) + n
    for pattern, n in largest_first(w, left, room):
        result[tuple(pattern.tolist())] = result.get(tuple(pattern.tolist()), 0) + n
    out = []
    for pattern, n in result.items():
        whole = np.zeros(len(width), dtype=np.int64)
        whole[live] = pattern
        out.append((whole, n))
    return out


def pack(spark: SparkSession, documents: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """documents (doc_id, text, ..) -> one row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    The ids of a text are followed by ``end_id``; a null or empty text has that id alone.
    Each id lies in one piece; sequences hold ``size`` ids at most and are gapless from 0.
    sequence_length is what a sequence is padded to: itself at a power of two, else ``size``.
    Rows with a null doc_id are packed like others, and repeated rows each on their own.
    Other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(spark, "packing")
    grain = GRAIN if size % GRAIN == 0 else 1
    fine = size // grain
    documents = documents.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    pieces = tb.map_batches(
        documents, _pieces(tokenizer, size, end_id), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long") \
        .withColumn("class", F.ceil(F.col("length") / grain).cast("int"))
    pieces = scratch.table(pieces)
    rows = pieces.count()
    shards = max(1, -(-rows // SHARD_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards)).cast("int"))
    counts = ordered.groupBy("class", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("class", "shard", "base")
    demand = np.zeros(fine + 1, dtype=np.int64)
    for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect():  # SIZE / GRAIN rows at most
        demand[r["class"]] = r["n"]
    plan, first_id = [], 0
    for pattern, n in cutting_stock(np.arange(1, fine + 1), demand[1:], fine):
        plan.append((first_id, pattern, n))
        first_id += n
    taken, slots = np.zeros(fine + 1, dtype=np.int64), []
    for first_id, pattern, n in plan:
        place = 0
        for c in np.flatnonzero(pattern)[::-1].tolist():
            each = int(pattern[c])
            slots.append((c + 1, int(taken[c + 1]), int(taken[c + 1]) + n * each, each, first_id, place))
            taken[c + 1] += n * each
            place += each
    # a row for each class of each pattern: at most (SIZE / GRAIN) ** 2 rows whatever the input
    slots = F.broadcast(spark.createDataFrame(slots, "class int, low long, high long, each long, first_id long, place long"))
    ranked = ordered.withColumn("inner", F.row_number().over(
        Window.partitionBy("class", "shard").orderBy("doc_id", "start", "ids_crc32")) - 1) \
        .join(base, ["class", "shard"]).withColumn("rank", F.col("base") + F.col("inner"))
    s = slots.withColumnRenamed("class", "of")
    placed = ranked.join(s, (F.col("class") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))) \
        .withColumn("sequence_id", F.expr("first_id + (rank - low) div each")) \
        .withColumn("place", F.expr("place + (rank - low) % each"))
    within = Window.partitionBy("sequence_id")
    whole = F.sum("length").over(within)
    return placed.withColumn("offset", F.sum("length").over(within.orderBy("place")) - F.col("length")) \
        .withColumn("used", whole).select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
            F.expr(f"case when bit_count(used) = 1 then used else {size}L end").alias("sequence_length"))
