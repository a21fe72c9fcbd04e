"""Document fingerprints by randomised edit embedding.

A random walk shared by all documents reads a text: at every step it writes the
current character and moves on with probability 1/2, by a random bit that
depends on the step and the character.  Texts at a small edit distance soon walk
in step again after an edit, so their embeddings lie at a small Hamming
distance.  The embedding itself isn't kept: a fingerprint samples ``SAMPLES``
of its steps in every octave of steps, one random bit of the character each, so it grows
with the logarithm of the text and compares texts of any lengths.

Likeness weighs the octaves by their steps and rescales the share of equal bits
so that unrelated texts are near 0.  ``similar`` finds near pairs: those that share a band of
sampled bits are all compared on their whole fingerprints.  A band draws its bits from the
first steps of a class of lengths, in proportion to the steps that a bit stands for: the
share of unequal steps then bounds the chance to miss a pair, short texts have keys
as long ones do, and the last partial octave counts.  ``near_classes`` joins near pairs to classes.

Each text is compared with its neighbour in ascending doc_id: documents are dealt
to ranges of doc_id and sorted there, and a range gets a copy of the first
document of the next one, so no row moves more than once and none passes
through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import textblocks as tb
from ledgerlake.llm.components import components
from ledgerlake.llm.scratch import Scratch

SAMPLES = 32
OCTAVES = 44
#: Classes of characters and steps after which the random bits of the walk repeat.
CLASSES = 16
PERIOD = 1 << 16
#: Keys for each class of lengths, and the chance of a pair at the limit to agree on all bits of a key.
BANDS = 80
SHARE = 0.055
#: Likeness of near pairs.
LEAST = 0.9
#: Members of a key in a block when they are compared with each other.
BLOCK = 500

_PIECE = 1024


def _walk_table() -> list[list[int]]:
    """For a class and a step, the step at which the walk leaves a character met then."""
    bits = tb.mix(np.arange(PERIOD, dtype=np.uint64) + np.uint64(0xC6A4A7935BD1E995))
    span = 2 * PERIOD
    out = []
    numbers = list(range(3 * PERIOD))  # shared by all rows
    for c in range(CLASSES):
        leaves = ((bits >> np.uint64(c)) & np.uint64(1)).astype(bool)
        steps = np.flatnonzero(np.concatenate([leaves, leaves, leaves]))
        out.append([numbers[k] for k in (steps[np.searchsorted(steps, np.arange(span))] + 1).tolist()])
    return out


def _sample_steps() -> np.ndarray:
    steps = [np.array([0, 1])]
    for o in range(1, OCTAVES):
        size = 1 << o
        if size <= SAMPLES:
            steps.append(size + np.arange(size))
        else:  # one step in each of SAMPLES equal parts of the octave
            part = size // SAMPLES
            jitter = tb.mix(np.arange(SAMPLES, dtype=np.uint64) + np.uint64(o << 20)) % np.uint64(part)
            steps.append(size + np.arange(SAMPLES) * part + jitter.astype(np.int64))
    return np.concatenate(steps)


_STEPS = _sample_steps()
_STEP_WEIGHT = np.diff(np.r_[_STEPS, 2 * _STEPS[-1]]).astype(float)
_STEP_BITS = tb.mix(np.arange(len(_STEPS), dtype=np.uint64) + np.uint64(0x2545F4914F6CDD1D)).astype(np.uint64)
#: Classes of lengths: the steps of a class's keys; each is a quarter longer than the one before.
_LENGTHS = np.unique(np.floor(1.25 ** np.arange(int(math.log(_STEPS[-1]) / math.log(1.25)))).astype(np.int64))
_TABLE: list[list[int]] = []


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return ((points * np.uint32(0x9E3779B1)) >> np.uint32(28)).astype(np.uint8)


def walk(chars: np.ndarray, step: int = 0) -> np.ndarray:
    """The step at which the walk leaves each character, from ``step`` on."""
    if not _TABLE:
        _TABLE.extend(_walk_table())
    table, out = _TABLE, np.empty(len(chars), dtype=np.int64)
    for lo in range(0, len(chars), _PIECE):
        j = step % PERIOD
        base = step - j
        left = [j := table[c][j] for c in chars[lo:lo + _PIECE].tobytes()]
        out[lo:lo + len(left)] = left
        out[lo:lo + len(left)] += base
        step = base + j
    return out


Print = tuple[int, np.ndarray]


def sampled(chars: np.ndarray, leaves: np.ndarray) -> Print:
    """Length of the walk, and a bit for each sampled step below it."""
    end = int(leaves[-1]) if len(leaves) else 0
    n = int(np.searchsorted(_STEPS, end))
    at = np.searchsorted(leaves, _STEPS[:n], "right")
    return end, ((_STEP_BITS[:n] >> chars[at].astype(np.uint64)) & np.uint64(1)).astype(np.uint8)


def written(p: Print) -> str:
    return f"{p[0]:x}:{np.packbits(p[1]).tobytes().hex()}"


def read(s: str) -> Print:
    end, bits = s.split(":")
    end = int(end, 16)
    return end, np.unpackbits(np.frombuffer(bytes.fromhex(bits), dtype=np.uint8))[:int(np.searchsorted(_STEPS, end))]


def likeness(a: Print, b: Print) -> float:
    """0 to 1; 1 for equal fingerprints.  Steps that only one walk reaches count as unrelated."""
    if a[0] == b[0] and np.array_equal(a[1], b[1]):
        return 1.0
    n, m = sorted((len(a[1]), len(b[1])))
    if not m:
        return 0.0
    weight = _STEP_WEIGHT[:m].copy()
    weight[m - 1] = max(1.0, max(a[0], b[0]) - _STEPS[m - 1])
    equal = a[1][:n] == b[1][:n]
    return float(max(0.0, (2.0 * (weight[:n] @ equal) - weight[:n].sum()) / weight.sum()))


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as many first characters of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (block, ahead, doc_id, text): a row with the one after it, if both are of one block."""
    out: list[tuple] = []
    last = None

    def flush() -> pa.RecordBatch:
        names = [f.split()[0] for f in _SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        out.clear()
        return batch

    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            for block, ahead, doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                text = text or ""
                if last is not None and last[0] == block and last[1]:
                    continue  # more copies of the document ahead
                chars = codes(text)
                leaves = walk(chars)
                own = sampled(chars, leaves)
                if last is not None and last[0] == block:
                    _, _, before_id, before, b_chars, b_leaves, b_own = last
                    half = len(before) // 2
                    kept = len(before) - half
                    e_chars = np.concatenate([b_chars[:kept], chars[:half]])
                    tail = walk(chars[:half], int(b_leaves[kept - 1]) if kept else 0)
                    e_own = sampled(e_chars, np.concatenate([b_leaves[:kept], tail]))
                    changed = edited(before, text)
                    out.append((before_id, len(before), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                                written(b_own), written(e_own), likeness(b_own, e_own), likeness(b_own, own)))
                last = (block, ahead, doc_id, text, chars, leaves, own)
            if len(out) >= 500:
                yield flush()
    if out:
        yield flush()


def fingerprints(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """documents (doc_id, text, ..) -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    One row for each input row.  The edited text takes the beginning of the next
    document in ascending doc_id (after the last: the first; a single document follows
    itself).  Rows with a null doc_id come before all others; rows that share a doc_id
    stand in the order of a hash of their text.  Null texts count as
    empty: length 0, and a likeness of 0 to any other text.  Other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("doc_id")
    cuts = ids.agg(F.percentile_approx("doc_id", [k / blocks for k in range(1, blocks)], 20 * blocks)).first()[0] or []
    cuts = sorted(set(cuts))  # fewer than blocks, whatever the input
    # the number of cuts below doc_id
    block = F.lit(0)
    if cuts:
        block = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("doc_id"))))
    rows = rows.withColumn("block", block.cast("int")).withColumn("same", F.xxhash64("text"))
    firsts = sorted(((r["block"], r["doc_id"]) for r in rows.groupBy("block").agg(F.min("doc_id").alias("doc_id")).collect()), key=lambda r: r[0])
    if not firsts:
        return rows.select("doc_id", "text").limit(0).mapInArrow(lambda it: iter(()), _SCHEMA)
    # a block's first document is needed at the end of the block before
    before = spark.createDataFrame([(b, d, firsts[k - 1][0]) for k, (b, d) in enumerate(firsts)], "block int, first long, to int")
    ahead = rows.join(F.broadcast(before), "block").where("doc_id <=> first").select(F.col("to").alias("block"), F.lit(1).alias("ahead"), "doc_id", "same", "text")
    every = rows.select("block", F.lit(0).alias("ahead"), "doc_id", "same", "text").union(ahead)
    every = every.repartition("block").sortWithinPartitions("block", "ahead", "doc_id", "same")
    return every.select("block", "ahead", "doc_id", "text").mapInArrow(_neighbours, _SCHEMA)


def _draws(least: float) -> int:
    """Sampled bits a band: as many as leave a pair at ``least`` the chance ``SHARE`` to agree on all of them."""
    apart = (1.0 - least) / 2.0  # the share of unequal steps
    return 64 if apart <= 0.0 else max(1, min(64, math.ceil(math.log(SHARE) / math.log1p(-apart))))


def _class(end: float) -> int:
    """The largest class of lengths whose first steps a walk of this length has; -1 for an empty walk."""
    return int(np.searchsorted(_LENGTHS, end, "right")) - 1


@lru_cache(maxsize=None)  # one entry a class
def _places(length: int, draws: int) -> np.ndarray:
    """(BANDS, draws) sampled bits below a class's length, drawn by the steps that they stand for."""
    end = int(_LENGTHS[length])
    steps = _STEPS[:int(np.searchsorted(_STEPS, end))]
    edge = np.cumsum(np.diff(np.r_[steps, end])) / end
    salt = np.uint64((length + 1) << 32)
    random = tb.mix(np.arange(BANDS * draws, dtype=np.uint64) + salt).astype(float) / 2.0 ** 64
    return np.minimum(np.searchsorted(edge, random, "right"), len(steps) - 1).reshape(BANDS, draws)


def _band_keys(prints: list[Print], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and band keys of fingerprints: BANDS keys for each class of lengths in which a near one may be met.

    The bits of a class are those of its first steps, last partial octave included, however few they are.
    A pair is near only if the shorter walk, up to the step sampled next, has ``least`` of the steps of the longer:
    keys of all classes from there up to the own one hold the class of the shorter.
    """
    draws = _draws(least)
    at: dict[int, list[int]] = {}
    for i, p in enumerate(prints):
        low = _class(max(1.0, least * p[0] / (1 + 2 / SAMPLES)))
        for length in range(low, _class(p[0]) + 1):
            at.setdefault(length, []).append(i)
    rows, keys = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for length, own in at.items():
        places = _places(length, draws)
        bits = np.stack([prints[i][1][:places.max() + 1] for i in own])[:, places]
        packed = np.zeros((len(own), BANDS, 8), dtype=np.uint8)
        value = np.packbits(bits, axis=2)
        packed[:, :, :value.shape[2]] = value
        salt = tb.mix(np.arange(BANDS, dtype=np.uint64) + np.uint64((length + 1) << 16))
        keys.append(tb.signed(tb.mix(packed.view(np.uint64)[:, :, 0] ^ salt).ravel()))
        rows.append(np.repeat(np.array(own), BANDS))
    return np.concatenate(rows), np.concatenate(keys)


def likenesses(a: list[Print], b: list[Print]) -> np.ndarray:
    """The likeness of each fingerprint in a to each in b."""
    width = max(len(p[1]) for p in (*a, *b))

    def signs(prints: list[Print]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = np.zeros((len(prints), width))
        for k, p in enumerate(prints):
            out[k, :len(p[1])] = 2.0 * p[1] - 1.0
        return out, np.array([len(p[1]) for p in prints]), np.array([float(p[0]) for p in prints])

    (x, n, end_a), (y, m, end_b) = signs(a), signs(b)
    weight = _STEP_WEIGHT[:width]
    equal = (x * weight) @ y.T  # of the steps that both reach, the equal less the unequal ones
    most, end = np.maximum.outer(n, m), np.maximum.outer(end_a, end_b)
    last = np.maximum(most - 1, 0)
    tail = np.maximum(1.0, end - _STEPS[last])
    i, j = np.nonzero((n[:, None] == m[None, :]) & (most > 0))
    equal[i, j] += (tail[i, j] - weight[last[i, j]]) * x[i, last[i, j]] * y[j, last[i, j]]
    return np.where(np.minimum.outer(n, m) > 0, np.maximum(0.0, equal) / (_STEPS[last] + tail), 0.0)


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Sorted rows in runs that are equal in their first columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(width)], axis=1)
        cuts = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if held and tuple(key[lo]) != last:
                yield pa.Table.from_batches(held)
                held = []
            last = tuple(key[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, doc) -> those whose key has other rows, with the smallest doc of the key."""
    before: tuple | None = None  # the last row so far, the smallest doc of its key, and whether it was given
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if before is not None:
            key, doc = np.r_[before[0], key], np.r_[before[1], doc]
        starts = np.r_[True, key[1:] != key[:-1]]
        first = np.flatnonzero(starts)
        hub = doc[first][np.cumsum(starts) - 1]
        many = np.repeat(np.diff(np.r_[first, len(key)]) > 1, np.diff(np.r_[first, len(key)]))
        if before is not None and key[0] == before[0]:
            hub[:first[1] if len(first) > 1 else len(key)] = before[2]
            many[0] &= not before[3]
        end = first[-1]
        given = len(key) - end > 1 or (end == 0 and before is not None and before[3])
        before = (key[-1], doc[-1], hub[-1], given)
        keep = np.flatnonzero(many)
        if len(keep):
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(doc[keep]), pa.array(hub[keep])], names=["key", "doc", "hub"])


def _classes(prints: DataFrame) -> DataFrame:
    return prints.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("doc"))


def _meeting(scratch: Scratch, classes: DataFrame, least: float) -> DataFrame:
    """classes (fingerprint, doc) -> key, doc, hub: the members of band keys with more than one, hub the smallest of a key."""
    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                rows, keys = _band_keys([read(s) for s in part.column(0).to_pylist()], least)
                yield pa.RecordBatch.from_arrays([pa.array(keys), part.column(1).take(pa.array(rows))], names=["key", "doc"])

    rows = classes.select("fingerprint", "doc").mapInArrow(bands, "key long, doc long")
    rows = rows.repartition("key").sortWithinPartitions("key", "doc")
    return scratch.table(rows.mapInArrow(_shared, "key long, doc long, hub long"))


def _search(least: float, joining: bool):
    """Rows sorted by block -> near pairs of asking rows and members; if joining, only those that join components of the block."""
    def near(rows: pa.Table) -> list[tuple[int, int, float]]:
        doc, asks = np.asarray(rows["doc"]), np.asarray(rows["asks"])
        comp = np.unique(np.asarray(rows["component"]), return_inverse=True)[1]
        prints = [read(s) for s in rows["fingerprint"].to_pylist()]
        one, two = np.flatnonzero(asks != 0), np.flatnonzero(asks != 1)
        if not len(one) or not len(two):
            return []
        close = likenesses([prints[i] for i in one], [prints[i] for i in two])
        x, y = np.nonzero(close >= least)
        found = []
        for a, b, value in zip(one[x].tolist(), two[y].tolist(), close[x, y].tolist(), strict=True):
            if doc[a] == doc[b] or joining and comp[a] == comp[b]:
                continue
            found.append((int(min(doc[a], doc[b])), int(max(doc[a], doc[b])), value))
            if joining:
                comp[comp == comp[b]] = comp[a]
        return sorted(set(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, 3):
            if found := near(rows):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["a", "b", "likeness"])
    return run


def _inside(met: DataFrame, classes: DataFrame, least: float, joining: bool) -> DataFrame:
    """met (key, doc, component, least) -> pairs (a, b, likeness): the members of a key against each other, in blocks of BLOCK.

    If joining, only members outside the key's smallest component ask, and pairs inside a component go.
    """
    size = met.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("lowest"), F.max("component").alias("highest"))
    if joining:
        size = size.where("n > 2 and lowest <> highest")
    rows = met.join(size.select("key", "n", "lowest"), "key")
    rows = rows.withColumn("asking", F.col("component") != F.col("lowest") if joining else F.lit(True))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc"), blocks).cast("int")
    every = F.sequence(F.lit(0), blocks - 1)
    # the asking rows of block i meet the members of block j; 0: a member, 1: asks, 2: both
    asks = rows.where("asking").select("key", "doc", "component", own.alias("i"), F.explode(every).alias("j")) \
        .select("key", "i", "j", "doc", "component", F.when(F.col("i") == F.col("j"), 2).otherwise(1).alias("asks"))
    # members go only to the blocks that ask: n / BLOCK numbers at most a key
    to = rows.join(rows.where("asking").groupBy("key").agg(F.collect_set(own).alias("blocks")), "key") if joining else rows.withColumn("blocks", every)
    members = to.select("key", "doc", "component", "asking", own.alias("j"), F.explode("blocks").alias("i")) \
        .where("not (asking and i = j)").select("key", "i", "j", "doc", "component", F.lit(0).alias("asks"))
    both = asks.union(members)
    if not joining:
        both = both.where("i <= j")  # each pair of blocks once
    groups = both.join(classes, "doc").select("key", "i", "j", "doc", "component", "asks", "fingerprint")
    groups = groups.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "doc")
    return groups.mapInArrow(_search(least, joining), "a long, b long, likeness double")


def similar(prints: DataFrame, least: float = LEAST) -> DataFrame:
    """prints (doc_id, fingerprint) -> pairs (a, b, likeness) of class representatives, a < b; equal fingerprints are one class.

    A class is named by its smallest doc_id.  All pairs of a band key are compared on whole fingerprints, in
    blocks of bounded size, and those of at least ``least`` are returned: their number follows the near pairs, which
    for a large group is the square of its size (``near_classes`` gives such groups in one row a document).  A
    pair at ``least`` shares no key with a probability near (1 - SHARE) ** BANDS, 0.01, and up to 0.04 where the
    class of its lengths is much shorter; nearer pairs are missed less.  Bands get shorter as
    ``least`` falls and are made for a ``least`` of 0.5 and more.
    """
    classes = _classes(prints)
    scratch = Scratch(prints.sparkSession, "similar")
    classes = scratch.table(classes)
    met = _meeting(scratch, classes, least).select("key", "doc", F.col("doc").alias("component")).distinct()
    # pairs of different members of one doc_id are the likest of them
    return _inside(met, classes, least, False).groupBy("a", "b").agg(F.max("likeness").alias("likeness"))


def _verified(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [likeness(read(x), read(y)) >= least for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(near, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])
    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            chars = [codes(t or "") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([written(sampled(c, walk(c))) for c in chars], pa.string())],
                                             names=["doc_id", "fingerprint"])


def near_classes(spark: SparkSession, documents: DataFrame, least: float = LEAST) -> DataFrame:
    """documents (doc_id, text, ..) -> doc_id, fingerprint, near_id; one row for each input row.

    near_id is the smallest doc_id reachable over pairs of a likeness of ``least`` or more that share a band key (the
    pairs of ``similar``).  The members of a key are compared with its smallest one first; a key whose members then
    stand in several components is searched in full, and a block passes on only pairs that join components, so
    what is written follows the members, not their pairs.  Rows with a null doc_id have a null near_id and take no part.
    Rows that share a doc_id are one vertex with the links of all of them.  Null texts count as empty; empty
    texts are one class and near to no other.
    """
    scratch = Scratch(spark, "near")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = scratch.table(rows.mapInArrow(_own, "doc_id long, fingerprint string"))
    classes = scratch.table(_classes(prints))
    met = _meeting(scratch, classes, least)
    star = met.where("hub <> doc").select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct()
    pairs = star.join(classes.toDF("fa", "a"), "a").join(classes.toDF("fb", "b"), "b").select("a", "b", "fa", "fb")
    links = scratch.table(pairs.mapInArrow(_verified(least), "a long, b long"))
    labels = components(spark, links, scratch)
    named = met.join(labels.toDF("doc", "component"), "doc", "left").select("key", "doc", F.coalesce("component", "doc").alias("component"))
    more = _inside(scratch.table(named.distinct()), classes, least, True).select("a", "b")
    # rows that share a doc_id tie the classes of their fingerprints together
    member = prints.where("doc_id is not null").distinct().join(classes, "fingerprint").select("doc_id", "doc")
    shared = member.groupBy("doc_id").agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
    ties = member.join(shared.where("a <> b").select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    labels = scratch.table(components(spark, links.union(more).union(ties), scratch))
    near = shared.select("doc_id", F.col("a").alias("doc")).join(labels.toDF("doc", "component"), "doc", "left") \
        .select("doc_id", F.coalesce("component", "doc").alias("near_id"))
    return prints.join(near, "doc_id", "left").select("doc_id", "fingerprint", "near_id")
