"""Near-duplicate documents by HyperMinHash over word shingles.

Signature: the 64-bit hashes of a text's shingles are split by their first bits
into ``REGISTERS`` buckets.  A register keeps, of the bucket's smallest hash, the
number of leading zeros (6 bits) and the next 10 bits (the mantissa): 16 bits
instead of 64.  An empty bucket of a short text takes the register of the first
non-empty bucket in an order drawn once for it (optimal densification), so
short texts are compared on equal terms.

Search: ``BANDS`` groups of ``ROWS`` registers are hashed to band keys.  The
members of a key are paired with its smallest member only (a star), the Jaccard
index of each pair is estimated from equal registers, corrected for registers
that agree by chance, and pairs clearly below the threshold go.  What is left is
verified on full shingle sets.  After joining the verified links, a key whose
members fell into several components is searched again, its outsiders against
all its members, in blocks of bounded size: no pair that shares a key and could
join two components is left out, and no key is capped.  Members go only to the blocks that hold an outsider.
There texts are compared by their SKETCH smallest shingle hashes of 64 bits: sets that fit are compared in full, and
of the pairs that join the same two components a block passes on one. Longer sets are compared on the hashes
that both sketches cover; a pair clearly above the threshold counts as joined, one that is near it is passed on, and
both are verified on full sets.

A hub of many pairs is salted: its pairs are dealt out by their other end, LIMIT or so to a task, and its registers or set
go along once for each salt.

Equal sets are one vertex: copies are collapsed by a 128-bit digest of the set
before any pairing, so a hot group of copies is one row per task.

At Jaccard 0.75, four registers a band and 40 bands, a pair shares no key with
probability (1 - 0.75**4)**40, below 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import textblocks as tb
from ledgerlake.llm.components import components
from ledgerlake.llm.scratch import Scratch

WORDS = 5
PERCENT = 75
REGISTERS = 256
MANTISSA = 10
ROWS = 4
BANDS = 40
#: Standard deviations of the estimate by which a pair may miss the threshold and still be verified.
SLACK = 5.0
#: Members in a block when a key is searched again.
BLOCK = 500
#: Smallest shingle hashes by which texts are compared when a key is searched again.
SKETCH = 2048
#: Pairs of one hub in a task; salts of a hub in the second search.
LIMIT = 1000
SALTS = 64

_LOG = int(np.log2(REGISTERS))


def _donors() -> np.ndarray:
    """For each bucket, the rank of every bucket in its order of donors."""
    keys = tb.mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    return keys.reshape(REGISTERS, REGISTERS).argsort(axis=1).argsort(axis=1).astype(np.uint16)


_RANK = _donors()


def registers(hashes: np.ndarray) -> np.ndarray:
    """16-bit registers of an ascending array of distinct hashes (at least one)."""
    bucket = (hashes >> np.uint64(64 - _LOG)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rest = hashes[first] << np.uint64(_LOG)
    zeros = 63 - np.frexp(np.maximum(rest, np.uint64(1)).astype(np.float64))[1] + 1
    zeros = np.clip(zeros, 0, 62)
    mantissa = (rest << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    codes = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)
    full = bucket[first]
    if len(full) == REGISTERS:
        return codes
    out = np.empty(REGISTERS, dtype=np.uint16)
    out[full] = codes
    empty = np.ones(REGISTERS, dtype=bool)
    empty[full] = False
    empty = np.flatnonzero(empty)
    out[empty] = codes[_RANK[empty][:, full].argmin(axis=1)]
    return out


def shingle_sets(buf: np.ndarray, off: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each row, the ascending distinct hashes of its shingles; of all words if there are fewer."""
    starts, ends, first = tb.word_spans(buf, off)
    hashes = tb.span_hashes(tb.LOWER[buf], starts, ends)
    windows = tb.window_hashes(hashes, words)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= words:
            part = np.sort(windows[lo:hi - words + 1])
            yield part[np.r_[True, part[1:] != part[:-1]]]
        elif hi > lo:
            yield tb.mix(tb.window_hashes(hashes[lo:hi], hi - lo) + np.uint64(hi - lo))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _digest(s: np.ndarray) -> tuple[int, int]:
    return (int(tb.mix(s + np.uint64(1)).sum().view(np.int64)), int(tb.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().view(np.int64)))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, buf, off in tb.text_blocks(batch.column(1)):
            n, one, two, regs = [], [], [], []
            for s in shingle_sets(buf, off):
                n.append(len(s))
                a, b = _digest(s) if len(s) else (0, 0)
                one.append(a)
                two.append(b)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.array(regs, pa.binary())],
                names=["doc_id", "n_shingles", "set_1", "set_2", "registers"])


def signatures(documents: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, 128-bit digest of the set, registers (null for an
    empty set)."""
    return tb.map_batches(
        documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), _signatures, "doc_id long, n_shingles long, set_1 long, set_2 long, registers binary")


def _matrix(column: pa.Array) -> np.ndarray:
    _, offsets, data = column.buffers()
    lo = np.frombuffer(offsets, dtype=np.int32)[column.offset]
    return np.frombuffer(data, dtype=np.uint16, offset=int(lo), count=len(column) * REGISTERS).reshape(-1, REGISTERS)


def _band_order() -> np.ndarray:
    """The registers of all bands, none used twice."""
    return tb.mix(np.arange(REGISTERS, dtype=np.uint64) + np.uint64(77)).argsort()[:ROWS * BANDS]


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(documents, BANDS) band keys of a matrix of registers."""
    picked = np.ascontiguousarray(regs[:, _band_order()]).view(np.uint64)  # four 16-bit registers
    return tb.mix(picked + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            keys = band_keys(_matrix(part.column(0)))
            rest = [c.take(pa.array(np.repeat(np.arange(part.num_rows), BANDS))) for c in part.columns[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(tb.signed(keys.ravel())), *rest], names=["key", *part.schema.names[1:]])


def _chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that registers of unrelated sets of these sizes agree: the leading zeros do, and then the mantissas."""
    zeros = np.arange(0, 40)[:, None]

    def level(n):
        load = np.maximum(n / REGISTERS, 1.0)
        return np.exp(-load * 2.0 ** -(zeros + 1)) - np.exp(-load * 2.0 ** -zeros)

    return (level(n_a) * level(n_b)).sum(axis=0) / 2.0 ** MANTISSA


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard index from equal registers, corrected for chance agreement."""
    equal, chance = (a == b).mean(axis=1), _chance(n_a, n_b)
    return np.maximum(0.0, (equal - chance) / (1.0 - chance))


def _passes(a, b, n_a, n_b, share: float) -> np.ndarray:
    """Estimate and sizes leave the threshold possible."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    spread = np.sqrt(share * (1 - share) / np.minimum(REGISTERS, small))
    return (small >= share * large) & (estimate(a, b, n_a, n_b) >= share - SLACK * spread)


def _likely(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _matrix(batch.column(3)), _matrix(batch.column(4))
            n_a, n_b = (np.asarray(batch.column(i)).astype(float) for i in (5, 6))
            keep = pa.array(_passes(a, b, n_a, n_b, share))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1, 2)], names=["a", "b", "salt"])
    return run


def at_hub(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """pairs (a, salt, ..) with the columns of values (a, ..): one copy of a hub's values for each of its salts."""
    salted = pairs.select("a", "salt").distinct().join(values, "a")
    return pairs.join(salted, ["a", "salt"])


def likely_pairs(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, salt) whose estimated Jaccard index doesn't rule out the threshold."""
    one = reps.select(F.col("doc").alias("a"), F.col("registers").alias("ra"), F.col("n_shingles").alias("na"))
    two = reps.select(F.col("doc").alias("b"), F.col("registers").alias("rb"), F.col("n_shingles").alias("nb"))
    joined = at_hub(pairs.join(two, "b"), one).select("a", "b", "salt", "ra", "rb", "na", "nb")
    return tb.map_batches(joined, _likely(percent / 100), "a long, b long, salt int")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, buf, off in tb.text_blocks(batch.column(1)):
            sets = list(shingle_sets(buf, off))
            values = pa.array(tb.signed(np.concatenate(sets)))
            ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.ListArray.from_arrays(ends, values)], names=["doc", "shingles"])


def shingles_of(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """wanted (doc_id) -> doc, shingles: the sets of those documents, from their texts."""
    # sorted and merged at any size: the list of wanted documents follows the input
    texts = documents.select("doc_id", "text").join(wanted.hint("merge"), "doc_id", "left_semi")
    return tb.map_batches(texts, _sets, "doc long, shingles array<long>")


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()


def verified_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, salt) whose full shingle sets reach the threshold, as (a, b)."""
    both = at_hub(pairs.join(sets.toDF("b", "sb"), "b"), sets.toDF("a", "sa"))
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b").distinct()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, buf, off in tb.text_blocks(batch.column(1)):
            sets = list(shingle_sets(buf, off))
            least = [s[:SKETCH] for s in sets]  # ascending hashes
            ends = pa.array(np.cumsum([0, *map(len, least)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(tb.signed(np.concatenate(least))))], names=["doc", "n_shingles", "sketch"])


def sketches_of(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """wanted (doc_id) -> doc, n_shingles, sketch (the SKETCH smallest hashes of its set)."""
    texts = documents.select("doc_id", "text").join(wanted.hint("merge"), "doc_id", "left_semi")
    return tb.map_batches(texts, _sketches, "doc long, n_shingles long, sketch array<long>").where("n_shingles > 0")


def _search(rows: pa.Table, share: float) -> list[tuple[int, int]]:
    """Links of one block that may join components: outsiders against all members."""
    doc, out = np.asarray(rows["doc"]), np.asarray(rows["outsider"])
    n = np.asarray(rows["n_shingles"])
    comp = np.unique(np.asarray(rows["component"]), return_inverse=True)[1]
    values = rows["sketch"].chunk(0)
    size = np.asarray(values.value_lengths())
    place = np.cumsum(size) - size
    # codes ascend as the (unsigned) hashes do
    code = np.unique(values.flatten().to_numpy(zero_copy_only=False).view(np.uint64), return_inverse=True)[1]
    mark = np.zeros(len(code) + 1, dtype=bool)
    cut = n > size
    last = np.where(cut, code[place + size - 1], len(code))
    members = np.flatnonzero(out != 1)
    at, begin = tb.ranges(place[members], size[members]), np.cumsum(size[members]) - size[members]
    theirs = code[at]
    found: list[tuple[int, int]] = []
    for i in np.flatnonzero(out != 0).tolist():
        own = code[place[i]:place[i] + size[i]]
        mark[own] = True
        common = np.add.reduceat(mark[theirs], begin, dtype=np.int64)
        mark[own] = False
        # both sets up to the last hash that both sketches cover
        ours = np.searchsorted(own, last[members], "right")
        them = np.add.reduceat(theirs <= last[i], begin, dtype=np.int64) if cut[i] else size[members]
        either = ours + them - common
        likeness = common / np.maximum(either, 1)
        sampled = cut[members] | cut[i]
        slack = np.where(sampled, SLACK * np.sqrt(share * (1 - share) / np.maximum(either, 1)), 0.0)
        fits = np.minimum(n[members], n[i]) >= share * np.maximum(n[members], n[i]) - 1e-9
        apart = comp[members] != comp[i]
        sure = np.flatnonzero(fits & apart & (likeness >= share + slack - 1e-9))
        for j in members[sure[np.argsort(-likeness[sure], kind="stable")]].tolist():
            if comp[j] != comp[i]:
                found.append((int(min(doc[i], doc[j])), int(max(doc[i], doc[j]))))
                comp[comp == comp[j]] = comp[i]
        near = members[fits & sampled & (likeness >= share - slack) & (comp[members] != comp[i])]
        found += [(int(min(doc[i], doc[j])), int(max(doc[i], doc[j]))) for j in near.tolist()]
    return found


def _again(share: float):
    """Rows sorted by block."""
    def search(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        found = sorted(set(_search(rows, share)))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(3)], axis=1)
            cuts = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if held and tuple(key[lo]) != last:
                    yield from search(held)
                    held = []
                last = tuple(key[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from search(held)
    return run


def open_pairs(reps: DataFrame, labels: DataFrame, documents: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b, salt) that share a band key, may join two components and weren't decided by the star."""
    named = reps.join(labels.toDF("doc", "component"), "doc", "left") \
        .select("registers", "doc", F.coalesce("component", "doc").alias("component"))
    rows = tb.map_batches(named, _bands, "key long, doc long, component long")
    keys = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("least"), F.max("component").alias("most")) \
        .where("n > 2 and least <> most").select("key", "n", "least")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    inside = scratch.table(rows.join(keys, "key").withColumn("outside", F.col("component") != F.col("least"))
                           .withColumn("own", F.pmod(F.xxhash64("doc"), blocks).cast("int")).drop("least"))
    sketches = scratch.table(sketches_of(inside.select(F.col("doc").alias("doc_id")).distinct(), documents))
    asking = inside.where("outside").groupBy("key").agg(F.collect_set("own").alias("asking"))  # n / BLOCK numbers at most
    # the outsiders of block i meet the members of block j; 0: a member, 1: an outsider, 2: both
    asks = inside.where("outside").select("key", "doc", "component", F.col("own").alias("i"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j")) \
        .select("key", "i", "j", "doc", "component", F.when(F.col("i") == F.col("j"), 2).otherwise(1).alias("outsider"))
    members = inside.join(asking, "key").select("key", "doc", "component", "outside", F.col("own").alias("j"), F.explode("asking").alias("i")) \
        .where("not (outside and i = j)").select("key", "i", "j", "doc", "component", F.lit(0).alias("outsider"))
    groups = asks.union(members).join(sketches, "doc").select("key", "i", "j", "doc", "component", "outsider", "n_shingles", "sketch")
    groups = groups.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "doc")
    return tb.map_batches(groups, _again(percent / 100), "a long, b long").distinct() \
        .withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))


def near_duplicates(spark: SparkSession, documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """documents (doc_id, text, ..) -> doc_id, n_shingles, component_id, kept; one row for each input row.

    A text's set: its distinct 5-word shingles after lower-casing A-Z; all words
    as one shingle if there are fewer.  Null and empty texts and texts of white
    space have an empty set and are linked with nothing.  component_id is the
    smallest doc_id reachable over links; kept marks the row that has it.  Rows
    with a null doc_id are returned with component_id null and kept true and take no part in links.
    Repeated rows and rows that share a doc_id are one vertex with the links of
    all of them.  Other columns are ignored.  An empty table gives no rows.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scratch = Scratch(spark, "minhash")
    signed = scratch.table(signatures(documents))
    whole = signed.where("doc_id is not null and n_shingles > 0")
    classes = whole.groupBy("set_1", "set_2", "n_shingles").agg(F.min("doc_id").alias("doc"))
    member = scratch.table(whole.select("doc_id", "set_1", "set_2", "n_shingles").distinct()
                           .join(classes, ["set_1", "set_2", "n_shingles"]).select("doc_id", "doc", "set_1", "set_2"))
    chosen = member.where("doc_id = doc").select("doc", "set_1", "set_2").distinct()
    reps = scratch.table(whole.withColumnRenamed("doc_id", "doc").join(chosen, ["doc", "set_1", "set_2"])
                         .select("registers", "doc", "n_shingles").dropDuplicates(["doc", "registers"]))

    rows = tb.map_batches(reps.select("registers", "doc"), _bands, "key long, doc long")
    hubs = rows.groupBy("key").agg(F.min("doc").alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", "hub", "n")
    star = rows.join(hubs, "key").where("hub <> doc").groupBy(F.col("hub").alias("a"), F.col("doc").alias("b")).agg(F.max("n").alias("n"))
    # the pairs of a hub, LIMIT or so to a salt
    star = star.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / LIMIT)).cast("int").alias("salt"))
    likely = scratch.table(likely_pairs(star, reps, percent))
    sets = scratch.table(shingles_of(ends(likely), documents))
    links = scratch.table(verified_pairs(likely, sets, percent))
    # rows that share a doc_id tie the classes of their texts together
    ties = member.where("doc_id <> doc").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    labels = scratch.table(components(spark, links, scratch))
    more = scratch.table(open_pairs(reps, labels, documents, percent, scratch).join(likely, ["a", "b"], "left_anti"))
    if more.limit(1).count():
        missing = scratch.table(ends(more).join(sets.select(F.col("doc").alias("doc_id")), "doc_id", "left_anti"))
        late = tb.map_batches(documents.select("doc_id", "text").join(missing, "doc_id", "left_semi"), _sets, "doc long, shingles array<long>")
        more = scratch.table(verified_pairs(more, sets.union(late), percent))
        labels = scratch.table(components(spark, links.union(more), scratch))
    shared = member.groupBy("doc_id").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least <> most")
    if shared.limit(1).count():
        labels = scratch.table(components(spark, links.union(more).union(ties), scratch))

    of = member.groupBy("doc_id").agg(F.min("doc").alias("doc")).join(labels.toDF("doc", "component_id"), "doc", "left") \
        .select("doc_id", F.coalesce("component_id", "doc").alias("component_id"))
    # rows without a set keep their own id
    out = signed.select("doc_id", "n_shingles").join(of, "doc_id", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_duplicates(spark: SparkSession, documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, that are the smallest doc_id of their component; of repeated rows of a doc_id, one."""
    marked = near_duplicates(spark, documents, percent)
    gone = marked.where("not kept").select("doc_id").distinct()
    out = documents.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
    if documents.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        out = out.where("doc_id is null").union(out.where("doc_id is not null").dropDuplicates(["doc_id"]))
    return out
