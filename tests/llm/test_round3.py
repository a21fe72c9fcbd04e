"""Resampling, runs and top-k search against brute-force versions, on awkward rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import blocksearch, lm, minhash, periodic, queries, resampling, substrings

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# --- resampling -----------------------------------------------------------------------
def features(text, orders, buckets):
    words = TERM.findall((text or "").translate(LOW))
    grams = [" ".join(words[i:i + n]) for n in range(orders[0], orders[1] + 1) for i in range(len(words) - n + 1)]
    return len(words), collections.Counter(zlib.crc32(g.encode()) % buckets for g in grams)


def resampled(rows, target, orders=(1, 1), buckets=10_000, min_words=20, percent=10):
    own = [(i, *features(t, orders, buckets)) for i, t in rows]
    s, t = (sum((c for *_, c in x), collections.Counter()) for x in (own, [features(x, orders, buckets) for x in target]))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    out = []
    for i, n, c in own:
        many = sum(c.values())
        weight = sum(gain[b] * k for b, k in c.items()) // many if many else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, many, weight, score, None])
    may = sorted((r for r in out if r[1] >= min_words and r[0] is not None), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(may[:percent * len(may) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("orders,percent,buckets", [((1, 1), 10, 10_000), ((1, 3), 50, 97), ((2, 2), 100, 1000)])
def test_resampling(spark, documents, rows, orders, percent, buckets):
    target = spark.createDataFrame([(None,), ("",), (rows[3][1],), (rows[20][1],), ("One's A-b_c 12é",)], "text string")
    got = resampling.resample(spark, documents, target, orders, buckets, min_words=5, percent=percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert collected(got) == resampled([r[:2] for r in rows], [r[0] for r in target.collect()], orders, buckets, 5, percent)


def test_resampling_odd(spark, odd, nothing):
    got = collected(resampling.resample(spark, odd, odd, min_words=1, percent=100))
    ranks = sorted(r[5] for r in got if r[5] is not None)
    assert len(got) == 8 and ranks == [1, 2, 3, 4]
    assert all(r[4] is None and r[5] is None for r in got if r[0] is None)
    same = [r for r in got if r[0] == 5]
    assert len(same) == 3
    assert resampling.resample(spark, nothing, nothing).count() == 0
    assert {r[3] for r in collected(resampling.resample(spark, odd, nothing))} != set()
    clash = odd.withColumn("rank", F.lit("x")).withColumn("bucket", F.lit(1)).withColumn("times", F.lit(2)).withColumn("weight", F.lit(3))
    assert collected(resampling.resample(spark, clash, odd, min_words=1, percent=100)) == got


def test_resampling_breaks_ties_by_doc_id(spark):
    rows = [(i, " ".join(["same"] * 30)) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert collected(resampling.resample(spark, df, df, percent=33)) == resampled(rows, [t for _, t in rows], percent=33)


def test_overlapped_spans_are_the_runs_of_words():
    line = resampling.collapsed("  The-Cat; sat\tÜber 9 a\x00a".encode())
    assert line == "the cat sat Über 9 a a".encode()
    spans = [m.span() for m in resampling.span_pattern(3).finditer(line, overlapped=True)]
    words = line.split()
    assert [line[a:b] for a, b in spans] == [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)]


# --- runs ---------------------------------------------------------------------------------
def all_runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def kept(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def check_runs(texts, got):
    for text, r in zip(texts, got, strict=True):
        words = WORD.findall(text or "")
        want = all_runs(words)
        assert [tuple(x) for x in r["runs"]] == want
        assert r["n_words"] == len(words) and r["kept_text"] == kept(words, want)
        assert r["n_dropped"] == len(words) - len(WORD.findall(r["kept_text"]))


def periodic_texts(seed, many):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(many):
        letters, text = int(rng.integers(1, 7)), []
        for _ in range(int(rng.integers(1, 6))):
            root = rng.integers(0, letters, int(rng.integers(1, 30)))
            text += np.resize(root, int(len(root) * rng.uniform(1, 5))).tolist() + rng.integers(0, letters * 3, int(rng.integers(0, 20))).tolist()
        out.append(" ".join(f"w{x}" for x in text))
    return out


def test_runs_against_brute_force(spark):
    texts = periodic_texts(3, 160)
    a, b = "a", "b"
    for _ in range(9):
        a, b = f"{a} {b}", a  # Fibonacci words: runs at every scale
    texts += [a, "x " * 11, "x " * 12, "x " * 300, "a b " * 200 + "c " + "a b " * 90, None, "", " \n\t", "one two three"]
    thue = [bin(i).count("1") % 2 for i in range(256)]
    texts.append(" ".join("ab"[i] for i in thue))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    check_runs(texts, periodic.find_runs(df).orderBy("doc_id").collect())


def test_long_text_of_one_word_stays_cheap():
    words = np.full(200_000, 7, dtype=np.uint64)
    start, end, period = periodic.runs(words, np.array([0, len(words)]))
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [200_000], [1])


def test_splitting_keeps_words_that_may_run():
    words = np.array([1, 2, 3] * 5 + [9] + [4, 5] * 7 + [8, 1], dtype=np.uint64)
    at, segment = periodic.split(words, np.zeros(len(words), np.int64))
    assert at.tolist() == [*range(15), *range(16, 30)] and len(set(segment.tolist())) == 2


def test_runs_odd(spark, odd, nothing):
    assert periodic.find_runs(odd).count() == 8 and periodic.find_runs(nothing).count() == 0
    clash = odd.withColumn("runs", F.lit(1)).withColumn("n_words", F.lit("x"))
    assert collected(periodic.find_runs(clash)) == collected(periodic.find_runs(odd))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_runs_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, sf, "documents").collect()}
    got = {r["doc_id"]: r for r in queries.op12_runs(spark, sf).collect()}
    assert set(got) == set(texts)
    changed = 0
    for i, text in texts.items():
        words = planted(i, WORD.findall(text or ""))
        changed += zlib.crc32(str(i).encode()) % 10 == 0
        if len(words) > 3000:
            continue  # the brute-force version is quadratic
        want, r = all_runs(words), got[i]
        best = min(want, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r["n_runs"] == len(want)
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(kept(words, want).encode()).hexdigest()
    assert changed > 5


# --- top-k ---------------------------------------------------------------------------------
def top(rows, asks, k=5):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in sound:
        if asks(i):
            held = lambda s: max(min(s, 2**63 - 1), -2**63)
            near = sorted((-held(sum(a * b for a, b in zip(v, w, strict=False))), j) for j, w in sound if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


def search(spark, rows, every=5, k=5, parts=3, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(parts)
    return sorted(map(tuple, blocksearch.top_k(spark, df, F.col("vec_id") % every == 0, k).collect()))


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(i, np.float32(centres[i // 150 % 6] + rng.normal(size=8) / 9).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # a third of the rows share a vector
    assert search(spark, rows) == top(rows, lambda i: i % 5 == 0)
    for name, n in (("SHARD", 2), ("CHUNK", 1)):
        monkeypatch.setattr(blocksearch, name, n)
    assert search(spark, rows, parts=2) == top(rows, lambda i: i % 5 == 0)


def test_top_k_skips_blocks_by_their_bounds(monkeypatch):
    import pandas as pd
    rng = np.random.default_rng(4)
    matrix = [np.floor(rng.normal(size=(50, 6)) + 40 * np.eye(6)[b]) for b in range(6)]
    table = pd.DataFrame([{"ids": np.arange(50 * b, 50 * b + 50).tobytes(), "size": 50, "terms": 6, "matrix": m.tobytes(), "block": b}
                          for b, m in enumerate(matrix)])
    seen, scores = [], blocksearch.scores
    monkeypatch.setattr(blocksearch, "scores", lambda a, b: seen.append(len(a)) or scores(a, b))
    got = blocksearch._search(5)(table, table)
    flat = np.concatenate(matrix)
    want = flat @ flat.T
    np.fill_diagonal(want, -1e9)
    for q, part in got.groupby("query_id"):
        assert sorted(part["vec_id"]) == sorted(sorted(range(300), key=lambda j, q=q: (-want[q, j], j))[:5])
    assert sum(seen) < 2 * 300  # of 6 blocks for each of 300 queries


def test_top_k_odd_vectors(spark, nothing):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, None), (10, [1.0, None]), (15, [nan, 1.0]), (20, [inf, 0.0]), (25, []), (30, [1.0]), (None, [1.0, 1.0]),
            (1, [0.5, -0.001]), (2, [0.5, -0.001]), (3, [-1.0, 3.0])]
    assert search(spark, rows) == top(rows, lambda i: i % 5 == 0)
    twice = [(0, [1.0]), (0, [1.0]), (1, [2.0])]
    assert search(spark, twice) == [(0, 1, 1, 2 * 256 * 256)] * 2
    huge = [(0, [1e10, -1e10]), (1, [3e9, 1.5]), (2, [1e300, 1.0]), (3, [-1e300, 0.1])]
    assert search(spark, huge, kind="double") == top(huge, lambda i: i % 5 == 0)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, rank string")
    assert blocksearch.top_k(spark, none, F.col("vec_id") % 50 == 0).count() == 0
    assert search(spark, [(1, [1.0]), (2, [2.0])]) == []


# --- second search of near duplicates ---------------------------------------------------------
def alike_sets(rng, many, size, shared):
    """Sets of shingle hashes that all share some, in groups that share more."""
    base = rng.integers(0, 2**63, shared, dtype=np.uint64)
    group = rng.integers(0, 2**63, (8, size // 10), dtype=np.uint64)
    out = []
    for i in range(many):
        own = rng.integers(0, 2**63, size - shared - size // 10, dtype=np.uint64)
        out.append(np.unique(np.concatenate([base, group[i % 8], own])))
    return out


def block(sets):
    return pa.table({"doc": pa.array(range(len(sets)), pa.int64()), "component": pa.array(range(len(sets)), pa.int64()),
                     "outsider": pa.array([2] * len(sets), pa.int32()), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                     "sketch": pa.array([s[:minhash.SKETCH].view(np.int64).tolist() for s in sets], pa.list_(pa.int64()))}).combine_chunks()


def likeness(a, b):
    common = len(np.intersect1d(a, b))
    return common / (len(a) + len(b) - common)


@pytest.mark.parametrize("shared", [750, 800, 820])
def test_second_search_passes_on_a_forest(shared):
    rng = np.random.default_rng(shared)
    for many in (50, 200):
        sets = alike_sets(rng, many, 1000, shared)
        found = minhash._search(block(sets), 0.75)
        assert len(found) < many and all(likeness(sets[a], sets[b]) >= 0.75 for a, b in found)
        root = list(range(many))
        for a, b in found:
            root = [root[a] if r == root[b] else r for r in root]
        assert all(root[a] == root[b] for a in range(many) for b in range(a) if likeness(sets[a], sets[b]) >= 0.75)


def test_second_search_of_long_sets_leaves_no_link_out():
    rng = np.random.default_rng(9)
    for shared in (6900, 7300, 7900):
        sets = alike_sets(rng, 40, 9000, shared)
        found = set(minhash._search(block(sets), 0.75))
        root = list(range(40))
        for a, b in found:
            if likeness(sets[a], sets[b]) >= 0.75:
                root = [root[a] if r == root[b] else r for r in root]
        assert all(root[a] == root[b] for a in range(40) for b in range(a) if likeness(sets[a], sets[b]) >= 0.75)


def test_near_duplicates_of_texts_around_the_threshold(spark):
    rng = np.random.default_rng(12)
    common = [f"c{i}" for i in range(3000)]
    texts = []
    for i in range(60):
        size, share = (300, 0.83) if i < 40 else (3000, 0.85)
        words = common[:size]
        for at in rng.choice(size, int(size * (1 - share) / 5 * rng.uniform(0.4, 1.1)), replace=False):
            words[at] = f"x{i}_{at}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    words = [t.split() for t in texts]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in words]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark, df).collect()}
    assert got == dict(enumerate(root)) and 2 < len(set(root)) < 60


# --- passages by doubling ------------------------------------------------------------------
def stretches(texts, words):
    """Brute force: at each doubled length, what windows shared with another text cover."""
    split = {i: WORD.findall(t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(split):
        first.setdefault(tuple(split[i]), i)
    own = {i: w for i, w in split.items() if first[tuple(w)] == i}
    out, length = [], words
    while True:
        where = collections.defaultdict(set)
        for i, w in own.items():
            for p in range(len(w) - length + 1):
                where[tuple(w[p:p + length])].add(i)
        rows = []
        for i, w in own.items():
            end = -1
            for p in range(len(w) - length + 1):
                if len(where[tuple(w[p:p + length])]) > 1:
                    if p <= end:
                        rows[-1][3] = end = p + length
                    else:
                        end = p + length
                        rows.append([i, length, p, end])
        if not rows:
            return sorted(map(tuple, out))
        out, length = out + rows, 2 * length


@pytest.mark.parametrize("words", [4, 7])
def test_passages_double_until_none_survive(spark, documents, rows, words):
    got = substrings.passages(spark, documents, words)
    assert got.columns == ["doc_id", "length", "start", "end"]
    want = stretches({r[0]: r[1] for r in rows}, words)
    assert sorted(map(tuple, got.collect())) == want and len({w[1] for w in want}) > 3
    some = substrings.passages(spark, documents, words, until=2 * words)
    assert sorted(map(tuple, some.collect())) == [w for w in want if w[1] <= 2 * words]


def test_passages_odd(spark, odd, nothing):
    # the text of row 9 is that of row 5, and "other .." holds it; both stand under doc_id 5
    assert substrings.passages(spark, odd, 10).where("doc_id is null").count() == 0
    assert substrings.passages(spark, nothing).count() == 0


def test_token_indices_are_as_wide_as_the_words_need():
    assert [lm._width(n) for n in (0, 1, 1 << 24, (1 << 24) + 1, 1 << 32)] == [3, 3, 3, 4, 4]
    tokens = np.array([0, 5, (1 << 24) + 7, 3], dtype=np.int64)
    assert (lm._unpacked(lm._packed(tokens, 4), 4, 4) == tokens.astype(np.uint64)).all()


# --- deleted interpolation by hand -----------------------------------------------------------
def hand_scores(rows, train, deleted):
    """Score of each text from plain dictionaries: counts, expectation-maximisation on the deleted fold, mixture."""
    tokens = {i: [*WORD.findall((t or "").translate(LOW)), None] for i, t in rows}

    def counted(ids):
        word, pair = collections.Counter(), collections.Counter()
        for i in ids:
            word.update(tokens[i])
            pair.update(zip([None, *tokens[i]], tokens[i], strict=False))
        return word, pair
    of = lambda n: min(int(n).bit_length(), lm.BUCKETS - 1)
    word, pair = counted([i for i in tokens if train(i)])
    left, left_pair = counted([i for i in tokens if train(i) and not deleted(i)])
    n, known, n_left = sum(word.values()), len(word), sum(left.values())
    coarse = lambda x: 0.0 if x == 0 else 2.0 ** (round(math.log2(x) * lm.FINE) / lm.FINE)
    seen = collections.defaultdict(list)
    for i in tokens:
        if train(i) and deleted(i):
            for v, w in zip([None, *tokens[i]], tokens[i], strict=False):
                c = left[v]
                seen[of(c)].append((coarse((left_pair[v, w] / c if c else 0.0) * (known + 1)), coarse(left[w] / n_left * (known + 1)), 1.0))
    mix = {}
    for b in range(lm.BUCKETS):
        a = [0.4, 0.4, 0.2] if b else [0.0, 0.7, 0.3]
        if not seen[b]:
            mix[b] = mix[b - 1] if b > 1 else [0.0, 0.9, 0.1]
            continue
        for _ in range(lm.ROUNDS):
            share = np.array([0.0 if not b else 0.5, 0.5, 0.5])
            for p in seen[b]:
                part = np.array(p) * a
                share += part / part.sum()
            a = share / share.sum()
        mix[b] = a
    out = {}
    for i, t in tokens.items():
        total = 0.0
        for v, w in zip([None, *t], t, strict=False):
            a, u, z = mix[of(word[v])]
            total += math.log10((a * pair[v, w] / word[v] if word[v] else 0.0) + u * word[w] / n + z / (known + 1))
        out[i] = total
    return out


def test_interpolated_scores_by_hand(spark, documents, rows):
    got = lm.interpolated(spark, documents, F.col("doc_id") % 5 != 2, F.col("doc_id") % 5 == 3).collect()
    want = hand_scores([r[:2] for r in rows], lambda i: i % 5 != 2, lambda i: i % 5 == 3)
    assert {r["doc_id"] for r in got} == set(want)
    for r in got:
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-6, abs=1e-6)
