"""Secret scans: fixed patterns, and formats learned by grammar inference.

The fixed patterns find credentials that are labelled by their form.  From a
bounded sample of them (``SAMPLE`` distinct values a kind, the smallest hashes)
one probabilistic automaton a kind is inferred: the values, written in
character classes, form a prefix tree; states whose ending and outgoing
frequencies do not differ by more than Hoeffding's bound allows are merged,
the deepest states last.  All other tokens give a background automaton.

Candidates are all tokens of the alphabet of the labelled values, from their kind's least length up, that no fixed span
covers, letters alone and dotted ones included; a token that a fixed span covers in part is
scored whole.  Each is scored by the mean log-likelihood of its format: it
is a secret if one kind's automaton finds it as likely as that kind's own values
(all but ``MISS`` of them) and likelier than the background does.

No value leaves the worker that found it: what is gathered are classed forms (letters and digits by class) with a
hash that tells distinct values apart.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import textblocks as tb
from ledgerlake.llm.scratch import Scratch, smallest

KINDS = ("assign", "access", "hex")
#: The kind of the spans that the automata add.
LEARNED = "format"
SAMPLE = 2000
MISS = 0.01
ALPHA = 0.05
REDACTED = "<secret>"

# The patterns and least lengths.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_LEAST = 6

#: A candidate: the alphabet of the labelled values, and the least length that any of them may have.
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
#: Verdicts on tokens that a worker keeps.
REMEMBERED = 200_000

Span = tuple[str, int, int]
#: Transitions, ends and passes of each state.
Automaton = list[tuple[dict[str, tuple[int, float]], float]]


def base_spans(text: str) -> tuple[list[Span], list[tuple[str, str]]]:
    """Spans of the fixed patterns in order, and the labelled values."""
    spans, values = [], []
    low = text.lower()
    if any(w in low for w in _WORDS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= _ASSIGN_LEAST:
                spans.append((m.start(), 0, m.end()))
                values.append(("assign", m[2]))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            spans.append((m.start(), 1, m.end()))
            values.append(("access", m[0]))
    for m in _HEX.finditer(text):
        spans.append((m.start(), 2, m.end()))
        values.append(("hex", m[0]))
    return [(KINDS[k], s, e) for s, k, e in sorted(spans)], values


def candidates(text: str, taken: list[Span], wanted: set[str] | None = None) -> list[tuple[int, int]]:
    """Tokens (of those wanted) that no span covers whole."""
    return [(m.start(), m.end()) for m in _TOKEN.finditer(text)
            if (wanted is None or m[0] in wanted) and not any(s <= m.start() and m.end() <= e for _, s, e in taken)]


_CLASS = {**dict.fromkeys("abcdef", "a"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "g"), **dict.fromkeys("ABCDEF", "A"),
          **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "G"), **dict.fromkeys("0123456789", "0")}
_CLASS_SIZE = {"a": 6, "g": 20, "A": 6, "G": 20, "0": 10}


def classes(value: str) -> str:
    return "".join(_CLASS.get(c, c) for c in value)


def infer(values: list[str], alpha: float = ALPHA) -> Automaton:
    """State merging over the prefix tree of the values' classes (a classed form is its own)."""
    child: list[dict[str, int]] = [{}]
    passed: list[dict[str, int]] = [{}]
    ends, visits = [0], [0]
    for value in values:
        s = 0
        visits[0] += 1
        for c in classes(value):
            if c not in child[s]:
                child[s][c] = len(child)
                child.append({})
                passed.append({})
                ends.append(0)
                visits.append(0)
            passed[s][c] = passed[s].get(c, 0) + 1
            s = child[s][c]
            visits[s] += 1
        ends[s] += 1
    width = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > width * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if differ(ends[x], visits[x], ends[y], visits[y]):
                return False
            for c in sorted({*passed[x], *passed[y]}):
                if differ(passed[x].get(c, 0), visits[x], passed[y].get(c, 0), visits[y]):
                    return False
                if c in child[x] and c in child[y]:
                    todo.append((child[x][c], child[y][c]))
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below b to a."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            ends[x] += ends[y]
            visits[x] += visits[y]
            for c, n in passed[y].items():
                passed[x][c] = passed[x].get(c, 0) + n
            for c, t in child[y].items():
                if c in child[x]:
                    todo.append((child[x][c], t))
                else:
                    child[x][c] = t

    red = [0]
    while True:
        blue = {child[r][c]: (r, c) for r in red for c in sorted(child[r]) if child[r][c] not in red}
        if not blue:
            break
        b = max(blue, key=lambda s: (visits[s], -s))
        r, c = blue[b]
        for old in red:
            if compatible(old, b):
                child[r][c] = old
                fold(old, b)
                break
        else:
            red.append(b)
    name = {s: i for i, s in enumerate(red)}
    out = []
    for s in red:
        n = max(visits[s], 1)
        moves = {c: (name[child[s][c]], math.log10(passed[s][c] / n / _CLASS_SIZE.get(c, 1))) for c in child[s] if passed[s].get(c)}
        out.append((moves, math.log10(ends[s] / n) if ends[s] else -3.0))
    return out


def likelihood(value: str, automaton: Automaton) -> float:
    """Mean log10 probability of the characters and the end; a move never seen counts as 10 ** -4."""
    s, total = 0, 0.0
    for c in classes(value):
        moves, _ = automaton[s]
        if c in moves:
            s, p = moves[c]
            total += p
        else:
            total -= 4.0
    return (total + automaton[s][1]) / (len(value) + 1)


class _Smallest:
    """The forms of the values with the smallest hashes, of all that were shown."""

    def __init__(self, size: int):
        self.size, self.held, self.most = size, {}, 1 << 64

    def show(self, value: str) -> None:
        h = xxhash.xxh3_64_intdigest(value)
        if h < self.most:
            self.held[h] = value
            if len(self.held) > 4 * self.size:
                self.held = dict(sorted(self.held.items())[:self.size])
                self.most = max(self.held)

    def forms(self) -> list[tuple[int, str]]:
        return [(h - (1 << 63), classes(v)) for h, v in sorted(self.held.items())[:self.size]]


def _labelled(sample: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task passes on ``sample`` forms a kind at most; the smallest hashes of all are among them
        held = {k: _Smallest(sample) for k in (*KINDS, LEARNED)}
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                others: set[str] = set()
                for text in batch.column(0).slice(lo, 200).to_pylist():
                    if text:
                        spans, values = base_spans(text)
                        for kind, value in values:
                            held[kind].show(value)
                        others.update([text[s:e] for s, e in candidates(text, spans)] if spans else _TOKEN.findall(text))
                for value in others:
                    held[LEARNED].show(value)
        rows = [(k, h, form) for k, x in held.items() for h, form in x.forms()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.string())], names=["kind", "h", "form"])
    return run


#: An automaton, the least likelihood and the least length of its kind's own values.
Model = dict[str, tuple[Automaton, float, int]]


def learn(spark: SparkSession, documents: DataFrame, sample: int = SAMPLE) -> Model:
    """An automaton and a limit for each kind that the documents hold, from however few values, and the background's under LEARNED."""
    scratch = Scratch(spark, "secrets")
    forms = scratch.table(tb.map_batches(documents.select(F.col("text").cast("string").alias("text")),
                                         _labelled(sample), "kind string, h long, form string").distinct())
    model: Model = {}
    for kind in (*KINDS, LEARNED):
        mine = [r["form"] for r in smallest(forms.where(F.col("kind") == kind), sample, "h", "form")]
        if mine:
            own = infer(mine[::2])
            held = sorted(likelihood(v, own) for v in mine[1::2] or mine)
            model[kind] = (own, held[int(MISS * len(held))], min(map(len, mine)))
    scratch.drop(forms)
    return model if any(k in model for k in KINDS) else {}


def judge(value: str, model: Model) -> bool:
    form = classes(value)
    kinds = [k for k in KINDS if k in model and len(form) >= model[k][2]]
    if not kinds:
        return False
    best = [likelihood(form, model[k][0]) for k in kinds]
    background = likelihood(form, model[LEARNED][0]) if LEARNED in model else -4.0
    return any(p >= model[k][1] and p > background for k, p in zip(kinds, best, strict=True))


class Judge:
    """Verdicts of a model, remembered for tokens that come again (REMEMBERED at most)."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def __call__(self, value: str) -> bool:
        verdict = self.known.get(value)
        if verdict is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            verdict = self.known[value] = judge(value, self.model)
        return verdict


def spans_of(text: str | None, model: Model, verdict: Judge | None = None) -> tuple[list[Span], list[Span]]:
    """The spans of the fixed patterns, and all spans, by start and kind."""
    if not text:
        return [], []
    base, _ = base_spans(text)
    if not model:
        return base, base
    verdict = verdict or Judge(model)
    wanted = {t for t in set(_TOKEN.findall(text)) if verdict(t)}
    added = [(LEARNED, s, e) for s, e in candidates(text, base, wanted)] if wanted else []
    if not added:
        return base, base
    rank = {k: i for i, k in enumerate((*KINDS, LEARNED))}
    return base, sorted(base + added, key=lambda x: (x[1], rank[x[0]], x[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(documents: DataFrame, model: Model, *keep: str) -> DataFrame:
    """documents (text, keep ..) -> keep .., base, spans: arrays of (kind, start, end) in code points, end exclusive.

    One row for each input row; null and empty texts have no spans.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdict = Judge(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                both = [spans_of(t, model, verdict) for t in part.column(0).to_pylist()]
                arrays = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x[i]] for x in both], _SPANS) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *arrays], names=[*part.schema.names[1:], "base", "spans"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in documents.select(*keep).schema)
    spans = "array<struct<kind: string, start: bigint, end: bigint>>"
    return tb.map_batches(documents.select(F.col("text").cast("string").alias("text"), *keep), run, f"{fields}base {spans}, spans {spans}")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by REDACTED."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def redact(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with secrets replaced in text; all other columns as they are, null texts stay null."""
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, verdict = names.index("text"), Judge(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [t and redacted(t, spans_of(t, model, verdict)[1]) for t in part.column(at).to_pylist()]
                yield part.set_column(at, "text", pa.array(texts, pa.string()))

    return tb.map_batches(documents, run, documents.schema)
