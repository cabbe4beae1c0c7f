"""Operator 6: personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns (e-mail, IP address, card and phone numbers), applied
to whole texts in linear time. The field then labels tokens (runs without white space) that hold
a digit or an ``@``; all other tokens are clamped to "none" and only act as context. Its
potentials are

* unary: shape, digits, signs and neighbours of a token;
* chain: labels of neighbouring tokens;
* skip: equal labels of distant tokens that are the same or alike (equal digits, or the
  same name before the ``@``), each occurrence being tied to the one before it, so k
  repeats cost k - 1 edges.

Loopy sum-product message passing gives the marginals; tokens that are likely of a kind and
touch no base span become spans of that kind. So a number written once in full marks the
same number written otherwise. Base spans always stay.

The weights are learned by pseudo-likelihood from about ``sample`` windows of text: as many for
each kind as for the others, each around a base span of that kind, and as many from documents with
a digit or an ``@`` but no base span. A rare kind, or one that occurs in long documents only, so has
its share. Windows are chosen by hash and have at most ``WINDOW`` characters on each side of the
span's start.

Memory for a document grows with its tokens by some hundred bytes each: features are numbers in
one array, and messages are worked out block by block.

Results: a null text counts as empty and has no spans; every input row gives one row,
repeated rows included; a null doc_id is carried through; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspend.llm.op08_bpe import slices

# The kinds, in the order that breaks ties, and the patterns of the base spans.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ANY = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
EDGES = re.compile(r"^[^\w+(@]+|[^\w)@]+$")
NO_DIGITS, DIGIT, LETTERS, NINES, WORDS = (re.compile(p) for p in (r"[^0-9]+", r"[0-9]", r"[^\W\d_]+", r"9{5,}", r"\w+"))
SAMPLE = 4000
WINDOW = 2000
BLOCK = 1 << 16
SPACE = 1 << 12
ROUNDS = 30
CERTAIN = 0.9
NONE, LABELS = 0, 1 + len(KINDS)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern: each ``@`` with all local characters before it."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base spans, sorted."""
    if ANY.search(text) is None:
        return []
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _shape(word: str) -> str:
    shape = LETTERS.sub("a", DIGIT.sub("9", word))
    return NINES.sub(lambda m: f"9x{min(len(m[0]), 20)}", shape)


def _features(w: str, digits: str, shape: str, left: str, right: str, before: str, after: str) -> list[int]:
    """The numbers of the features of a token between its neighbours' shapes and the text around it."""
    out = ["bias", "shape " + shape, f"digits {min(len(digits), 24)}", "signs " + "".join(sorted(set(WORDS.sub("", w)))),
           f"letters {any(c.isalpha() for c in w)}", f"at {'@' in w}", f"dots {min(w.count('.'), 5)}"]
    if 14 <= len(digits) <= 19:
        out.append(f"luhn {luhn(digits)}")
    if w.count(".") == 3 and shape.replace(".", "").strip("9") == "":
        out.append(f"byte parts {all(len(p) <= 3 and int(p or 999) <= 255 for p in w.split('.'))}")
    word = (WORDS.findall(before) or ["-"])[-1]
    out.append("before " + _shape(word.lower() if word.isalpha() and len(word) < 12 else "-"))
    out += ["left " + left, "right " + right, f"ends {WORDS.search(after) is None}"]
    return sorted({zlib.crc32(f.encode()) % SPACE for f in out})


class Document:
    """The tokens of a text that the field labels, with features and edges. The features of token i
    are ``columns[first[i]:first[i + 1]]``."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        starts, ends, shapes, names = array("q"), array("q"), [], []
        close = array("b")
        last = 0
        for m in TOKEN.finditer(text):
            core = EDGES.sub("", m[0])
            start = m.start() + (m[0].find(core) if core else 0)
            name = core or m[0]
            gap = text[last:last + 3] if m.start() - last > 2 else text[last:m.start()]
            close.append(len(gap) <= 2 and not gap.strip(" "))
            last = m.end()
            starts.append(start)
            ends.append(start + len(name))
            names.append(name)
            shapes.append(_shape(name))
        n = len(names)
        self.starts, self.ends = np.array(starts, np.int64), np.array(ends, np.int64)
        self.labels = np.zeros(n, np.int64)
        self.covered = np.zeros(n, bool)
        for a, kind, b in reversed(base):
            # the spans are sorted, so are the tokens: those that overlap are neighbours
            lo, hi = np.searchsorted(self.ends, a, "right"), np.searchsorted(self.starts, b, "left")
            self.labels[lo:hi] = 1 + kind
            self.covered[lo:hi] = True
        #: whether a token has the next one beside it
        self.next = np.array(close, bool)[1:]
        columns, first = array("i"), array("q", [0])
        seen: dict[tuple, int] = {}
        ties = set()
        for i, w in enumerate(names):
            digits = NO_DIGITS.sub("", w)
            left = shapes[i - 1] if i and self.next[i - 1] else "-"
            right = shapes[i + 1] if i + 1 < n and self.next[i] else "-"
            columns.extend(_features(w, digits, shapes[i], left, right, text[max(0, starts[i] - 24):starts[i]], text[ends[i]:ends[i] + 24]))
            first.append(len(columns))
            name = w.split("@")[0].lower()
            keys = [("same", w.lower())] * (len(w) >= 5) + [("digits", digits)] * (len(digits) >= 6) + [("name", name)] * (len(name) >= 5)
            for key in keys:
                if key in seen:
                    ties.add((seen[key], i))
                seen[key] = i
        self.columns, self.first = np.array(columns, np.int64), np.array(first, np.int64)
        self.ties = sorted(ties)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Chain edges and skip edges as pairs of token numbers."""
        chain = np.flatnonzero(self.next)
        chain = np.stack([chain, chain + 1], 1) if len(chain) else np.empty((0, 2), np.int64)
        return chain, np.array(self.ties, np.int64).reshape(-1, 2)


def fit(documents: list[Document], steps: int = 150, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unary, chain and skip weights by pseudo-likelihood (Adagrad over all tokens)."""
    unary, chain, skip = np.zeros((SPACE, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)
    base = np.cumsum([0, *(len(d.labels) for d in documents)])
    n = int(base[-1])
    if not n:
        unary[:, NONE] = 1
        return unary, chain, skip
    y = np.concatenate([d.labels for d in documents])
    rows = np.repeat(np.arange(n), np.concatenate([np.diff(d.first) for d in documents]))
    columns = np.concatenate([d.columns for d in documents])
    pairs = [d.edges() for d in documents]
    links = np.concatenate([c + b for (c, _), b in zip(pairs, base)])
    ties = np.concatenate([t + b for (_, t), b in zip(pairs, base)])
    one = np.eye(LABELS)
    sums = [np.full_like(w, 1e-6) for w in (unary, chain, skip)]
    for _ in range(steps):
        z = np.zeros((n, LABELS))
        np.add.at(z, rows, unary[columns])
        np.add.at(z, links[:, 1], chain[y[links[:, 0]]])
        np.add.at(z, links[:, 0], chain[:, y[links[:, 1]]].T)
        for a, b in ((0, 1), (1, 0)):
            np.add.at(z, ties[:, a], one[y[ties[:, b]]] * skip)
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        error = p / p.sum(1, keepdims=True) - one[y]
        gu = np.zeros_like(unary)
        np.add.at(gu, columns, error[rows])
        gc = one[y[links[:, 0]]].T @ error[links[:, 1]] + error[links[:, 0]].T @ one[y[links[:, 1]]]
        gs = sum((error[ties[:, a]] * one[y[ties[:, b]]]).sum(0) for a, b in ((0, 1), (1, 0)))
        for w, g, s in zip((unary, chain, skip), (gu, gc, gs), sums):
            g = g / n + decay * w
            s += g * g
            w -= rate * g / np.sqrt(s)
    # a tie never speaks against agreement
    return unary, chain, np.maximum(skip, 0)


def marginals(document: Document, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities by loopy sum-product with damped parallel messages; tokens inside
    base spans are clamped to their kind."""
    n = len(document.labels)
    first = document.first
    local = np.empty((n, LABELS))
    for a in range(0, n, BLOCK):
        b = min(a + BLOCK, n)
        local[a:b] = np.add.reduceat(unary[document.columns[first[a]:first[b]]], first[a:b] - first[a])
    clamped = np.flatnonzero(document.covered)
    local[clamped] = -50.0
    local[clamped, document.labels[clamped]] = 0
    links, ties = document.edges()
    alike = np.zeros((LABELS, LABELS)) + np.diag(skip)
    # each way of each edge: its ends, its potential, and the way back
    ways = [(links[:, 0], links[:, 1], chain, 1), (links[:, 1], links[:, 0], chain.T, 0),
            (ties[:, 0], ties[:, 1], alike, 3), (ties[:, 1], ties[:, 0], alike, 2)]
    ways = [(source, target, np.exp(kernel - kernel.max()), back) for source, target, kernel, back in ways]
    messages = [np.zeros((len(source), LABELS)) for source, *_ in ways]

    def beliefs() -> np.ndarray:
        out = local.copy()
        for (_, target, _, _), sent in zip(ways, messages):
            np.add.at(out, target, sent)
        return out

    for _ in range(rounds if len(links) + len(ties) else 0):
        belief = beliefs()
        change, sent = 0.0, []
        for (source, _, kernel, back), old in zip(ways, messages):
            new = np.empty_like(old)
            for a in range(0, len(old), BLOCK):
                part = slice(a, a + BLOCK)
                inward = belief[source[part]] - messages[back][part]
                inward -= inward.max(1, keepdims=True)
                outward = np.log(np.exp(inward) @ kernel)
                outward -= outward.max(1, keepdims=True)
                change = max(change, np.abs(outward - old[part]).max())
                new[part] = 0.5 * old[part] + 0.5 * outward
            sent.append(new)
        messages = sent
        if change < 1e-3:
            break
    belief = beliefs()
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(document: Document, weights: tuple[np.ndarray, np.ndarray, np.ndarray], certain: float = CERTAIN) -> list[tuple[int, int, int]]:
    """Spans of neighbouring tokens of one likely kind, outside the base spans."""
    if document.covered.all():
        return []
    p = marginals(document, *weights)
    label = np.where((p.max(1) >= certain) & ~document.covered, p.argmax(1), NONE)
    out: list[tuple[int, int, int]] = []
    for i in np.flatnonzero(label):
        a, b = int(document.starts[i]), int(document.ends[i])
        if out and i and label[i - 1] == label[i] and document.next[i - 1] and out[-1][1] == label[i] - 1:
            out[-1] = (out[-1][0], out[-1][1], b)
        else:
            out.append((a, int(label[i]) - 1, b))
    return out


def window(text: str, a: int, b: int, width: int = WINDOW) -> tuple[int, int]:
    """The range of ``text`` with at most ``width`` characters before ``a`` and after it, cut at spaces
    between it and the span from ``a`` to ``b`` where there are some."""
    lo, hi = max(0, a - width), min(len(text), a + width)
    if lo:
        lo = max(lo, text.find(" ", lo, a))
    if hi < len(text):
        hi = max(text.rfind(" ", b, hi), min(b, hi))
    return lo, hi


def windows(text: str, base: list[tuple[int, int, int]], draw: int, wanted: set[int]) -> Iterator[tuple[int, int, int]]:
    """``kind, start, end`` of one window for each wanted kind of base span, or, in a text without such spans, one of
    no kind (``len(KINDS)``) around a digit or an ``@``. ``draw`` says which of the spans of a kind it is."""
    for kind in sorted(wanted):
        mine = [(a, b) for a, k, b in base if k == kind]
        if mine:
            yield kind, *window(text, *mine[draw % len(mine)])
    if not base and len(KINDS) in wanted:
        n = sum(1 for _ in ANY.finditer(text))
        if n:
            yield len(KINDS), *window(text, *next(islice(ANY.finditer(text), draw % n, None)).span())


def learn(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights from about ``sample`` windows, an equal share for each kind of base span and for none.

    The documents of each kind are counted first; those of a kind whose hash is below the share of
    that kind give a window. Both steps read all documents. Repeated texts give one window.
    """
    share = -(-sample // LABELS)
    some = docs.select("text").where(F.col("text").rlike("[0-9@]")).withColumn("draw", F.xxhash64("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column("text").to_pylist():
                seen.update({k for _, k, _ in base_spans(text)} or {len(KINDS)})
            yield pa.record_batch([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["kind", "n"])

    totals = some.select("text").mapInArrow(count, "kind int, n long").groupBy("kind").agg(F.sum("n").alias("n"))
    # of all hashes, those below this one
    below = {r.kind: share * (1 << 64) // max(r.n, share) - (1 << 63) for r in totals.collect()}

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"kind": [], "draw": [], "labels": [], "first": [], "columns": [], "next": [], "ties": []}
            for text, code in zip(batch.column("text").to_pylist(), batch.column("draw").to_pylist()):
                base = base_spans(text)
                for kind, a, b in windows(text, base, code, {k for k, t in below.items() if code < t}):
                    d = Document(text[a:b], [(max(x, a) - a, k, min(y, b) - a) for x, k, y in base if x < b and y > a])
                    out["kind"].append(kind)
                    out["draw"].append(code)
                    for name in ("labels", "first", "columns", "next"):
                        out[name].append(getattr(d, name).tolist())
                    out["ties"].append([x for pair in d.ties for x in pair])
            types = {"kind": pa.int32(), "draw": pa.int64(), "next": pa.list_(pa.bool_())}
            yield pa.record_batch([pa.array(v, types.get(c, pa.list_(pa.int32()))) for c, v in out.items()], names=list(out))

    most = max(below.values(), default=0)
    lists = ", ".join(f"{c} array<int>" for c in ("labels", "first", "columns"))
    drawn = some.where(F.col("draw") < most) if most < 1 << 63 else some
    drawn = drawn.mapInArrow(draw, f"kind int, draw long, {lists}, next array<boolean>, ties array<int>").dropDuplicates(["kind", "draw"])
    known = []
    for r in drawn.orderBy("draw", "kind").limit(2 * sample).collect():
        d = Document("", [])
        d.labels, d.first, d.columns = (np.array(x, np.int64) for x in (r.labels, r.first, r.columns))
        d.next, d.ties = np.array(r.next, bool), np.array(r.ties, np.int64).reshape(-1, 2).tolist()
        known.append(d)
    return fit(known)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans``: counts of base spans, and the
    base spans and all spans as ``kind:start:end`` joined by commas."""
    weights = learn(docs, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text"):
                part = batch.slice(a, b - a)
                counts, bases, every = [], [], []
                for text in part.column("text").to_pylist():
                    base = base_spans(text or "")
                    counts.append(Counter(k for _, k, _ in base))
                    bases.append(_joined(base))
                    more = added_spans(Document(text, base), weights) if text and ANY.search(text) else []
                    every.append(_joined(sorted(base + more)))
                yield pa.record_batch([part.column("doc_id"), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))),
                                       pa.array(bases, pa.string()), pa.array(every, pa.string())],
                                      names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
