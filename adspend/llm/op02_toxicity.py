"""Operator 2: toxicity of texts whose words may be disguised.

1. A character model (letter 4-grams, smoothed downwards) is counted over the words of all
   documents. Its table has ``len(LETTERS) ** 4`` cells, whatever the corpus.
2. Words with look-alikes, signs, repeated letters or spaced-out letters become a lattice
   of letters they may stand for; a Viterbi search under the character model restores them.
   Two or three single letters in a row, and neighbours of at most ``PIECE`` letters, are also
   read as one word where that costs less. All other words are their own restoration.
3. A logistic model over restored words and their beginnings is learned from labelled
   documents. ``sample`` bounds the labelled documents used (chosen by hash), ``features`` the
   words offered to it (those that go best with the label); an L1 penalty leaves few of them. Near copies in the sample
   count once, else the words of one text that was copied would go with its label. Documents whose
   ``crc32(doc_id) mod 4`` is 2 are held out: their labels are never read.
4. Every whole text is restored and scored.

Nothing but the text enters a score. Results: null and empty texts get the score of a text
without known words; every input row gives one row, repeated rows included; a null doc_id
counts as the empty id; without usable labels no word is known and every score is about 0;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspend.llm.common import id_remainder, per_worker, written
from adspend.llm.lattice import INDEX, PLAIN, Restorer, char_model, ngram_counts
from adspend.llm.op08_bpe import slices
from adspend.llm.shingles import Words, shingle_sets, superminhash

FOLDS, HELD_OUT = 4, 2
SAMPLE = 12_000
FEATURES = 400
THRESHOLD = 0.3
SPACED = 4
PIECE = 4
CACHE_WORDS = 250_000
CALL_BYTES = 2 << 20
L1 = 2e-4
MARKS = 8
PREFIXES = range(3, 8)
MOST = 3


def character_counts(docs: DataFrame) -> DataFrame:
    """``gram, n``: letter n-grams of the words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        grams: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    words.update(text.lower().split())
                if len(words) > CACHE_WORDS:
                    grams.update(ngram_counts(words))
                    words.clear()
        grams.update(ngram_counts(words))
        yield pa.record_batch([pa.array(list(grams), pa.int64()), pa.array(list(grams.values()), pa.int64())], names=["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def learn_characters(docs: DataFrame) -> np.ndarray:
    table = character_counts(docs).toPandas()
    return char_model(table["gram"].to_numpy(np.int64), table["n"].to_numpy(np.float64))


class Reader:
    """Restored words of texts; the words of a task are numbered and restored once.

    With more than ``CACHE_WORDS`` words those that came again stay, at most half as many, and the
    others go: most words of a corpus come once, and a few come all the time.
    """

    def __init__(self, model: np.ndarray):
        self.restorer = Restorer(model)
        self.resets = 0
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.restored: list[list[str]] = []
        self.times = np.empty(0, np.int64)
        self.single = np.empty(0, bool)
        self.piece = np.empty(0, bool)
        self.letters, self.costs = np.empty((0, 6), np.int8), np.empty((0, 2), np.float32)
        self.short: dict[str, list[str]] = {}

    def reset(self) -> None:
        """Number the words that stay anew; the next time only those that come again until then stay."""
        self.resets += 1
        often = np.argsort(-self.times, kind="stable")[:CACHE_WORDS // 2]
        stays = np.sort(often[self.times[often] > 1])
        names = list(self.number)
        self.number = defaultdict(count(len(stays)).__next__, ((names[i], k) for k, i in enumerate(stays.tolist())))
        self.restored = [self.restored[i] for i in stays.tolist()]
        self.single, self.piece, self.letters, self.costs = (x[stays] for x in (self.single, self.piece, self.letters, self.costs))
        self.times = np.zeros(len(stays), np.int64)
        self.short = {}

    def together(self, text: str) -> list[str]:
        """The words behind two or three single signs that stood apart."""
        if text not in self.short:
            letters = any(c in INDEX for c in text)
            self.short[text] = self.restorer.decode(text, spaced=True) if letters else self.restorer.signs(text, spaced=True)
        return self.short[text]

    def read(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
        """For each text the numbers of its words, and the words restored from spaced letters and pieces."""
        if len(self.number) > CACHE_WORDS:
            self.reset()
        number = self.number.__getitem__
        codes = [np.fromiter(map(number, (text or "").lower().split()), np.int64) for text in texts]
        fresh = list(self.number)[len(self.restored):]
        self.restored += map(self.restorer.words, fresh)
        self.single = np.append(self.single, np.fromiter((len(w) == 1 for w in fresh), bool, len(fresh)))
        self.piece = np.append(self.piece, np.fromiter((len(w) <= PIECE and PLAIN.fullmatch(w) is not None for w in fresh), bool, len(fresh)))
        self.times = np.append(self.times, np.zeros(len(fresh), np.int64))
        self.times += np.bincount(np.concatenate([np.empty(0, np.int64), *codes]), minlength=len(self.times))
        at = np.flatnonzero(self.piece[len(self.piece) - len(fresh):])
        letters, costs = np.zeros((len(fresh), 6), np.int8), np.zeros((len(fresh), 2), np.float32)
        letters[at], costs[at] = self.restorer.outline([fresh[i] for i in at])
        self.letters, self.costs = np.concatenate([self.letters, letters]), np.concatenate([self.costs, costs])
        names = list(self.number)
        for mine in codes:
            spaced: list[str] = []
            alone = self.single[mine]
            if alone.sum() >= 2:
                edges = np.flatnonzero(np.diff(np.concatenate([[0], alone.view(np.int8), [0]])))
                for a, b in edges.reshape(-1, 2):
                    if b - a >= 2:
                        text = "".join(names[i] for i in mine[a:b])
                        spaced += self.restorer.decode(text, spaced=True) if b - a >= SPACED else self.together(text)
            piece = self.piece[mine]
            left = np.flatnonzero(piece[:-1] & piece[1:] & ~(alone[:-1] & alone[1:]))
            left = left[self.restorer.joins(self.letters, self.costs, mine[left], mine[left + 1])] if len(left) else left
            for part in np.split(left, np.flatnonzero(np.diff(left) > 1) + 1) if len(left) else ():
                spaced.append("".join(names[i] for i in mine[part[0]:part[-1] + 2]))
            yield mine, spaced


def reader_maker(spark: SparkSession, model: np.ndarray):
    """A function by which tasks get the reader of their worker process; words it has restored for
    one task it knows in the next, as long as the model is the same. A worker holds one model, one
    reader and one scorer at most: with another model all of them go."""
    shared, digest = spark.sparkContext.broadcast(model), hashlib.sha256(model.tobytes()).hexdigest()

    def reader() -> Reader:
        held = per_worker("toxicity", dict)
        if held.get("model") != digest:
            held.clear()
            held.update(model=digest, reader=Reader(shared.value))
        return held["reader"]

    return reader


def restored_words(docs: DataFrame, model: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns ``keep``, ``words`` (the distinct restored words of each text) and ``marks``
    (a short signature of its shingles, by which near copies know each other)."""
    reader_of = reader_maker(docs.sparkSession, model)
    schema = T.StructType([*docs.select(*keep).schema, T.StructField("words", T.ArrayType(T.StringType())),
                           T.StructField("marks", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, plain = reader_of(), Words()
        for batch in batches:
            for a, b in slices(batch, "text", CALL_BYTES):
                part = batch.slice(a, b - a)
                marks = superminhash(*shingle_sets(*plain.of(part.column("text").to_pylist())), MARKS).view(np.int64)
                words = [sorted({w for i in set(mine.tolist()) for w in reader.restored[i]} | set(spaced))
                         for mine, spaced in reader.read(part.column("text").to_pylist())]
                yield pa.record_batch([*(part.column(k) for k in keep), pa.array(words, pa.list_(pa.string())),
                                       pa.array(list(marks), pa.list_(pa.int64()))], names=[*keep, "words", "marks"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def traits(word: str) -> list[str]:
    """What the model may know of a word: itself, and its beginnings (marked by ``*``)."""
    return [word, *(word[:n] + "*" for n in PREFIXES if n < len(word))]


def doc_traits(words: list[str]) -> set[str]:
    """The traits of a document's distinct words, with a number where several words have one."""
    seen = Counter(t for w in words for t in traits(w))
    return {t if k == 1 else f"{t}{k}" for t, n in seen.items() for k in range(1, min(n, MOST) + 1)}


def trait_counts(seen: DataFrame) -> DataFrame:
    """``word, n, t``: documents and toxic documents with each trait; each task sums its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter = Counter()
        toxic: Counter = Counter()
        for batch in batches:
            for label, words in zip(batch.column("toxic").to_pylist(), batch.column("words").to_pylist()):
                mine = doc_traits(words)
                every.update(mine)
                if label > 0:
                    toxic.update(mine)
        names = list(every)
        yield pa.record_batch([pa.array(names, pa.string()), pa.array([every[w] for w in names], pa.int64()),
                               pa.array([toxic[w] for w in names], pa.int64())], names=["word", "n", "t"])

    counted = seen.select("toxic", "words").mapInArrow(run, "word string, n long, t long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def fit_words(x: np.ndarray, y: np.ndarray, l1: float = L1, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty and no negative weights, by accelerated proximal gradient."""
    n, k = x.shape
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    step = 4 / (1 + (np.linalg.norm(x, 2) ** 2 / n if k else 0))
    v, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(x @ v + vb))) - y
        new = np.maximum(v - step * (x.T @ error / n) - step * l1, 0)
        newb = vb - step * error.mean()
        grown = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = new + (t - 1) / grown * (new - w), newb + (t - 1) / grown * (newb - b)
        w, b, t = new, newb, grown
    return w, b


def one_of_each(rows: list) -> list[int]:
    """The first doc_id of each group of rows that share a mark, for a bounded list of rows."""
    parent: dict = {}

    def find(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for r in rows:
        for place, mark in enumerate(r.marks):
            a, b = find((place, mark)), find(r.doc_id)
            if a != b:
                parent[a] = b
    first: dict = {}
    for r in rows:
        first.setdefault(find(r.doc_id), r.doc_id)
    return list(first.values())


def learn_words(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample: int = SAMPLE, features: int = FEATURES) -> tuple[dict[str, float], float]:
    """Weights of words and the bias, from at most about ``sample`` labelled documents."""
    spark = docs.sparkSession
    known = (labels.where("doc_id is not null and toxic is not null").where(id_remainder("doc_id", FOLDS) != HELD_OUT)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = known.count()
    million = 1 << 20
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(million)) < -(-sample * million // max(total, sample)))
    # `chosen` has about `sample` rows of two numbers, at most
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # of several texts of one id always the same one
    texts = texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    seen = written(restored_words(texts, model, ["doc_id", "toxic"]), "sample")
    apart = one_of_each(seen.select("doc_id", "marks").orderBy("doc_id").collect())
    if not apart:
        return {}, -20.0
    seen = seen.join(F.broadcast(spark.createDataFrame([(i,) for i in apart], "doc_id long")), "doc_id")
    n, positive = seen.agg(F.count("*"), F.sum((F.col("toxic") > 0).cast("int"))).first()
    by_word = trait_counts(seen)
    expected = F.col("n") * (positive / n)
    gain = (F.col("t") - expected) / F.sqrt(expected + 1)
    best = by_word.where(F.col("t") >= 3).where(F.col("t") > 2 * expected).orderBy(F.desc(gain), "word").limit(features)
    names = [r.word for r in best.collect()]
    place = {w: i for i, w in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [sorted(place[t] for t in doc_traits(words) if t in place) for words in batch.column("words").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("toxic"), pa.array(places, pa.list_(pa.int32()))],
                                  names=["doc_id", "toxic", "places"])

    rows = seen.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "words").mapInArrow(run, "doc_id long, toxic int, places array<int>")
    x, y = np.zeros((n, len(names)), np.float32), np.zeros(n)
    for i, r in enumerate(rows.orderBy("doc_id").collect()):  # at most about `sample` rows of few words
        y[i] = r.toxic > 0
        x[i, r.places] = 1
    weights, bias = fit_words(x, y)
    return {w: float(v) for w, v in zip(names, weights) if v > 1e-3}, float(bias)


class Scorer:
    """Scores of texts under a learned model; the words that its reader knows are judged once."""

    def __init__(self, reader: Reader, weights: dict[str, float], bias: float):
        self.reader = reader
        names = list(weights)
        self.value, self.bias = np.array([weights[w] for w in names]), bias
        self.place = {w: i for i, w in enumerate(names)}
        # restored words have letters only: digits at the end of a trait count words
        self.asked = {w.rstrip("0123456789") for w in names}
        self.heads = {w[:PREFIXES[0]] for w in self.asked if w.endswith("*")}
        self.told: list[tuple[str, ...]] = []
        self.tells = np.empty(0, bool)
        self.resets = self.reader.resets

    def telling(self, words: list[str]) -> tuple[str, ...]:
        """The words of which the model knows a trait."""
        asked, heads = self.asked, self.heads
        if len(words) == 1 and words[0] not in asked and words[0][:PREFIXES[0]] not in heads:  # nearly all words
            return ()
        return tuple([w for w in words if w in asked or w[:PREFIXES[0]] in heads and any(t in asked for t in traits(w))])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        reader, place = self.reader, self.place
        for k, (mine, spaced) in enumerate(reader.read(texts)):
            if self.resets != reader.resets:
                self.told, self.resets = [], reader.resets
            if len(self.told) < len(reader.restored):
                self.told += map(self.telling, reader.restored[len(self.told):])
                self.tells = np.fromiter(map(bool, self.told), bool, len(self.told))
            words = {w for i in np.unique(mine[self.tells[mine]]).tolist() for w in self.told[i]} if len(mine) else set()
            found = sorted(place[t] for t in doc_traits([*words.union(spaced)]) if t in place)
            out[k] = 1 / (1 + np.exp(-(self.bias + self.value[found].sum())))
        return out


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES):
    """A maker of scorers that tasks call, with the learned model in it."""
    model = learn_characters(docs)
    weights, bias = learn_words(docs, labels, model, sample, features)
    reader_of, fit = reader_maker(docs.sparkSession, model), uuid.uuid4().hex

    def scorer() -> Scorer:
        reader, held = reader_of(), per_worker("toxicity", dict)
        if held.get("fit") != fit:
            held.update(fit=fit, scorer=Scorer(reader, weights, bias))
        return held["scorer"]

    return scorer


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    scorer = learn(docs, labels, sample, features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = scorer()
        for batch in batches:
            for a, b in slices(batch, "text", CALL_BYTES):
                part = batch.slice(a, b - a)
                scores = judge.scores(part.column("text").to_pylist())
                yield pa.record_batch([part.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (id_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below the threshold."""
    scorer = learn(docs, labels, sample, features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = scorer()
        for batch in batches:
            for a, b in slices(batch, "text", CALL_BYTES):
                part = batch.slice(a, b - a)
                yield part.filter(pa.array(judge.scores(part.column("text").to_pylist()) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
