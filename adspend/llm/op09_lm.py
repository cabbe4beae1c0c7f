"""Operator 9: language-model scoring with Elias-Fano bigram tries.

Tokens are the words of a text, then one end; the model sees each token after its
predecessor (the first after a start). Every task sends, for each shard, one packed block of
the records (context, token, document) whose context belongs to the shard: a range of the
64-bit word hashes. One task per shard has all records of its contexts. It

1. asks for the corpus counts of the shard's distinct tokens, by ranges of their hashes (one
   task per range has the exact counts of its words), and sends its share of the sums that
   the smoothing rests on, which come back summed over all shards;
2. counts the training records and builds the shard's trie: contexts, successors and
   quantised smoothed probabilities in Elias-Fano levels (``elias_fano.Trie``);
3. looks up all records, training or not, by successor search relative to their context;
4. returns a partial sum for each document of each block.

The first step and the others read the same shuffle of the records.

So no task holds the whole model and nothing that grows with the corpus is broadcast. Words
with more than ``1/4`` of a shard's share of all tokens are hot (at most four for each shard):
their records are dealt over all shards by context and token, each shard building the
trie of its slice, with the word's exact count, which was taken before.

Smoothing: ``p(w | v) = (1 - b) c(v, w) / c(v) + b q(w)``. ``b`` is the share of tokens that
followed contexts of about equal count just once (a leave-one-out estimate of novelty).
``q`` is the unigram distribution of all training tokens, which leaves the share of the
once-seen words to unseen words, taken to be one more than the vocabulary. Both are counted over
the whole corpus, so shards move a score by no more than the grid of the quantised values.

The base score uses exact counts and no quantised value.

Results: a null or empty text has the end alone; every input row gives one row, repeated rows
included; a null doc_id counts as the empty id; without training documents all counts are 0
and the model is empty; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspend.llm.common import id_remainder, written
from adspend.llm.elias_fano import Trie
from adspend.llm.op08_bpe import slices
from adspend.llm.shingles import Words, mix64

FOLDS, HELD_OUT = 5, 1
SHARD_TOKENS = 1_500_000
LEAST_SHARDS = 12
RANGE_SHARDS = 8
BLOCK_DOCS = 1 << 15
SLICE_BYTES = 4 << 20
START, END = np.uint64(0x5AFE5AFE5AFE5AFE), np.uint64(0xE17DE17DE17DE17D)
HELD = np.uint16(1 << 15)
ORDERS = 65  # binary orders of counts
MESSAGE = "range int, shard int, kind int, n int, payload binary"


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", (id_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: hashes of the training words and their exact counts; tasks sum their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        pending: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            found, inverse = np.unique(np.concatenate([h for h, _ in pending]), return_inverse=True)
            return found, np.bincount(inverse, np.concatenate([c for _, c in pending]), len(found)).astype(np.int64)

        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                pending.append(np.unique(words.of(batch.column("text").slice(a, b - a).to_pylist())[0], return_counts=True))
                if len(pending) >= 4:
                    pending = [merged()]
                if len(pending[0][0]) > 1 << 21:
                    yield pa.record_batch([pa.array(x.view(np.int64)) for x in merged()], names=["word", "n"])
                    pending = []
        if pending:
            yield pa.record_batch([pa.array(x.view(np.int64)) for x in merged()], names=["word", "n"])

    texts = _rows(docs).where("not held_out").select("text")
    return texts.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers, byte plane by byte plane (equal high bytes compress well)."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T) for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in planes))


def _unpack(data: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    raw, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), 0, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def _deal(shards: int, hot: np.ndarray):
    """Packed blocks of records for each shard; ``kind`` 0 has the documents of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, block = Words(), TaskContext.get().partitionId() << 32
        bounds = np.array([(k << 64) // shards for k in range(1, shards)], np.uint64)
        names = ["shard", "block", "kind", "n", "payload"]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            for a, b in slices(batch, "text", SLICE_BYTES):
                for a in range(a, b, BLOCK_DOCS):
                    part = batch.slice(a, min(BLOCK_DOCS, b - a))
                    tokens, sizes = words.of(part.column("text").to_pylist())
                    held = part.column("held_out").to_numpy(zero_copy_only=False)
                    ends = np.cumsum(sizes + 1)
                    context = np.insert(tokens, ends - sizes - 1 - np.arange(len(sizes)), START)
                    token = np.insert(tokens, ends - 1 - np.arange(len(sizes)), END)
                    owner = np.repeat(np.arange(len(sizes), dtype=np.uint16) | np.where(held, HELD, np.uint16(0)), sizes + 1)
                    route = np.where(np.isin(context, hot), mix64(context ^ mix64(token)), context)
                    order = np.argsort(route)
                    edges = np.concatenate([[0], np.searchsorted(route[order], bounds), [len(order)]])
                    ids = part.column("doc_id")
                    info = _pack(np.nan_to_num(ids.fill_null(0).to_numpy()).astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                                 held.astype(np.uint8), (sizes + 1).astype(np.int64))
                    rows = [(block % shards, block, 0, len(sizes), info)]
                    for s in np.flatnonzero(np.diff(edges)).tolist():
                        some = order[edges[s]:edges[s + 1]]
                        c = context[some]
                        gaps = np.diff(c, prepend=np.uint64(0))
                        rows.append((s, block, 1, len(some), _pack(gaps, (token[some] >> np.uint64(32)).astype(np.uint32), owner[some])))
                    block += 1
                    yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

    return run


def _records(blocks: list[dict]) -> tuple[np.ndarray, ...]:
    """Context, token, owner and place among ``blocks`` of a shard's records, ascending by context and token."""
    parts = []
    for r in blocks:
        gaps, token, owner = _unpack(r.pop("payload"), r["n"], "u8", "u4", "u2")
        parts.append((np.cumsum(gaps, dtype=np.uint64), token, owner))
    context, token, owner = (np.concatenate(x) for x in zip(*parts))
    place = np.repeat(np.arange(len(blocks)), [len(p[0]) for p in parts])
    del parts
    order = np.lexsort((token, context))
    return context[order], token[order], owner[order], place[order]


def _pairs(c: np.ndarray, t: np.ndarray, hot: np.ndarray, hot_counts: np.ndarray):
    """Of ascending training records: the contexts, where the pairs of each start, their counts in
    the corpus, and each pair's context (by place), successor and count."""
    new = np.append(True, (c[1:] != c[:-1]) | (t[1:] != t[:-1]))[:len(c)]
    firsts = np.flatnonzero(new)
    pair_counts = np.diff(np.append(firsts, len(c)))
    contexts, starts, owner = np.unique(c[firsts], return_index=True, return_inverse=True)
    totals = np.bincount(owner, pair_counts, len(contexts))
    if len(hot):
        at = np.minimum(np.searchsorted(hot, contexts), len(hot) - 1)
        totals = np.where(hot[at] == contexts, np.maximum(hot_counts[at], totals), totals)
    return contexts, starts, totals, owner, t[firsts], pair_counts


def _novelty_sums(totals: np.ndarray, owner: np.ndarray, pair_counts: np.ndarray) -> np.ndarray:
    """For each binary order of a context's count: once-seen successors, and tokens."""
    order = np.frexp(totals.astype(np.float64))[1][owner]
    return np.array([np.bincount(order, w, ORDERS) for w in (pair_counts == 1, pair_counts)]).astype(np.int64)


def _unigrams(n: float, once: int, vocabulary: int) -> tuple[float, float]:
    """The share of one token in ``q``, and the probability of an unseen word."""
    rare = min(max((once + 0.5) / (n + 1), 1e-4), 1 - 1e-4)
    return (1 - rare) / max(n, 1), rare / (vocabulary + 1)


def _ask(hot: np.ndarray, hot_counts: np.ndarray, ranges: int):
    """One shard's distinct tokens for each range of tokens (kind 2), and its part of the novelty
    sums for range 0 (kind 3)."""
    bounds = np.array([-((-k << 32) // ranges) for k in range(1, ranges)], np.uint64)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        blocks = [r for r in table.to_pylist() if r["kind"] == 1]
        rows = []
        if blocks:
            context, token, owner, _ = _records(blocks)
            train = owner < HELD
            _, _, totals, owner, _, pair_counts = _pairs(context[train], token[train], hot, hot_counts)
            rows.append((0, 3, 2 * ORDERS, _pack(_novelty_sums(totals, owner, pair_counts).reshape(-1))))
            token = np.unique(token)
            for k, part in enumerate(np.split(token, np.searchsorted(token, bounds))):
                if len(part):
                    rows.append((k, 2, len(part), _pack(np.diff(part, prepend=np.uint32(0)))))
        return _messages([(k, key[0].as_py(), *rest) for k, *rest in rows])

    return run


def _messages(rows: list[tuple]) -> pa.Table:
    """Rows by the schema ``MESSAGE``."""
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * 5
    return pa.table([pa.array(v, k) for v, k in zip(columns, kinds)], names=["range", "shard", "kind", "n", "payload"])


def _count_blocks(ranges: int):
    """Packed blocks of ``word, n`` rows for each range of tokens (kind 4)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token = (batch.column("word").to_numpy().view(np.uint64) >> np.uint64(32)).astype(np.uint64)
            n = batch.column("n").to_numpy()
            order = np.argsort(token)
            token, n = token[order], n[order]
            home = (token * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            edges = np.searchsorted(home, np.arange(ranges + 1))
            rows = [(k, -1, 4, int(b - a), _pack(token[a:b].astype(np.uint32), n[a:b]))
                    for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
            yield from _messages(rows).to_batches()

    return run


def _answer(train_docs: int, ranges: int):
    """To each shard the corpus counts of the tokens it asked for, in their order (kind 2); range 0
    also returns the novelty sums of all shards (kind 3)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows, here = table.to_pylist(), key[0].as_py()
        known = [_unpack(r["payload"], r["n"], "u4", "i8") for r in rows if r["kind"] == 4]
        end = END >> np.uint64(32)
        if int(end) * ranges >> 32 == here:
            known.append([np.array([end], np.uint32), np.array([train_docs], np.int64)])
        words, inverse = np.unique(np.concatenate([np.zeros(0, np.uint32), *(k[0] for k in known)]), return_inverse=True)
        counts = np.append(np.bincount(inverse, np.concatenate([np.zeros(0, np.int64), *(k[1] for k in known)]), len(words)), 0).astype(np.int64)
        words = np.append(words, np.uint32(0))
        out = []
        for r in rows:
            if r["kind"] == 2:
                token = np.cumsum(_unpack(r["payload"], r["n"], "u4")[0], dtype=np.uint32)
                at = np.searchsorted(words[:-1], token)
                out.append((here, r["shard"], 2, r["n"], _pack(np.where(words[at] == token, counts[at], 0))))
        sums = [r for r in rows if r["kind"] == 3]
        if sums:
            whole = _pack(np.sum([_unpack(r["payload"], r["n"], "i8")[0] for r in sums], axis=0))
            out += [(here, r["shard"], 3, 2 * ORDERS, whole) for r in sums]
        return _messages(out)

    return run


def _score(hot: np.ndarray, hot_counts: np.ndarray, tokens: int, once: int, vocabulary: int):
    """The partial sums of one shard's records, with what was answered to the shard."""

    def run(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out = [(r["block"], 0, r["n"], r["payload"]) for r in rows if r["kind"] == 0]
        blocks = [r for r in rows if r["kind"] == 1]
        if blocks:
            answers = sorted(told.to_pylist(), key=lambda r: (r["kind"], r["range"]))
            seen = np.concatenate([_unpack(r["payload"], r["n"], "i8")[0] for r in answers if r["kind"] == 2])
            sums = _unpack(answers[-1]["payload"], 2 * ORDERS, "i8")[0].reshape(2, ORDERS)
            context, token, owner, place = _records(blocks)
            base, known, model = _sums(context, token, owner < HELD, hot, hot_counts, vocabulary, (seen, tokens, once, sums))
            owner &= ~HELD
            order = np.argsort(place, kind="stable")
            edges = np.searchsorted(place[order], np.arange(len(blocks) + 1))
            for k, r in enumerate(blocks):
                some = order[edges[k]:edges[k + 1]]
                docs, inverse = np.unique(owner[some], return_inverse=True)
                sums = [np.bincount(inverse, x[some], len(docs)) for x in (base, known, model)]
                out.append((r["block"], 1, len(docs), _pack(docs, sums[0], sums[1].astype(np.uint32), sums[2].astype(np.float32))))
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        columns = zip(*((key[0].as_py(), *row) for row in out)) if out else [[]] * 5
        return pa.table([pa.array(v, k) for v, k in zip(columns, kinds)], names=["shard", "block", "kind", "n", "payload"])

    return run


def _sums(context: np.ndarray, token: np.ndarray, train: np.ndarray, hot: np.ndarray, hot_counts: np.ndarray, vocabulary: int, corpus: tuple | None = None):
    """For records ascending by context and token: log10(c + 0.5) of the context as a word,
    whether it is known, and log10 p of the token after the context.

    ``corpus``: the counts of the distinct tokens in their order, the numbers of all tokens and of
    once-seen words, and the novelty sums; without it the records are the whole corpus.
    """
    contexts, starts, totals, owner, pair_token, pair_counts = _pairs(context[train], token[train], hot, hot_counts)
    words = np.unique(token)
    if corpus is None:
        seen = np.bincount(np.searchsorted(words, pair_token), pair_counts, len(words))
        corpus = seen, seen.sum(), (seen == 1).sum(), _novelty_sums(totals, owner, pair_counts)
    seen, n, once, sums = corpus
    share, unseen = _unigrams(n, once, vocabulary)
    q = np.where(seen > 0, share * seen, unseen)

    b = np.clip((sums[0] + 0.5) / (sums[1] + 1), 1e-4, 1 - 1e-4)
    novelty = b[np.frexp(totals.astype(np.float64))[1]]
    hit = (1 - novelty[owner]) * pair_counts / np.maximum(totals, 1)[owner] + novelty[owner] * q[np.searchsorted(words, pair_token)]
    trie = Trie(contexts, np.append(starts[1:], len(pair_token)) if len(starts) else starts, pair_token, np.log10(hit), np.log10(novelty))

    place, known, pair, follows = trie.search(context, token)
    lower = np.log10(q)[np.searchsorted(words, token)]
    model = np.where(known, trie.back[np.where(known, place, 0)], 0.0) + lower if len(contexts) else lower
    model[follows] = trie.hit[pair[follows]]

    number = np.zeros(len(context))
    if len(contexts):
        number = np.where(known, totals[np.where(known, place, 0)], 0)
    if len(hot):  # a slice without training records still knows the count of its word
        at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
        number = np.where(hot[at] == context, hot_counts[at], number)
    word = context != START
    return np.where(word, np.log10(number + 0.5), 0.0), word & (number > 0), model


def _total(train_docs: int, tokens: int, vocabulary: int):
    """The documents of a block with the sums over all shards."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        info = next(r for r in rows if r["kind"] == 0)
        n = info["n"]
        ids, null, held, sizes = _unpack(info["payload"], n, "i8", "u1", "u1", "i8")
        base, known, model = np.full(n, np.log10(train_docs + 0.5)), np.full(n, int(train_docs > 0)), np.zeros(n)
        for r in sorted((r for r in rows if r["kind"] == 1), key=lambda r: r["shard"]):
            docs, b, k, m = _unpack(r["payload"], r["n"], "u2", "f8", "u4", "f4")
            base[docs] += b
            known[docs] += k
            model[docs] += m
        base -= sizes * np.log10(tokens + 0.5 * (vocabulary + 1))
        return pa.table({"doc_id": pa.array(ids, mask=null > 0), "held_out": held > 0, "n_tokens": sizes, "n_known": known.astype(np.int64),
                         "train_tokens": np.full(n, tokens), "base_score": base, "score": model})

    return run


def score(docs: DataFrame, shard_tokens: int = SHARD_TOKENS, least_shards: int = LEAST_SHARDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row."""
    rows = _rows(docs)
    counts = written(word_counts(docs), "words")
    train_docs = rows.where("not held_out").count()
    distinct, words, once = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") == 1)).first()
    tokens, vocabulary, once = words + train_docs, distinct + (train_docs > 0), once + (train_docs == 1)
    shards = max(least_shards, -(-tokens // shard_tokens))
    ranges = max(least_shards, shards // RANGE_SHARDS)
    # at most 4 * shards words, as their counts add up to no more than all tokens
    often = counts.where(F.col("n") > max(tokens // (4 * shards), 1)).orderBy("word").collect()
    hot = np.array([np.uint64(r.word % 2**64) for r in often] + [START], np.uint64)
    hot_counts = np.array([r.n for r in often] + [train_docs], np.int64)
    order = np.argsort(hot)
    hot, hot_counts = hot[order], hot_counts[order]

    dealt = rows.mapInArrow(_deal(shards, hot), "shard int, block long, kind int, n int, payload binary")
    asked = dealt.groupBy("shard").applyInArrow(_ask(hot, hot_counts, ranges), MESSAGE)
    told = asked.unionByName(counts.mapInArrow(_count_blocks(ranges), MESSAGE)).groupBy("range").applyInArrow(_answer(train_docs, ranges), MESSAGE)
    scored = dealt.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(
        _score(hot, hot_counts, tokens, once, vocabulary), "shard int, block long, kind int, n int, payload binary")
    return scored.groupBy("block").applyInArrow(
        _total(train_docs, tokens, vocabulary),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
