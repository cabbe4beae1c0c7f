"""Operators 3, 6, 8 and 9, and the models behind them, against plain versions."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import HARD_ROWS, base_lm, base_pii, bpe_digests, interpolated_lm
from tokenizers import Tokenizer

from adspend.llm import op03_token_files, op06_pii, op08_bpe, op09_lm, registry
from adspend.llm.common import scratch
from adspend.llm.elias_fano import CHUNK, Monotone, Trie

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"
TEXTS = st.text(st.one_of(st.sampled_from("aeiou thsnrdlTHE'\n\t.,!01$%ñéß|"), st.characters(codec="utf-8")), max_size=60)


@pytest.fixture(scope="module")
def byte_bpe():
    return op08_bpe.Bpe(BYTE), Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def word_bpe():
    return op03_token_files.WordCoder(WORD), Tokenizer.from_file(WORD)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=4), st.booleans())
def test_byte_bpe_equals_the_library(byte_bpe, texts, special):
    mine, library = byte_bpe
    texts = [t + "<|endoftext|> x" * special for t in texts]
    flat, ends = mine.encode(texts)
    for text, ids in zip(texts, np.split(flat, ends[:-1])):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert mine.decode(ids) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=4), st.booleans())
def test_word_coder_equals_the_library(word_bpe, texts, special):
    mine, library = word_bpe
    texts = [t + "<|startoftext|>" * special for t in texts]
    flat, ends = mine.encode(pa.array(texts, pa.string()))
    for text, ids in zip(texts, np.split(flat, ends[:-1])):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_bpe_of_long_words(byte_bpe):
    import random
    import tracemalloc

    mine, library = byte_bpe
    letters = "".join(random.Random(7).choices("abcdefghijklmnopqrstuvwxyz", k=200_000))
    for text in (letters, "x" * 100_000, "ab" * 50_000, "é" * 30_000, " " * 50_000 + "end"):
        ids, _ = mine.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    tracemalloc.start()
    text = "".join(random.Random(8).choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    ids, _ = mine.encode([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    mine.forget()
    assert mine.decode(ids) == text
    assert peak < 600 << 20


def test_bpe_query(spark, small_rows, byte_bpe, hard, empty):
    got = {r.doc_id: tuple(r)[1:] for r in registry.QUERIES["op8_bpe"](spark, SMALL).collect()}
    assert got == {i: bpe_digests(t, byte_bpe[1]) for i, t in small_rows}
    rows = sorted((tuple(r) for r in op08_bpe.round_trip(hard, BYTE).collect()), key=str)
    assert rows == sorted(((r[0], *bpe_digests(r[1], byte_bpe[1])) for r in HARD_ROWS), key=str)
    assert op08_bpe.round_trip(empty, BYTE).count() == 0


def test_bpe_round_trip_of_the_operator(hard, empty):
    encoded = op08_bpe.encode(hard, BYTE)
    got = sorted(((r.doc_id, r.text) for r in op08_bpe.decode(encoded, BYTE).collect()), key=str)
    assert got == sorted(((r[0], r[1] or "") for r in HARD_ROWS), key=str)
    assert op08_bpe.encode(empty, BYTE).count() == 0


def plain_files(rows, library):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_query(spark, small_rows, word_bpe):
    got = sorted(tuple(r) for r in registry.QUERIES["op3_token_files"](spark, SMALL).collect())
    assert got == plain_files(small_rows, word_bpe[1])


def test_token_files_on_hard_rows(spark, hard, empty, word_bpe, monkeypatch):
    monkeypatch.setattr(op03_token_files, "SHARD_DOCS", 3)
    path = scratch(spark, "tokens")
    op03_token_files.write_files(hard, WORD, path)
    got = sorted((tuple(r) for r in op03_token_files.read_files(spark, path).collect()), key=lambda r: r[1])
    assert got == plain_files([(r[0], r[1]) for r in HARD_ROWS], word_bpe[1])
    for doc_id in (5, 12, 10):
        texts = [r[1] for r in HARD_ROWS if r[0] == doc_id]
        found = op03_token_files.read_document(spark, path, doc_id)
        assert [x.tolist() for x in found] == [[*word_bpe[1].encode(t, add_special_tokens=False).ids, 2] for t in texts]
    path = scratch(spark, "tokens")
    op03_token_files.write_files(empty, WORD, path)
    assert op03_token_files.read_files(spark, path).count() == 0


@settings(max_examples=600, deadline=None)
@given(st.text("ab@@..-+_%1259 ()", max_size=50))
def test_base_spans_equal_the_patterns(text):
    assert op06_pii.base_spans(text) == base_pii(text)


def test_pii_query(spark, small_rows):
    import hashlib

    got = {r.doc_id: r for r in registry.QUERIES["op6_pii"](spark, SMALL).collect()}
    for i, text in small_rows:
        base = base_pii(text)
        joined = [f"{op06_pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in base) for x in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r.spans.split(",")) | {""}


def test_pii_on_hard_rows(hard, empty):
    got = op06_pii.personal_data(hard).collect()
    assert sorted(((r.doc_id, r.base) for r in got), key=str) == sorted(
        ((r[0], ",".join(f"{op06_pii.KINDS[k]}:{a}:{b}" for a, k, b in base_pii(r[1]))) for r in HARD_ROWS), key=str)
    assert op06_pii.personal_data(empty).count() == 0


def test_pii_spans_on_hard_rows(hard):
    first, again = (sorted(((r.doc_id, r.base, r.spans) for r in op06_pii.personal_data(hard).collect()), key=str) for _ in range(2))
    assert first == again and len(first) == len(HARD_ROWS)
    assert all(set(base.split(",")) <= set(spans.split(",")) | {""} for _, base, spans in first)
    assert {(base, spans) for i, base, spans in first if not any(r[1] and op06_pii.ANY.search(r[1]) for r in HARD_ROWS if r[0] == i)} <= {("", "")}


def field(n, links, ties, covered, rng):
    """A document of n tokens with two features each, and random weights."""
    d = op06_pii.Document("", [])
    d.columns, d.first = rng.integers(0, 40, 2 * n), np.arange(0, 2 * n + 1, 2)
    d.next, d.ties = np.isin(np.arange(n - 1), links), ties
    d.covered = np.isin(np.arange(n), covered)
    d.labels = np.where(d.covered, 2, 0)
    return d, (rng.normal(size=(op06_pii.SPACE, op06_pii.LABELS)), rng.normal(size=(op06_pii.LABELS, op06_pii.LABELS)) * 0.5, rng.random(op06_pii.LABELS))


def exact_marginals(d, unary, chain, skip):
    """By the sum over all labellings."""
    import itertools

    n = len(d.labels)
    out = np.zeros((n, op06_pii.LABELS))
    for y in itertools.product(range(op06_pii.LABELS), repeat=n):
        if any(c and a != b for a, b, c in zip(y, d.labels, d.covered)):
            continue
        energy = sum(unary[d.columns[d.first[i]:d.first[i + 1]], y[i]].sum() for i in range(n) if not d.covered[i])
        energy += sum(chain[y[i], y[i + 1]] for i in np.flatnonzero(d.next))
        energy += sum(skip[y[a]] for a, b in d.ties if y[a] == y[b])
        out[np.arange(n), y] += np.exp(energy)
    return out / out.sum(1, keepdims=True)


@pytest.mark.parametrize("links, ties, covered, near", [
    ([0, 1, 2], [], [], 2e-3), ([0, 2], [(1, 3)], [], 2e-3), ([0, 1, 2], [], [1], 2e-3), ([], [(0, 3), (1, 3)], [0], 2e-3), ([], [], [], 1e-9),
    ([0, 1, 2], [(0, 3)], [], 0.08), ([0, 1, 2], [(0, 2), (1, 3)], [2], 0.08)])
def test_marginals_equal_the_sum_over_all_labellings(links, ties, covered, near):
    rng = np.random.default_rng(7)
    for _ in range(5):
        d, weights = field(4, links, ties, covered, rng)
        assert np.abs(op06_pii.marginals(d, *weights) - exact_marginals(d, *weights)).max() < near


def test_marginals_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(documents_with_numbers()[:40])
    d = op06_pii.Document(text, op06_pii.base_spans(text)[::3])
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(op06_pii.SPACE, 5)), rng.normal(size=(5, 5)), rng.random(5)
    whole = op06_pii.marginals(d, *weights)
    monkeypatch.setattr(op06_pii, "BLOCK", 7)
    assert np.allclose(op06_pii.marginals(d, *weights), whole)


def test_pii_of_a_long_number_table():
    import time
    import tracemalloc

    text = "\n".join(" ".join(str((k * 7919 + c * 104729) % 1_000_003) for c in range(8)) for k in range(8_000)) + " +1 555 123 4567"
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(op06_pii.SPACE, 5)) * 0.1, rng.normal(size=(5, 5)), rng.random(5)
    start = time.process_time()
    tracemalloc.start()
    d = op06_pii.Document(text, op06_pii.base_spans(text))
    op06_pii.added_spans(d, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print("tokens", len(d.labels), "chars", len(text), "peak MB", peak / 1e6, "s", time.process_time() - start)
    assert peak < 1200 * len(d.labels)


def test_windows_lie_around_their_spans():
    text = "x " * 5000 + "mail a@b.example here " + "y " * 5000 + "10.0.0.7 " + "z" * 9000
    base = op06_pii.base_spans(text)
    found = {k: text[a:b] for k, a, b in op06_pii.windows(text, base, 12345, {0, 1, 4})}
    assert set(found) == {0, 1}
    assert "a@b.example" in found[0] and "10.0.0.7" in found[1] and all(len(t) <= 2 * op06_pii.WINDOW for t in found.values())
    plain = "q " * 4000 + "77 " + "r" * 9000
    [(kind, a, b)] = op06_pii.windows(plain, [], -3, {0, 4})
    assert kind == 4 and "7" in plain[a:b]
    assert op06_pii.window("1" * 9000, 100, 8000) == (0, 100 + op06_pii.WINDOW)


def test_rare_kind_in_long_texts_is_learned(spark):
    rows = [(k, f"released {1900 + k % 100} as version {k % 9}.1") for k in range(3000)]
    rows += [(5000 + k, "word " * 6000 + t) for k, t in enumerate(documents_with_numbers()[:60])]
    rows.append((9999, "reach me at (555) 123-4567 today"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in op06_pii.personal_data(df, sample=250).collect()}
    assert spans[9999] == "phone:12:26" and not any(spans[k] for k in range(3000))


def documents_with_numbers():
    rng = np.random.default_rng(0)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    texts = []
    for k in range(300):
        texts.append(f"call +1 (555) {digits(3)}-{digits(4)} or version {k % 9}.0 of anno {1900 + k % 100}, mail bob{k}@mail{k % 7}.example.com from 10.0.{k % 250}.7, then bob{k}@mail{k % 7}.example.com")
    return texts


def test_crf_keeps_repeats_consistent():
    texts = documents_with_numbers()
    weights = op06_pii.fit([op06_pii.Document(t, op06_pii.base_spans(t)) for t in texts])
    found = lambda t: [(op06_pii.KINDS[k], t[a:b]) for a, k, b in op06_pii.added_spans(op06_pii.Document(t, op06_pii.base_spans(t)), weights)]
    assert found("reach me at (555) 123-4567 today") == [("phone", "(555) 123-4567")]
    assert found("version 3.0 of anno 1994 and a plain text") == []
    assert (weights[2] >= 0).all() and weights[2].max() > 0
    # a tie moves a doubtful token towards the kind of its twin
    unary, chain, _ = weights
    text = "mail zed_99@corp.example.org and later, far from it, zed_99 again"
    tied, free = (op06_pii.marginals(op06_pii.Document(text, op06_pii.base_spans(text)), unary, chain, s)[1, 1] for s in (np.full(5, 3.0), np.zeros(5)))
    assert tied > free


def test_lm_query(spark, small_rows):
    check_lm(registry.QUERIES["op9_lm"](spark, SMALL), small_rows)


def check_lm(df, rows):
    want = base_lm(rows)
    got = df.collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((i for i, _ in rows), key=str)
    for r in got:
        held, n, known, train, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    return got


def test_lm_does_not_depend_on_the_shards_for_its_base(spark, small_rows):
    docs = spark.createDataFrame(small_rows, "doc_id long, text string")
    got = check_lm(op09_lm.score(docs, shard_tokens=2000, least_shards=3), small_rows)
    # it learns: held-out texts with copies among the training texts are likelier than by words alone
    assert np.mean([r.score - r.base_score for r in got if not r.held_out]) > 0


def test_lm_score_is_that_of_the_whole_corpus_in_any_shards(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = interpolated_lm(rows)
    for options in ({}, {"shard_tokens": 20_000}, {"shard_tokens": 4_000}):
        got = op09_lm.score(docs, **options).collect()
        assert len(got) == len(want)
        # half a step of the grid a token, at most: 256 steps span no more than ten powers of ten
        assert all(abs(r.score - want[r.doc_id]) <= 0.02 * r.n_tokens for r in got)
        assert abs(sum(r.score for r in got) - sum(want.values())) <= 0.003 * sum(r.n_tokens for r in got)


def test_lm_held_out_is_better_than_the_base(spark):
    got = [r for r in registry.QUERIES["op9_lm"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert all(r.score < 0 for r in got)


def test_lm_probabilities_add_up():
    rng = np.random.default_rng(1)
    words = np.sort(rng.integers(0, 1 << 63, 50).astype(np.uint64))
    context, token = words[rng.integers(0, 20, 3000)], (words[rng.integers(0, 50, 3000)] >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((token, context))
    context, token = context[order], token[order]
    tokens = np.unique(np.concatenate([token, (words >> np.uint64(32)).astype(np.uint32)]))
    for c in (words[3], np.uint64(12345)):
        asked_c = np.concatenate([context, np.full(len(tokens) + 1, c)])
        asked_t = np.concatenate([token, tokens, [np.uint32(7)]]).astype(np.uint32)
        train = np.arange(len(asked_c)) < len(context)
        order = np.lexsort((asked_t, asked_c))
        hot = np.array([op09_lm.START])
        model = op09_lm._sums(asked_c[order], asked_t[order], train[order], hot, np.array([0]), len(tokens))[2]
        back = np.empty(len(order))
        back[order] = 10 ** model
        assert back[len(context):].sum() == pytest.approx(1, abs=0.03)  # quantised values


def test_lm_on_hard_rows(hard, empty):
    rows = [(r[0], r[1]) for r in HARD_ROWS]
    got = op09_lm.score(hard, shard_tokens=5000).collect()
    assert sorted((str(r.doc_id) for r in got)) == sorted(str(i) for i, _ in rows)
    want = base_lm(rows)
    for r in got:
        assert r.train_tokens == want[r.doc_id][3]
    assert sorted(r.n_tokens for r in got) == sorted(len((t or "").encode().split()) + 1 for _, t in rows)
    assert op09_lm.score(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**63), max_size=300), st.lists(st.integers(0, 2**63), max_size=50))
def test_elias_fano(values, queries):
    values, queries = np.sort(np.array(values, np.uint64)), np.sort(np.array(queries + values[:20], np.uint64))
    m = Monotone(values, 2**63 + 1)
    place, equal = m.successors(queries)
    assert (place == np.searchsorted(values, queries)).all()
    assert (equal == np.isin(queries, values)).all()


def test_elias_fano_over_chunks():
    values = np.sort(np.random.default_rng(2).integers(0, 1 << 40, 3 * CHUNK + 5, dtype=np.uint64))
    m = Monotone(values, 1 << 40)
    assert (np.concatenate([m.chunk(k) for k in range(4)]) == values).all()
    assert 8 * sum(map(len, m.parts())) / len(values) < 2 + 40 - 17 + 1


def test_trie_search():
    contexts = np.array([5, 9, 1 << 60], np.uint64)
    trie = Trie(contexts, np.array([2, 3, 6]), np.array([1, 4, 4, 0, 7, 9], np.uint32), np.log10(np.arange(1, 7) / 10), np.log10([0.1, 0.2, 0.3]))
    place, known, at, follows = trie.search(np.array([5, 5, 8, 9, 1 << 60, 1 << 60], np.uint64), np.array([1, 2, 4, 4, 7, 8], np.uint32))
    assert known.tolist() == [True, True, False, True, True, True]
    assert follows.tolist() == [True, False, False, True, True, False]
    assert at[follows].tolist() == [0, 2, 4]
