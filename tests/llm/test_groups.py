"""Operators 2, 5 and 7, and the pipeline, against plain versions."""

from __future__ import annotations

import gc
import math
import weakref
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from plain import HARD_ROWS, Groups, bpe_digests, line_dedup, mix_places, near_duplicates, shingles, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from adspend.llm import op02_toxicity, op05_minhash, op07_metric, registry
from adspend.llm.components import components
from adspend.llm import lattice
from adspend.llm.lattice import Restorer, char_model, ngram_counts
from adspend.llm.shingles import shingle_sets, superminhash

SMALL = "/root/testdata/sf0.001"


def check_groups(df, rows):
    got = {r.doc_id: (r.component_id, r.kept) for r in df.collect()}
    want = near_duplicates([r for r in rows if r[0] is not None])
    assert {i: v[0] for i, v in got.items() if i is not None} == want
    assert all(kept == (i is None or c == i) for i, (c, kept) in got.items())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_minhash_query(spark, sf):
    path = f"/root/testdata/{sf}"
    df = registry.QUERIES["op5_minhash"](spark, path).cache()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    check_groups(df, rows)
    assert {r.doc_id: r.n_shingles for r in df.collect()} == {i: len(shingles(t)) for i, t in rows}


def test_minhash_on_hard_rows(hard, empty):
    got = op05_minhash.near_duplicates(hard)
    assert got.count() == len(HARD_ROWS)
    check_groups(got, [(r[0], r[1]) for r in HARD_ROWS])
    assert op05_minhash.near_duplicates(empty).count() == 0


def test_chain_of_near_copies_is_searched_in_blocks(spark):
    """A long chain: each text is near the next one only, and one bucket holds many."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 10**6, 120)]
    rows = []
    for k in range(90):
        base[k] = f"changed{k}"
        rows.append((int(rng.permutation(1000)[0]) * 1000 + k, " ".join(base)))
    check_groups(op05_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=4), rows)


def test_superminhash_is_unbiased_and_less_scattered():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(300):
        u = rng.integers(0, 2**63, 40, dtype=np.uint64)
        s = superminhash(np.concatenate([u[:34], u[6:]]), np.array([34, 34]), 128)
        errors.append((s[0] == s[1]).mean() - 28 / 40)
    assert abs(np.mean(errors)) < 0.006
    assert np.std(errors) < 0.85 * math.sqrt(0.7 * 0.3 / 128)


def test_shingle_sets():
    w = np.array([1, 2, 3, 4, 5, 6, 1, 2, 9, 9, 9, 9, 9, 9, 9], np.uint64)
    sets, sizes = shingle_sets(w, np.array([6, 2, 0, 7]))
    assert sizes.tolist() == [2, 1, 0, 1] and len(sets) == 4


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(1, 2), (2, 3), (3, 1), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    g = Groups()
    for a, b in edges:
        g.join(a, b)
    assert got == {x: g.find(x) for e in edges for x in e if x != 5}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_vectors(rows, threshold=0.98):
    usable = [(k, np.array(v, np.float64)) for k, (_, v, label) in enumerate(rows)
              if rows[k][0] is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    g, links = Groups(), [0] * len(rows)
    for a, (i, x) in enumerate(usable):
        for j, y in usable[a + 1:]:
            if rows[i][2] == rows[j][2] and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                links[i] += 1
                links[j] += 1
                g.join(rows[i][0], rows[j][0])
    return sorted(((r[0], n, None if r[0] is None else g.find(r[0])) for r, n in zip(rows, links)), key=str)


@pytest.mark.parametrize("options", [{}, {"cell": 20, "block": 16}, {"cell": 10, "block": 64, "max_pivots": 9}])
def test_metric_join(spark, options):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(260):
        if k % 3 or not rows:
            v = rng.normal(size=12)
        else:
            v = np.array(rows[int(rng.integers(0, len(rows)))][1]) * rng.uniform(0.5, 2) + rng.normal(size=12) * 0.05 * (k % 2)
        rows.append((k, [float(np.float32(x)) for x in v], int(k % 7 == 0)))
    rows += [(300 + k, rows[5][1], rows[5][2]) for k in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = op07_metric.near_vectors(df, **options).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == plain_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_metric_join_on_hard_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one, 1), (2, [2.0, 4.0, 6.0], 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
            (8, [float("nan"), 1.0, 1.0], 1), (9, [float("inf"), 1.0, 1.0], 1), (10, [1.0, None, 3.0], 1), (11, [1.0, 2.0], 1), (11, one, 1),
            (11, one, 1), (None, one, 1), (12, [-1.0, -2.0, -3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("node", "cell", "key", "links", "home")})
    got = op07_metric.near_vectors(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == plain_vectors(rows)
    assert all(r.kept for r in got if r.vec_id is None)
    assert op07_metric.near_vectors(df.limit(0)).count() == 0


def test_metric_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = registry.QUERIES["op7_metric"](spark, SMALL).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == plain_vectors(rows)


@pytest.fixture(scope="module")
def characters(spark):
    return op02_toxicity.learn_characters(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_lattice_restores_disguises(characters):
    restorer = Restorer(characters)
    for token, word in {"1d10t": "idiot", "m0r0n": "moron", "$tup1d": "stupid", "tr4sh": "trash", "scuuuum": "scum", "l.o.s.e.r": "loser",
                        "p@th3tic": "pathetic", "clown$$$": "clown", "the": "the", "ered***": "ered", "d!sgust!ng": "disgusting"}.items():
        assert restorer.words(token) == [word]
    assert restorer.words("4785380592391140") == [] and restorer.words("|") == []
    assert restorer.decode("loser", spaced=True) == ["loser"]
    assert restorer.decode("idiotclown", spaced=True) == ["idiot", "clown"]
    assert np.exp(-characters[1, 2, 3].astype(np.float64)).sum() == pytest.approx(1, rel=1e-4)


def words_model(*frequent):
    counts = ngram_counts(Counter({w: 300 for w in frequent}))
    return char_model(np.array(list(counts), np.int64), np.array(list(counts.values()), float))


def test_lattice_reads_doubled_letters_signs_and_pieces(characters):
    assert [Restorer(characters).words(w) for w in ("iddiot", "mmoronn", "stuupid")] == [["idiot"], ["moron"], ["stupid"]]
    reader = op02_toxicity.Reader(words_model("ass", "slob", "stupid", "letter", "the", "river", "of"))
    restorer = reader.restorer
    assert restorer.words("455") == ["ass"] and restorer.words("$|0b") == ["slob"] and restorer.words("$#1#0#8") == ["slob"]
    assert restorer.words("letter") == ["letter"]
    assert restorer.words("4785380592391140") == restorer.words("日本") == restorer.words("73") == []
    texts = ["the a s s of", "the stu pid river", "the st up id river", "of the river", "the 4 5 5 river", None, "the"]
    assert [spaced for _, spaced in reader.read(texts)] == [["ass"], ["stupid"], ["stupid"], [], ["ass"], [], []]


def test_a_worker_holds_one_model_only(spark, monkeypatch):
    models = iter([words_model("river"), words_model("stone")])
    monkeypatch.setattr(op02_toxicity, "learn_characters", lambda docs: next(models))
    monkeypatch.setattr(op02_toxicity, "learn_words", lambda *args: ({"river": 1.0}, 0.0))
    docs = spark.createDataFrame([(1, "river")], "doc_id long, text string")
    first = weakref.ref(op02_toxicity.learn(docs, docs)().reader)
    op02_toxicity.reader_maker(spark, next(models))()  # the next model's first task, which makes no scorer
    gc.collect()
    assert first() is None


def test_words_that_come_again_stay_known(monkeypatch):
    model = words_model("ass", "slob", "stupid", "letter", "the", "river", "of")
    texts = ["the river of the river", "one 1etter two", "the stu pid river", "$|0b three four", "the river 455 stuupid five"]
    want = [sorted(w for i in mine.tolist() for w in reader.restored[i]) + spaced
            for t in texts for reader in [op02_toxicity.Reader(model)] for mine, spaced in reader.read([t])]
    monkeypatch.setattr(op02_toxicity, "CACHE_WORDS", 5)
    reader = op02_toxicity.Reader(model)
    got = [sorted(w for i in mine.tolist() for w in reader.restored[i]) + spaced for t in texts for mine, spaced in reader.read([t])]
    assert got == want and reader.resets
    list(reader.read(["the river of the river"]))
    reader.reset()
    assert {"the", "river"} <= set(reader.number) and "of" not in reader.number


def test_toxicity_finds_the_other_disguises(spark):
    rng = np.random.default_rng(6)
    plain = ["river", "stone", "garden", "window", "letter", "summer", "bridge", "market"]
    rows, labels = [], []
    for k in range(600):
        text = [plain[i] for i in rng.integers(0, 8, 30)]
        if k % 4 == 0:
            text[7:7] = [("slob", "stupid")[k // 4 % 2]]
        rows.append((k, " ".join(text)))
        labels.append((k, int(k % 4 == 0)))
    rows += [(1000 + k, f"river stone {w} garden") for k, w in enumerate(["window", "stuupid", "5108", "stu pid", "sl ob"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in op02_toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert [got[1000 + k] for k in range(5)] == [0, 1, 1, 1, 1]


def test_lattice_search_is_exact(characters, monkeypatch):
    rng = np.random.default_rng(7)
    tokens = ["a" + "".join(rng.choice(list("1168|!@e"), 8)) for _ in range(60)]
    exact = [Restorer(characters)._search(t, False, np.inf)[1].split() for t in tokens]
    assert [Restorer(characters).decode(t) for t in tokens] == exact
    monkeypatch.setattr(lattice, "BEAM", 2)
    assert [Restorer(characters).decode(t) for t in tokens] == exact


def test_toxicity_on_held_out_labels(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet").where("toxic is not null").select("doc_id", "toxic")
    got = registry.QUERIES["op2_toxicity"](spark, path).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit / sum(r.predicted for r in got) > 0.9
    assert hit / sum(r.toxic for r in got) > 0.75
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_toxicity_finds_disguised_words_and_ignores_held_out_labels(spark):
    rng = np.random.default_rng(5)
    plain = ["river", "stone", "garden", "window", "letter", "summer", "bridge", "market", "idiot", "winter"]
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        text = [plain[i] for i in rng.integers(0, 8, 30)]
        if toxic:
            text[7:7] = ["idiot"]
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    rows += [(1001, "river stone 1d10t garden"), (1002, "river stone garden"), (1003, "river i d i o t garden stone"), (1004, "the id1oooot window")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in op02_toxicity.toxicity(docs, named).collect()}
    assert [got[k].predicted for k in (1001, 1002, 1003, 1004)] == [1, 0, 1, 1]
    flipped = named.withColumn("toxic", F.when(op02_toxicity.id_remainder("doc_id", 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in op02_toxicity.toxicity(docs, flipped).collect()} == {k: r.score for k, r in got.items()}


def test_toxicity_on_hard_rows(spark, hard, empty):
    labels = spark.createDataFrame([(1, 0, 1), (None, 1, 1), (10, 1, None), (99, 0, 0), (12, 1, 1), (12, 1, 1)], "doc_id long, quality int, toxic int")
    got = op02_toxicity.toxicity(hard, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in HARD_ROWS)
    assert op02_toxicity.toxicity(empty, labels).count() == 0
    assert op02_toxicity.toxicity(hard, labels.limit(0)).where("predicted = 1").count() == 0
    kept = op02_toxicity.without_toxic(hard, labels.limit(0))
    assert kept.columns == hard.columns and kept.count() == len(HARD_ROWS)


def test_pipeline_equals_its_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scorer = op02_toxicity.learn(docs, labels)()
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]

    def plain_score(text):
        read = [scorer.reader.restorer.words(w) for w in (text or "").lower().split()]
        traits = op02_toxicity.doc_traits(list({w for ws in read for w in ws}))
        names = list(scorer.place)
        return 1 / (1 + math.exp(-(scorer.bias + sum(scorer.value[scorer.place[t]] for t in names if t in traits))))

    rows = [r for r in rows if plain_score(r[1]) < op02_toxicity.THRESHOLD]
    texts = line_dedup(rows)
    rows = [(i, new) for (i, old), new in zip(rows, texts) if new == old or words(new)]
    groups = near_duplicates(rows)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i, *bpe_digests(t, library)) for i, t in rows if groups[i] == i)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()) == want


def test_pipeline_rows_are_in_the_mixed_order(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SMALL).cache()
    places = mix_places([(r.doc_id, r.source, r.text) for r in docs.collect()])
    assert len(set(docs.select("source").collect())) > 1
    scattered = docs.repartition(7)  # files are read in any order
    assert {r.doc_id: (r.slot, r.start) for r in corpus_pipeline.bpe(spark, scattered, SMALL).collect()} == places
    order = [r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert order == sorted(places, key=lambda i: (*places[i], i)) != sorted(places)


def test_near_dedup_decides_by_the_text_of_each_row(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(0, a), (1, a + " end"), (1, b), (2, b), (2, b + " end"), (7, c), (7, d), (7, d + " end"), (7, c), (8, ""), (8, None)]
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SMALL).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(0, a), (1, b), (7, c), (7, d), (8, ""), (8, None)], key=str)


def test_pipeline_stages_on_hard_rows(spark, hard, empty):
    for frame, n in ((hard, len(HARD_ROWS)), (empty, 0)):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL).cache()
            if name != "bpe":
                assert docs.columns == frame.columns, name
            assert docs.count() <= n
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, hard, SMALL).collect()}
    assert {1, 2, 3, 4, 9, 10, 11, 12, 13, 14, -15} <= kept and 5 not in kept
