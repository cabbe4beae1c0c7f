"""Operator 3: token ids in binary files, each document compressed with a shared dictionary.

The file format, written and read by Spark so that it works on any store:

``path/dictionary``  one row ``hash, id_bytes, content``: a zstandard dictionary trained on the
    id arrays of a bounded sample of short documents, its sha256, and the bytes of one id.
``path/shards``  one row for each shard of about ``SHARD_BYTES``, in ascending doc_id order of
    ``part, shard``: ``dictionary`` (the hash), ``payload`` (the documents' zstandard frames
    one after another) and the offset index ``doc_ids, ends, counts`` (id, end of the frame in
    the payload, number of ids of each document).

A frame holds one document's ids as little-endian unsigned integers of ``id_bytes`` bytes, so
one document is read by its shard's index and one short decompression (``read_document``).

Texts are encoded by the tokenizers library. Its vocabulary drops white space and never
looks across it, so distinct words are encoded once and documents are put together from
their words' ids.

Results: a null or empty text has the end id alone; rows with a null doc_id come first;
repeated rows are documents of their own, in the order of their texts; an empty table has a
dictionary, no shards and no rows; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adspend.llm.common import per_worker
from adspend.llm.op08_bpe import LATIN_END, WHITE, ragged, slices, table

END_ID = 2
SHARD_BYTES = 1 << 20
SHARD_DOCS = 8192
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 20_000
LEVEL = 3
CACHE_WORDS = 1_000_000
TOGETHER = 1024
# The split inside words, for letters L, numbers N and white space S, and the
# mark of a piece's last token.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[L]+|[N]|[^SLN]+"
END_MARK = "</w>"


def piece_pattern() -> re.Pattern:
    """The vocabulary's own split of a word, spelt out for letters and numbers up to U+024F."""
    chars = [chr(c) for c in range(LATIN_END + 1)]
    classes = {k: re.escape("".join(c for c in chars if unicodedata.category(c)[0] == k)) for k in "LN"} | {"S": re.escape(WHITE)}
    return re.compile(re.sub("[LNS]", lambda m: classes[m[0]], PIECES))


class WordCoder:
    """Ids of texts by a tokenizers vocabulary that works word by word.

    White space never survives its split, so each distinct run without ASCII white space
    (a chunk) is worked out once, and so is each distinct piece of the vocabulary's own
    split inside chunks. Pieces are encoded by the library, many in one call: the last token
    of a piece carries the end mark. Chunks with a special token or characters beyond U+024F
    are given to the library whole.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        words = self.library.get_vocab()
        self.id_bytes = 2 if len(words) <= 1 << 16 else 4
        self.last = np.zeros(max(words.values()) + 1, bool)
        self.last[[i for w, i in words.items() if w.endswith(END_MARK)]] = True
        self.pieces = piece_pattern().findall
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or "(?!)")
        self.marks = os.path.commonprefix([t.content for t in self.library.get_added_tokens_decoder().values()])
        self.beyond = re.compile(f"[^\\x00-{chr(LATIN_END)}]")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.known: list[bytes] = []
        self.piece: dict[str, bytes] = {}

    def learn(self, chunks: list[str]) -> None:
        """The ids of new chunks."""
        parts: list[list[str]] = []
        whole: dict[int, str] = {}
        for k, text in enumerate(chunks):
            lower = text.lower()
            if not text.isascii() and self.beyond.search(lower) or self.marks in text and self.special.search(text):
                whole[k] = text
                parts.append([])
            else:
                parts.append(self.pieces(lower))
        if len(self.piece) > CACHE_WORDS:
            self.piece.clear()
        new = list(set().union(*parts) - self.piece.keys())
        for a in range(0, len(new), TOGETHER):
            some = new[a:a + TOGETHER]
            ids = np.array(self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
            packed = ids.tobytes()
            self.piece.update(zip(some, map(packed.__getitem__, map(slice, [0, *ends], ends))))
        get, before = self.piece.__getitem__, len(self.known)
        self.known += [get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for p in parts]
        if whole:
            for k, found in zip(whole, self.library.encode_batch([*whole.values()], add_special_tokens=False)):
                self.known[before + k] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each closed by the end id, and their ends.

        Arrow splits the texts and finds the distinct chunks, so Python sees each once a call.
        """
        if len(self.number) > CACHE_WORDS:
            self.forget()
        chunks = pyarrow.compute.ascii_split_whitespace(texts.fill_null(""))
        flat = chunks.flatten().dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        numbers = list(map(self.number.__getitem__, distinct))
        if new := len(self.number) - len(self.known):
            self.learn(list(islice(reversed(self.number), new))[::-1])
        sizes = chunks.value_lengths().to_numpy()
        codes = np.insert(flat.indices.to_numpy(), np.cumsum(sizes), len(numbers))
        ids, ends = ragged(*table([*map(self.known.__getitem__, numbers), END_ID.to_bytes(4, "little")], "<u4"), codes)
        return ids, ends[np.cumsum(sizes + 1) - 1] if len(texts) else ends


def train_dictionary(docs: DataFrame, vocabulary: str) -> tuple[bytes, int]:
    """The dictionary and the bytes of an id, from about ``SAMPLE_DOCS`` documents (twice as many
    at most) of at most ``SAMPLE_CHARS`` characters, chosen by a hash of their id."""
    million = 1 << 20
    share = -(-SAMPLE_DOCS * million // max(docs.select("doc_id").count(), SAMPLE_DOCS))
    picked = docs.select("doc_id", "text").where(F.pmod(F.xxhash64("doc_id"), F.lit(million)) < share)
    chosen = picked.where(F.length("text").between(1, SAMPLE_CHARS)).limit(2 * SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = per_worker(("word coder", vocabulary), lambda: WordCoder(vocabulary))
        for batch in batches:
            ids, ends = coder.encode(batch.column("text"))
            yield pa.record_batch([pa.array([x.astype(f"<u{coder.id_bytes}").tobytes() for x in np.split(ids, ends[:-1])], pa.binary())], names=["ids"])

    samples = [bytes(r.ids) for r in chosen.mapInArrow(run, "ids binary").collect()]
    try:
        content = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little to train on: the samples themselves are the dictionary
        content = b"".join(samples)[:DICTIONARY_BYTES]
    return content, WordCoder(vocabulary).id_bytes


def write_files(docs: DataFrame, vocabulary: str, path: str) -> None:
    """Encode every whole text and write the files described above under ``path``."""
    spark = docs.sparkSession
    content, id_bytes = train_dictionary(docs, vocabulary)
    name = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(name, id_bytes, bytearray(content))], "hash string, id_bytes int, content binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = per_worker(("word coder", vocabulary), lambda: WordCoder(vocabulary))
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content) if content else None).compress
        part, shard = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        frames: list[bytes] = []
        counts: list[int] = []
        held = 0

        def close() -> pa.RecordBatch:
            row = [[part], [shard], [name], [b"".join(frames)], [doc_ids], [np.cumsum([len(f) for f in frames])], [counts]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
            return pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds)],
                                   names=["part", "shard", "dictionary", "payload", "doc_ids", "ends", "counts"])

        for batch in batches:
            for a, b in slices(batch, "text"):
                rows = batch.slice(a, b - a)
                ids, ends = coder.encode(rows.column("text"))
                for doc_id, mine in zip(rows.column("doc_id").to_pylist(), np.split(ids, ends[:-1])):
                    doc_ids.append(doc_id)
                    frames.append(compress(mine.astype(f"<u{id_bytes}").tobytes()))
                    counts.append(len(mine))
                    held += len(frames[-1])
                    if held >= SHARD_BYTES or len(frames) >= SHARD_DOCS:
                        yield close()
                        doc_ids, frames, counts, held, shard = [], [], [], 0, shard + 1
        if frames:
            yield close()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "part int, shard int, dictionary string, payload binary, doc_ids array<long>, ends array<long>, counts array<int>"
    ordered.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/shards")


def _dictionary(spark: SparkSession, path: str):
    row = spark.read.parquet(f"{path}/dictionary").first()
    content = bytes(row.content)
    if hashlib.sha256(content).hexdigest() != row.hash:
        raise ValueError(f"{path}: the dictionary does not match its hash")
    return row.hash, row.id_bytes, content


def _opener(name: str, id_bytes: int, content: bytes):
    """A function from a shard's dictionary hash and a frame to the document's ids."""
    decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content) if content else None).decompress

    def ids_of(dictionary: str, frame) -> np.ndarray:
        if dictionary != name:
            raise ValueError(f"a shard was written with dictionary {dictionary}, not {name}")
        return np.frombuffer(decompress(frame), f"<u{id_bytes}")

    return ids_of


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` is the place of its first id in the concatenation of all documents. Starts are
    summed over parts, over the shards of a part, and inside a shard.
    """
    opened = _dictionary(spark, path)
    shards = spark.read.parquet(f"{path}/shards")
    totals = shards.select("part", "shard", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("ids"))
    before = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = totals.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", before(Window.orderBy("part")).alias("part_start"))
    starts = totals.select("part", "shard", before(Window.partitionBy("part").orderBy("shard")).alias("shard_start"))
    starts = starts.join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _opener(*opened)
        for batch in batches:
            for row in batch.to_pylist():
                payload, found, a = memoryview(row["payload"]), [], 0
                for b in row["ends"]:
                    found.append(ids_of(row["dictionary"], payload[a:b]))
                    a = b
                n = [len(x) for x in found]
                yield pa.record_batch([
                    pa.array([row["part"]] * len(n), pa.int32()), pa.array([row["shard"]] * len(n), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(np.cumsum([0, *n])[:-1], pa.int64()), pa.array(n, pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64()),
                ], names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    docs = shards.select("part", "shard", "dictionary", "payload", "doc_ids", "ends").mapInArrow(
        run, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this id: one slice of the payload is read and decompressed."""
    ids_of = _opener(*_dictionary(spark, path))
    shards = spark.read.parquet(f"{path}/shards").where(F.array_contains("doc_ids", F.lit(doc_id)))
    at = shards.select("dictionary", "payload", "ends", F.explode(F.filter(
        F.transform("doc_ids", lambda x, i: F.when(x == doc_id, i)), lambda i: i.isNotNull())).alias("i"))
    begin = F.coalesce(F.get("ends", F.col("i") - 1), F.lit(0))
    frame = F.substring("payload", (begin + 1).cast("int"), (F.get("ends", "i") - begin).cast("int"))
    return [ids_of(r.dictionary, bytes(r.frame)) for r in at.select("dictionary", frame.alias("frame")).collect()]
