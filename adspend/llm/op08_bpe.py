"""Operator 8: byte-level BPE encoding and decoding over a trie of distinct words.

A BPE encoding has a local description: a token sequence is the encoding of a text exactly
if every two neighbours are the encoding of their own concatenation. So the encoding of
a prefix ends in the one token ``t`` that is a suffix of the prefix and goes with the last
token of what stands before ``t``; that last token is the only state a prefix needs, and
just one ``t`` goes.

The distinct words of a batch are visited in byte order. This is the depth-first traversal
of their trie: ``last[0..n]`` holds the states on the path from the root to the current
node and ``begin[0..n]`` where their tokens begin, so that an encoding is read by going back;
the part shared with the previous word is kept, and only the nodes below it are computed. Time
and memory are linear in the length of a word.

Results: a null text counts as empty; an empty text has no ids; every input row gives one
row, repeated rows included; a null doc_id is carried through; other columns of the input
are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The pattern by which byte-level BPE vocabularies split text into words,
# for letters L, numbers N and white space S.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"
WHITE = "\t\n\x0b\x0c\r \x85\xa0"
# Up to this character the classes are built from unicodedata. Libraries may know different
# Unicode versions beyond it: such texts are split by the tokenizers library itself.
LATIN_END = 0x24F
CACHE_WORDS = 300_000
CACHE_PAIRS = 2_000_000
INF = 1 << 60


def byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def word_pattern() -> re.Pattern:
    chars = [chr(c) for c in range(LATIN_END + 1)]
    classes = {k: re.escape("".join(c for c in chars if unicodedata.category(c)[0] == k)) for k in "LN"}
    return re.compile(re.sub("[LNS]", lambda m: classes.get(m[0], re.escape(WHITE)), WORDS))


def ragged(flat: np.ndarray, edges: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen rows of a ragged table one after another, and the end of each."""
    sizes = (edges[1:] - edges[:-1])[rows]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(edges[:-1][rows] - (ends - sizes), sizes)
    return flat[at], ends


def table(values: list[bytes], kind: str = "u1") -> tuple[np.ndarray, np.ndarray]:
    """A ragged table of byte strings: all values joined, and their edges in items of ``kind``."""
    edges = np.cumsum([0, *map(len, values)]) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(values), kind), edges


class Bpe:
    """A vocabulary file of the tokenizers library, prepared for the trie traversal."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        raw = lambda s: bytes(chars[c] for c in s)
        model = spec["model"]
        self.id_of = {raw(t): i for t, i in model["vocab"].items()}
        self.bytes_of = {i: t for t, i in self.id_of.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.tails = {t[k:] for t in self.id_of for k in range(len(t))}
        size = 1 + max(self.bytes_of)
        self.size = size
        self.rank: dict[int, int] = {}
        self.born = [-1] * size
        self.left, self.right = list(range(size)), list(range(size))
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y = raw(a), raw(b)
            i, j, k = self.id_of[x], self.id_of[y], self.id_of[x + y]
            self.rank[i * size + j] = r
            if self.born[k] < 0:
                self.born[k], self.left[k], self.right[k] = r, i, j
        self.whole = {i: self.born[i] < 0 and len(t) == 1 or self.born[i] >= 0 and self.goes(self.left[i], self.right[i], self.born[i])
                      for t, i in self.id_of.items()}
        self.words = word_pattern()
        self.beyond = re.compile(f"[^\\x00-{chr(LATIN_END)}]")
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.packed = {i: i.to_bytes(4, "little") for i in self.bytes_of}
        every = range(size)
        self.token_bytes = table([self.bytes_of.get(i, b"") for i in every])
        self.token_text = table([f"{i},".encode() for i in every])
        self.library = None
        self.forget()

    def forget(self) -> None:
        """Empty the caches: numbers of known words, their ids, and which token may follow which."""
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.known: list[bytes] = []
        self.pairs: dict[int, bool] = {}

    def goes(self, a: int, b: int, until: int = INF) -> bool:
        """Whether no merge earlier than ``until`` crosses the border between tokens a and b.

        The pieces at the border grow as merges run: the right spine of a and the left
        spine of b. A crossing merge wins if it comes before the next merge of either side;
        of equal ranks the one further left runs first.
        """
        ups, downs, born = [a], [b], self.born
        while born[ups[-1]] >= 0:
            ups.append(self.right[ups[-1]])
        while born[downs[-1]] >= 0:
            downs.append(self.left[downs[-1]])
        i, j = len(ups) - 1, len(downs) - 1
        while True:
            r = self.rank.get(ups[i] * self.size + downs[j], INF)
            na = born[ups[i - 1]] if i else until
            nb = born[downs[j - 1]] if j else until
            if r < na and r <= nb and r < until:
                return False
            if not i and not j:
                return True
            if i and (na <= nb or not j):
                i -= 1
            else:
                j -= 1

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words as bytes, by one traversal of their trie."""
        find, tails, packed, whole, size, pairs = self.id_of.get, self.tails, self.packed, self.whole, self.size, self.pairs
        out = [b""] * len(words)
        begin, last = [0], [-1]
        before = b""
        for word, place in sorted((w.encode("utf-8", "surrogatepass"), i) for i, w in enumerate(words)):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del begin[shared + 1:], last[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                start = end - 1
                while (tail := word[start:end]) in tails:
                    t = find(tail, -1)
                    if t >= 0:
                        if not start:
                            fits = whole[t]
                        elif (fits := pairs.get(key := last[start] * size + t)) is None:
                            if len(pairs) > CACHE_PAIRS:
                                pairs.clear()
                            fits = pairs[key] = whole[t] and self.goes(last[start], t)
                        if fits:
                            break
                    start -= 1
                last.append(t)
                begin.append(start)
            ids, end = [], len(word)
            while end:
                ids.append(packed[last[end]])
                end = begin[end]
            out[place] = b"".join(reversed(ids))
            before = word
        return out

    def split(self, text: str) -> list[str]:
        if self.beyond.search(text) is None:
            return self.words.findall(text)
        if self.library is None:
            from tokenizers.pre_tokenizers import ByteLevel
            self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        spans = self.library.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in spans]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the end of each text's.

        A special token's string in a text is that token, as in the library.
        """
        if len(self.number) > CACHE_WORDS:
            self.forget()
        number, words, sizes = self.number.__getitem__, [], []
        for text in texts:
            n = len(words)
            if self.special and text and any(s in text for s in self.special):
                for k, part in enumerate(self.split_special.split(text)):
                    words += [-1 - self.special[part]] if k % 2 else map(number, self.split(part))
            elif text:
                words += map(number, self.split(text))
            sizes.append(len(words) - n)
        codes = np.array(words, np.int64)
        if new := len(self.number) - len(self.known):
            self.known += self.learn(list(islice(reversed(self.number), new))[::-1])
        flat, edges = table(self.known + [self.packed[i] for i in sorted(self.special.values())], "<u4")
        codes[codes < 0] = len(self.known) + np.searchsorted(sorted(self.special.values()), -1 - codes[codes < 0])
        ids, ends = ragged(flat, edges, codes)
        return ids, np.concatenate([[0], ends])[np.cumsum(sizes, dtype=np.int64)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, special tokens included; invalid UTF-8 becomes U+FFFD."""
        return ragged(*self.token_bytes, ids)[0].tobytes().decode("utf-8", "replace")

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by commas."""
        return ragged(*self.token_text, ids)[0].tobytes()[:-1]


def slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about ``limit`` bytes of text each."""
    sizes = np.nan_to_num(pyarrow.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float))
    cut = (np.cumsum(sizes) // limit).astype(int)
    edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
    return zip(edges, edges[1:])


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in batches:
            for a, b in slices(batch, "text"):
                part = batch.slice(a, b - a)
                ids, ends = bpe.encode(part.column("text").to_pylist())
                lists = pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), ids.astype(np.int32))
                yield pa.record_batch([part.column("doc_id"), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text``: the texts of ``doc_id, ids``; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in batches:
            texts = [bpe.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str, keep: list[str] | None = None) -> DataFrame:
    """Encode every whole text, decode the ids, and return digests of both.

    ``doc_id, n_tokens, ids_sha256`` (decimal ids joined by commas) ``, decoded_sha256``
    (the decoded text in UTF-8), then the columns ``keep``. Both passes run in one task, so the
    ids never leave it.
    """
    keep = keep or []
    kept = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                         T.StructField("decoded_sha256", T.StringType()), *docs.select(*keep).schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in batches:
            for a, b in slices(batch, "text"):
                part = batch.slice(a, b - a)
                flat, ends = bpe.encode(part.column("text").to_pylist())
                ids = np.split(flat, ends[:-1])
                yield pa.record_batch([
                    part.column("doc_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(bpe.decimal(i)).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in ids], pa.string()),
                    *(part.column(k) for k in keep),
                ], names=kept.names)

    return docs.select("doc_id", "text", *keep).mapInArrow(run, kept)
