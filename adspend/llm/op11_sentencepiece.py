"""Operator 11: SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

SentencePiece joins, again and again, the two neighbouring symbols whose joined piece has the
best score, the one further left of equals. No piece reaches over the border before a space
sign, so texts fall into words that can be encoded alone, and each distinct word once.

All new words of a batch lie one after another in one flat numpy array of symbols. One round
finds the least rank of any pair in each word (a segmented minimum), joins all pairs of that
rank at once, those furthest left where they overlap, and closes the gaps; words without a
pair left drop out. A joined symbol can form a pair with a better rank than its own (a piece
may contain a piece of a worse score); only the leftmost pair of such a rank is joined in a
round, which keeps the result that of the one-by-one order. Words of more than ``LONG``
symbols go through the same rounds one by one, with the places of each rank kept in buckets,
so that a round touches only what it joins; time and memory are linear in their length but for
sorting.

Results: a null text counts as empty; an empty text has no ids; every input row gives one row,
repeated rows included; a null doc_id is carried through; other columns of the input are not
read.
"""

from __future__ import annotations

import codecs
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from adspend.llm.common import per_worker
from adspend.llm.op08_bpe import ragged, slices, table

SPACE = "▁"  # stands for a space in pieces
LONG = 4096
CALL_CHARS = 1 << 20
CACHE_WORDS, CACHE_CHARS = 400_000, 16 << 20
NONE = 1 << 30

codecs.register_error("one_for_each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def leftmost(follows: np.ndarray) -> np.ndarray:
    """Which of sorted places to take so that none overlaps the one before; ``follows[k]`` says
    that place k begins where place k - 1 ends its first symbol."""
    at = np.arange(len(follows))
    return (at - np.maximum.accumulate(np.where(follows, 0, at))) % 2 == 0


class Pieces:
    """A BPE model file of the sentencepiece library, prepared for merge rounds.

    A symbol is the id of its piece; a character that is no piece is ``size`` plus its code point.
    Raises ValueError for models that need more than this: other normalisation than a space sign
    before the text, other kinds than BPE, pieces set by the user or unused, no byte pieces.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        library = SentencePieceProcessor(model_file=path)
        model.ParseFromString(library.serialized_model_proto())
        rules, trained = model.normalizer_spec, model.trainer_spec
        plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        if trained.model_type != trained.BPE or not plain or trained.treat_whitespace_as_suffix or not trained.byte_fallback:
            raise ValueError("only BPE models with byte pieces and a space sign before the text")
        kind = model.SentencePiece
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("pieces set by the user and unused pieces are not supported")
        size = self.size = len(model.pieces)
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        score = np.array([p.score for p in model.pieces])
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece reaches over the border before a space")
        ids = np.array(sorted(normal.values()))
        self.rank = np.full(size + 1, NONE)
        self.rank[ids] = np.unique(-score[ids], return_inverse=True)[1]
        # a piece that is part of one with the same or a better rank
        self.early = np.zeros(self.rank[ids].max() + 1, bool)
        symbol = lambda s: normal.get(s, size + ord(s) if len(s) == 1 else -1)
        pairs: dict[int, int] = {}
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                a, b = symbol(piece[:k]), symbol(piece[k:])
                for part in (a, b):
                    if 0 <= part < size and self.rank[i] <= self.rank[part]:
                        self.early[self.rank[part]] = True
                if a >= 0 and b >= 0:
                    pairs[a << 32 | b] = i
        self.keys = np.array(sorted(pairs))
        self.targets = np.array([pairs[k] for k in self.keys.tolist()])
        self.of_char = size + np.arange(0x110000)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        self.byte_ids = np.array([library.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.space = self.of_char[ord(SPACE)]
        self.runs = self.run_pieces(normal)
        shown = [b""] * size
        for i, p in enumerate(model.pieces):
            if p.type == kind.NORMAL:
                shown[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == kind.BYTE:
                shown[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == kind.UNKNOWN:
                shown[i] = trained.unk_surface.encode()
        self.shown = table(shown)
        self.leads = np.array([p.type == kind.NORMAL and p.piece.startswith(SPACE) for p in model.pieces])
        self.decimals = table([f"{i},".encode() for i in range(size)])
        self.forget()

    def run_pieces(self, normal: dict[str, int]) -> list[bytes]:
        """Ids of runs of 0, 1, ... space signs up to the longest piece of such.

        Pieces of several signs must hold nothing else and come last in the order of scores: then
        a run is joined last. A longer run must begin with that longest piece, whatever its length.
        """
        runs = {len(p): i for p, i in normal.items() if not p.strip(SPACE)}
        longer = {i for n, i in runs.items() if n > 1}
        others = max(self.rank[i] for p, i in normal.items() if p.strip(SPACE))
        longest = max(runs)
        known = [self.rounds(np.full(n, self.space), np.zeros(n, int))[0].tolist() for n in range(3 * longest + 1)]
        if any(p.startswith(2 * SPACE) for p, i in normal.items() if i not in longer) or any(self.rank[i] <= others for i in longer) \
                or any(known[n] != [runs[longest], *known[n - longest]] for n in range(longest, len(known))):
            raise ValueError("pieces of several spaces must come last in the order of scores")
        return [np.array(ids, "<u4").tobytes() for ids in known[:longest + 1]]

    def forget(self) -> None:
        """Empty the cache of words; number 0 is the empty word."""
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.known: list[bytes] = [b""]
        self.alone: list[bool] = [True]
        self.chars = 0
        self.number[""]

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, or ``size``."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.targets[at], self.size)

    def rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words after merging, in order of words, and the word of each."""
        if not len(symbols):
            return symbols, word
        made = self.pair(symbols, np.append(symbols[1:], -1))
        made[np.append(word[1:] != word[:-1], True)] = self.size
        done = []
        while len(symbols):
            rank = self.rank[made]
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(word)))
            on = np.repeat(least < NONE, sizes)
            if not on.all():
                done.append((symbols[~on], word[~on]))
                symbols, word, made, rank = symbols[on], word[on], made[on], rank[on]
                sizes, least = sizes[least < NONE], least[least < NONE]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            take = leftmost(np.append(False, np.diff(at) == 1))
            first = np.append(True, word[at[1:]] != word[at[:-1]])
            at = at[take & (first | ~self.early[rank[at]])]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = (np.cumsum(keep) - 1)[at]
            symbols, word, made = symbols[keep], word[keep], made[keep]
            touched = np.concatenate([place, place[place > 0] - 1])
            after = np.minimum(touched + 1, len(symbols) - 1)
            new = self.pair(symbols[touched], symbols[after])
            new[(word[touched] != word[after]) | (after == touched)] = self.size
            made[touched] = new
        symbols, word = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def long_rounds(self, symbols: np.ndarray) -> np.ndarray:
        """The same rounds over one long word, with the places of each rank in buckets."""
        n = len(symbols)
        symbols = np.append(symbols, -1)  # the end, which makes no pair; also stands before the start
        alive = np.arange(n + 1) < n
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        made = np.append(self.pair(symbols[:-1], symbols[1:]), self.size)
        rank = self.rank[made]
        buckets: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def put(places: np.ndarray) -> None:
            ranks = rank[places]
            places, ranks = places[ranks < NONE], ranks[ranks < NONE]
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            edges = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])) if len(ranks) else np.zeros(0, int)
            for r, part in zip(ranks[edges].tolist(), np.split(places, edges[1:])):
                if r not in buckets:
                    buckets[r] = []
                    heappush(heap, r)
                buckets[r].append(part)

        put(np.arange(n))
        while heap:
            r = heappop(heap)
            parts = buckets.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[rank[at] == r]
            if not len(at):
                continue
            take = at[leftmost(np.append(False, after[at[:-1]] == at[1:]))]
            gone, new = after[take], made[take]
            if self.early[r]:
                # joined one by one, a new pair of this rank or a better one would come next
                left = symbols[before[take]]
                joined = np.append(False, gone[:-1] == before[take][1:])
                left[joined] = new[:-1][joined[1:]]
                better = np.minimum(self.rank[self.pair(left, new)], self.rank[self.pair(new, symbols[after[gone]])]) <= r
                if better.any():
                    stop = int(np.argmax(better))
                    rest = at[np.searchsorted(at, gone[stop], side="right"):]
                    if len(rest):
                        buckets[r] = [rest]
                        heappush(heap, r)
                    take, gone, new = take[:stop + 1], gone[:stop + 1], new[:stop + 1]
            symbols[take] = new
            rank[gone], made[gone], alive[gone] = NONE, self.size, False
            after[take] = after[gone]
            before[after[take]] = take
            touched = np.unique(np.concatenate([take, before[take][before[take] >= 0]]))
            made[touched] = self.pair(symbols[touched], symbols[after[touched]])
            rank[touched] = self.rank[made[touched]]
            put(touched)
        return symbols[alive]

    def learn(self, words: list[str]) -> None:
        """Encode new words, each behind one space sign, and remember their ids."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.chars += int(sizes.sum())
        parts: dict[int, np.ndarray] = {}
        short = np.flatnonzero(sizes <= LONG)
        for some in np.split(short, np.flatnonzero(np.diff(np.cumsum(sizes[short]) // CALL_CHARS)) + 1):
            text = "".join(SPACE + words[k] for k in some.tolist())
            symbols, word = self.rounds(self.of_char[code_points(text)], np.repeat(some, sizes[some]))
            ends = np.searchsorted(word, some, side="right")
            parts |= zip(some.tolist(), np.split(symbols, ends[:-1]))
        for k in np.flatnonzero(sizes > LONG).tolist():
            parts[k] = self.long_rounds(self.of_char[code_points(SPACE + words[k])])
        for k in range(len(words)):
            alone = bool(parts[k][0] == self.space)
            self.alone.append(alone)
            self.known.append(self.ids(parts[k][alone:]).astype("<u4").tobytes())

    def ids(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols as ids; a character that is no piece becomes the pieces of its bytes."""
        odd = symbols >= self.size
        if not odd.any():
            return symbols
        chars, rows = np.unique(symbols[odd], return_inverse=True)
        raw = [self.byte_ids[list(chr(c - self.size).encode("utf-8", "surrogatepass"))] for c in chars.tolist()]
        parts = [[s] for s in symbols.tolist()]
        for k, row in zip(np.flatnonzero(odd).tolist(), rows.tolist()):
            parts[k] = raw[row].tolist()
        return np.array([i for p in parts for i in p], np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the end of each text's."""
        if len(self.number) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.forget()
        number, codes, sizes = self.number.__getitem__, [], []
        for text in texts:
            n = len(codes)
            if text:
                codes += map(number, text.replace(" ", SPACE).split(SPACE))
            sizes.append(len(codes) - n)
        if new := len(self.number) - len(self.known):
            self.learn(list(islice(reversed(self.number), new))[::-1])
        # each code is one space sign and a word; signs that stay alone make runs with the empty words before them
        codes, ends = np.array(codes, np.int64), np.cumsum(sizes, dtype=np.int64)
        flat, edges = table(self.known + self.runs, "<u4")
        longest, base = len(self.runs) - 1, len(self.known)
        alone = np.array(self.alone)[codes]
        rows, owner = codes, np.repeat(np.arange(len(texts)), sizes)
        empty = codes == 0
        # a run: empty words of one text and, if its sign stays alone, the word after them
        place = np.arange(len(codes))
        last = np.append(owner[1:] != owner[:-1], True) if len(codes) else np.zeros(0, bool)
        start = np.append(True, ~empty[:-1] | last[:-1]) if len(codes) else np.zeros(0, bool)
        length = place - np.maximum.accumulate(np.where(start, place, 0)) + alone
        closes = ~empty | last
        length = np.where(closes, length, 0)
        full, part = length // longest, length % longest
        # full pieces first, then the rest of the run, then the word
        n_rows = full + (part > 0) + ~empty
        out = np.repeat(rows, n_rows)
        first = np.cumsum(n_rows) - n_rows
        lead = np.repeat(full, n_rows) > np.arange(len(out)) - np.repeat(first, n_rows)
        out[lead] = base + longest
        rest = part > 0
        out[(first + full)[rest]] = base + part[rest]
        ids, stops = ragged(flat, edges, out)
        by_code = np.append(0, np.cumsum(n_rows))[ends]
        return ids.astype(np.int64), np.append(0, stops)[by_code]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: the first space goes, invalid bytes become U+FFFD each."""
        text = ragged(*self.shown, ids)[0].tobytes().decode("utf-8", "one_for_each_byte")
        return text[1:] if len(ids) and self.leads[ids[0]] else text

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by commas."""
        return ragged(*self.decimals, ids)[0].tobytes()[:-1]


def pieces(path: str) -> Pieces:
    """The prepared model of this worker process."""
    return per_worker(("pieces", path), lambda: Pieces(path))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in batches:
            for a, b in slices(batch, "text"):
                part = batch.slice(a, b - a)
                ids, ends = coder.encode(part.column("text").to_pylist())
                lists = pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), ids.astype(np.int32))
                yield pa.record_batch([part.column("doc_id"), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, text``: the texts of ``doc_id, ids``; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in batches:
            texts = [coder.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """Encode every whole text, decode the ids, and return digests of both: ``doc_id, n_tokens,
    ids_sha256`` (decimal ids joined by commas) ``, decoded_sha256`` (the decoded text in UTF-8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in batches:
            for a, b in slices(batch, "text"):
                part = batch.slice(a, b - a)
                flat, ends = coder.encode(part.column("text").to_pylist())
                ids = np.split(flat, ends[:-1])
                yield pa.record_batch([
                    part.column("doc_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(coder.decimal(i)).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(coder.decode(i).encode()).hexdigest() for i in ids], pa.string()),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
