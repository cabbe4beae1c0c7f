"""Operator 12: collocations of two to five words, counted over a prefix-free parse.

Every text is cut into chunks: where the hash of ``OVERLAP`` following words falls on a fixed value
a chunk ends behind them, and the next one begins with them. Where to cut follows from the words
alone, so copied passages give the same chunks. In a chunk the words of one piece (what stands
between two marks of punctuation) have one blank between them, and pieces a line feed. The dictionary holds each distinct chunk of a language once with its parse frequency, the
number of its occurrences; all counting works on the dictionary, weighted by that. A phrase counts
in the chunk in which it begins before the closing overlap, thus once for each occurrence.

A phrase has no more occurrences than any part of it, so pairs are counted only where both words,
and longer phrases only where all pairs may be frequent. That is read from a bitmap of hashes of
``FILTER_BITS`` bits, whatever the size of the input; a bit set by another phrase lets too much
through to the exact counts, never too little. Of words and then of pairs hashes of 32 bits are
counted first, short rows that need no strings: most pairs of frequent words are rare, and their
strings are never shuffled. One pass counts the phrases of all sizes that are left: a task sums the
phrases of all its chunks, and sends the sums of each of ``BUCKETS`` buckets as lists in one row.
The files of a step's shuffles go when the step ends.

Results: as in the contract of ``collocations``. A null text counts as empty, a null lang as
``und``; rows need no id, and repeated rows count as often as they occur; other columns of the
input are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspend.llm.common import shuffles_removed, written

OVERLAP = 4  # one less than the words of the longest phrase
CUT_EVERY = 64
FILTER_BITS = 26
SALTS = 8
BUCKETS = 1024
HELD_ROWS = 1 << 20
CALL_BYTES = 4 << 20
GAP, END = 0x20, 0x0A
# A-Z in lower case, the other blank and all marks as one
CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def hashes(values: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(v) for v in values.cast(pa.binary()).to_pylist()], np.uint64)


def chained(codes: list[np.ndarray]) -> np.ndarray:
    """A hash of each row of several columns of hashes."""
    out = codes[0]
    for c in codes[1:]:
        out = mixed(out + c)
    return out


class Words:
    """The words of a text buffer: dictionary, code, begin and size of each, and the number of its piece.

    ``breaks`` are places where a word begins whatever stands before it.
    """

    def __init__(self, data: np.ndarray, breaks: np.ndarray):
        solid = (data != GAP) & (data != END)
        opens = np.append(True, ~solid[:-1])
        opens[breaks] = True
        self.starts = np.flatnonzero(solid & opens)
        ends = np.flatnonzero(solid & np.append(~solid[1:] | opens[1:], True))
        self.sizes = ends + 1 - self.starts
        borders = np.union1d(np.flatnonzero(data == END), breaks)
        self.piece = np.searchsorted(borders, self.starts, side="right")
        offsets = np.append(0, np.cumsum(self.sizes))
        words = pa.Array.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])])
        found = words.dictionary_encode()
        self.codes, self.texts = found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.cast(pa.large_string())
        self.hash = hashes(found.dictionary)

    def phrases(self, rows: list[np.ndarray]) -> pa.Array:
        """The words of several columns of codes joined by blanks; -1 is no word."""
        columns = [pc.take(self.texts, pa.array(c, mask=c < 0)) for c in rows]
        return pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string()), null_handling="skip").cast(pa.string())


def summed(columns: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of several columns of codes, and the sum of the weights of each."""
    if not len(weights):
        return columns, weights
    code = columns[0]
    for c in columns[1:]:
        code = np.unique(code, return_inverse=True)[1] * (c.max() + 2) + c + 1
    order = np.argsort(code, kind="stable")
    edges = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
    return [c[order[edges]] for c in columns], np.add.reduceat(weights[order], edges)


def chunks_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of all texts, whether each is the last one of its text, its words before the closing
    overlap, and the row of its text."""
    clean = [t.encode().translate(CLEAN) if t else b"" for t in texts.to_pylist()]
    sizes = np.fromiter(map(len, clean), np.int64, len(clean)) + 1
    data = np.frombuffer(b"\n".join([*clean, b""]), np.uint8)
    words = Words(data, np.zeros(0, np.int64))
    n = len(words.starts)
    if not n:
        return pa.array([], pa.string()), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.searchsorted(np.cumsum(sizes), words.starts, side="right")
    opens = np.append(True, row[1:] != row[:-1])
    # windows of OVERLAP words that lie in one text with a word behind them, and fall on the value
    code = words.hash[words.codes]
    cut = np.zeros(n, bool)
    if n > OVERLAP:
        window = chained([code[k:n - OVERLAP + k] for k in range(OVERLAP)])
        cut[:n - OVERLAP] = (window % np.uint64(CUT_EVERY) == 0) & (row[:n - OVERLAP] == row[OVERLAP:])
    begin = np.flatnonzero(opens | cut)
    stop = np.append(begin[1:], n)
    last = np.append(opens[begin[1:]], True)  # the next chunk is of another text
    stop = np.where(last, stop, stop + OVERLAP)
    # all words with one sign behind each; a chunk is a stretch of that
    blank = (data == GAP) | (data == END)
    flat = data[~blank | np.append(False, ~blank[:-1])]
    at = np.append(0, np.cumsum(words.sizes + 1))
    flat[at[1:] - 1] = np.where(np.append(words.piece[1:] != words.piece[:-1], True), END, GAP)
    a, b = at[begin], at[stop] - 1
    ends = np.cumsum(b - a)
    take = np.repeat(a - (ends - (b - a)), b - a)
    take += np.arange(ends[-1])
    chunks = pa.Array.from_buffers(pa.large_binary(), len(a), [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(flat[take])])
    return chunks.cast(pa.large_string()).cast(pa.string()), last, np.where(last, stop - begin, stop - begin - OVERLAP), row[begin]


def gathered(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Batches put together to about ``CALL_BYTES`` of a column, and cut where one has more."""
    held, size = [], 0
    for batch in batches:
        bytes_ = np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float))
        cut = (np.cumsum(bytes_) // CALL_BYTES).astype(int)
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            held.append(batch.slice(a, b - a))
            size += bytes_[a:b].sum()
            if size >= CALL_BYTES:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def parse(docs: DataFrame) -> DataFrame:
    """The dictionary ``lang, chunk, last, own, times``: each chunk of a language, whether it ends its text,
    its words before the closing overlap, and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text"):
            chunks, last, own, row = chunks_of(table.column("text").combine_chunks())
            lang = pc.take(table.column("lang").combine_chunks(), pa.array(row))
            yield from pa.table({"lang": lang, "chunk": chunks, "last": last, "own": own}).to_batches(65_536)

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    chunks = texts.mapInArrow(run, "lang string, chunk string, last boolean, own long")
    return chunks.groupBy("lang", "chunk", "last", "own").agg(F.count("*").alias("times"))


def rest(group: np.ndarray) -> np.ndarray:
    """For rows in order of groups: how many of its group are left, the row itself included."""
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)) if len(group) else np.zeros(0, np.int64)
    return np.repeat(ends, np.diff(np.append(0, ends))) - np.arange(len(group))


class Dictionary:
    """Some chunks of the dictionary in memory."""

    def __init__(self, table: pa.Table):
        chunks = table.column("chunk").combine_chunks().cast(pa.large_string())
        offsets = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
        data = np.frombuffer(chunks.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        edges = offsets - offsets[0]
        self.words = Words(data, edges[:-1])
        self.codes = self.words.codes
        chunk = np.searchsorted(edges, self.words.starts, side="right") - 1
        lang = table.column("lang").combine_chunks().dictionary_encode()
        self.langs = lang.dictionary
        self.lang = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[chunk]
        self.times = table.column("times").to_numpy()[chunk]
        #: words from each one to the end of its piece, itself included
        self.left = rest(self.words.piece)
        self.own = table.column("last").to_numpy(zero_copy_only=False)[chunk] | (rest(chunk) > OVERLAP)
        self.lang_hash = hashes(self.langs)

    def code(self, n: int) -> np.ndarray:
        """The hash of language and phrase of n words from each word on (if it is there)."""
        code = self.words.hash[self.codes]
        return mixed(chained([self.lang_hash[self.lang], *(np.append(code[k:], code[:k]) for k in range(n))]))

    def passes(self, n: int, bitmap: bytes) -> np.ndarray:
        """Whether the phrase of n words from each word on is there and may be frequent."""
        bit = (self.code(n) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        return (self.left >= n) & (np.frombuffer(bitmap, np.uint8)[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)

    def hashed(self, n: int, on: np.ndarray) -> pa.Table:
        """The hashes of the phrases of n words that begin in this chunk where ``on`` is set."""
        at = on & self.own & (self.left >= n)
        (code,), times = summed([(self.code(n)[at] >> np.uint64(32)).astype(np.int64)], self.times[at])
        return pa.table({"code": code.astype(np.uint32).view(np.int32), "times": times})

    def exact(self, n: int, on: np.ndarray) -> pa.Table:
        """The phrases of n words that begin in this chunk where ``on`` is set."""
        at = np.flatnonzero(on & self.own & (self.left >= n))
        rows, times = summed([self.lang[at], *(self.codes[at + k] for k in range(n))], self.times[at])
        bucket = mixed(chained([self.lang_hash[rows[0]], *(self.words.hash[c] for c in rows[1:])])) % np.uint64(BUCKETS)
        return pa.table({"bucket": bucket.astype(np.int32), "lang": pc.take(self.langs, pa.array(rows[0])), "phrase": self.words.phrases(rows[1:]), "times": times})


def chains(on: np.ndarray, n: int) -> np.ndarray:
    """Where n set places follow each other."""
    out = on
    for k in range(1, n):
        out = out & np.append(on[k:], np.zeros(min(k, len(on)), bool))
    return out


def counted(dictionary: DataFrame, count) -> DataFrame:
    """``n`` of each ``code`` in the tables that ``count`` makes of parts of the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "chunk"):
            for found in count(Dictionary(table)):
                yield from found.to_batches(65_536)

    found = dictionary.select("lang", "chunk", "last", "times").mapInArrow(run, "code int, times long")
    return found.groupBy("code").agg(F.sum("times").alias("n"))


def totalled(tables: list[pa.Table]) -> pa.Table:
    """Tables put together, with one row for each distinct row of all columns but ``times``, which is summed."""
    keys = [c for c in tables[0].column_names if c != "times"]
    return pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("times", "sum")]).rename_columns([*keys, "times"])


def summed_up(tables: Iterable[pa.Table]) -> Iterator[pa.Table]:
    """The sums over all tables, in one table unless it has more than ``HELD_ROWS`` rows."""
    held, rows = [], 0
    for table in tables:
        held.append(table)
        rows += table.num_rows
        if rows > 2 * HELD_ROWS:
            held = [totalled(held)]
            rows = held[0].num_rows
            if rows > HELD_ROWS:
                yield held[0]
                held, rows = [], 0
    if rows:
        yield totalled(held)


def packed(table: pa.Table) -> pa.Table:
    """``bucket, lang, phrases, counts``: the phrases of one bucket and language, and their times, as lists."""
    lang = table.column("lang").combine_chunks().dictionary_encode()
    bucket, code = table.column("bucket").to_numpy(), lang.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((code, bucket))
    bucket, code = bucket[order], code[order]
    edges = np.flatnonzero(np.append(True, (np.diff(bucket) != 0) | (np.diff(code) != 0)))
    table, offsets = table.take(pa.array(order)).combine_chunks(), pa.array(np.append(edges, len(order)), pa.int32())
    lists = {to: pa.ListArray.from_arrays(offsets, table.column(c).combine_chunks()) for to, c in (("phrases", "phrase"), ("counts", "times"))}
    return pa.table({"bucket": bucket[edges], "lang": pc.take(lang.dictionary, pa.array(code[edges])), **lists})


def unpacked(table: pa.Table) -> pa.Table:
    phrases, counts = (table.column(c).combine_chunks() for c in ("phrases", "counts"))
    lang = pc.take(table.column("lang").combine_chunks(), pc.list_parent_indices(phrases))
    return pa.table({"lang": lang, "phrase": phrases.flatten(), "times": counts.flatten()})


def exactly(dictionary: DataFrame, count, least: int) -> DataFrame:
    """``lang, phrase, n`` of the phrases that occur ``least`` times or more in the tables that ``count`` makes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in summed_up(found for part in gathered(batches, "chunk") for found in count(Dictionary(part))):
            yield from packed(table).to_batches(BUCKETS)

    def merge(table: pa.Table) -> pa.Table:
        found = totalled([unpacked(table)])
        return found.filter(pc.greater_equal(found.column("times"), least)).rename_columns(["lang", "phrase", "n"])

    found = dictionary.select("lang", "chunk", "last", "times").mapInArrow(run, "bucket int, lang string, phrases array<string>, counts array<long>")
    return found.groupBy("bucket").applyInArrow(merge, "lang string, phrase string, n long")


def bitmap_of(codes: DataFrame):
    """A broadcast bitmap of ``2 ** FILTER_BITS`` bits: the first bits of each ``code``."""
    bit = F.shiftrightunsigned("code", 32 - FILTER_BITS).cast("long") + 1  # the functions count from 1
    found = codes.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    bitmap = bytearray(1 << FILTER_BITS - 3)
    for r in found:
        bitmap[(r.bucket - 1) * len(r.bits):r.bucket * len(r.bits)] = r.bits
    return codes.sparkSession.sparkContext.broadcast(bytes(bitmap))


def frequent(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, n`` of all phrases of one to five words that occur ``least`` times or more,
    and ``lang, total``: all words of each language."""
    enough = F.col("n") >= least
    with shuffles_removed(docs.sparkSession):
        dictionary = written(parse(docs), "chunks")
        totals = written(dictionary.groupBy("lang").agg(F.sum(F.col("times") * F.col("own")).alias("total")), "totals")

        def single(d: Dictionary) -> Iterator[pa.Table]:
            yield d.hashed(1, d.own)

        words = bitmap_of(counted(dictionary, single).where(enough))

        def double(d: Dictionary) -> Iterator[pa.Table]:
            yield d.hashed(2, chains(d.passes(1, words.value), 2))

        pairs = bitmap_of(counted(dictionary, double).where(enough))

        def exact(d: Dictionary) -> Iterator[pa.Table]:
            yield d.exact(1, d.passes(1, words.value))
            may = d.passes(2, pairs.value)
            for n in (2, 3, 4, 5):
                yield d.exact(n, chains(may, n - 1))

        found = exactly(dictionary, exact, least)
        return written(found.withColumn("size", F.size(F.split("phrase", " "))), "frequent"), totals


def part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, least: int = 100, share: int = 100, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    ``a`` is the number of occurrences of the phrase, at least ``least``, ``l`` and ``r`` those of the
    two parts of its weakest cut, ``n`` all words, ``score`` floor(1000 a n / (l r)). A phrase goes if a
    longer candidate that holds it has ``share`` percent of its occurrences or more.
    """
    known, totals = frequent(docs, least)
    words = F.split("phrase", " ")
    candidates = known.where("size > 1").withColumnRenamed("n", "a")
    # a part can be that of very many phrases: the parts' counts are met in SALTS places
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    cuts = candidates.select("lang", "phrase", "size", "a", salt.alias("salt"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumns({"left": part(words, F.lit(1), F.col("k")), "right": part(words, F.col("k") + 1, F.col("size") - F.col("k"))})
    counts = known.where(F.col("size") <= OVERLAP).select("lang", "n", "phrase", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", "salt", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", "salt", side])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.join(totals.withColumnRenamed("total", "n"), "lang").withColumn("top", wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)"))
    cuts = cuts.withColumn("bottom", wide("l") * wide("r")).withColumn("score", F.expr("top div bottom"))
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("cut"))
    # the most frequent longer candidate around each phrase
    inner = candidates.where("size > 2").select("lang", "size", words.alias("words"), "a", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    inner = inner.select("lang", "words", "a", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at"))
    around = inner.select("lang", part(F.col("words"), F.col("at"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = weakest.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < share * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def oracle(least: int = 100, share: int = 100, top: int = 2000) -> str:
    """The same in DuckDB SQL, from every phrase of every piece."""
    return f"""
WITH cleaned AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(part, '[^ \\t]+') AS words
  FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\n\\x0B\\f\\r]')) AS part FROM cleaned)),
words AS (SELECT lang, piece, unnest(words) AS w, generate_subscripts(words, 1) AS k FROM pieces),
windows AS (
  SELECT lang, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4, lead(w, 4) OVER p AS w5
  FROM words WINDOW p AS (PARTITION BY piece ORDER BY k)),
phrases AS (
  SELECT lang, size, phrase, count(*) AS n
  FROM (SELECT lang, unnest([1, 2, 3, 4, 5]) AS size,
               unnest([w, w || ' ' || w2, w || ' ' || w2 || ' ' || w3, w || ' ' || w2 || ' ' || w3 || ' ' || w4,
                       w || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5]) AS phrase FROM windows)
  WHERE phrase IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS words, n AS a FROM phrases WHERE size > 1 AND n >= {least}),
cuts AS (
  SELECT c.lang, c.phrase, c.size, c.words, c.a, k, l.n AS l, r.n AS r, t.n, ((1000::HUGEINT * c.a * t.n) // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, array_to_string(words[s:s + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates)) GROUP BY ALL),
ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase, a, l, r, n, score
  FROM weakest w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase
  WHERE o.most IS NULL OR 100 * o.most < {share} * a)
SELECT * FROM ranked WHERE rank <= {top}
"""
