"""Operator 1: quality rules, a threshold table compiled into one projection.

``RULES`` names ratios of integer measures and their limits per mille. ``quality`` turns
the measures and the whole table into column expressions of one projection: no user
functions, no shuffle, one pass over the texts.

Words are runs without space, \\t, \\n, \\v, \\f or \\r; lines are split at \\n. Results: a null
text has no words and fails; empty texts fail; every input row gives one row, repeated rows
included; a null doc_id is carried through; other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspend.llm.common import WORD, WORD_SEP

MIN_WORDS = 50
# Positions of words fit into these bits: a string has at most 2**31 bytes.
POSITION_BITS = 30
SYMBOLS = "#*$%&|<>"
UPPER = "A-ZÀ-ÖØ-Þ"

# Very common words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it was for on are as with be by this from at "
    "der die und den von zu das mit dem des ist im für ein eine auf "
    "la le les et un une du est que pour dans en qui sur pas "
    "el los las y se por con una para su al lo como del"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * part / whole <= high``; an empty whole passes."""

    name: str
    part: str
    whole: str
    low: int = 0
    high: int = 1_000_000


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2500, 9500),
    Rule("symbols", "n_symbols", "word_chars", high=20),
    Rule("shouting", "n_exclamations", "word_chars", high=30),
    Rule("upper_case", "n_upper", "word_chars", high=300),
    Rule("stop_words", "n_stop_words", "n_words", low=30),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=340),
    Rule("short_lines", "n_lines", "n_words", high=400),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, by way of a one-element array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(text: Column, chars: str) -> Column:
    """Characters of ``text`` that belong to the class ``chars``."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more among ``words``.

    Many texts have no such window: equal numbers of windows and of distinct window hashes
    prove it. In the others a sort of numbers (high bits of the hash, then the position)
    brings equal windows together; only those with an equal neighbour are then sorted by their
    words, so the count does not depend on the hash.
    """
    window = lambda i: [F.get(words, i + k) for k in range(3)]
    high = lambda x: F.shiftright(x, POSITION_BITS)
    same = lambda a, b: F.coalesce(a == b, F.lit(False))

    def search(hashes: Column) -> Column:
        keys = F.transform(hashes, lambda x, i: F.shiftleft(high(x), POSITION_BITS).bitwiseOR(i.cast("long")))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(F.sort_array(keys), likely)).otherwise(0)

    def likely(keys: Column) -> Column:
        near = F.filter(keys, lambda x, j: same(high(x), high(F.get(keys, j - 1))) | same(high(x), high(F.get(keys, j + 1))))
        at = F.transform(near, lambda x: x.bitwiseAND((1 << POSITION_BITS) - 1).cast("int"))
        return let(F.sort_array(F.transform(at, lambda i: F.struct(F.struct(*window(i)).alias("w"), i.alias("i")))), certain)

    def certain(placed: Column) -> Column:
        again = F.filter(placed, lambda x, j: same(x["w"], F.get(placed, j - 1)["w"]) | same(x["w"], F.get(placed, j + 1)["w"]))
        return let(F.sort_array(F.transform(again, lambda x: x["i"])), covered)

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(*window(i)))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(hashes, search)).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the integer measures of every whole text."""
    text = F.coalesce("text", F.lit(""))
    words, lines, chars = F.col("words"), F.col("lines"), F.col("chars")
    split = docs.select(
        "doc_id",
        text.alias("whole"),
        F.filter(F.split(text, WORD_SEP, -1), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
        F.regexp_replace(text, WORD_SEP, "").alias("chars"),
    )
    return split.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(chars).cast("long").alias("word_chars"),
        _count(chars, SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeat_words(words).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        _count(chars, "!").alias("n_exclamations"),
        _count(chars, UPPER).alias("n_upper"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


def passes(rule: Rule) -> Column:
    part, whole = F.col(rule.part) * 1000, F.col(rule.whole)
    return (whole == 0) | (part >= rule.low * whole) & (part <= rule.high * whole)


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = MIN_WORDS) -> DataFrame:
    """The measures, ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``."""
    measured = measures(docs)
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]))
    return measured.select(
        "*",
        base_failed.alias("base_failed"),
        failed.alias("failed_rules"),
        (~base_failed & (F.size(failed) == 0)).alias("kept"),
    )


OUTPUT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def oracle(rules: tuple[Rule, ...] = RULES, min_words: int = MIN_WORDS) -> str:
    """DuckDB SQL for ``OUTPUT``: windows are unnested and grouped instead of sorted per row."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    tests = " and ".join(
        f"({r.whole} = 0 or {r.part} * 1000 between {r.low} * {r.whole} and {r.high} * {r.whole})" for r in rules)
    return f"""
with texts as (
  select row_number() over () as row_id, doc_id, coalesce(text, '') as t from documents),
parts as (
  select row_id, doc_id, t,
    list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from texts),
placed as (
  select row_id, unnest(words) as a, unnest(range(1, len(words) + 1)) as i from parts),
triples as (
  select row_id, i, a, lead(a, 1) over w as b, lead(a, 2) over w as c from placed window w as (partition by row_id order by i)),
windows as (
  select row_id, i, count(*) over (partition by row_id, a, b, c) as n from triples where c is not null),
again as (
  select row_id, count(distinct p) as n_repeat_words
  from (select row_id, unnest([i, i + 1, i + 2]) as p from windows where n > 1) group by row_id),
measured as (
  select doc_id, cast(len(words) as bigint) as n_words,
    cast(length(array_to_string(words, '')) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
    len(lines) as n_lines,
    length(regexp_replace(t, '[^!]', '', 'g')) as n_exclamations,
    length(regexp_replace(t, '[^{UPPER}]', '', 'g')) as n_upper,
    len(list_filter(words, lambda w: lower(w) in ({stop}))) as n_stop_words
  from parts left join again using (row_id)),
judged as (
  select *, n_words < {min_words} or 100 * n_repeat_words > 50 * n_words as base_failed, {tests} as fine from measured)
select {", ".join(OUTPUT[:-1])}, not base_failed and fine as kept from judged
"""
