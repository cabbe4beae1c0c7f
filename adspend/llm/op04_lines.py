"""Operator 4: line dedup by overlapping windows of three lines.

Lines are split at \\n. Every three consecutive lines, of which one has a word, form a
window, known by two 64-bit hashes. Windows are counted over all documents; those that occur
more than once keep their first occurrence (least doc_id, then MD5 of the text, then position), and
every line covered by a later occurrence is removed, overlapping windows being merged.

Counting aggregates before it shuffles, and only the windows that repeat are joined back, so
a passage in a third of all documents is no hot group in either step.

Results: texts of fewer than three lines, empty and null texts stay as they are; rows equal
in id and text count as one document and get the same text; rows of one id with different texts
are documents of their own, in the order of the MD5 of their texts; null ids come last in the order
of occurrence; an empty table gives no rows. All columns of the input are kept, ``text`` being
replaced, and the struct column ``name`` has ``n_lines`` and ``n_removed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspend.llm.common import WORD

WINDOW = 3


def dedup_lines(docs: DataFrame, name: str = "lines", window: int = WINDOW) -> DataFrame:
    lines = F.split(F.coalesce(docs["text"], F.lit("")), "\n", -1)
    ident = [docs["doc_id"].alias("doc_id"), F.unhex(F.md5(docs["text"])).alias("text_hash")]
    rows = docs.select(*ident, F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), lines.alias("lines"))

    split = docs.select(*ident, lines.alias("lines")).where(F.size("lines") >= window)
    at = lambda i: [F.get("lines", i + k) for k in range(window)]
    hashed = F.transform(F.sequence(F.lit(0), F.size("lines") - window), lambda i: F.when(
        F.concat_ws("", *at(i)).rlike(WORD), F.struct(F.xxhash64(*at(i)).alias("h1"), F.xxhash64(F.lit(1), *at(i)[::-1]).alias("h2"))))
    found = (split.select("doc_id", "text_hash", F.posexplode(hashed).alias("pos", "h"))
             .where("h is not null").select("doc_id", "text_hash", "pos", "h.h1", "h.h2"))

    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "pos")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("final")).where("first < final")
    later = found.join(first.select("h1", "h2", "first"), ["h1", "h2"]).where(place != F.col("first"))
    starts = later.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("starts"))
    starts = starts.select(F.col("doc_id").alias("s_id"), F.col("text_hash").alias("s_hash"), "starts")

    joined = rows.join(starts, rows["doc_id"].eqNullSafe(F.col("s_id")) & (rows["text_hash"] == F.col("s_hash")), "left")
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p, p + window - 1))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), covered)
    clean = F.when(F.col("starts").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    n_lines = F.when(F.col("row.text").isNull(), 0).otherwise(F.size("lines")).cast("long")
    counts = F.struct(n_lines.alias("n_lines"), F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_removed"))
    columns = [clean.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return joined.select(*columns, counts.alias(name))


ORACLE = """
with texts as (
  select row_number() over () as row_id, doc_id, text, string_split(text, chr(10)) as lines
  from (select distinct doc_id, text from documents)),
placed as (
  select row_id, doc_id, text, unnest(lines) as a, unnest(range(1, len(lines) + 1)) as i from texts),
triples as (
  select *, lead(a, 1) over w as b, lead(a, 2) over w as c from placed window w as (partition by row_id order by i)),
windows as (
  select row_id, i, row_number() over (partition by a, b, c order by doc_id nulls last, md5(text), i) as occurrence
  from triples where regexp_matches(a || b || c, '[^\\x20\\x09-\\x0D]')),
covered as (
  select row_id, list(distinct p) as gone from (select row_id, unnest([i, i + 1, i + 2]) as p from windows where occurrence > 1) group by row_id),
cleaned as (
  select doc_id, text, coalesce(len(lines), 0) as n_lines, coalesce(len(gone), 0) as n_removed,
    case when gone is null then text
      else array_to_string(list_transform(list_filter(range(1, len(lines) + 1), lambda i: not list_contains(gone, i)), lambda i: lines[i]), chr(10))
    end as clean
  from texts left join covered using (row_id))
select d.doc_id, cast(n_lines as bigint) as n_lines, cast(n_removed as bigint) as n_removed, md5(clean) as clean_md5
from documents d join cleaned c on d.doc_id is not distinct from c.doc_id and d.text is not distinct from c.text
"""
