"""Operator 10: mixing sources to target weights by Pfair scheduling.

Each source's documents form one stream of characters, cut into blocks of ``block_chars``.
A source of weight a out of L gives its k-th block (from 0) the release time
``floor(k * L / a)`` and the deadline ``ceil((k + 1) * L / a)``, in slots; in every slot the
released block with the earliest deadline runs (ties: the source first by name). So after
any number of slots each source has run its share less or more by under one block, as long
as all sources have blocks. The weights fill the time exactly, hence the schedule repeats
every L slots: one period is worked out, and each block's slot follows from its number.
Sources that end earlier leave their slots empty; no document is dropped or repeated.

Documents of a source are ordered by the md5 of id and text. A document's place in its source's
stream is the total of the hash buckets before its own and the running sum inside its
bucket, so a source with a third of all rows, or different texts without an id or with one id, are
spread over all its buckets. The totals and
the plan of a source enter each bucket as a head row, and the texts are shuffled once.

Target weights: ``weights`` maps source names to whole numbers; sources not named get
``other``. Without it the weight is the square root of the source's share of characters,
in units of 1/``units`` and at least 1. The period table has one row for each unit of weight
of all sources (about ``units`` + number of sources), and its one-row fold costs their product,
which is meant for up to some thousand sources.

Results: a null source is a source of its own, a null text or an empty one has no characters
and takes the place where it stands; repeated rows and null ids are placed like others, in
the order of id and text; an empty table gives no rows. Every column of the input is kept:
the placement is one struct column (``name`` says how it is called).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspend.llm.common import unused

BLOCK_CHARS = 65_536
UNITS = 1000
BUCKET_DIGITS = 3


def source_weights(docs: DataFrame, weights: dict[str, int] | None = None, other: int = 1, units: int = UNITS) -> DataFrame:
    """``source, units`` with one row for each source (null included) of ``source, chars`` rows."""
    sums = docs.groupBy("source").agg(F.sum("chars").alias("chars"))
    if weights is not None:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.lit(None).cast("map<string,int>")
        return sums.select("source", F.greatest(F.lit(1), F.coalesce(F.get(F.map_values(F.map_filter(named, lambda k, _: k == F.col("source"))), F.lit(0)), F.lit(other))).cast("long").alias("units"))
    roots = sums.select("source", F.floor(F.sqrt(F.col("chars").cast("double"))).alias("root"))
    total = F.greatest(F.sum("root").over(Window.partitionBy()), F.lit(1))
    return roots.select("source", F.greatest(F.floor((F.col("root") * units) / total), F.lit(1)).cast("long").alias("units"))


def period(weighted: DataFrame) -> DataFrame:
    """``source, units, k, period, slot``: the slot of each source's k-th block in a period.

    One row folds over the slots of the period; its state is the number of blocks each source
    has run. Input and output are small: one row for each source, one for each unit.
    """
    row = weighted.agg(F.sort_array(F.collect_list(F.struct(
        F.col("source").isNotNull().alias("named"), "source", "units"))).alias("s"), F.sum("units").alias("period"))
    s, length = F.col("s"), F.col("period")

    def ready(done: Column, slot: Column, x: Column, i: Column) -> Column:
        k, a = F.get(done, i), x["units"]
        release, deadline = F.floor(k * length / a), F.ceil((k + 1) * length / a)
        return F.when(release <= slot, F.struct(deadline.alias("deadline"), i.alias("i")))

    def step(state: Column, slot: Column) -> Column:
        best = F.array_min(F.transform(s, lambda x, i: ready(state["done"], slot, x, i)))["i"]
        return F.struct(
            F.transform(state["done"], lambda k, i: F.when(i == best, k + 1).otherwise(k)).alias("done"),
            F.concat(state["order"], F.array(best)).alias("order"))

    start = F.struct(F.transform(s, lambda _: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("order"))
    order = F.aggregate(F.sequence(F.lit(0).cast("long"), length - 1), start, step, lambda x: x["order"])
    slots = (row.where(F.size("s") > 0).select("s", "period", F.posexplode(order).alias("slot", "i"))
             .select(F.get("s", "i").alias("x"), "period", F.col("slot").cast("long").alias("slot")))
    by_source = Window.partitionBy("source").orderBy("slot")
    return (slots.select("x.source", "x.units", "period", "slot")
            .withColumn("k", (F.row_number().over(by_source) - 1).cast("long")))


def mix(docs: DataFrame, weights: dict[str, int] | None = None, other: int = 1, units: int = UNITS,
        block_chars: int = BLOCK_CHARS, bucket_digits: int = BUCKET_DIGITS, name: str = "mix") -> DataFrame:
    """``docs`` with the struct ``name``: ``units, period, start, block, slot, release, deadline``.

    ``start`` counts the characters of the source before the document, ``block`` is the block
    it starts in. The mixed order is the order of ``slot``, then ``start``.
    """
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    key = F.md5(F.concat_ws("\n", docs["doc_id"].cast("string"), docs["text"]).cast("binary"))
    chars = F.coalesce(F.length(docs["text"]), F.lit(0)).cast("long")
    rows = docs.select(docs["source"].alias("source"), F.substring(key, 1, bucket_digits).alias("bucket"),
                       chars.alias("chars"), key.alias("key"), whole.alias("row"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("chars").alias("chars"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.withColumn("chars", F.coalesce(F.sum("chars").over(earlier), F.lit(0)))
    plans = (period(source_weights(sums, weights, other, units)).groupBy("source")
             .agg(F.struct(F.first("units").alias("units"), F.first("period").alias("period"),
                           F.sort_array(F.collect_list(F.struct("k", "slot")))["slot"].alias("slots")).alias("plan"))
             .withColumnRenamed("source", "planned"))
    heads = heads.join(plans, F.col("source").eqNullSafe(F.col("planned"))).drop("planned")

    # each bucket is headed by a row that holds what lies before it and its source's plan
    both = rows.unionByName(heads, allowMissingColumns=True)
    inside = Window.partitionBy("source", "bucket").orderBy(F.col("plan").isNull(), "key", F.col("row.doc_id"), F.col("row.text"))
    placed = both.select(
        "row",
        F.sum("chars").over(inside.rowsBetween(Window.unboundedPreceding, -1)).alias("start"),
        F.first("plan", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("plan"),
    ).where(F.col("row").isNotNull())
    start, a, length = F.col("start"), F.col("plan.units"), F.col("plan.period")
    b = F.floor(start / block_chars)
    slot = F.floor(b / a) * length + F.get("plan.slots", (b % a).cast("int"))
    return placed.select("row.*", F.struct(
        a.alias("units"), length.alias("period"), start.alias("start"), b.alias("block"), slot.alias("slot"),
        F.floor(b * length / a).alias("release"), F.ceil((b + 1) * length / a).alias("deadline")).alias(name))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, globally sorted into the mixed order."""
    name = unused(docs, "mix")
    placed = mix(docs, name=name, **options)
    return placed.orderBy(f"{name}.slot", f"{name}.start", "doc_id").drop(name)


def oracle(units: int = UNITS, block_chars: int = BLOCK_CHARS) -> str:
    """DuckDB SQL for ``doc_id, source`` and the placement: one running sum for each source,
    and the schedule by a recursive query over the slots."""
    return f"""
with recursive texts as (
  select doc_id, source, text, coalesce(text, '') as t, cast(coalesce(length(text), 0) as bigint) as chars from documents),
placed as (
  select doc_id, source, coalesce(sum(chars) over (
    partition by source order by md5(concat_ws(chr(10), cast(doc_id as varchar), text)), doc_id, t
    rows between unbounded preceding and 1 preceding), 0) as start from texts),
roots as (select source, cast(floor(sqrt(sum(chars))) as bigint) as root from texts group by source),
weighted as (
  select source, greatest(root * {units} // greatest((select sum(root) from roots), 1), 1) as units,
    row_number() over (order by source nulls first) as i from roots),
total as (select sum(units) as period, list(units order by i) as a, count(*) as n from weighted),
schedule(slot, i, done) as (
  select cast(-1 as bigint), cast(0 as bigint), list_transform(a, lambda x: cast(0 as bigint)) from total
  union all
  select slot + 1, best, list_transform(range(1, n + 1), lambda j: done[j] + case when j = best then 1 else 0 end)
  from (
    select slot, done, n, list_aggregate(list_filter(list_transform(range(1, n + 1), lambda j:
      case when done[j] * period // a[j] <= slot + 1
        then (((done[j] + 1) * period + a[j] - 1) // a[j]) * 1000000 + j end), lambda x: x is not null), 'min') % 1000000 as best
    from schedule, total where slot + 1 < period)),
slots as (
  select w.source, w.units, t.period, s.slot, row_number() over (partition by s.i order by s.slot) - 1 as k
  from schedule s join weighted w using (i) cross join total t where s.slot >= 0),
blocks as (select doc_id, source, start, start // {block_chars} as block from placed)
select b.doc_id, b.source, cast(units as bigint) as units, cast(period as bigint) as period, cast(start as bigint) as start,
  cast(block as bigint) as block, cast(block // units * period + slot as bigint) as slot,
  cast(block * period // units as bigint) as release, cast(((block + 1) * period + units - 1) // units as bigint) as deadline
from blocks b join slots s on b.source is not distinct from s.source and b.block % s.units = s.k
"""
