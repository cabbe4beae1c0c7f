"""Operator 5: near-duplicate documents by SuperMinHash, banding, verification, union-find.

1. Each text becomes the set of its word shingles and a SuperMinHash signature of
   ``bands * rows`` slots. Texts with equal sets form a class; only classes go on, named by
   their least doc_id, so a large group of copies is one row.
2. Classes that agree on all slots of a band share a bucket. In each bucket every class is
   compared with the least one only (the hub), by the sizes of intersection and union of
   the full sets. Links that hold are joined to components.
3. Buckets that still hold several components are searched whole: their classes are cut
   into blocks, pairs of blocks are dealt to tasks, and each task compares the classes of
   different components whose first common band this is. It returns the links that join two
   components, never the pairs. So every pair of classes with a common bucket is linked,
   or known to be unlinked, or in one component already.
4. Large-star and small-star steps over all links (a distributed union-find) give the
   components.

Two sets with Jaccard similarity s share a bucket with probability ``1 - (1 - s**rows)**bands``:
0.999995 at 0.75 with the defaults. Shingles are compared by 64-bit hashes.

Results: a null or empty text has an empty set, is linked with nothing and kept; rows that
share a doc_id are one document and have one component; a row without doc_id is linked with
nothing, has a null component and is kept; an empty table gives no rows; other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspend.llm.common import written
from adspend.llm.components import components
from adspend.llm.op08_bpe import slices
from adspend.llm.shingles import Words, mix64, shingle_sets, superminhash

BANDS, ROWS = 32, 4
PER_CENT = 75
BLOCK = 512
SALT = np.uint64(0xD6E8FEB86659FD93)


def _digests(sets: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums that name each set."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for values in (mix64(sets ^ SALT), mix64(sets + SALT)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        out.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
    return out


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(values.view(np.int64)))


def _batches(batches: Iterator[pa.RecordBatch]):
    words = Words()
    for batch in batches:
        for a, b in slices(batch, "text"):
            part = batch.slice(a, b - a)
            yield part.column("doc_id"), *shingle_sets(*words.of(part.column("text").to_pylist()))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, bands``: set size, set digest and band keys of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets, sizes in _batches(batches):
            slots = superminhash(sets, sizes, bands * rows).reshape(-1, bands, rows)
            keys = np.zeros(slots.shape[:2], np.uint64)
            for k in range(rows):
                keys = mix64(keys * SALT + slots[:, :, k])
            some = np.where(sizes > 0, bands, 0)
            yield pa.record_batch([ids, pa.array(sizes.astype(np.int64)), *map(pa.array, _digests(sets, sizes)),
                                   _lists(keys[sizes > 0].reshape(-1), some)], names=["doc_id", "n_shingles", "d1", "d2", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, d1, d2, shingles``: the sorted distinct shingle hashes of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets, sizes in _batches(batches):
            yield pa.record_batch([ids, *map(pa.array, _digests(sets, sizes)), _lists(sets, sizes)], names=["doc_id", "d1", "d2", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, d1 long, d2 long, shingles array<long>")


def _search(per_cent: int):
    """Links that join different components inside the buckets of one task."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        get = lambda c: table.column(c).to_numpy()
        node, label, band, key, side = (get(c) for c in ("node", "label", "band", "key", "side"))
        bands = np.stack(table.column("bands").to_numpy()) if len(node) else np.empty((0, 0))
        sets = table.column("shingles").to_numpy()
        sizes = np.array([len(s) for s in sets], np.int64)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        out: list[tuple[int, int]] = []
        order = np.lexsort((side, key, band))
        edges = np.flatnonzero(np.diff(band[order]) | np.diff(key[order])) + 1
        for group in np.split(order, edges):
            own = int(band[group[0]])
            left = group[side[group] < 2]  # side: 0 in both blocks (a block with itself), 1 in the first, 2 in the second
            for place, x in enumerate(left):
                others = left[place + 1:] if side[x] == 0 else group[side[group] == 2]
                if not len(others):
                    continue
                root = find(int(label[x]))
                far = np.fromiter((find(int(v)) != root for v in label[others]), bool, len(others))
                far &= 100 * np.minimum(sizes[others], sizes[x]) >= per_cent * np.maximum(sizes[others], sizes[x])
                others = others[far]
                if own and len(others):
                    others = others[~(bands[others, :own] == bands[x, :own]).any(1)]
                if not len(others):
                    continue
                flat = np.concatenate(sets[others])
                at = np.minimum(np.searchsorted(sets[x], flat), sizes[x] - 1)
                common = np.add.reduceat((sets[x][at] == flat).astype(np.int64), np.append(0, np.cumsum(sizes[others])[:-1]))
                for y in others[100 * common >= per_cent * (sizes[others] + sizes[x] - common)]:
                    a, b = find(int(label[x])), find(int(label[y]))
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        out.append((int(node[x]), int(node[y])))
        return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, per_cent: int = PER_CENT, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    signed = written(signatures(docs, bands, rows), "signatures")
    classes = (signed.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2")
               .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")))
    classes = written(classes, "classes")

    slots = classes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = slots.groupBy("band", "key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top").drop("top")
    buckets = written(slots.join(shared, ["band", "key"]), "buckets")

    members = buckets.select("node").distinct()
    sets = full_sets(docs.select("doc_id", "text").join(members, F.col("doc_id") == F.col("node"), "left_semi"))
    sets = written(sets.join(classes.select("d1", "d2", "node"), ["d1", "d2"]).where("doc_id = node")
                   .select("node", "shingles").dropDuplicates(["node", "shingles"]), "sets")

    hubs = buckets.where("node <> hub").select("hub", "node").distinct()
    pairs = hubs.join(sets, "node").join(sets.select(F.col("node").alias("hub"), F.col("shingles").alias("other")), "hub")
    common = F.size(F.array_intersect("shingles", "other"))
    joined = F.size("shingles") + F.size("other") - common
    links = written(pairs.where(100 * common >= per_cent * joined).select(F.col("hub").alias("u"), F.col("node").alias("v")), "links")

    labels = components(links)
    named = (buckets.join(labels, "node", "left").select("band", "key", "node", F.coalesce("component", "node").alias("label")))
    named = written(named, "named")
    mixed = written(named.groupBy("band", "key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("size"))
             .where("a < b").select("band", "key", F.ceil(F.col("size") / block).cast("int").alias("blocks"), "size"), "mixed")
    small = mixed.where("blocks = 1").agg(F.sum("size")).first()[0] or 0
    rest = named.join(mixed.drop("size"), ["band", "key"]).join(sets, "node").join(classes.select("node", "bands"), "node")
    links = links.unionByName(written(_residual(rest, per_cent, block, 1 + small // (2 * block)), "links"))
    found = components(links)

    of_class = classes.select("d1", "d2", "node").join(found, "node", "left").select("d1", "d2", F.coalesce("component", "node").alias("found"))
    # rows that share a doc_id are one document: the least component of its texts holds
    mine = signed.where("n_shingles > 0 and doc_id is not null").select("doc_id", "d1", "d2").distinct().join(of_class, ["d1", "d2"])
    mine = mine.groupBy("doc_id").agg(F.min("found").alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(mine, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _residual(rest: DataFrame, per_cent: int, block: int, lots: int) -> DataFrame:
    """Links between components inside the buckets ``rest``, found block by block.

    A bucket of one block is dealt to a task together with other small ones; a larger one
    becomes a task for each pair of its blocks.
    """
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = rest.withColumn("mine", mine).select("*", other)
    lot = F.pmod(F.xxhash64("band", "key"), F.lit(lots))
    task = F.when(F.col("blocks") == 1, lot).otherwise(
        F.xxhash64("band", "key", F.least("mine", "other"), F.greatest("mine", "other")))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    dealt = dealt.select(task.alias("task"), side.alias("side"), "band", "key", "node", "label", "bands", "shingles")
    return dealt.groupBy("task").applyInArrow(_search(per_cent), "u long, v long")
