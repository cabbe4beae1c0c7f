"""Operator 7: near-duplicate embeddings by an exact metric range join.

Vectors of a label are compared by cosine; on the unit sphere ``cosine >= t`` is the chord
distance ``e = sqrt(2 - 2 t)`` or less.

1. Rows with the same bytes in one label form a class, named by its least vec_id; only
   classes go on, with their number of rows.
2. Pivots, chosen by hash among the classes of each large label, partition the label:
   a vector's home is the cell of its nearest pivot. A vector within ``e`` of one at home in
   another cell is at most ``2 e`` farther from that cell's pivot than from its own, by the
   triangle inequality, and at most ``e`` from the plane between the two pivots. Every vector
   is copied to the later cells that satisfy both.
3. Cells join independently. A cell is cut into blocks, and each pair of blocks is a task, so
   no task grows with a cell. A task returns the number of links of each class and the
   components among its rows, never the pairs.
4. Large-star and small-star steps join the components of all tasks.

The pivots are broadcast: at most ``max_pivots`` vectors in all, however large the tables are.
Their choice decides how the work is cut, not what is found.

Results: vectors that are null, empty, zero or hold null or non-finite components and rows
without label link with nothing, and are kept; vectors of different lengths never link; rows
that repeat a vec_id are vectors like others, and share a component; a null vec_id has a
component, links with nothing and is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspend.llm.common import written
from adspend.llm.components import components

THRESHOLD = 0.98
CELL = 512
LABEL_PIVOTS = 256
MAX_PIVOTS = 4096
BLOCK = 1024
SLACK = 1e-7


def _classes(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with their class key (null where they link with nothing), and the classes."""
    v = F.col("embedding")
    sound = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    some = F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    fit = sound & some & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    key = F.struct("label", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), F.col("embedding")).alias("h2"))
    rows = embeddings.select("vec_id", "label", "embedding", F.when(fit, key).alias("key"))
    classes = (rows.where("key is not null").groupBy("key")
               .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("embedding").alias("vector"))
               .select("key", "key.label", F.col("key.h1").alias("h1"), F.size("vector").alias("dim"), "node", "copies", "vector"))
    return rows.select("vec_id", "key"), classes


def _pivots(classes: DataFrame, cell: int, label_pivots: int, max_pivots: int) -> dict[tuple[int, int], np.ndarray]:
    """Unit pivots of each (label, dim): one for ``cell`` classes, none for a label of one cell."""
    sizes = classes.groupBy("label", "dim").count().where(F.col("count") > cell)
    sizes = sizes.select("label", "dim", F.least(F.lit(label_pivots), F.ceil(F.col("count") / cell)).alias("n")).orderBy(F.desc("n"), "label", "dim").limit(max_pivots // 2)
    wanted, left = [], max_pivots
    for r in sizes.collect():
        if (n := min(r.n, left)) > 1:
            wanted.append((r.label, r.dim, int(n)))
            left -= n
    if not wanted:
        return {}
    want = classes.sparkSession.createDataFrame(wanted, "label long, dim int, n int")
    # a narrow choice by hash before the ranking: a few times the number wanted, of each label
    ranked = classes.select(F.col("label").cast("long").alias("label"), "dim", "node", F.xxhash64("node").alias("h"))
    chance = ranked.join(F.broadcast(want), ["label", "dim"]).join(
        classes.groupBy(F.col("label").cast("long").alias("label"), "dim").agg(F.count("*").alias("of")), ["label", "dim"])
    chance = chance.where(F.pmod("h", F.lit(1 << 20)) < F.ceil((4 * F.col("n") + 64) * (1 << 20) / F.col("of")))
    first = chance.withColumn("k", F.row_number().over(Window.partitionBy("label", "dim").orderBy("h", "node"))).where("k <= n")
    rows = first.select("node", "label").join(classes.select("node", "vector"), "node").orderBy("label", "node").collect()
    out: dict[tuple[int, int], list] = {}
    for r in rows:
        out.setdefault((r.label, len(r.vector)), []).append(_unit(np.array([r.vector], np.float64))[0])
    return {k: np.array(v) for k, v in out.items()}


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _placed(pivots: dict[tuple[int, int], np.ndarray], reach: float):
    """Rows of classes with ``cell`` and ``home``, one for each cell they belong or are copied to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, dims = batch.column("label").to_numpy(), batch.column("dim").to_numpy()
            rows, cells, homes = [], [], []
            for label, dim in sorted(set(zip(labels.tolist(), dims.tolist()))):
                at = np.flatnonzero((labels == label) & (dims == dim))
                if (label, dim) not in pivots:
                    rows.append(at), cells.append(np.zeros(len(at), np.int64)), homes.append(np.ones(len(at), bool))
                    continue
                p = pivots[label, dim]
                u = _unit(_vectors(batch.column("vector").take(pa.array(at)), dim))
                square = np.maximum(2 - 2 * (u @ p.T), 0)
                between = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0))
                home = square.argmin(1)
                own = square[np.arange(len(at)), home][:, None]
                near = np.sqrt(square) - np.sqrt(own) <= 2 * reach
                near &= square - own <= 2 * reach * between[home]
                near &= np.arange(len(p)) > home[:, None]
                i, c = np.nonzero(near)
                rows += [at, at[i]]
                cells += [home, c]
                homes += [np.ones(len(at), bool), np.zeros(len(i), bool)]
            if rows:
                out = batch.take(pa.array(np.concatenate(rows)))
                yield pa.record_batch([*out.columns, pa.array(np.concatenate(cells).astype(np.int32)), pa.array(np.concatenate(homes))],
                                      names=[*batch.schema.names, "cell", "home"])

    return run


def _joined(threshold: float):
    """Links of each class of a task, and the least class it is connected to inside the task."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, h1, copies, home, side = (table.column(c).to_numpy() for c in ("node", "h1", "copies", "home", "side"))
        v = _vectors(table.column("vector").chunk(0), int(table.column("dim")[0].as_py()))
        v = v / np.abs(v).max(1, keepdims=True)
        norm = np.sqrt((v * v).sum(1))
        a, b = np.flatnonzero(side < 2), np.flatnonzero(side != 1)
        close = (v[a] @ v[b].T) / (norm[a][:, None] * norm[b][None, :]) >= threshold
        close &= home[a][:, None] | home[b][None, :]
        close &= a[:, None] != b[None, :]
        links = np.zeros(len(node), np.int64)
        links[a] += close @ copies[b]
        if side[0]:
            links[b] += copies[a] @ close
        least = node.copy()
        while True:
            before = least.copy()
            big = np.iinfo(np.int64).max
            least[a] = np.minimum(least[a], np.where(close, least[b][None, :], big).min(1, initial=big))
            least[b] = np.minimum(least[b], np.where(close, least[a][:, None], big).min(0, initial=big))
            if (before == least).all():
                break
        some = links > 0
        return pa.table({"node": node[some], "h1": h1[some], "links": links[some], "least": least[some]})

    return run


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, cell: int = CELL, label_pivots: int = LABEL_PIVOTS,
                 max_pivots: int = MAX_PIVOTS, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings``."""
    rows, classes = _classes(embeddings)
    classes = written(classes, "classes")
    pivots = _pivots(classes, cell, label_pivots, max_pivots)
    reach = float(np.sqrt(max(2 - 2 * threshold, 0))) + SLACK
    kept = classes.select("label", "dim", "node", "h1", "copies", "vector")
    schema = T.StructType([*kept.schema, T.StructField("cell", T.IntegerType()), T.StructField("home", T.BooleanType())])
    placed = written(kept.mapInArrow(_placed(pivots, reach), schema), "placed")

    blocks = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1").drop("n")
    dealt = placed.join(blocks, ["label", "dim", "cell"])
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    dealt = dealt.select("label", "dim", "cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                         side.alias("side"), "node", "h1", "copies", "home", "vector")
    found = dealt.groupBy("label", "dim", "cell", "i", "j").applyInArrow(_joined(threshold), "node long, h1 long, links long, least long")
    found = written(found, "links")

    # rows that share a vec_id but not their vector tie the classes of their vectors
    ids = rows.where("key is not null").groupBy("vec_id").agg(F.min("key.h1").alias("a"), F.max("key.h1").alias("b")).where("a <> b")
    ties = rows.join(ids.select("vec_id"), "vec_id", "left_semi").join(classes.select("key", "node"), "key").select(F.col("vec_id").alias("u"), F.col("node").alias("v"))
    named = components(found.select(F.col("node").alias("u"), F.col("least").alias("v")).unionByName(ties))
    linked = found.groupBy("node", "h1").agg(F.sum("links").alias("links"))
    of_class = (classes.select("key", "node", "h1", "copies").join(linked, ["node", "h1"], "left").join(named, "node", "left")
                .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("found")))
    out = rows.join(of_class, "key", "left")
    # a row without a class may share its vec_id with rows that have one
    linked_ids = named.select(F.col("node").alias("vec_id"), F.col("component").alias("by_id"))
    out = out.join(linked_ids, "vec_id", "left")
    component = F.coalesce("found", "by_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
