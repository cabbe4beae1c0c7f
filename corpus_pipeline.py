"""A training-data pipeline over the documents table.

Each stage takes the documents that its predecessor kept, with all their columns, and returns
a frame, which is written as Parquet to the shared folder and read again as the input of the
next one. All stages but the last return the columns of documents; the last one returns each
document's place in the mixed order, which does not rest on the order in which files are read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adspend.llm import op02_toxicity, op04_lines, op05_minhash, op08_bpe, op10_mix
from adspend.llm.common import WORD, read, unused, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that it holds for toxic go."""
    return op02_toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: later occurrences of three-line passages go, and documents left without a
    word by that; ``n_chars``, if there is one, counts the characters that stay."""
    name = unused(docs, "lines")
    clean = op04_lines.dedup_lines(docs, name)
    touched = F.col(f"{name}.n_removed") > 0
    kept = clean.where(~touched | F.col("text").rlike(WORD))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(touched, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return kept.select([f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of texts the row with the least id stays; of a group's rows with that
    id the first by text. Each row goes by its own text, whatever other rows have its id. Documents
    without an id stay."""
    key, same, group = unused(docs, "row_key"), unused(docs, "same_key"), unused(docs, "row_group")
    known = docs.where(docs["doc_id"].isNotNull()).withColumn(key, F.xxhash64(docs["doc_id"], docs["text"]))
    found = op05_minhash.near_duplicates(known.select(F.col(key).alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias(same), F.col("component_id").alias(group)).distinct()
    members = written(known.select(F.col(key).alias(same), "doc_id").distinct().join(groups, same), "members")
    first = members.groupBy(group).agg(F.min("doc_id").alias("doc_id"))
    stays = written(members.join(first, [group, "doc_id"]).select(same, group), "stays")
    # several texts of one id in one group: the first stays; only these few texts are looked at again
    several = stays.groupBy(group).agg(F.count("*").alias("n")).where("n > 1").select(group)
    tied = written(stays.join(several, group), "tied")
    texts = known.join(tied, F.col(key) == F.col(same)).select(same, group, "text")
    best = texts.groupBy(group).agg(F.min_by(same, "text").alias(same))
    stays = stays.join(written(tied.join(best, [group, same], "left_anti"), "later"), same, "left_anti")
    kept = known.join(stays, F.col(key) == F.col(same), "left_semi")
    # repeated rows stay once; the second hash keeps apart documents that meet in the first
    place, second = unused(kept, "place"), F.xxhash64(F.lit(1), docs["text"], docs["doc_id"])
    kept = kept.withColumn(place, F.row_number().over(Window.partitionBy(key, second).orderBy(key))).where(f"{place} = 1")
    return kept.drop(key, place).unionByName(docs.where(docs["doc_id"].isNull()))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the documents in the order that mixes their sources to the target weights."""
    return op10_mix.mixed(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every document is encoded, and decoded again; ``slot`` and ``start`` are its place
    in the mixed order, which follows from the documents and not from the order of the rows."""
    placed = op10_mix.mix(docs.select("doc_id", "source", "text")).select("doc_id", "text", "mix.slot", "mix.start")
    return op08_bpe.round_trip(placed, public_tokenizers.path("byte_bpe_50k.json"), ["slot", "start"])


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("bpe", bpe),
]

# the toxicity model cannot be expressed in SQL; tests/llm compares run() with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of the last stage, in the mixed order."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs.orderBy("slot", "start", "doc_id").drop("slot", "start")
