"""The named queries of the operators, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspend.llm import op01_quality, op02_toxicity, op03_token_files, op04_lines, op05_minhash, op06_pii, op07_metric, op08_bpe, op09_lm
from adspend.llm import op10_mix as op10_mix_
from adspend.llm import op11_sentencepiece as op11_sentencepiece_
from adspend.llm import op12_collocations as op12_collocations_
from adspend.llm import op13_conversations as op13_conversations_
from adspend.llm.common import read, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_quality.quality(read(spark, sf_dir, "documents")).select(*op01_quality.OUTPUT)


ORACLE["op1_quality"] = op01_quality.oracle()


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    op03_token_files.write_files(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return op03_token_files.read_files(spark, path)


@query
def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return op04_lines.dedup_lines(docs).select("doc_id", "lines.*", F.md5("text").alias("clean_md5"))


ORACLE["op4_lines"] = op04_lines.ORACLE


@query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op05_minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op06_pii.personal_data(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op7_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_metric.near_vectors(read(spark, sf_dir, "embeddings"))


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_lm.score(read(spark, sf_dir, "documents"))


@query
def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return op10_mix_.mix(docs).select("doc_id", "source", "mix.*")


ORACLE["op10_mix"] = op10_mix_.oracle()


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_sentencepiece_.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_collocations_.collocations(read(spark, sf_dir, "documents"))


ORACLE["op12_collocations"] = op12_collocations_.oracle()


@query
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_conversations_.repair(read(spark, sf_dir, "conversations"))
