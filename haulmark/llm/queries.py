"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import (
    fingerprints,
    html_blocks,
    language,
    lexical,
    mixing,
    near_dups,
    packing,
    pieces,
    quality,
    runs,
    sharding,
    token_counts,
    topk,
)
from haulmark.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(read(spark, sf_dir, "pages"))


@query
def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"), ["doc_id"])


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.train(docs)
    rows = docs.withColumn("held_out", language.held_out(F.col("doc_id")))
    return language.identify(rows, model, ["doc_id", "held_out"])


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("copies") * F.col("size")).alias("taken")
    mix = mixing.mix(read(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", taken)


@query
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read(spark, sf_dir, "documents"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    rows = docs.withColumn("held_out", language.held_out(F.col("doc_id")))
    return quality.score(rows, model, ["doc_id", "held_out"])


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints.fingerprints(read(spark, sf_dir, "documents"))
    return fingerprints.with_neighbours(prints)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(read(spark, sf_dir, "documents"))


@query
def op12_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
