"""A corpus pipeline of five stages over the table of documents.

Each stage is a function of (session, documents, data folder) and gives documents again; the
last one adds the pieces of each text. ``run`` writes each stage's rows to the shared folder
and reads them back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import language, mixing, near_dups, pieces, quality
from haulmark.llm.tables import fresh, read, written

LEAST_SHARE = 0.5  # of a document's words that must be in its main language


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language: texts without letters and mere mixtures go."""
    found = language.identify(docs, language.train(docs), docs.columns)
    name, score = fresh("lang_pred", docs.columns), fresh("score", docs.columns)
    known = (F.col(name) != language.UNKNOWN) & (F.col(score) >= LEAST_SHARE)
    return found.filter(known).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, docs.columns)
    return scored.filter(F.col(fresh("predicted", docs.columns)) == 1).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dups.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their pieces, checked by decoding."""
    return pieces.encode(docs, docs.columns)


STAGES = [
    ("language", keep_languages),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("pieces", encode_pieces),
]

ORACLE_SQL = None  # SQL cannot express the models; tests hold the stages to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
