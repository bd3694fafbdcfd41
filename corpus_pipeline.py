"""Five stages from raw documents to training pieces: quality, lines, near-duplicates, mixture, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapeloom.llm import lines, mixing, ngram_join, pieces, quality
from shapeloom.llm import queries as q
from shapeloom.llm.common import ship, stored
from shapeloom.session import table

#: SQL can state neither the classifiers nor the pieces.
ORACLE_SQL = None


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line passages; one left without text goes."""
    return lines.without_repeated_lines(docs)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class."""
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says."""
    return mixing.mixed(docs, q.label_domains(spark, sf_dir), q.MIX_TARGETS, anchor="clean")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with its id and source."""
    model = pieces.load_model()
    encoded = pieces.with_pieces(docs, model)
    return encoded.select("doc_id", "lang", "source", F.size("pieces").alias("n_pieces"), "pieces")


STAGES = [
    ("quality classifier", reject_poor),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", one_of_each_class),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    ship(docs)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage{k + 1}")
    return docs
