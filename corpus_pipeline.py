"""Training-corpus pipeline: judge quality, remove repeated chunks, keep one of near copies, mix, encode.

A stage takes the rows that the one before it kept; all but the last return the columns of documents, and
other columns pass whatever their names. An empty table gives an empty one at every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gamelake.llm import bpe, mixing, quality, simhash, units
from gamelake.llm.common import fresh, materialise, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts. Null and empty texts are judged as texts without
    n-grams; rows without an id by their text; repeated rows stay or go together."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier ranked chunk. Null texts stay null; a text of
    which nothing is left is empty; repeated rows are cut alike."""
    return units.drop_repeated_chunks(docs, offsets=None)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the one with the smallest id) of each group of near copies. Rows without an id stay;
    empty and null texts are near copies of each other; repeated rows stay or go together."""
    return simhash.keep_one(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its Poisson count says, so that sources have equal shares; a document may
    be there several times or not at all. Null sources are one source; null ids share one count."""
    return mixing.mix(docs, "source", added=tuple(fresh(docs, "copy", "mix_key"))).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row. Null and empty texts have no tokens;
    repeated rows have one row each."""
    return bpe.encode_and_decode(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing_sources", mixing_sources),
    ("bpe_encoding", bpe_encoding),
]

#: SQL can't express the classifier, the fingerprints or the byte-pair merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
