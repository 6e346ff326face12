"""A corpus pipeline of the training-data operators: language, copies, near copies, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last return the
columns of ``documents``, and columns beside these, whatever their names. An empty table passes through empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.llm import exact_dedup, language_id, near_dedup
from runnel.llm.packing import pack_documents
from runnel.llm.source_mix import mixed_documents
from runnel.llm.storage import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language for 40 % of their words, go; so null and empty texts go.

    Repeated rows and ids are each judged by their text. Without a labelled text nothing can be learned and all stay.
    """
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_identified(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays, one row of it; null text is empty text.

    Rows are told apart by doc_id and text: of two texts under one doc_id each is judged by itself.
    """
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the smallest doc_id stays; documents without words are linked with nothing.

    Texts under one doc_id are one document here: they stay or go together. Rows without doc_id go only if their
    shingles are those of a document that has one.
    """
    return near_dedup.survivors(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's target weight takes them: not at all, once or twice.

    A null source is a source of its own. Rows of one doc_id, or of none, have the same copies.
    """
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 1024 tokens; every row is a document of its own, null text is the end id alone."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix),
    ("pack", pack),
]

#: The random field and the packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
