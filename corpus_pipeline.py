"""The training-corpus pipeline: each stage takes what the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a frame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.

1. language: documents without a letter have no language and go.
2. near_duplicates: of each SimHash group the document with the smallest id stays.
3. repeats: passages of 50 bytes or more that an earlier document holds are cut out.
4. mixing: documents are dropped or repeated until the sources meet their weights.
5. packing: the pieces of all documents and their places in sequences.

Nulls, ties, repeated rows, empty tables and extra columns: see the operators;
every stage passes extra columns on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickweave.llm import language, mixing, packing, repeats, simhash
from clickweave.llm.common import read_table
from clickweave.session import shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.cut(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The stages use hashes, trees and a tokenizer that SQL does not have; tests/llm
# holds them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; stages are handed over as
    Parquet in the session's shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    folder = shared_dir(spark, f"pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = f"{folder}/{i + 1}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
