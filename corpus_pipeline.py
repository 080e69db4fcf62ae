"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back as the next stage's docs. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwater.llm import exact_dedup, mixing, near_dup, packing, toxicity
from tarnwater.session import Tables, materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the scorer learns from all labelled documents."""
    return toxicity.without_toxic(docs, toxicity.fit_toxicity(docs, Tables(spark, sf_dir).labels))


def exact_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id."""
    return exact_dedup.without_duplicates(docs)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id."""
    return near_dup.one_per_class(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture, which the written files keep: by file name, and by row inside a file."""
    return mixing.in_order(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 ids, documents one behind another in the order of the files."""
    name = F.col("_metadata.file_name")
    number = F.lpad(F.regexp_extract(name, r"part-(\d+)", 1), 12, "0")
    placed = docs.select("doc_id", "text", F.concat(number, name).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return packing.pack(placed, order=("_file", "_row"))


STAGES = [("toxicity", toxic_out), ("exact_dedup", exact_duplicates_out), ("near_dedup", near_duplicates_out), ("mixing", mixed), ("packing", packed)]

#: A fitted tagger, MinHash and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences of all documents that stay."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
