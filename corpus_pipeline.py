"""Corpus pipeline: the documents table through five operators, each stage written as
Parquet and read again as the next one's input.

A stage takes (spark, docs, sf_dir). The first four return the columns of documents: toxic
documents go, documents in no known language go, one document of each group of near copies
stays, benchmark words are cut out of the text; the last returns packed token pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectra.llm import decontaminate, langid, neardup, packing, toxicity
from aspectra.llm.common import read_table, stored
from aspectra.llm.queries import tokenizer_path
from aspectra.session import ship_package


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return langid.keep_known(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word shingles of five at a similarity of 0.8."""
    ship_package(spark)
    return neardup.drop_copies(docs, k=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Hit words leave the text; the document stays, with n_chars of the new text."""
    ship_package(spark)
    clean = decontaminate.remove_spans(docs, read_table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxic_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The stages learn models and pack by least squares, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, name)
    return docs
