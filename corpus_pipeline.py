"""Raw documents to packed training sequences: filter, classify, clean, deduplicate, pack.

Every stage works on all rows its predecessor kept, and is written as Parquet and read
again before the next. Null ids, texts and other columns, empty texts, repeated rows
and empty tables are handled as the operators' docstrings say; extra columns of the
first table are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import read_table, stored
from meterline.llm.cotrain import quality_scores
from meterline.llm.line_dedup import dedup_lines
from meterline.llm.packing import pack
from meterline.llm.quality_rules import quality_rules
from meterline.llm.simhash import one_of_each

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, their own and their host's."""
    return quality_rules(docs, columns=COLUMNS).filter("kept").select(COLUMNS)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good."""
    labels = read_table(spark, sf_dir, "labels")
    return quality_scores(docs.select(COLUMNS), labels).filter("kept").select(COLUMNS)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that many of them share; n_chars is counted anew.

    Of large groups of copies one stays whole.
    """
    cleaned = dedup_lines(docs.select(COLUMNS), keep_copy=True)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs.select(COLUMNS)).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("line dedup", lines_stage),
    ("simhash near-dedup", near_duplicates_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: The classifier's verdicts and the packing cannot be expressed in SQL.
ORACLE_SQL = None
