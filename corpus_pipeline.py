"""A corpus pipeline of five stages, each over all rows its predecessor kept.

Stages judge rows, not ids: null and repeated ids, null, empty and very long texts and columns of any further name go
through all of them, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tomewright.llm.common import table, work_table
from tomewright.llm.cotrain import fit_quality, keep_quality
from tomewright.llm.decontaminate import clean
from tomewright.llm.mixing import mix
from tomewright.llm.pii import mask
from tomewright.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the co-trained classifier rejects go; each is judged by itself, whatever its id."""
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays, once. Rows with a null id stay."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go; other rows of their id stay."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by the name of its kind; null texts stay null."""
    return mask(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a row comes as often as it is taken, a null source is a source."""
    return mix(docs)


STAGES = [("quality_classifier", quality), ("simhash_near_dedup", near_dedup), ("benchmark_decontamination", decontaminate), ("pii", pii), ("mixing", mixing)]

#: Fitted classifiers, fingerprints and Viterbi decoding can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
