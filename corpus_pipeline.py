"""The corpus pipeline: documents to a mixed, deduplicated, decontaminated corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents. Near-duplicate joining takes shingles of five words and
a similarity of 0.8.

Defined results: a null text counts as empty; rows with a null id are kept or
dropped by their texts like others and come after all ids where one of a group
stays; equal rows (id and text) are kept or dropped together; a very long text
is one document throughout; an empty table gives an empty mix; columns besides
id, text, source and label are carried through up to the last stage, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import kit
from leafmill.llm.decontaminate import decontaminate
from leafmill.llm.exact_dedup import exact_dedup
from leafmill.llm.jaccard_join import jaccard_dedup
from leafmill.llm.mixing import mixed_corpus
from leafmill.llm.quality import quality_filter

#: SQL cannot express the classifier; tests hold every stage against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_filter(docs, kit.read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents one stays."""
    return jaccard_dedup(docs, k=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, kit.read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixed_corpus(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kit.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kit.save(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
