"""The training-data pipeline: from raw documents to shards of a mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of ``documents``.

In every stage null and empty texts are documents without words, rows without a
doc_id and repeated rows are documents of their own unless a stage says
otherwise, an empty table gives an empty one, long texts count whole, and
further columns pass through whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trainyard.llm import (decontamination, mixing, quality, sharding,
                           simhash)
from trainyard.llm.common import prepare, table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str
                   ) -> DataFrame:
    """Documents that the quality classifier accepts.  Equal texts stand or
    fall together."""
    prepare(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str
                    ) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with
    the smallest doc_id (null last, ties by a hash of the text; of equal rows
    one).  Texts without words are one group."""
    prepare(spark)
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str
                  ) -> DataFrame:
    """Documents without any benchmark passage; null texts have none."""
    prepare(spark)
    return decontamination.remove_contaminated(
        docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes, as documents: a document of a source that is
    repeated comes once per pass, one cut by a block with the words taken.
    Null is a source of its own; documents without words are never taken."""
    prepare(spark)
    packed, slots = mixing.mix_sources(docs)
    return mixing.mixed_documents(docs, packed, slots)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard and slot (columns of these names are
    replaced)."""
    prepare(spark)
    return sharding.shard_documents(docs, keep=docs.columns)


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("sharding", shard),
]

# The stages are not expressible in SQL; tests/llm holds run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir),
                       "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
