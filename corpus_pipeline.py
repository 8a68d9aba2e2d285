"""The corpus pipeline: five stages from raw documents to packed sequences.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which run() writes as Parquet and reads again as the next
stage's docs. All but the last return the columns of documents.

Cases, for every stage: a null text counts as empty and, where the stage keeps the
row, stays null up to the last stage; texts of any length are taken whole; repeated
rows are documents of their own until near_duplicates keeps one of them, unless they
have no words; null ids are kept; columns beside id and text are passed on under
their names whatever they are, up to the last stage; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugekeep.llm import jaccard_join, packing, pii, suffix_dedup, toxicity
from gaugekeep.llm.common import stored
from gaugekeep.llm.registry import PACK_FILE, tokenizer

# Stages learn models and components, which SQL does not express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model calls toxic go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.ordinary(docs, model)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that repeat in what is left are removed."""
    return suffix_dedup.without_repeats(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are generalised or removed."""
    return pii.sanitised(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences."""
    return packing.pack(docs, tokenizer(PACK_FILE))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", one_of_near_duplicates), ("suffix_dedup", drop_repeats),
          ("pii", sanitise), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
