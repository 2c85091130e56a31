"""A training corpus from raw documents: five stages, each written as Parquet and read again.

Every stage takes the documents that its predecessor kept, in the columns of ``documents``:

1. quality rules: documents that fail the base rules or lie far out go,
2. n-gram Jaccard join: one document of each near-duplicate group stays, that with the smallest
   id; of rows that share it, or have none, the one with the smallest hash,
3. suffix-array dedup: characters in passages that an earlier document has are cut out,
4. benchmark decontamination: documents with too many words of test items go, and from others
   every passage of 13 or more words of test items is cut out,
5. mixing: documents with the number of copies that bring sources to their weights, above 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwarden.functions.staging import Staging
from txwarden.llm.decontaminate import decontaminate
from txwarden.llm.jaccard_join import near_duplicate_components
from txwarden.llm.mixing import pareto_mix
from txwarden.llm.quality_rules import quality_verdicts
from txwarden.llm.suffix_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
OTHERS = tuple(COLUMNS[1:])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_verdicts(docs, keep=OTHERS).filter("kept").select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicate_components(docs, words=5, percent=75, keep=OTHERS, one_each=True).select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = remove_repeats(docs, length=50, keep=("lang", "source"), with_text=True)
    left = left.withColumnRenamed("kept_text", "text")
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    left = decontaminate(docs, items, window=13, keep=("lang", "source"), with_text=True)
    left = left.filter("not contaminated").withColumnRenamed("kept_text", "text")
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = pareto_mix(docs, weights=(1, 2, 3), max_copies=3, keep=OTHERS)
    return mixed.filter("copies > 0").select(*COLUMNS, "size", "source_size", "target", "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Robust estimates and repeats of bytes are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    staging = Staging(spark)
    for name, stage in STAGES:
        docs = staging.write(stage(spark, docs, sf_dir), name)
    return docs
