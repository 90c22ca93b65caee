"""From raw documents to a mixed training set: five stages, each one operator.

Every stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lensgraph.llm import decontaminate, language_id, line_dedup, mixing, near_dedup
from lensgraph.llm.session import release, shared_folder, table


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told with confidence go."""
    return language_id.drop_unknown(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go; documents that nothing is left of go with them."""
    release(spark)
    return line_dedup.clean_documents(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    release(spark)
    return near_dedup.keep_one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a passage with the benchmark go."""
    release(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with how many of its words the mix takes (taken), its size and its source's size and target."""
    release(spark)
    return mixing.add_taken(docs)


STAGES = [
    ("language_id", tell_language),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_near),
    ("benchmark_decontamination", decontaminated),
    ("mix_sources", mix_sources),
]

#: Language identification has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; what they write lies in the shared folder of spark.checkpoint.dir.

    Rows with null, empty or very long texts, null and repeated ids, repeated rows,
    ties, empty tables and other columns of any name are handled as each stage's
    operator states; every stage looks at all that its predecessor kept.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
