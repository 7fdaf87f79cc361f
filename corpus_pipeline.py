"""From raw documents to packed sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows that the one before kept;
its result is written and read again as the next one's documents. All but the last return the
columns of documents. Null texts go in the first stage; null ids pass through the others as
documents of their own, and repeated rows of one id become one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; those without a letter go."""
    from chromasea.llm.mixture import with_language

    return with_language(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones."""
    from chromasea.llm.partenum import one_of_each

    return one_of_each(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences that an earlier document has."""
    from chromasea.llm.spans import remove_repeated

    return remove_repeated(docs)


def remove_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    from chromasea.llm.containment import without_contaminated

    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    from chromasea.llm.packing import pack_documents
    from chromasea.llm.queries import tokenizer

    return pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("near duplicates", join_near_duplicates),
    ("repeated passages", remove_repeated_passages),
    ("benchmark", remove_benchmark_documents),
    ("packing", pack_sequences),
]

# Tokens, trained likelihoods and planned places can't be said in SQL: tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`."""
    from chromasea.llm.shared import materialise

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
