"""Corpus pipeline over ``documents``: clean, deduplicate, decontaminate, mix, tokenise.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.llm import decontaminate, jaccard_join, mixing, tokens, toxicity
from simsift.llm.common import crc_bucket, fresh_path, table
from simsift.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    learn = crc_bucket(F.col("doc_id"), 5) != 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), learn)
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join stays."""
    return jaccard_join.keep_classes(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.drop_hits(docs, items, word_borders=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.take(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: (doc_id, start, n_tokens, ids_crc32)."""
    files = tokens.write_token_files(docs, vocabulary(), fresh_path(spark, "token-files"))
    return tokens.read_token_files(spark, files)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing_sources", mix_sources),
    ("token_files", token_files),
]

#: The trained model and the rounding of the mix have no SQL form; see tests/llm/.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
