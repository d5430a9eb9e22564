"""The corpus pipeline over ``documents``: quality rules, line dedup, near-duplicate
removal, mixing sources to target weights, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  A stage works on all rows its predecessor
kept, and ``run`` writes them to the shared folder in between.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultscope.llm import bpe
from vaultscope.llm.linededup import without_shared_lines
from vaultscope.llm.mixing import mixed_documents
from vaultscope.llm.neardup import one_of_each_group
from vaultscope.llm.quality import keep_quality
from vaultscope.llm.shared import table
from vaultscope.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host does, go."""
    return keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in the last of them only; n_chars follows the text."""
    return without_shared_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, 0.8) stays."""
    return one_of_each_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from the ids."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("bytes").cast("string").alias("text"))


STAGES = [("quality", quality), ("lines", lines), ("near_dedup", near_dedup), ("mixing", mixing), ("encoding", encoding)]

# SQL expresses neither the signatures' hash functions nor byte-pair merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
