"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; what it returns is written and read again
as the next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm.common import staged
from tiermill.llm.exact_dedup import drop_exact_copies
from tiermill.llm.kneser_ney import keep_good
from tiermill.llm.packing import pack_documents
from tiermill.llm.simhash import drop_near_copies
from tiermill.llm.substring_dedup import cut_repeats
from tiermill.sources.files import read_parquet

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose perplexity is beyond the threshold of their language."""
    return keep_good(docs, read_parquet(spark, f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has."""
    cut = cut_repeats(docs)
    cut = cut.select(*[F.col(f"`{now}`").alias(c) for now, c in zip(cut.columns, docs.columns)])
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    return pack_documents(docs, VOCABULARY)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("substring dedup", substring_stage),
    ("packing", packing_stage),
]

# The stages are beyond SQL; tests hold them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
