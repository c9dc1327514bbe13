"""The corpus pipeline over ``documents``: quality rules, line dedup, near dedup, packing.

Each stage works on all rows that the one before kept; ``run`` applies them one after another, each
written as Parquet in the shared folder and read again.

Defined cases, in each stage: null texts are empty (the quality rules reject them), repeated rows are
rows of their own until near dedup keeps one, an empty table gives none, texts of any length are
read whole, and further columns of any name travel along unchanged up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retention.llm import line_dedup, packing, quality_mcd, simhash
from retention.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or lie far outside their language and source go."""
    return quality_mcd.kept_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occur before, exactly or within two edits, go; documents stay."""
    return line_dedup.remove_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (three-word shingles, two bits or fewer) stays."""
    return simhash.without_near_duplicates(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their sequences and offsets."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: Estimates, edit distances and packing can't be stated in SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
