"""The corpus pipeline: from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared folder
and hands what it reads back to the next one. All but the last return the columns of ``documents``. A stage drops
only what its operator rejects; every document it has no reason to drop stays. Null and empty texts, repeated rows
and empty tables are handled as each operator's module states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cabwh.llm import decontam, exact_dedup, near_dedup, packing, quality
from cabwh.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the compression classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of equal texts the document with the smallest id stays."""
    return exact_dedup.keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group linked at similarity 0.8 or more the document with the smallest id stays."""
    return near_dedup.keep_one_of_each_group(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a benchmark passage go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: what is left as sequences of 2048 tokens; a row per piece."""
    return packing.digest_columns(packing.pack_documents(docs, packing.default_tokenizer()))


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_overlap", benchmark_overlap),
    ("packed", packed),
]

#: SQL has no compressor, tokenizer or best-fit packing; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
