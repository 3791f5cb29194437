"""From documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import stages
from ebbtide.llm.common import remove_path, scratch_path, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", stages.known_language),
    ("near_duplicates", stages.one_of_each_group),
    ("secrets", stages.without_secrets),
    ("mixture", stages.mixed),
    ("packing", stages.packed),
]

#: Learned filters, sketches and tokenizers are beyond SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet to the shared folder
    and read again by the next, after which they are removed."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_path(spark, before)
        before = path
    return docs
