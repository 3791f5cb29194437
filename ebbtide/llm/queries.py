"""The dealt operators applied to their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import scratch_path, table
from ebbtide.llm.covertree import near_vectors
from ebbtide.llm.dialogue import damaged, prepared, repair, repair_report
from ebbtide.llm.html import main_text
from ebbtide.llm.language import language_report
from ebbtide.llm.minhash import NearConfig, near_duplicates
from ebbtide.llm.mixing import mix_documents
from ebbtide.llm.packing import pack_documents
from ebbtide.llm.positional import decontaminate
from ebbtide.llm.secrets import secret_report
from ebbtide.llm.suffix import remove_repeats
from ebbtide.llm.topk import finite, quantised, top_inner_products
from ebbtide.llm.warc import round_trip
from ebbtide.llm.whitening import whiten


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"), gzip=True)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(finite(F.col("embedding")))
    vectors = rows.select("vec_id", quantised(F.col("embedding")).alias("vector"))
    return top_inner_products(vectors, F.col("vec_id") % 20 == 0)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearConfig(shingle=2))


def op10_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(repair(damaged(prepared(table(spark, sf_dir, "conversations")))))


QUERIES = {
    q.__name__: q
    for q in (
        op1_packing,
        op2_warc,
        op3_html,
        op4_suffix,
        op5_topk,
        op6_mixing,
        op7_language,
        op8_secrets,
        op9_minhash,
        op10_covertree,
        op11_whitening,
        op12_positional,
        op13_dialogue,
    )
}
