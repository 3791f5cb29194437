"""Stages of the corpus pipeline. Each takes ``(spark, docs, sf_dir)``; all but the last return the
columns of ``documents``. None reads anything but ``docs``, and an empty table stays empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import scratch_path, shared_dir
from ebbtide.llm.language import UNDETERMINED, LanguageModel, fit, held_out, predict
from ebbtide.llm.minhash import near_duplicates
from ebbtide.llm.mixing import repeated
from ebbtide.llm.packing import pack_documents
from ebbtide.llm.secrets import discovery_thresholds, redacted, with_spans

#: A text is like none of the learned languages when its winner knows less of its trigrams than this
#: share of what it knows of nearly all (all but ``LEAST_KNOWN``) of its own held-out documents.
LEAST_COVERAGE = 0.75
LEAST_KNOWN = 0.05
LEAST_HELD_OUT = 5


def least_coverage(docs: DataFrame, model: LanguageModel) -> dict[str, float]:
    """The coverage a text needs, by language; languages with fewer than ``LEAST_HELD_OUT`` held-out
    documents show no bound and are left out."""
    labelled = docs.filter(held_out(F.col("doc_id")) & F.col("lang").isin(list(model.languages)))
    judged = predict(labelled.select("lang", "text"), model, names=("_lang", "_score", "_coverage"))
    found = (
        judged.filter("_lang = lang")
        .groupBy("lang")
        .agg(F.percentile_approx("_coverage", LEAST_KNOWN).alias("least"), F.count("*").alias("n"))
        .collect()  # one row a language
    )
    return {r["lang"]: LEAST_COVERAGE * r["least"] for r in found if r["n"] >= LEAST_HELD_OUT}


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts that are NULL, without letters or like none of
    the languages go. Where no document has a language, nothing is learned and all stay."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    if not model.languages:
        return docs
    bounds = least_coverage(docs, model)
    judged = predict(docs, model, names=("_lang", "_score", "_coverage"))
    least = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair]) if bounds else F.create_map()
    needed = F.coalesce(F.element_at(least.cast("map<string,double>"), F.col("_lang")), F.lit(0.0))
    # the coverage of a short text scatters: three standard errors are allowed for
    slack = 3.0 * F.sqrt(needed * (1.0 - needed) / F.greatest(F.char_length("text"), F.lit(1)))
    known = (F.col("_lang") != UNDETERMINED) & (F.col("_coverage") > 0) & (F.col("_coverage") >= needed - slack)
    return judged.filter(known).drop("_lang", "_score", "_coverage")


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_key``: the id, or, where an id stands for different texts, a hash of id and text."""
    spark = docs.sparkSession
    shared_dir(spark)
    path, h = scratch_path(spark, "clashes"), F.xxhash64("text")
    named = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(h).alias("_low"), F.max(h).alias("_high")
    )
    # written, so that its size is known; as a rule it is empty
    named.filter("_low < _high").select(F.col("doc_id").alias("_clash")).write.parquet(path)
    clashes = spark.read.schema("_clash bigint").parquet(path)
    own = F.when(F.col("_clash").isNull(), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "text"))
    return docs.join(clashes, F.col("doc_id") == F.col("_clash"), "left").withColumn("_key", own).drop("_clash")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id. Of equal rows one stays; of
    rows that share an id and not the text each belongs to the group of its own text. Rows without id
    belong to no group and all stay."""
    keyed = _told_apart(docs)
    members = near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"))
    ids = keyed.filter("doc_id IS NOT NULL").select("_key", F.col("doc_id").alias("_id"))
    first = (
        members.filter("doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("_key"), "component_id")
        .distinct()
        .join(ids.distinct(), "_key")
        .groupBy("component_id")
        .agg(F.min_by("_key", F.struct("_id", "_key")).alias("_key"))
    )
    one = Window.partitionBy("_key").orderBy(F.xxhash64("text"), "text")
    named = keyed.join(first.select("_key"), "_key", "left_semi").withColumn(
        "_row", F.row_number().over(one)
    )
    return (
        named.filter("_row = 1")
        .select(docs.columns)
        .unionByName(docs.filter("doc_id is null"))
    )


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found replaced by a mark."""
    found = with_spans(docs, discovery_thresholds(docs), name="_spans")
    marked = found.withColumn("text", redacted(F.col("text"), F.col("_spans")))
    size = F.when(F.size("_spans") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return marked.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placement of every piece of every document in sequences of 1024 tokens."""
    return pack_documents(docs)
