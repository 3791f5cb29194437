"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put into a random order (by hash) and their words cut into blocks of
equal size, the last one of a source being shorter. Slot ``i`` of the mix takes the golden-ratio
point ``frac(i * phi)``; the cumulative shares of the sources say which source it falls to. The
``r``-th slot of a source takes its ``r``-th block, from the start again after the last one. So
any stretch of the schedule holds the sources in their proportions, and no random number is drawn.

Only DataFrame functions: positions and ranks are running sums in two steps (over buckets of a
source, then inside a bucket), so that a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import durable

# 2**64 and the golden ratio's fraction in 64 bits.
TWO_64 = "18446744073709551616"
GOLDEN_64 = "11400714819323198485"
#: ASCII white space, which parts words.
SPACES = "\t\n\x0b\x0c\r"


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[int, ...] = (5, 2, 1)
    most_repeats: int = 3
    block_words: int = 128
    seed: int = 17
    buckets: int = 4096
    share_bins: int = 1024


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; NULL has none."""
    parts = F.split(F.translate(text, SPACES, " " * len(SPACES)), " ")
    return F.coalesce(F.size(F.array_remove(parts, "")), F.lit(0)).cast("long")


def running(df: DataFrame, group: list[str], value: str, order: list[str], buckets: int, seed: int):
    """``_start``: sum of ``value`` before each row of its group, in an order fixed by a hash."""
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *order)).withColumn(
        "_bucket", F.shiftrightunsigned("_hash", 32) % buckets
    )
    sums = hashed.groupBy(*group, "_bucket").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = sums.select(
        *group, "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_first")
    )
    inside = (
        Window.partitionBy(*group, "_bucket")
        .orderBy("_hash", *order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        hashed.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(first, [*group, "_bucket"])
        .withColumn("_start", F.col("_first") + F.col("_in"))
        .drop("_hash", "_bucket", "_in", "_first")
    )


def targets(sizes: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """``source, source_id, source_size, target`` from rows with ``source`` and ``size``.

    Targets share the sum of all sizes by weight, and stop at ``most_repeats`` times the size of
    the source. The level at which the rest shares is found by one ordered pass: sources fill up
    in the order of cap per weight. One row a source, so the windows here are small.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in config.weights])
    named = totals.withColumn("source_id", F.row_number().over(by_name)).withColumn(
        "_weight", F.get(weights, (F.col("source_id") - 1) % len(config.weights))
    )
    whole = Window.partitionBy(F.lit(0))
    by_ratio = Window.orderBy("_ratio", "source_id").rowsBetween(Window.unboundedPreceding, -1)
    share = (
        named.withColumn("_cap", (F.col("source_size") * config.most_repeats).cast("double"))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_all", F.sum("source_size").over(whole).cast("double"))
        .withColumn("_weights", F.sum("_weight").over(whole))
        .withColumn("_full", F.coalesce(F.sum("_cap").over(by_ratio), F.lit(0.0)))
        .withColumn("_gone", F.coalesce(F.sum("_weight").over(by_ratio), F.lit(0.0)))
        # what a unit of weight gets if all sources before this one are full
        .withColumn("_level", (F.col("_all") - F.col("_full")) / (F.col("_weights") - F.col("_gone")))
        .withColumn(
            # levels rise until the right one is reached and fall after it
            "_level", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(whole)
        )
    )
    open_share = F.least(F.col("_cap"), F.col("_level") * F.col("_weight"))
    return share.select(
        "source",
        "source_id",
        "source_size",
        F.coalesce(open_share, F.col("_cap")).alias("target"),
    )


def plan_sources(goals: DataFrame, config: MixConfig) -> DataFrame:
    """Slots and words each source needs, and its stretch ``[low, high)`` of the unit interval."""
    block = config.block_words
    whole = Window.partitionBy(F.lit(0))
    so_far = Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        goals.withColumn("words", F.floor("target").cast("long"))
        .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
        .withColumn("_rounds", F.coalesce(F.expr("words div nullif(source_size, 0)"), F.lit(0)))
        .withColumn("rest", F.col("words") - F.col("_rounds") * F.col("source_size"))
        .withColumn(
            "slots",
            F.col("_rounds") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long"),
        )
        .withColumn("_all", F.sum("slots").over(whole).cast("double"))
        .withColumn("_end", F.sum("slots").over(so_far))
        .withColumn("high", F.try_divide("_end", "_all"))
        .withColumn("low", F.try_divide(F.col("_end") - F.col("slots"), F.col("_all")))
        .drop("_all", "_rounds", "_end")
    )


def schedule(sources: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Slots of the mix in order: ``slot, source_id, rank, block, word_from, word_to``.

    Every source gets the slots it needs: golden-ratio points beyond a source's need are left
    out, and the few slots a source lacks at the end (the discrepancy, a few slots whatever the
    length) follow as a tail after all points.
    """
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]  # one number
    index = F.col("slot").cast("decimal(17,0)")
    point = F.pmod(index * F.lit(GOLDEN_64).cast("decimal(20,0)"), F.lit(TWO_64).cast("decimal(20,0)"))
    points = (
        spark.range(total)
        .select(F.col("id").alias("slot"))
        .withColumn("_u", point.cast("double") / float(TWO_64))
        .withColumn("_bin", F.floor(F.col("_u") * config.share_bins))
    )
    bins = config.share_bins
    ranges = sources.withColumn(
        "_bin",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * bins),
                F.greatest(F.floor(F.col("low") * bins), F.floor(F.col("high") * bins)),
            )
        ),
    ).select("source_id", "slots", "low", "high", "_bin")
    drawn = points.join(ranges, "_bin").filter("_u >= low and _u < high")
    # rank of a slot within its source: running count in chunks of slots
    chunk = drawn.withColumn("_chunk", F.floor(F.col("slot") / 16384))
    counts = chunk.groupBy("source_id", "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("source_id").orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = counts.select(
        "source_id", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    inside = Window.partitionBy("source_id", "_chunk").orderBy("slot")
    ranked = (
        chunk.withColumn("_in", F.row_number().over(inside) - 1)
        .join(first, ["source_id", "_chunk"])
        .select("slot", "source_id", (F.col("_first") + F.col("_in")).alias("rank"))
    )
    got = counts.groupBy("source_id").agg(F.sum("_n").alias("_got"))
    lacking = sources.join(got, "source_id", "left").filter("coalesce(_got, 0) < slots")
    tail = lacking.select(
        "source_id", F.explode(F.sequence(F.coalesce("_got", F.lit(0)), F.col("slots") - 1)).alias("rank")
    ).select((F.col("rank") + total).alias("slot"), "source_id", "rank")
    block = config.block_words
    start = F.col("block") * block
    end = F.least(start + block, F.col("source_size"))
    last = (F.col("rank") == F.col("slots") - 1) & (F.col("rest") > 0)
    return (
        ranked.unionByName(tail)
        .join(sources, "source_id")
        .filter("rank < slots")
        .withColumn("block", F.col("rank") % F.col("blocks"))
        .select(
            "slot",
            "source_id",
            "rank",
            "block",
            start.alias("word_from"),
            F.when(last, F.least(end, F.col("rest"))).otherwise(end).alias("word_to"),
        )
    )


def block_parts(placed: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The documents cut at block borders: ``source_id, block`` and the stretch of the source's
    words ``[part_from, part_to)`` that lies in both the document (from ``_start``) and the block."""
    block = config.block_words
    end = F.col("_start") + F.col("size")
    steps = F.sequence(F.floor(F.col("_start") / block), F.floor((end - 1) / block))
    cut = placed.filter("size > 0").withColumn("block", F.explode(steps))
    return cut.select(
        "source_id",
        "block",
        "_start",
        F.greatest(F.col("_start"), F.col("block") * block).alias("part_from"),
        F.least(end, (F.col("block") + 1) * block).alias("part_to"),
    )


def mix_documents(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Every row of ``docs`` as ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken``, the
    words the mix takes from it, repeats counted; no row is taken more than ``most_repeats`` times.
    ``text_hash`` tells apart the texts of rows that share an id.

    NULL text and text without words have size 0 and are never taken; NULL is a source of its
    own, the last one; repeated rows are placed one after the other; an empty table gives no
    rows; further columns of ``docs`` are ignored. ``doc_id`` and the text's hash fix the order,
    so a rerun gives the same mix.
    """
    sized = durable(
        docs.select(
            "doc_id", F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_text"),
        )
    )
    goals = targets(sized, config)
    sources = durable(plan_sources(goals, config))
    named = sources.withColumnRenamed("source", "_name")
    with_source = sized.join(named, F.col("source").eqNullSafe(F.col("_name"))).select(
        "doc_id", "size", "_text", "source_id", "source_size", "target"
    )
    placed = durable(
        running(with_source, ["source_id"], "size", ["doc_id", "_text"], config.buckets, config.seed)
    )
    uses = (
        schedule(sources.filter("slots > 0"), config)
        .groupBy("source_id", "block", "word_from", "word_to")
        .agg(F.count("*").alias("uses"))
    )
    shared = F.least("part_to", "word_to") - F.greatest("part_from", "word_from")
    taken = (
        block_parts(placed, config)
        .join(uses, ["source_id", "block"])
        .groupBy("source_id", "_start")
        .agg(F.sum(F.greatest(shared, F.lit(0)) * F.col("uses")).alias("taken"))
    )
    # words of one source start at one place each, so (source, start) names a row with words
    out = placed.withColumn("_worded", F.col("size") > 0).join(
        taken.withColumn("_worded", F.lit(True)), ["source_id", "_start", "_worded"], "left"
    )
    return out.select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.col("_text").alias("text_hash"),
    )


def repeated(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, to the nearest whole number of times; rows
    the mix leaves out go."""
    taken = (
        mix_documents(docs, config)
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text"))
        .agg(F.round(F.try_divide(F.sum("taken"), F.sum("size"))).cast("int").alias("_times"))
        .filter("_times > 0")
    )
    same = docs.doc_id.eqNullSafe(taken["_id"]) & (F.xxhash64(docs.text) == taken["_text"])
    times = F.explode(F.sequence(F.lit(1), F.col("_times")))
    return docs.join(taken, same).select(*[docs[c] for c in docs.columns], times.alias("_time")).drop("_time")
