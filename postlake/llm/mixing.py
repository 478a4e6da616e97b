"""Mixing sources to target weights with hash-threshold histograms.

Tokens are summed by source and hash bucket; the running sums give the threshold up to which a
source's documents are taken; only the bucket that holds the threshold is refined, level by level.
Documents are then filtered by their hash: nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.tokens import VOCABULARY, count_tokens
from postlake.session import materialise

#: Bits of the hash that one histogram resolves, and how many histograms there can be.
LEVEL_BITS, LEVELS = 12, 5


def source_key(source: Column) -> Column:
    """Sources are spelled unevenly: case, outer space, and hyphen or space for underscore."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s\-]+", "_")


def sized(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, source_key, n_tokens, h): h is a hash of doc_id with LEVEL_BITS * LEVELS bits."""
    bits = LEVEL_BITS * LEVELS
    return documents.select(
        "doc_id",
        source_key(F.col("source")).alias("source_key"),
        count_tokens(F.col("text"), path).cast("long").alias("n_tokens"),
        F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits).alias("h"),
    )


def budgets(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """Per target: source_key, share, have, budget, passes, rest.

    Shares are scaled to add up to 1 over the sources that have tokens. Without ``total`` the
    largest size is taken at which every such source meets its share within ``max_repeats``;
    with one, a source that runs out gives all it may. A target repeated under another spelling
    counts once, with its shares added and the larger repeat limit. NULL or negative shares count
    as 0, NULL repeats as 1.
    """
    have = sizes.groupBy("source_key").agg(F.sum("n_tokens").alias("have"))
    want = targets.groupBy(source_key(F.col("source")).alias("source_key")).agg(
        F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats")
    )
    both = want.join(have, "source_key", "left").withColumn("have", F.coalesce("have", F.lit(0).cast("long")))
    live = (F.col("have") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    all_targets = Window.partitionBy()
    both = both.withColumn("share", F.when(live, F.col("target_share")).otherwise(F.lit(0.0)) / F.nullif(F.sum(F.when(live, F.col("target_share"))).over(all_targets), F.lit(0.0)))
    most = F.min(F.when(F.col("share") > 0, F.floor(F.col("have") * F.col("max_repeats") / F.col("share")))).over(all_targets)
    both = both.withColumn("total", F.lit(total).cast("long") if total is not None else most.cast("long"))
    budget = F.least(F.round(F.col("share") * F.col("total")).cast("long"), F.col("have") * F.col("max_repeats"))
    both = both.withColumn("budget", F.coalesce(budget, F.lit(0).cast("long")))
    passes = F.when(F.col("have") > 0, F.floor(F.col("budget") / F.col("have"))).otherwise(F.lit(0)).cast("long")
    return both.withColumn("passes", passes).withColumn("rest", F.col("budget") - F.col("passes") * F.col("have"))


def thresholds(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with ``threshold``: documents with h < threshold fill ``rest`` without exceeding it.

    Each level has at most 2^LEVEL_BITS rows a source. Refining ends when the bucket at the
    threshold is one hash wide; its documents stay out, as they would exceed the budget.
    """
    spark = sizes.sparkSession
    # One row per source in mix_targets, a hand-written table.
    state = plan.select("source_key", F.lit(0).cast("long").alias("prefix"), "rest").where("rest > 0")
    rows = [(r["source_key"], r["prefix"], r["rest"]) for r in state.collect()]
    for level in range(1, LEVELS + 1):
        if not rows:
            break
        shift = LEVEL_BITS * (LEVELS - level)
        now = F.broadcast(spark.createDataFrame(rows, "source_key string, prefix long, rest long"))
        bucket = F.shiftright("h", shift)
        hist = (
            sizes.join(now, "source_key")
            .where(F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
            .groupBy("source_key", "rest", bucket.alias("b"))
            .agg(F.sum("n_tokens").alias("tokens"))
        )
        upto = F.sum("tokens").over(Window.partitionBy("source_key").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        cum = hist.withColumn("upto", upto)
        edge = cum.where("upto > rest").groupBy("source_key").agg(F.min(F.struct("b", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left"))).alias("m"))
        found = {r["source_key"]: (r["m"]["b"], r["m"]["left"]) for r in edge.collect()}
        # No bucket exceeds the rest only when the rest takes in the whole prefix.
        rows = [(s, *found.get(s, ((p + 1) << LEVEL_BITS, 0))) for s, p, _ in rows]
    last = spark.createDataFrame(rows, "source_key string, prefix long, rest long") if rows else spark.createDataFrame([], "source_key string, prefix long, rest long")
    return plan.join(F.broadcast(last.select("source_key", F.col("prefix").alias("threshold"))), "source_key", "left").withColumn("threshold", F.coalesce("threshold", F.lit(0).cast("long")))


def mix(documents: DataFrame, targets: DataFrame, total: int | None = None, path: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(selection, shares).

    selection: doc_id, source_key, n_tokens, copies (how often the document is taken, from 1).
    shares: source_key, target_share, share (scaled), max_repeats, have, budget, tokens, actual_share.
    Documents of NULL or unlisted sources are not taken; blank documents have no tokens and follow
    their hash like others. Repeated doc_ids fall together. Empty tables give no selection, and
    shares of NULL.
    """
    sizes = materialise(sized(documents, path), "sizes")
    plan = thresholds(sizes, budgets(sizes, targets, total))
    use = F.broadcast(plan.select("source_key", "passes", "threshold"))
    picked = sizes.join(use, "source_key").withColumn("copies", (F.col("passes") + (F.col("h") < F.col("threshold")).cast("long")).cast("int")).where("copies > 0")
    picked = picked.select("doc_id", "source_key", "n_tokens", "copies")
    got = picked.groupBy("source_key").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"))
    shares = plan.join(got, "source_key", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0).cast("long")))
    shares = shares.withColumn("actual_share", F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy()), F.lit(0).cast("long")))
    return picked, shares.select("source_key", "target_share", "share", "max_repeats", "have", "budget", "tokens", "actual_share")
