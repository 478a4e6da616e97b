"""Rebuilding conversations from message rows by pointer jumping.

Every turn points at its parent, the turn before it in its conversation. Rows are laid out by range, so that the
turn before is found without a conversation ever being in one task. A turn that cannot be placed or has no
sender, and a first turn that is itself a reply, answer a message that isn't there. All pointers are resolved
by iterative self-joins that double their reach; conversations with an orphan or a cycle are
dropped, the others leave as paths from their root to their last turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.operators.dedup import further_copies
from postlake.operators.skew import join_facts
from postlake.session import materialise

#: The parent of a turn whose parent is not in the mailbox; no message has this id.
ABSENT = -(1 << 63)
#: Reply and forward prefixes of mail clients in several languages.
PREFIXES = ("re", "fw", "fwd", "aw", "wg", "tr", "rv", "sv", "vs", "antw", "réf", "ref", "res", "enc")
PREFIX_RE = r"(?iu)^[\s ]*(?:(?:" + "|".join(PREFIXES) + r")[\s ]*(?:\[\d+\]|\(\d+\))?[\s ]*[:：][\s ]*)+"
_BLANK = r"[\s\u00a0\u200b\ufeff]+"


def has_text(c: Column) -> Column:
    # Ends at the first sign that is no space.
    return F.coalesce(F.regexp_like(c, F.lit(r"[^\s\u00a0\u200b\ufeff]")), F.lit(False))


def topic_key(topic: Column) -> Column:
    """A topic without prefixes, letter case and spacing; NULL for a NULL or blank topic."""
    return F.when(has_text(topic), F.lower(F.regexp_replace(F.regexp_replace(topic, PREFIX_RE, ""), _BLANK, "")))


def pointer_jump(nodes: DataFrame) -> DataFrame:
    """Resolve (id, parent): id, root, before, state.

    ``before`` is the number of ancestors. ``state`` is "rooted", "orphan" (the chain
    ends at an id that isn't there) or "cycle" (it doesn't end). A self-parent is a cycle. Ids must be unique and
    not NULL. Each round doubles the distance a pointer spans, so the rounds are the logarithm of
    the longest chain; ids on or above a cycle are what still points when no round changes that. A round moves
    the pointers alone, not what rows hold besides.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    now = materialise(nodes.select("id", F.col("parent").alias("ptr"), F.col("id").alias("root"), F.when(F.col("parent").isNull(), none).otherwise(one).alias("before"), F.lit(False).alias("lost")), "jump")
    rounds, live = 0, None
    while True:
        count = now.where("ptr IS NOT NULL").count()
        # A chain of n nodes is done after log2(n) rounds; what points on is a cycle.
        live = count if live is None else live
        if not count or 2**rounds > 2 * live + 2:
            break
        to = now.select(F.col("id").alias("t"), F.col("ptr").alias("t_ptr"), F.col("root").alias("t_root"), F.col("before").alias("t_before"), F.col("lost").alias("t_lost"))
        j = now.where("ptr IS NOT NULL").join(to, F.col("ptr") == F.col("t"), "left")
        gone = F.col("t").isNull()
        moved = j.select("id", F.col("t_ptr").alias("ptr"), F.coalesce("t_root", "root").alias("root"), (F.col("before") + F.coalesce("t_before", -one)).alias("before"), (gone | F.coalesce("t_lost", F.lit(False))).alias("lost"))
        now = materialise(now.where("ptr IS NULL").unionByName(moved), "jump")
        rounds += 1
    state = F.when(F.col("ptr").isNotNull(), "cycle").when(F.col("lost"), "orphan").otherwise("rooted")
    return now.select("id", "root", "before", state.alias("state"))


def turns(messages: DataFrame, bodies: DataFrame) -> DataFrame:
    """nid, delivered_us, sender_email, subject, topic: rows that are turns of some topic, once each."""
    said = bodies.where(has_text(F.col("body_plain"))).select("nid", topic_key(F.col("conversation_topic")).alias("topic")).where("topic IS NOT NULL")
    rows = messages.select("nid", "delivered_us", "sender_email", "subject").join(said, "nid")
    return rows.join(further_copies(messages, bodies), "nid", "left_anti").dropDuplicates(["nid"])


def parents(rows: DataFrame) -> DataFrame:
    """(id, parent) of the turns: the turn before in the topic by delivered_us, then nid; NULL for a first turn, ABSENT for a turn
    without sender or time and for a first turn with a reply or forward prefix.

    The last turn of each range partition is handed on to the next: at most one row a topic and partition.
    """
    timed = rows.where("delivered_us IS NOT NULL").select("topic", "delivered_us", "nid", has_text(F.col("sender_email")).alias("sent"), F.coalesce(F.regexp_like("subject", F.lit(PREFIX_RE)), F.lit(False)).alias("reply"))
    laid = materialise(timed.repartitionByRange("topic", "delivered_us", "nid").withColumn("seg", F.spark_partition_id()), "laid")
    within = Window.partitionBy("topic", "seg").orderBy("delivered_us", "nid")
    near = laid.withColumn("prev", F.lag("nid").over(within))
    ends = laid.groupBy("topic", "seg").agg(F.max(F.struct("delivered_us", "nid"))["nid"].alias("end"))
    handed = ends.withColumn("end", F.lag("end").over(Window.partitionBy("topic").orderBy("seg"))).where("end IS NOT NULL")
    linked = near.join(handed, ["topic", "seg"], "left").withColumn("prev", F.coalesce("prev", "end"))
    parent = F.when(~F.col("sent") | (F.col("prev").isNull() & F.col("reply")), F.lit(ABSENT)).otherwise(F.col("prev"))
    unplaced = rows.where("delivered_us IS NULL").select(F.col("nid").alias("id"), F.lit(ABSENT).alias("parent"))
    return linked.select(F.col("nid").alias("id"), parent.alias("parent")).unionByName(unplaced)


def conversations(messages: DataFrame, bodies: DataFrame, accounts: DataFrame) -> DataFrame:
    """conv_nid, turn, nid, role of every turn of a whole conversation.

    Dropped: conversations with an orphan or a cycle among their turns (see :func:`parents`), or in which only one side
    writes. Rows without topic or text and further copies are no turns. Ties in delivery go by nid. Repeated rows count
    once. Empty tables give no rows; other columns are ignored.
    """
    rows = materialise(turns(messages, bodies), "turns")
    # accounts holds the addresses of one mailbox owner, written by hand.
    mine = accounts.where(has_text(F.col("address"))).select(F.lower(F.trim("address")).alias("who"), F.lit("owner").alias("role")).distinct()
    told = rows.select("nid", "topic", F.lower(F.trim("sender_email")).alias("who")).join(F.broadcast(mine), "who", "left").select("nid", "topic", F.coalesce("role", F.lit("correspondent")).alias("role"))
    jumped = pointer_jump(parents(rows)).select(F.col("id").alias("nid"), "state", (F.col("before") + 1).cast("int").alias("turn"))
    told = materialise(told.join(jumped, "nid"), "told")
    per = told.groupBy("topic").agg(F.min("nid").alias("conv_nid"), F.count("*").alias("n"), F.min(F.col("state") == "rooted").alias("sound"), (F.min("role") != F.max("role")).alias("both"))
    kept = materialise(per.where("sound AND both").select("topic", "conv_nid", "n"), "kept")
    # One topic may hold a third of the rows.
    return join_facts(told, kept, ["topic"]).select("conv_nid", "turn", "nid", "role")
