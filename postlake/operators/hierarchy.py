"""Folder trees: paths, levels and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.session import materialise

#: Fixed value: steps of a walk to the root before it stops, as on a cycle. A power of two.
MOST_STEPS = 64
#: Names of special folders by their code.
SPECIAL = {1: "Inbox", 2: "Outbox", 3: "Address Book", 4: "Calendar", 5: "Notes", 6: "Tasks", 8: "Sent Items", 9: "Deleted Items", 10: "Drafts", 12: "Junk Email", 99: "On My Computer", 103: "Temporary Items"}


def special_name(code: Column, stored: Column) -> Column:
    """A special code beats the stored name; a placeholder or empty name is none."""
    named = F.create_map(*[F.lit(x) for kv in SPECIAL.items() for x in kv])
    own = F.when(~F.regexp_like(stored, F.lit(r"^Placeholder_.*_Placeholder$")) & (stored != ""), stored)
    return F.coalesce(F.try_element_at(named, code.cast("int")), own)


def tree(folders: DataFrame) -> DataFrame:
    """nid, parent_nid, name, level, path from the parent pointers, a row for each folder.

    Roots are folders without a parent that is there; their name is no part of a path. A missing name is written
    folder-<nid>. Every pointer jumps to its target's, so that a walk of n steps takes log2(n) rounds; after
    MOST_STEPS it stops: folders deeper than that, on a cycle or below one keep the path as far as it was walked.
    """
    own = folders.select("nid", "parent_nid", "name").join(folders.select(F.col("nid").alias("p")).distinct(), F.col("parent_nid") == F.col("p"), "left")
    step = F.when(F.col("p").isNull(), "").otherwise(F.concat(F.lit("/"), F.coalesce("name", F.concat(F.lit("folder-"), F.col("nid").cast("string")))))
    now = materialise(own.select("nid", "parent_nid", "name", F.col("p").alias("ptr"), F.col("p").isNotNull().cast("int").alias("level"), step.alias("path")), "tree")
    for _ in range((MOST_STEPS - 1).bit_length()):
        if now.where("ptr IS NOT NULL").isEmpty():
            break
        to = now.select(F.col("nid").alias("t"), F.col("ptr").alias("t_ptr"), F.col("level").alias("t_level"), F.col("path").alias("t_path"))
        jumped = now.join(to, F.col("ptr") == F.col("t"), "left")
        now = materialise(jumped.select("nid", "parent_nid", "name", F.col("t_ptr").alias("ptr"), (F.col("level") + F.coalesce("t_level", F.lit(0))).alias("level"), F.concat(F.coalesce("t_path", F.lit("")), "path").alias("path")), "tree")
    return now.drop("ptr")


def counts(folders: DataFrame, messages: DataFrame) -> DataFrame:
    """nid, path, items, unread_items by counting; folders without messages have 0, unread NULL counts as read."""
    n = messages.groupBy(F.col("folder_nid").alias("nid")).agg(F.count("*").alias("items"), F.sum(F.when(F.col("unread"), 1).otherwise(0)).alias("unread_items"))
    return folders.select("nid", "path").join(n, "nid", "left").select("nid", "path", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("unread_items", F.lit(0)).alias("unread_items"))


def has_children(folders: DataFrame) -> DataFrame:
    parents = folders.select(F.col("parent_nid").alias("nid")).where("nid IS NOT NULL").distinct()
    return folders.select("nid").join(parents, "nid", "left_semi")


def sweep(folders: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages with the path of their folder; search folders own none. Folders are few: Spark broadcasts them by their size."""
    real = folders.where(~F.col("is_search_folder")).select(F.col("nid").alias("folder_nid"), F.col("path").alias("swept_path"))
    return messages.join(real, "folder_nid")


def hooked_attachments(messages: DataFrame, attachments: DataFrame, message_nid: int | None = None) -> DataFrame:
    """Attachments of one message, or of all that are swept; an unknown message gives no rows."""
    if message_nid is not None:
        return attachments.where(F.col("message_nid") == message_nid)
    return attachments.join(messages.select(F.col("nid").alias("message_nid")), "message_nid", "left_semi")
