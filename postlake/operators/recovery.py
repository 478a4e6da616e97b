"""Records recovered from a cache: revisions merged, ids given."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.schema import RECOVERED_BASE, RECOVERED_FOLDER

FIELDS = ("sender_name", "internet_message_id", "subject", "preview", "html")


def merge_revisions(records: DataFrame, order: str = "rec_id", by: tuple[str, ...] = ("sender_address", "sent_unix"), fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row for each sender and time (NULL equals NULL); each field is its first non-NULL in order."""
    first = [F.min_by(F.when(F.col(f).isNotNull(), F.col(f)), F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields]
    return records.groupBy(*by).agg(*first, F.min(order).alias(f"first_{order}"), F.count("*").alias("revisions"))


def with_ids(merged: DataFrame, order: str = "first_rec_id") -> DataFrame:
    """nid counts down from RECOVERED_BASE, newest first, unknown times last, ties in order.

    Ranks come from sorted ranges: each range is numbered by itself and shifted by the sizes of those
    before it, so that no task holds all rows.
    """
    from postlake.session import materialise

    key = [F.col("sent_unix").desc_nulls_last(), F.col(order).asc()]
    laid = materialise(merged.repartitionByRange(*key).withColumn("_range", F.spark_partition_id()), "ranked")
    # One row a range.
    sizes = laid.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*key)) - 1
    return laid.withColumn("_place", place).join(before, "_range").withColumn("nid", F.lit(RECOVERED_BASE) - F.col("_before") - F.col("_place")).withColumn("folder_nid", F.lit(RECOVERED_FOLDER).cast("long")).drop("_range", "_place", "_before")


def coverage(records: DataFrame, fields: tuple[str, ...] = ("sender_address", *FIELDS, "sent_unix")) -> DataFrame:
    """field, share of the rows in which it is known: one pass."""
    one = records.agg(*[F.avg(F.col(f).isNotNull().cast("int")).alias(f) for f in fields])
    return one.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.round(F.col(f), 6).alias("known")) for f in fields])).alias("x")).select("x.*")


def with_recovered_folder(folders: DataFrame, recovered: DataFrame) -> DataFrame:
    """The folders, with the recovered one appended only if it holds anything."""
    one = recovered.agg(F.count("*").alias("item_count")).where("item_count > 0")
    null = F.lit(None).cast("long")
    row = one.select(
        F.lit(RECOVERED_FOLDER).cast("long").alias("nid"), null.alias("parent_nid"), F.lit("Recovered").alias("name"), F.lit("/Recovered").alias("path"),
        "item_count", null.alias("unread_count"), F.lit(False).alias("has_subfolders"), F.lit(False).alias("is_search_folder"),
    )
    return folders.unionByName(row)
