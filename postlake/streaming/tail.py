"""An extension: new messages as a stream, each identifier once within a time of grace.

A mailbox as such is read again for every query; this tail is for folders into which tables of
new messages are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators.dedup import canonical_id

SCHEMA = T.StructType(
    [
        T.StructField("nid", T.LongType()),
        T.StructField("internet_message_id", T.StringType()),
        T.StructField("folder_path", T.StringType()),
        T.StructField("sender_email", T.StringType()),
        T.StructField("delivered", T.TimestampType()),
        T.StructField("size", T.LongType()),
    ]
)


def incoming(spark: SparkSession, path: str, schema: T.StructType = SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def once(stream: DataFrame, grace: str = "1 day") -> DataFrame:
    """Messages whose identifier was not seen within ``grace``; rows without identifier all pass, keyed by nid."""
    key = F.coalesce(canonical_id(F.col("internet_message_id")), F.concat(F.lit("nid:"), F.col("nid").cast("string")))
    return stream.withColumn("message_key", key).withWatermark("delivered", grace).dropDuplicatesWithinWatermark(["message_key"])


def arrivals(stream: DataFrame, window: str = "1 hour", grace: str = "1 day") -> DataFrame:
    """Messages and bytes per folder and time window."""
    return stream.withWatermark("delivered", grace).groupBy(F.window("delivered", window).alias("w"), "folder_path").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).select(F.col("w.start").alias("window_start"), "folder_path", "n", "bytes")
