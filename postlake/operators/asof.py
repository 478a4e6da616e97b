"""As-of join without a full sort of both sides, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, value: list[str], bucket_seconds: int = 7 * 86_400) -> DataFrame:
    """For each left row the values of the latest right row of its key at or before its time, else NULL.

    Both sides are merged into one stream per (key, time bucket) and filled forward by a window, so a
    hot key is spread over its buckets; what reaches over from earlier buckets is one row a bucket.
    Of right rows of the same time the greatest values win. NULL keys and times match nothing.
    """
    pick = F.struct(F.col(right_time).alias("_at"), *[F.col(v).alias(v) for v in value])
    lc = left.columns
    bucket = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (bucket_seconds * 1_000_000))
    r = right.where(F.col(right_time).isNotNull()).select(*by, bucket(right_time).alias("_b"), F.col(right_time).alias("_t"), pick.alias("_r"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*lc)).schema[0].dataType).alias("_l"))
    l = left.select(*by, bucket(left_time).alias("_b"), F.col(left_time).alias("_t"), F.lit(None).cast(r.schema["_r"].dataType).alias("_r"), F.lit(1).alias("_side"), F.struct(*lc).alias("_l"))  # noqa: E741
    both = r.unionByName(l)
    fill = Window.partitionBy(*by, "_b").orderBy("_t", "_side", "_r").rowsBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("_w", F.max("_r").over(fill)).where("_side = 1")
    # The last of each bucket, carried to the next buckets of the key that have rows.
    ends = both.groupBy(*by, "_b").agg(F.max("_r").alias("_last"))
    carry = ends.withColumn("_c", F.max("_last").over(Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).drop("_last")
    null_safe = [within[k].eqNullSafe(carry[k]) for k in by] + [within["_b"].eqNullSafe(carry["_b"])]
    cond = null_safe[0]
    for c in null_safe[1:]:
        cond = cond & c
    joined = within.join(carry, cond, "left").select(within["_l"], F.coalesce(within["_w"], carry["_c"]).alias("_m"), *[within[k].alias(f"_k_{k}") for k in by], within["_t"].alias("_lt"))
    known = F.col("_lt").isNotNull()
    for k in by:
        known = known & F.col(f"_k_{k}").isNotNull()
    return joined.select("_l.*", *[F.when(known, F.col(f"_m.{v}")).alias(v if v not in lc else f"right_{v}") for v in value])
