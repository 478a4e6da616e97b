"""Filling containers of a fixed token capacity by vector best-fit.

A container has three residual capacities: tokens, documents and attention cost (the sum of squared
lengths). Items go in by decreasing length to the open container that satisfies every constraint
and has the best score: the largest weighted dot product of item and residual in "dot" mode, or the
smallest weighted norm of what would remain in "norm" mode. An item that alone exceeds the attention cost, not
the tokens, opens a container and leaves no cost for others.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.tokens import VOCABULARY, count_tokens
from postlake.session import materialise

#: Attention cost a container may hold by default, as a share of that of one item of the full capacity.
COST_SHARE = 0.8


def best_fit(sizes: np.ndarray, capacity: int, max_docs: int, max_cost: int, weights: tuple[float, float, float] = (1.0, 0.05, 0.05), mode: str = "norm") -> np.ndarray:
    """Container number of each item; items come in the order given.

    Containers of equal (residual tokens, documents, cost) are alike, so they are kept as classes
    with a stack each; an item looks at the classes of the smallest sufficient residual tokens
    first and, in "norm" mode, stops when no later class can score better. Ties: lowest container.
    """
    wt, wd, wa = weights
    ct, cd, ca = float(max(capacity, 1)), float(max(max_docs, 1)), float(max(max_cost, 1))
    classes: dict[tuple[int, int, int], list[int]] = {}
    order: list[tuple[int, int, int]] = []
    out, opened = np.empty(len(sizes), np.int64), 0
    for i, n in enumerate(sizes.tolist()):
        cost, best, at = n * n, None, None
        for key in order[bisect_left(order, (n, 0, 0)) :]:
            t, d, a = key
            if mode == "norm":
                left = wt * ((t - n) / ct) ** 2
                if best is not None and left > best:
                    break
                if d < 1 or a < cost:
                    continue
                score = left + wd * ((d - 1) / cd) ** 2 + wa * ((a - cost) / ca) ** 2
            else:
                if d < 1 or a < cost:
                    continue
                score = -(wt * t * n / ct**2 + wd * d / cd**2 + wa * a * cost / ca**2)
            if best is None or score < best:
                best, at = score, key
        if at is None:
            number, opened = opened, opened + 1
            t, d, a = capacity, max_docs, max_cost
        else:
            stack = classes[at]
            number = stack.pop()
            if not stack:
                del classes[at]
                del order[bisect_left(order, at)]
            t, d, a = at
        out[i] = number
        key = (t - n, d - 1, max(0, a - cost))
        if key[1] > 0 and (key[0] > 0):
            if key in classes:
                classes[key].append(number)
            else:
                classes[key] = [number]
                insort(order, key)
    return out


def items_of(documents: DataFrame, capacity: int, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, part, start_token, n_tokens): a text over the capacity in pieces of it, others whole."""
    sizes = documents.select("doc_id", count_tokens(F.col("text"), path).cast("long").alias("size"))
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.greatest("size", F.lit(1)) - 1) / capacity))
    cut = sizes.select("doc_id", "size", F.explode(parts).alias("part"))
    start = F.col("part") * capacity
    return cut.select("doc_id", F.col("part").cast("int").alias("part"), start.alias("start_token"), F.least(F.lit(capacity), F.col("size") - start).alias("n_tokens"))


def pack(documents: DataFrame, capacity: int, max_docs: int | None = None, max_cost: int | None = None, per_shard: int = 25_000, mode: str = "norm", path: str = VOCABULARY) -> DataFrame:
    """Assign every text to a container: doc_id, part, start_token, n_tokens, container.

    A text is split only if it alone exceeds ``capacity``. ``max_docs`` defaults to a document for each 32 tokens
    of capacity, ``max_cost`` to COST_SHARE of the capacity squared: both bind. Items are spread by a hash over shards of
    about ``per_shard`` items, packed independently; a shard leaves a handful of containers part-filled whatever the
    size of the input. NULL and empty texts are items of no tokens. Repeated doc_ids are items of their own.
    """
    max_docs = max_docs or max(1, capacity // 32)
    max_cost = max_cost or int(COST_SHARE * capacity * capacity)
    items = materialise(items_of(documents, capacity, path), "items")
    shards = max(1, -(-items.count() // per_shard))
    schema = "doc_id long, part int, start_token long, n_tokens long, container string"

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "part"], ascending=[False, True, True], kind="stable")
        number = best_fit(pdf["n_tokens"].to_numpy(), capacity, max_docs, max_cost, mode=mode)
        shard = pdf["shard"].iloc[0]
        return pdf.assign(container=[f"{shard}-{n}" for n in number])[["doc_id", "part", "start_token", "n_tokens", "container"]]

    return items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "part"), F.lit(shards))).groupBy("shard").applyInPandas(fill, schema)


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: items, containers, tokens, fill (share of the capacity used), least possible containers."""
    n = packed.groupBy("container").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("c"))
    out = n.agg(F.sum("c").alias("items"), F.count("*").alias("containers"), F.sum("t").alias("tokens"))
    return out.withColumn("fill", F.col("tokens") / F.nullif(F.col("containers") * capacity, F.lit(0).cast("long"))).withColumn("least", F.ceil(F.col("tokens") / capacity))
