"""Joining facts of groups back to their rows when one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_facts(rows: DataFrame, facts: DataFrame, on: list[str], size: str = "n", parts: int = 1000, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``facts``, which has a row for each value of ``on`` and its number of rows in ``size``.

    A group of more than 1/``parts`` of all rows is hot; there are fewer than ``parts`` of those, so
    their facts are broadcast and their rows stay where they are. The others are joined by a shuffle in
    which no group exceeds 1/``parts``. ``how``: inner or left. Both inputs are read twice: give
    written tables. ``size`` is not in the result. NULL keys match nothing.
    """
    total = facts.agg(F.sum(size).alias("t")).first()["t"]
    if not total:
        return rows.join(facts.drop(size), on, how)
    limit = total / parts
    hot = facts.where(F.col(size) > limit)
    keys = F.broadcast(hot.select(*on))
    rest = rows.join(keys, on, "left_anti").join(facts.where(F.col(size) <= limit).drop(size), on, how)
    return rows.join(F.broadcast(hot.drop(size)), on, "inner").unionByName(rest)
