"""The two structured queries: folder list and message search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a reply: what is given without a limit, and the most.
DEFAULT_ROWS, MOST_ROWS = 200, 5000


def contains(c: Column, part: str) -> Column:
    """Case-insensitive containment; % and _ of the caller stay wildcards, a backslash is a plain sign."""
    return c.ilike("%" + part.replace("\\", "\\\\") + "%")


def clamp(limit: int | None) -> int:
    return max(1, min(limit if limit is not None else DEFAULT_ROWS, MOST_ROWS))


def list_folders(folders: DataFrame, part: str | None = None) -> DataFrame:
    """nid, path, name, item_count, unread_count, is_search_folder by path; an empty part matches all."""
    kept = folders if part is None else folders.where(contains(F.col("path"), part))
    return kept.select("nid", "path", "name", "item_count", "unread_count", "is_search_folder").orderBy(F.col("path").asc_nulls_first(), "nid").limit(MOST_ROWS)


def search_filter(text: str | None = None, folder: str | None = None, since: str | None = None, until: str | None = None, with_attachments: bool | None = None) -> Column | None:
    """The conjunction of the filters that are set.

    Empty text and folder set none. ``since`` includes its time, ``until`` doesn't; an unparseable one
    fails when the query runs; rows without delivery time drop out. ``with_attachments`` filters only if true.
    """
    parts: list[Column] = []
    if text:
        parts.append(contains(F.col("subject"), text) | contains(F.col("sender_name"), text) | contains(F.col("sender_email"), text))
    if folder:
        parts.append(contains(F.col("folder_path"), folder))
    if since is not None:
        parts.append(F.col("delivered") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        parts.append(F.col("delivered") < F.lit(until).cast("timestamp_ntz"))
    if with_attachments:
        parts.append(F.col("has_attachments"))
    return reduce(lambda a, b: a & b, parts) if parts else None


def search(messages: DataFrame, limit: int | None = None, **filters) -> DataFrame:
    """Newest first, ties by nid: a top-k over the filtered rows, planned without a full sort."""
    where = search_filter(**filters)
    kept = messages if where is None else messages.where(where)
    columns = ("nid", "folder_path", "subject", "sender_name", "sender_email", "delivered", "size", "unread", "has_attachments")
    return kept.select(*columns).orderBy(F.col("delivered").desc_nulls_last(), "nid").limit(clamp(limit))
