"""Finding stores and opening them by what they are."""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from postlake.errors import NotFoundError
from postlake.plans.mailbox import Mailbox
from postlake.sources.datasource import load

EXTENSIONS = (".ost", ".pst")


@dataclass(frozen=True)
class Found:
    path: str
    kind: str
    size: int

    def as_dict(self) -> dict:
        return asdict(self)


def is_store(path: str) -> bool:
    return path.lower().endswith(EXTENSIONS)


def roots() -> list[Path]:
    """Where clients keep stores: folders named in POSTLAKE_STORES first, then the usual places."""
    named = [Path(p) for p in os.environ.get("POSTLAKE_STORES", "").split(os.pathsep) if p]
    home = Path.home()
    return [*named, home / "AppData/Local/Microsoft/Outlook", home / "Documents/Outlook Files", home / "Library/Group Containers/UBF8T346G9.Office/Outlook"]


def stores(where: Iterable[Path] | None = None) -> list[Found]:
    """Stores by folder in the order given, the largest first in each; a path in other letter case counts once."""
    out, seen = [], set()
    for root in where if where is not None else roots():
        if not root.is_dir():
            continue
        here = [Found(str(p), "file", p.stat().st_size) for p in root.rglob("*") if p.is_file() and is_store(p.name)]
        here += [Found(str(p.parent), "mac", p.stat().st_size) for p in root.glob("**/*/Data/Outlook.sqlite")]
        for f in sorted(here, key=lambda f: (-f.size, f.path)):
            if f.path.lower() not in seen:
                seen.add(f.path.lower())
                out.append(f)
    return out


def mac_data_dir(path: Path) -> Path | None:
    """The Data folder of a profile given as itself, as its database or as the folder above."""
    for p in (path, path.parent if path.name == "Outlook.sqlite" else None, path / "Data"):
        if p is not None and (p / "Outlook.sqlite").is_file():
            return p
    return None


def open_store(spark: SparkSession, path: str | None = None) -> Mailbox:
    """A mailbox from a .ost or .pst file, a Mac profile, a folder of parquet tables or, without a path, the first store found."""
    if path is None:
        found = stores()
        if not found:
            raise NotFoundError("no store was found")
        path = found[0].path
    p = Path(path)
    if (p / "messages.parquet").exists():
        return Mailbox.from_parquet(spark, path)

    def relation(name: str, of: str) -> DataFrame:
        return load(spark, of, name)

    if is_store(path):
        from postlake.sources.pff import Store

        if not p.is_file():
            raise NotFoundError(path)
        store = Store(path)
        box = Mailbox(spark, *(relation(n, path) for n in ("folders", "messages", "attachments", "bodies", "recipients")), store.file.kind, path, store.display_name(), store.payload, store.detail)
    else:
        data = mac_data_dir(p)
        if data is None:
            raise NotFoundError(path)
        from postlake.sources.macdb import Profile

        profile, of = Profile(data), str(data)
        folders, messages, bodies = (relation(n, of) for n in ("folders", "messages", "bodies"))
        # By key, for what is not of the cache.
        fresh = {n: lambda n=n: load(spark, of, n, prune=True) for n in ("messages", "bodies", "attachments", "recipients")}
        cache = data.parent / "HxStore.hxd"
        if cache.is_file():
            folders, messages, bodies = with_cache(spark, str(cache), folders, messages, bodies)
        box = Mailbox(spark, folders, messages, relation("attachments", of), bodies, relation("recipients", of), "mac", of, profile.display_name(), profile.payload, strict_attachments=False, fresh=fresh)
    box.register()
    return box


def with_cache(spark: SparkSession, cache: str, folders: DataFrame, messages: DataFrame, bodies: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Folders, messages and bodies with what the block cache holds; the recovered folder only if that is anything."""
    from pyspark.sql import functions as F

    from postlake import schema
    from postlake.functions import scalars
    from postlake.operators import recovery

    raw = load(spark, cache, "records")
    raw = raw.withColumn("rec_id", F.struct("block_offset", "anchor"))
    found = recovery.with_ids(recovery.merge_revisions(raw))
    rows = found.select(
        "nid", "folder_nid", F.lit("/Recovered").alias("folder_path"), "subject", "sender_name", F.col("sender_address").alias("sender_email"),
        scalars.micros_to_timestamp(F.col("sent_unix") * 1_000_000).alias("delivered"), *[F.lit(None).cast(schema.MESSAGES[c].dataType).alias(c) for c in ("submitted", "modified", "size", "unread", "has_attachments", "message_class")],
    )
    held = {"internet_message_id": F.col("internet_message_id"), "body_plain": F.col("preview"), "body_html": F.col("html"), "nid": F.col("nid")}
    text = found.select(*[held.get(c, F.lit(None).cast("string")).alias(c) for c in schema.BODIES.fieldNames()])
    return recovery.with_recovered_folder(folders, found), messages.unionByName(rows), bodies.unionByName(text)
