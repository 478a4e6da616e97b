"""The stores as a Spark data source: ``spark.read.format("postlake").option("path", ...).option("relation", ...)``.

relation: folders, messages, attachments, bodies, recipients (of .ost and .pst files and Mac profiles), or
records (of a block cache). Messages and what hangs on them are read with a partition for each folder, several for
a folder of many. With the option prune an equality on folder_nid or folder_path leaves that folder's, one on nid or message_nid is
one partition that goes to the message by its key. Spark keeps what was pushed with the loaded relation, so a relation that
prunes may be filtered in one place only: views, which a query can name twice, are loaded without.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition
from pyspark.sql.types import StructType

from postlake import schema
from postlake.errors import FormatError, NotFoundError, UnsupportedError

RECIPIENTS = schema._struct(("message_nid", schema._L, False), ("ordinal", schema._I, True), ("kind", schema._I, True), ("name", schema._S, True), ("email", schema._S, True))
SCHEMAS = {"folders": schema.FOLDERS, "messages": schema.MESSAGES, "attachments": schema.ATTACHMENTS, "bodies": schema.BODIES, "recipients": RECIPIENTS, "records": schema.HX_RECORDS}
#: Bytes of a block cache that one task scans.
PART_BYTES = 64 << 20
#: Messages of a folder that one task reads.
PART_ROWS = 20_000


def open_store(path: str):
    if path.lower().endswith((".ost", ".pst")):
        from postlake.sources.pff import Store

        return Store(path)
    from postlake.sources.macdb import Profile

    return Profile(Path(path))


@dataclass
class FolderPart(InputPartition):
    nid: int
    path: str
    part: int = 0
    of: int = 1


@dataclass
class MessagePart(InputPartition):
    nid: int


@dataclass
class BytesPart(InputPartition):
    start: int
    end: int


class StoreReader(DataSourceReader):
    def __init__(self, path: str, relation: str, prune: bool = False):
        self.path, self.relation, self.prune = path, relation, prune
        self.only: dict[str, object] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        keys = {"messages": ("folder_nid", "folder_path", "nid"), "attachments": ("message_nid",), "bodies": ("nid",), "recipients": ("message_nid",)}.get(self.relation, ())
        for f in filters:
            if self.prune and isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in keys and f.attribute[0] not in self.only:
                self.only[f.attribute[0]] = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.relation == "records":
            size = os.path.getsize(self.path)
            return [BytesPart(a, min(size, a + PART_BYTES)) for a in range(0, size, PART_BYTES)]
        if self.relation == "folders":
            return [FolderPart(-1, "")]
        wanted = self.only.get("message_nid", self.only.get("nid"))
        if wanted is not None:
            return [MessagePart(wanted)]
        # A search folder owns no messages. A listing that fails gives no parts.
        try:
            folders = [(f[0], f[3], -(-(f[4] or 0) // PART_ROWS) or 1) for f in open_store(self.path).folders() if not f[7]]
        except (FormatError, NotFoundError):
            return []
        folders = [f for f in folders if self.only.get("folder_nid", f[0]) == f[0] and self.only.get("folder_path", f[1]) == f[1]]
        return [FolderPart(nid, path, i, n) for nid, path, n in folders for i in range(n)]

    def read(self, part: InputPartition) -> Iterator[tuple]:
        if part is None:  # what Spark passes when there are no partitions
            return
        if isinstance(part, BytesPart):
            from postlake.sources import hx

            yield from hx.read(self.path, part.start, part.end)
            return
        store = open_store(self.path)
        if self.relation == "folders":
            yield from store.folders()
            return
        if isinstance(part, MessagePart):
            if self.relation != "messages":
                yield from store.details(self.relation, [part.nid])
                return
            row = store.row(part.nid)
            rows = [row] if row and self.only.get("folder_nid", row[1]) == row[1] and self.only.get("folder_path", row[2]) == row[2] else []
        else:
            try:
                rows = list(store.messages(part.nid, part.path, part.part, part.of))
            except (FormatError, NotFoundError):
                return
        if self.relation == "messages":
            for r in rows:
                yield (*r[:6], *map(_time, r[6:9]), *r[9:])
        else:
            yield from store.details(self.relation, [r[0] for r in rows])


def _time(us: int | None):
    import datetime as dt

    return None if us is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)


class StoreSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "postlake"

    def _relation(self) -> str:
        relation = self.options.get("relation", "messages")
        if relation not in SCHEMAS:
            raise UnsupportedError(f"no relation {relation}")
        return relation

    def schema(self) -> StructType:
        # A reader's rows are nullable wherever Spark cannot check them.
        return StructType([type(f)(f.name, f.dataType, True) for f in SCHEMAS[self._relation()].fields])

    def reader(self, schema: StructType) -> StoreReader:
        return StoreReader(self.options["path"], self._relation(), self.options.get("prune") == "true")


def load(spark: SparkSession, path: str, relation: str, prune: bool = False) -> DataFrame:
    """A relation of a store. Sessions that were not made here may lack what pushes filters into a reader."""
    spark.dataSource.register(StoreSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("postlake").option("path", path).option("relation", relation).option("prune", str(prune).lower()).load()
