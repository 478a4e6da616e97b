"""A mailbox as relations and tools: the API surface."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import schema
from postlake.errors import IoError, NotFoundError, UnsupportedError
from postlake.operators import listing
from postlake.plans import dialect, guard, shape
from postlake.session import table

BODY_CHARS, PAYLOAD_BYTES, CLI_ROWS = 20_000, 1 << 20, 10_000
RELATIONS = frozenset(("folders", "messages", "recipients", "attachments", "message_bodies", "accounts", "hx_messages", "ost_attachments", "documents"))

#: Names of recipient kinds.
_KINDS = {1: "to", 2: "cc", 3: "bcc"}


class Mailbox:
    """Relations of one store: DataFrames that are scanned when a query runs, never held.

    ``payload(message_nid, attachment_nid)`` gives the bytes of an attachment, where the source has them; ``detail(nid)``
    a message with ``recipients`` and ``attachments``, where the source finds it without a scan. ``fresh``: relations by name that a
    lookup by key may load anew, for positive ids.
    """

    def __init__(self, spark: SparkSession, folders: DataFrame, messages: DataFrame, attachments: DataFrame, bodies: DataFrame | None = None, recipients: DataFrame | None = None, kind: str = "parquet", path: str = "", display_name: str | None = None, payload=None, detail=None, strict_attachments: bool = True, fresh=None):
        self.spark, self.folders, self.messages, self.attachments = spark, folders, messages, attachments
        self.bodies, self.recipients, self.kind, self.path, self.display_name = bodies, recipients, kind, path, display_name
        self.payload, self.detail, self.strict_attachments, self.fresh = payload, detail, strict_attachments, fresh or {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, d: str) -> Mailbox:
        t = {n: table(spark, d, n) for n in ("folders", "messages", "attachments", "message_bodies", "recipients", "accounts")}
        names = [r[0] for r in t["accounts"].select("account_name").where("account_name IS NOT NULL").orderBy("account_name").limit(1).collect()]
        box = cls(spark, t["folders"], t["messages"], t["attachments"], t["message_bodies"], t["recipients"], "parquet", d, names[0] if names else None)
        box.register()
        return box

    def register(self) -> None:
        """Views folders and messages, and the table function ost_attachments(message_nid => ...)."""
        self.folders.createOrReplaceTempView("folders")
        self.messages.createOrReplaceTempView("messages")
        self.attachments.createOrReplaceTempView("attachments")
        for name, df in (("recipients", self.recipients), ("message_bodies", self.bodies)):
            if df is not None:
                df.createOrReplaceTempView(name)
        self.spark.sql("DROP TEMPORARY FUNCTION IF EXISTS ost_attachments")
        self.spark.sql(
            "CREATE TEMPORARY FUNCTION ost_attachments(message_nid BIGINT DEFAULT NULL) RETURNS TABLE (message_nid BIGINT, nid BIGINT, filename STRING, mime STRING, content_id STRING, declared_size BIGINT, data_len BIGINT)"
            " RETURN SELECT a.message_nid, a.nid, a.filename, a.mime, a.content_id, a.declared_size, a.data_len FROM attachments a WHERE ost_attachments.message_nid IS NULL OR a.message_nid = ost_attachments.message_nid"
        )

    # Tools

    def store_info(self) -> dict[str, Any]:
        return {"path": self.path, "display_name": self.display_name, "kind": self.kind, "folders": self.folders.count(), "tables": list(schema.TABLES)}

    def list_folders(self, contains: str | None = None) -> dict[str, Any]:
        return shape.reply(listing.list_folders(self.folders, contains), listing.MOST_ROWS)

    def search(self, limit: int | None = None, **filters) -> dict[str, Any]:
        n = listing.clamp(limit)
        where = listing.search_filter(**filters)
        rows = self.messages if where is None else self.messages.where(where)
        columns = ("nid", "folder_path", "subject", "sender_name", "sender_email", "delivered", "size", "unread", "has_attachments")
        return shape.reply(rows.select(*columns).orderBy(F.col("delivered").desc_nulls_last(), "nid"), n)

    def query(self, sql: str, args: list | dict | None = None) -> DataFrame:
        """A guarded query as a DataFrame."""
        text = dialect.qualify(dialect.windows(guard.check_read_only(sql)))
        other = dialect.special(text)
        if other:
            what, about = other
            if what == "show_tables":
                return self.spark.sql("SHOW TABLES")
            guard.check_plan(self.spark, about, RELATIONS)
            df = self.spark.sql(about)
            return dialect.summarize(df) if what == "summarize" else dialect.table_info(self.spark, df)
        guard.check_plan(self.spark, text, RELATIONS)
        return self.spark.sql(text, args=args) if args else self.spark.sql(text)

    def sql(self, sql: str, limit: int | None = None, args: list | dict | None = None) -> dict[str, Any]:
        return shape.reply(self.query(sql, args), listing.clamp(limit))

    def get_message(self, nid: int, max_body_chars: int = BODY_CHARS) -> dict[str, Any]:
        """The 20 fields of a message; by its node where the source can, else by filters the source prunes by."""
        m = (self.detail(nid) if self.detail else None) or self._detail(nid)
        present = [(n, m[f"body_{n}"]) for n in ("plain", "html", "rtf") if m.get(f"body_{n}") is not None]
        form, body = present[0] if present else (None, None)
        out = {k: shape.value(m.get(k)) for k in ("nid", "subject", "sender_name", "sender_email")}
        out |= {"to": m.get("display_to"), "cc": m.get("display_cc")}
        out |= {k: shape.value(m.get(k)) for k in ("delivered", "submitted", "modified", "size", "unread", "message_class", "internet_message_id", "conversation_topic")}
        out |= {"body": None if body is None else body[:max_body_chars], "body_format": form, "body_truncated": body is not None and len(body) > max_body_chars, "bodies_available": [n for n, _ in present]}
        out["recipients"] = [{"kind": _KINDS.get(kind, "unknown" if kind is None else str(kind)), "name": name, "email": email} for kind, name, email in m["recipients"]]
        out["attachments"] = m["attachments"]
        return out

    def _by_key(self, name: str, whole: DataFrame | None, nid: int) -> DataFrame | None:
        of = self.fresh[name]() if name in self.fresh and nid > 0 else whole
        return None if of is None else of.where(F.col("nid" if name in ("messages", "bodies") else "message_nid") == nid)

    def _detail(self, nid: int) -> dict[str, Any]:
        got = self._by_key("messages", self.messages, nid).limit(1).collect()
        if not got:
            raise NotFoundError(f"message {nid}")
        text, named = self._by_key("bodies", self.bodies, nid), self._by_key("recipients", self.recipients, nid)
        bodies = text.limit(1).collect() if text is not None else []
        people = named.select("ordinal", "kind", "name", "email").orderBy(F.col("ordinal").asc_nulls_last()).collect() if named is not None else []
        return (bodies[0].asDict() if bodies else {}) | got[0].asDict() | {"recipients": [tuple(r)[1:] for r in people], "attachments": self._attachments(nid)}

    def _attachments(self, nid: int) -> list[dict[str, Any]]:
        rows = self._by_key("attachments", self.attachments, nid).orderBy("nid").collect()
        return [{k: shape.value(v) for k, v in r.asDict().items() if k != "message_nid"} for r in rows]

    def list_attachments(self, nid: int) -> list[dict[str, Any]]:
        """An unknown message is an error where the source can tell (``strict_attachments``), else an empty list."""
        m = self.detail(nid) if self.detail else None
        if m is not None:
            return m["attachments"]
        if self.strict_attachments and self.messages.where(F.col("nid") == nid).isEmpty():
            raise NotFoundError(f"message {nid}")
        return self._attachments(nid)

    def _payload(self, message_nid: int, attachment_nid: int) -> tuple[dict[str, Any], bytes]:
        try:
            meta = next((a for a in self.list_attachments(message_nid) if a["nid"] == attachment_nid), None)
        except NotFoundError:
            meta = None
        if meta is None:
            raise NotFoundError(f"attachment {message_nid}:{attachment_nid}")
        if self.payload is None:
            raise UnsupportedError("this source holds no payloads")
        return meta, self.payload(message_nid, attachment_nid)

    def read_attachment(self, message_nid: int, attachment_nid: int, max_bytes: int = PAYLOAD_BYTES) -> dict[str, Any]:
        meta, data = self._payload(message_nid, attachment_nid)
        return {"message_nid": message_nid, "nid": attachment_nid, "filename": meta["filename"], "mime": meta["mime"]} | shape.payload(data, max_bytes)

    def save_attachment(self, message_nid: int, attachment_nid: int, out: str) -> dict[str, Any]:
        """Write a whole payload to a file: the only thing this engine writes outside the shared folder."""
        meta, data = self._payload(message_nid, attachment_nid)
        try:
            Path(out).write_bytes(data)
        except OSError as e:
            raise IoError(str(e)) from e
        return {"message_nid": message_nid, "nid": attachment_nid, "filename": meta["filename"], "mime": meta["mime"], "bytes": len(data), "out": out}
