"""The classic Mac profile: an SQLite file with companion files for bodies and attachments."""

from __future__ import annotations

import base64
import re
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path, PurePosixPath

from postlake.errors import FormatError, IoError, NotFoundError
from postlake.functions.scalars import fnv1a_id, percent_decode
from postlake.operators.hierarchy import MOST_STEPS, SPECIAL
from postlake.schema import BODIES

#: What files begin with, and the length of a body file's header.
BODY_MAGIC, BODY_HEADER, ATTACHMENT_MAGIC = bytes((0x0D, 0, 0, 1)), 20, bytes((0xD0, 0x0D, 0, 0))
#: Where a body may begin, with its kind; what ends it.
_BODY_MARKS = ((b"<html", "html", False), (b"<HTML", "html", False), ("<html".encode("utf-16-le"), "html", True), ("<HTML".encode("utf-16-le"), "html", True), (rb"{\rtf", "rtf", False), (b"BEGIN:VCALENDAR", "calendar", False))
_TAIL_MARKS = ('{"MessageCardSerialized":', '<?xml version="1.0" encoding="utf-16"?>')
_SOURCE_MARKS = (b"Received:", b"From:", b"Return-Path:", b"MIME-Version:", b"Date:", b"Subject:", b"Message-ID:")
#: Fixed value: what the stored path of an attachment holds. Keys bound at once.
ATTACHED, BIND = "Message Attachments", 500
_CONTROLS = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]{3,}")


def parse_body(data: bytes) -> tuple[str, str] | None:
    """(kind, text) of a body file; None if no mark of a body is in it.

    The text ends at the last closing tag, before the client's own appendices and before control signs.
    """
    rest = data[BODY_HEADER:]
    found = [(at, kind, wide) for mark, kind, wide in _BODY_MARKS if (at := rest.find(mark)) >= 0]
    if not found:
        return None
    at, kind, wide = min(found)
    text = rest[at:].decode("utf-16-le" if wide else "utf-8", "replace")
    ends = [len(text)]
    if kind == "html":
        for tag in ("html", "body"):
            closing = [m.end() for m in re.finditer(rf"</{tag}>", text, re.I | re.A)]
            if closing:
                ends.append(closing[-1])
                break
    if kind == "calendar" and (i := text.rfind("END:VCALENDAR")) >= 0:
        ends.append(i + len("END:VCALENDAR"))
    ends += [i for mark in _TAIL_MARKS if (i := text.find(mark)) >= 0]
    if m := _CONTROLS.search(text):
        ends.append(m.start())
    return kind, text[: min(ends)].rstrip()


def parse_source(data: bytes) -> bytes | None:
    """The message source behind its binary prefix: from the first header on."""
    found = [at for mark in _SOURCE_MARKS if (at := data.find(mark)) >= 0]
    return data[min(found) :] if found else None


def header_value(text: str, key: str) -> str | None:
    """The value behind a key, any case: in quotes, or up to a semicolon or line end; None if empty."""
    m = re.search(re.escape(key) + r'[ \t]*(?:"([^"]*)"|([^;\r\n]*))', text, re.I)
    return ((m.group(1) if m.group(1) is not None else m.group(2)).strip() or None) if m else None


def _attachment_parts(data: bytes) -> tuple[str, bytes]:
    if not data.startswith(ATTACHMENT_MAGIC):
        raise FormatError("attachment file without its magic")
    head, mark, rest = data.partition(b"\r\r")
    if not mark:
        raise FormatError("attachment file without end of headers")
    return head.decode("utf-8", "replace"), rest


def attachment_metadata(data: bytes) -> tuple[str | None, str | None]:
    """(file name, type) without decoding the payload."""
    head, _ = _attachment_parts(data)
    return header_value(head, "name="), header_value(head, "Content-type:")


def parse_attachment(data: bytes) -> tuple[str | None, str | None, bytes]:
    head, rest = _attachment_parts(data)
    run = re.match(rb"[A-Za-z0-9+/=\r\n]*", rest).group().replace(b"\r", b"").replace(b"\n", b"").rstrip(b"=")
    try:
        payload = base64.b64decode(run + b"=" * (-len(run) % 4))
    except ValueError as e:
        raise FormatError(f"attachment payload: {e}") from e
    return header_value(head, "name="), header_value(head, "Content-type:"), payload


def seconds(v: object) -> int | None:
    """Unix seconds of an integer, real or numeric text, towards zero."""
    try:
        return int(float(v)) if isinstance(v, (int, float, str)) and not isinstance(v, bool) else None
    except (ValueError, OverflowError):
        return None


def micros(v: object) -> int | None:
    s = seconds(v)
    return None if s is None else s * 1_000_000


@dataclass
class Profile:
    """A Data folder with its database."""

    data_dir: Path

    def connect(self) -> sqlite3.Connection:
        db = self.data_dir / "Outlook.sqlite"
        try:
            return sqlite3.connect(f"{db.resolve().as_uri()}?mode=ro", uri=True)
        except sqlite3.Error as e:
            raise IoError(f"{db}: {e}") from e

    def rows(self, sql: str, *args: object) -> list[tuple]:
        c = self.connect()
        try:
            return c.execute(sql, args).fetchall()
        except sqlite3.Error as e:
            raise FormatError(str(e)) from e
        finally:
            c.close()

    def display_name(self) -> str | None:
        for table in ("AccountsExchange", "AccountsMail"):
            try:
                got = self.rows(f"SELECT Account_Name FROM {table} WHERE Account_Name IS NOT NULL AND Account_Name <> '' LIMIT 1")
            except FormatError:
                continue
            if got:
                return got[0][0]
        return None

    def folders(self) -> list[tuple]:
        """Rows of FOLDERS; a parent that is 0 or negative is none; unread counts read flags of 0."""
        raw = self.rows("SELECT Record_RecordID, Folder_ParentID, Folder_Name, Folder_SpecialFolderType FROM Folders ORDER BY Record_RecordID")
        counted = {f: (n, u or 0) for f, n, u in self.rows("SELECT Record_FolderID, count(*), sum(CASE WHEN Message_ReadFlag = 0 THEN 1 ELSE 0 END) FROM Mail GROUP BY 1")}
        own = {i: (p if p is not None and p > 0 else None, self._name(n, code)) for i, p, n, code in raw}
        parents = {p for p, _ in own.values()}
        out = []
        for i, (parent, name) in own.items():
            steps, at, seen = [], i, 0
            while at in own and seen < MOST_STEPS:
                steps.append(own[at][1] or f"folder-{at}")
                at, seen = own[at][0], seen + 1
            out.append((i, parent, name, "/" + "/".join(reversed(steps)), *counted.get(i, (0, 0)), i in parents, False))
        return out

    @staticmethod
    def _name(stored: str | None, code: int | None) -> str | None:
        if code in SPECIAL:
            return SPECIAL[code]
        return None if not stored or re.fullmatch(r"Placeholder_.*_Placeholder", stored) else stored

    _COLUMNS = "Record_RecordID, Record_FolderID, Message_NormalizedSubject, Message_SenderList, Message_SenderAddressList, Message_TimeReceived, Message_TimeSent, Record_ModDate, Message_Size, Message_ReadFlag, Message_HasAttachment"

    @staticmethod
    def _row(r: tuple, path: str) -> tuple:
        flag = lambda v, zero: None if v is None else (v == 0) is zero
        return (r[0], r[1], path, r[2], r[3] or None, r[4] or None, micros(r[5]), micros(r[6]), micros(r[7]), r[8], flag(r[9], True), flag(r[10], False), None)

    def messages(self, folder: int, path: str, part: int = 0, of: int = 1) -> list[tuple]:
        """Rows of MESSAGES of a folder, or of every ``of``-th id, times in microseconds; this store knows no message class."""
        return [self._row(r, path) for r in self.rows(f"SELECT {self._COLUMNS} FROM Mail WHERE Record_FolderID = ? AND abs(Record_RecordID % ?) = ?", folder, of, part)]

    def row(self, nid: int) -> tuple | None:
        """The row of one message, by its key."""
        got = self.rows(f"SELECT {self._COLUMNS} FROM Mail WHERE Record_RecordID = ?", nid)
        path = next((f[3] for f in self.folders() if got and f[0] == got[0][1]), None)
        return self._row(got[0], path) if path is not None else None

    def details(self, relation: str, nids: list[int]) -> Iterator[tuple]:
        """Rows of bodies or attachments of messages: a query for every few hundred of them."""
        for at in range(0, len(nids), BIND):
            some = nids[at : at + BIND]
            marks = ",".join("?" * len(some))
            if relation == "bodies":
                for nid, path, topic in self.rows(f"SELECT Record_RecordID, PathToDataFile, Message_ThreadTopic FROM Mail WHERE Record_RecordID IN ({marks})", *some):
                    try:
                        yield tuple(self._body(nid, path, topic).get(k) for k in BODIES.fieldNames())
                    except (FormatError, IoError):
                        continue
            elif relation == "attachments":
                for nid, block, path in self.rows(f"SELECT o.Record_RecordID, b.BlockID, b.PathToDataFile FROM Blocks b JOIN Mail_OwnedBlocks o ON o.BlockID = b.BlockID WHERE o.Record_RecordID IN ({marks})", *some):
                    if path is not None and ATTACHED in path:
                        yield self._attachment(nid, fnv1a_id(bytes(block)), path)

    def message(self, nid: int) -> dict:
        got = self.rows("SELECT PathToDataFile, Message_ThreadTopic FROM Mail WHERE Record_RecordID = ?", nid)
        if not got:
            raise NotFoundError(f"message {nid}")
        return self._body(nid, *got[0])

    def _body(self, nid: int, path: str | None, topic: str | None) -> dict:
        body = parse_body(self.read_file(path)) if path else None
        kind, text = body or (None, None)
        return {"nid": nid, "conversation_topic": topic or None, "body_plain": text if kind == "calendar" else None, "body_html": text if kind == "html" else None, "body_rtf": text if kind == "rtf" else None}

    def blocks(self, nid: int, part: str = ATTACHED) -> list[tuple[int, str]]:
        """(id, path) of the files a message owns whose stored path contains ``part``."""
        got = self.rows("SELECT b.BlockID, b.PathToDataFile FROM Blocks b JOIN Mail_OwnedBlocks o ON o.BlockID = b.BlockID WHERE o.Record_RecordID = ?", nid)
        # The stored form decides, before its percent signs are decoded.
        return [(fnv1a_id(bytes(b)), p) for b, p in got if p is not None and part in p]

    def attachments(self, nid: int) -> list[tuple]:
        """Rows of ATTACHMENTS; unreadable files keep their row, without details."""
        return [self._attachment(nid, i, path) for i, path in self.blocks(nid)]

    def _attachment(self, nid: int, i: int, path: str) -> tuple:
        name = kind = size = None
        try:
            data = self.read_file(path)
            (name, kind), size = attachment_metadata(data), len(data)
        except (FormatError, IoError):
            pass
        return nid, i, name, kind, None, size, None

    def payload(self, nid: int, attachment: int) -> bytes:
        for i, path in self.blocks(nid):
            if i == attachment:
                return parse_attachment(self.read_file(path))[2]
        raise NotFoundError(f"attachment {nid}:{attachment}")

    def read_file(self, stored: str) -> bytes:
        """A companion file by its stored path, which must stay inside the folder."""
        path = PurePosixPath(percent_decode(stored))
        if path.is_absolute() or ".." in path.parts:
            raise FormatError(f"path leaves the profile: {stored}")
        try:
            return (self.data_dir / path).read_bytes()
        except OSError as e:
            raise IoError(str(e)) from e
