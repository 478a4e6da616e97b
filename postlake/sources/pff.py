"""Mail stores in the .ost/.pst family, read in place: Unicode files (version 23) and those with 4K pages (36).

After the published [MS-PST] structures: pages and blocks, heaps and tables, property contexts. Lookups
descend the B-trees page by page, so opening a store in every task costs nothing but the map.
"""

from __future__ import annotations

import datetime as dt
import mmap
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from postlake.errors import FormatError, IoError, NotFoundError, UnsupportedError
from postlake.functions.scalars import FILETIME_EPOCH, one_off_address
from postlake.schema import ATTACHMENTS, BODIES

#: Node ids and types.
ROOT_FOLDER, MESSAGE_STORE, ATTACHMENT_TABLE, RECIPIENT_TABLE = 0x122, 0x21, 0x671, 0x692
NORMAL_FOLDER, HIERARCHY, CONTENTS = 0x02, 0x0D, 0x0E
#: Property types and ids.
I16, I32, F32, F64, BOOL, OBJECT, I64, STRING8, UNICODE, TIME, BINARY = 0x02, 0x03, 0x04, 0x05, 0x0B, 0x0D, 0x14, 0x1E, 0x1F, 0x40, 0x102
P = {
    "message_class": 0x001A, "subject": 0x0037, "submitted": 0x0039, "represented_entry": 0x0041, "represented_name": 0x0042, "topic": 0x0070, "recipient_type": 0x0C15, "sender_entry": 0x0C19,
    "sender_name": 0x0C1A, "sender_email": 0x0C1F, "display_bcc": 0x0E02, "display_cc": 0x0E03, "display_to": 0x0E04, "delivered": 0x0E06, "flags": 0x0E07, "size": 0x0E08, "has_attachments": 0x0E1B,
    "attach_size": 0x0E20, "body": 0x1000, "rtf": 0x1009, "html": 0x1013, "message_id": 0x1035, "display_name": 0x3001, "email": 0x3003, "modified": 0x3008, "content_count": 0x3602, "unread_count": 0x3603,
    "subfolders": 0x360A, "attach_data": 0x3701, "attach_filename": 0x3704, "attach_method": 0x3705, "attach_long_filename": 0x3707, "attach_mime": 0x370E, "attach_content_id": 0x3712, "smtp": 0x39FE,
}
#: Depth at which a walk is taken for a loop: B-trees, data trees, subnodes.
DEEPEST_TREE, DEEPEST_DATA, DEEPEST_SUBNODE = 16, 4, 4


@dataclass(frozen=True)
class Geometry:
    page: int
    entries: int
    wide_counts: bool
    index_bits: int


GEOMETRY = {23: Geometry(512, 488, False, 11), 36: Geometry(4096, 4056, True, 14)}


def looks_deflated(data: bytes) -> bool:
    """A zlib header: method 8, and the first two bytes a multiple of 31."""
    return len(data) > 2 and data[0] & 0x0F == 8 and (data[0] << 8 | data[1]) % 31 == 0


def inflated(data: bytes) -> bytes:
    """The inflated block if it is one, else the bytes as they are."""
    if not looks_deflated(data):
        return data
    try:
        return zlib.decompress(data) or data
    except zlib.error:
        return data


def split_hid(hid: int, index_bits: int) -> tuple[int, int]:
    """(block, index) of a heap id."""
    return hid >> (5 + index_bits), hid >> 5 & (1 << index_bits) - 1


class Pff:
    """The node layer."""

    def __init__(self, path: str):
        self.path = path
        try:
            with open(path, "rb") as f:
                self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        except (OSError, ValueError) as e:
            raise IoError(f"{path}: {e}") from e
        m = self.map
        if len(m) < 564 or m[:4] != b"!BDN":
            raise FormatError(f"{path}: no !BDN header")
        if m[8:10] not in (b"SM", b"SO"):
            raise FormatError(f"{path}: neither a PST nor an OST")
        self.version = struct.unpack_from("<H", m, 10)[0]
        if self.version in (14, 15):
            raise UnsupportedError(f"{path}: ANSI stores are not read")
        if self.version not in GEOMETRY:
            raise UnsupportedError(f"{path}: version {self.version}")
        if m[0x201]:
            raise UnsupportedError(f"{path}: encoded stores are not read")
        self.geometry = GEOMETRY[self.version]
        self.kind = {36: "ost-v36", 23: "ost-v23"}[self.version]
        self.node_root = struct.unpack_from("<QQ", m, 0xD8)[1]
        self.block_root = struct.unpack_from("<QQ", m, 0xE8)[1]

    def close(self) -> None:
        self.map.close()

    def _page(self, ib: int) -> tuple[int, int, int]:
        """Count, entry size and level of a B-tree page."""
        g = self.geometry
        if ib + g.page > len(self.map):
            raise FormatError(f"page {ib:#x} beyond the end")
        count, _, size, level = struct.unpack_from("<HHBB" if g.wide_counts else "<BBBB", self.map, ib + g.entries)
        if not size or count * size > g.entries:
            raise FormatError(f"page {ib:#x} is broken")
        return count, size, level

    def _find(self, root: int, key: int, form: str) -> tuple | None:
        ib = root
        for _ in range(DEEPEST_TREE):
            count, size, level = self._page(ib)
            low, high = 0, count
            while low < high:
                mid = (low + high) // 2
                if struct.unpack_from("<Q", self.map, ib + mid * size)[0] <= key:
                    low = mid + 1
                else:
                    high = mid
            if not low:
                return None
            at = ib + (low - 1) * size
            if level == 0:
                entry = struct.unpack_from(form, self.map, at)
                return entry if entry[0] == key else None
            ib = struct.unpack_from("<QQQ", self.map, at)[2]
        raise FormatError("a B-tree is too deep")

    def node(self, nid: int) -> tuple[int, int]:
        """(data, subnodes) of a node."""
        e = self._find(self.node_root, nid, "<QQQI")
        if e is None:
            raise NotFoundError(f"node {nid:#x}")
        return e[1], e[2]

    def block(self, bid: int) -> bytes:
        e = self._find(self.block_root, bid & ~1, "<QQHH")
        if e is None:
            raise FormatError(f"block {bid:#x} is missing")
        if e[1] + e[2] > len(self.map):
            raise FormatError(f"block {bid:#x} beyond the end")
        return inflated(self.map[e[1] : e[1] + e[2]])

    def blocks(self, bid: int, depth: int = 0) -> list[bytes]:
        """The leaves of a data tree, in order."""
        if not bid:
            return []
        data = self.block(bid)
        if not bid & 2:
            return [data]
        if depth >= DEEPEST_DATA or len(data) < 8 or data[0] != 1:
            raise FormatError(f"block {bid:#x} is no data tree")
        count = struct.unpack_from("<H", data, 2)[0]
        return [leaf for b in struct.unpack_from(f"<{count}Q", data, 8) for leaf in self.blocks(b, depth + 1)]

    def subnodes(self, bid: int, depth: int = 0) -> dict[int, tuple[int, int]]:
        """nid to (data, subnodes)."""
        if not bid:
            return {}
        data = self.block(bid)
        if depth >= DEEPEST_SUBNODE or len(data) < 8 or data[0] != 2:
            raise FormatError(f"block {bid:#x} is no subnode tree")
        level, count = data[1], struct.unpack_from("<H", data, 2)[0]
        out: dict[int, tuple[int, int]] = {}
        for i in range(count):
            if level == 0:
                nid, leaf, sub = struct.unpack_from("<QQQ", data, 8 + 24 * i)
                out[nid & 0xFFFFFFFF] = leaf, sub
            else:
                out |= self.subnodes(struct.unpack_from("<QQ", data, 8 + 16 * i)[1], depth + 1)
        return out


class Heap:
    """A heap on a node, with the subnodes its values may point to."""

    def __init__(self, store: Pff, data: int, sub: int):
        self.store, self.blocks = store, store.blocks(data)
        self._sub_bid, self._sub = sub, None
        if not self.blocks or len(self.blocks[0]) < 12 or self.blocks[0][2] != 0xEC:
            raise FormatError("no heap")
        self.client, self.root = self.blocks[0][3], struct.unpack_from("<I", self.blocks[0], 4)[0]

    @property
    def sub(self) -> dict[int, tuple[int, int]]:
        if self._sub is None:
            self._sub = self.store.subnodes(self._sub_bid)
        return self._sub

    def item(self, hid: int) -> bytes:
        block, index = split_hid(hid, self.store.geometry.index_bits)
        if hid & 0x1F or not index or block >= len(self.blocks):
            raise FormatError(f"heap id {hid:#x}")
        b = self.blocks[block]
        at = struct.unpack_from("<H", b, 0)[0]
        if at + 4 > len(b) or index > struct.unpack_from("<H", b, at)[0]:
            raise FormatError(f"heap id {hid:#x}")
        start, end = struct.unpack_from("<HH", b, at + 4 + 2 * (index - 1))
        return b[start:end]

    def pieces(self, hnid: int) -> list[bytes]:
        """What a heap or node id points to, in blocks."""
        if not hnid:
            return []
        if not hnid & 0x1F:
            return [self.item(hnid)]
        if hnid not in self.sub:
            raise FormatError(f"subnode {hnid:#x} is missing")
        return self.store.blocks(self.sub[hnid][0])

    def records(self, hid: int) -> Iterator[bytes]:
        """Records of a B-tree on the heap, key and value together."""
        head = self.item(hid)
        if len(head) < 8 or head[0] != 0xB5:
            raise FormatError("no B-tree on the heap")
        key, value, levels, root = head[1], head[2], head[3], struct.unpack_from("<I", head, 4)[0]

        def walk(at: int, level: int) -> Iterator[bytes]:
            data = self.item(at) if at else b""
            step = key + (4 if level else value)
            for i in range(0, len(data) - step + 1, step):
                if level:
                    yield from walk(struct.unpack_from("<I", data, i + key)[0], level - 1)
                else:
                    yield data[i : i + step]

        if levels > DEEPEST_TREE:
            raise FormatError("a heap B-tree is too deep")
        yield from walk(root, levels)


def decoded(kind: int, raw: bytes):
    """The Python value of a property's bytes."""
    if kind == UNICODE:
        return raw.decode("utf-16-le", "replace")
    if kind == STRING8:
        return raw.decode("utf-8", "replace")
    sizes = {I16: ("<h", 2), I32: ("<i", 4), F32: ("<f", 4), F64: ("<d", 8), I64: ("<q", 8), TIME: ("<Q", 8)}
    if kind in sizes:
        form, size = sizes[kind]
        return struct.unpack_from(form, raw)[0] if len(raw) >= size else None
    if kind == BOOL:
        return bool(raw[0]) if raw else None
    return raw


_INLINE = frozenset((I16, I32, F32, BOOL))


class Properties:
    """A property context."""

    def __init__(self, store: Pff, data: int, sub: int):
        self.heap = Heap(store, data, sub)
        if self.heap.client != 0xBC:
            raise FormatError("no property context")
        self.raw = {}
        for r in self.heap.records(self.heap.root):
            pid, kind, value = struct.unpack_from("<HHI", r)
            self.raw[pid] = kind, value, r[4:8]

    def kind(self, pid: int) -> int | None:
        return self.raw[pid][0] if pid in self.raw else None

    def get(self, name: str):
        """The value of a property; None if it is absent or cannot be resolved."""
        found = self.raw.get(P[name])
        if found is None:
            return None
        kind, value, inline = found
        if kind in _INLINE:
            return decoded(kind, inline)
        try:
            return decoded(kind, b"".join(self.heap.pieces(value)))
        except FormatError:
            return None

    def text(self, name: str) -> str | None:
        v = self.get(name)
        return v.decode("utf-8", "replace") if isinstance(v, bytes) else v if isinstance(v, str) else None


class Table:
    """A table context: rows of (row id, reader of a column by its property's name)."""

    def __init__(self, store: Pff, data: int, sub: int):
        self.heap = Heap(store, data, sub)
        info = self.heap.item(self.heap.root)
        if len(info) < 22 or info[0] != 0x7C:
            raise FormatError("no table context")
        _, _, self.bits, self.size = struct.unpack_from("<4H", info, 2)
        rows = struct.unpack_from("<I", info, 14)[0]
        self.columns = {}
        for i in range(info[1]):
            kind, pid, at, size, bit = struct.unpack_from("<HHHBB", info, 22 + 8 * i)
            self.columns[pid] = kind, at, size, bit
        # Rows don't cross blocks.
        self.rows = [b[i : i + self.size] for b in self.heap.pieces(rows) for i in range(0, len(b) - self.size + 1, self.size)] if self.size else []

    def __iter__(self) -> Iterator[tuple[int, Row]]:
        for r in self.rows:
            yield struct.unpack_from("<I", r)[0], Row(self, r)


class Row:
    def __init__(self, table: Table, data: bytes):
        self.table, self.data = table, data

    def get(self, name: str):
        """The cell of a column; None if the table lacks it, its bit is clear or it cannot be resolved."""
        c = self.table.columns.get(P[name])
        if c is None:
            return None
        kind, at, size, bit = c
        where = self.table.bits + bit // 8
        if where >= len(self.data) or not self.data[where] & 0x80 >> bit % 8:
            return None
        cell = self.data[at : at + size]
        if kind in _INLINE or kind in (I64, F64, TIME) and size == 8:
            return decoded(kind, cell)
        hnid = struct.unpack("<I", cell)[0] if size == 4 else 0
        if not hnid:
            return None
        try:
            return decoded(kind, b"".join(self.table.heap.pieces(hnid)))
        except FormatError:
            return None


def to_micros(filetime: int | None) -> int | None:
    return None if not filetime else filetime // 10 - FILETIME_EPOCH // 10


def plain_subject(s: str | None) -> str | None:
    return s[2:] if s and s[0] == "\x01" else s


#: Fixed value: what the dictionary of compressed RTF begins with, by the published algorithm.
RTF_START = (
    b"{\\rtf1\\ansi\\mac\\deff0\\deftab720{\\fonttbl;}{\\f0\\fnil \\froman \\fswiss \\fmodern \\fscript \\fdecor MS Sans SerifSymbolArialTimes New RomanCourier{\\colortbl\\red0\\green0\\blue0\r\n\\par \\pard\\plain\\f0\\fs20\\b\\i\\u\\tab\\tx"
)


def plain_rtf(data: bytes | None) -> str | None:
    """RTF from its compressed form; None if it is none."""
    if data is None or len(data) < 16:
        return None
    _, size, magic = struct.unpack_from("<II4s", data)
    if magic == b"MELA":
        return data[16 : 16 + size].decode("cp1252", "replace")
    if magic != b"LZFu":
        return None
    ring, at, out, i = bytearray(RTF_START.ljust(4096, b"\0")), len(RTF_START), bytearray(), 16
    while i < len(data):
        control, i = data[i], i + 1
        for bit in range(8):
            if i >= len(data):
                break
            if control >> bit & 1:
                if i + 2 > len(data):
                    return None
                word, i = data[i] << 8 | data[i + 1], i + 2
                start, length = word >> 4, (word & 15) + 2
                if start == at:
                    return bytes(out[:size]).decode("cp1252", "replace")
                for k in range(length):
                    c = ring[(start + k) % 4096]
                    out.append(c)
                    ring[at] = c
                    at = (at + 1) % 4096
            else:
                out.append(data[i])
                ring[at] = data[i]
                at, i = (at + 1) % 4096, i + 1
    return bytes(out[:size]).decode("cp1252", "replace")


@dataclass
class Store:
    """The messaging layer: folders, messages, attachments as plain tuples in schema order."""

    path: str
    file: Pff = field(init=False)

    def __post_init__(self) -> None:
        self.file = Pff(self.path)

    def display_name(self) -> str | None:
        try:
            return Properties(self.file, *self.file.node(MESSAGE_STORE)).text("display_name")
        except (FormatError, NotFoundError):
            return None

    def folders(self) -> list[tuple]:
        """The tree breadth first; each folder once; only normal folders are descended into; an unreadable hierarchy table makes a leaf."""
        try:
            name = Properties(self.file, *self.file.node(ROOT_FOLDER)).text("display_name")
        except FormatError:
            name = None
        out = [(ROOT_FOLDER, None, name or "Root", "", None, None, True, ROOT_FOLDER & 0x1F != NORMAL_FOLDER)]
        seen, queue = {ROOT_FOLDER}, [(ROOT_FOLDER, "")]
        while queue:
            parent, prefix = queue.pop(0)
            try:
                rows = list(Table(self.file, *self.file.node(parent >> 5 << 5 | HIERARCHY)))
            except (FormatError, NotFoundError):
                continue
            for nid, row in rows:
                if not nid or nid in seen:
                    continue
                seen.add(nid)
                name = row.get("display_name")
                path = f"{prefix}/{name or ''}"
                out.append((nid, parent, name, path, row.get("content_count"), row.get("unread_count"), bool(row.get("subfolders")), nid & 0x1F != NORMAL_FOLDER))
                if nid & 0x1F == NORMAL_FOLDER:
                    queue.append((nid, path))
        return out

    def messages(self, folder: int, path: str, part: int = 0, of: int = 1) -> Iterator[tuple]:
        """Rows of a folder's contents table, or every ``of``-th of them; sender from the columns, else from the entry ids."""
        t = Table(self.file, *self.file.node(folder >> 5 << 5 | CONTENTS))
        t.rows = t.rows[part::of]
        for nid, r in t:
            flags = r.get("flags")
            own = one_off_address(r.get("sender_entry")) or one_off_address(r.get("represented_entry")) or (None, None)
            has = r.get("has_attachments")
            yield (
                nid, folder, path, plain_subject(r.get("subject")), r.get("sender_name") or own[0], r.get("sender_email") or own[1], to_micros(r.get("delivered")), to_micros(r.get("submitted")), to_micros(r.get("modified")),
                r.get("size"), None if flags is None else not flags & 1, has if has is not None else None if flags is None else bool(flags & 0x10), r.get("message_class"),
            )

    def _node(self, nid: int) -> tuple[int, int]:
        try:
            if 0 < nid < 1 << 32:
                return self.file.node(nid)
        except NotFoundError:
            pass
        raise NotFoundError(f"message {nid}")

    def row(self, nid: int) -> tuple | None:
        """The row of one message: the folder its node names, else each folder in turn."""
        data = self.file._find(self.file.node_root, nid, "<QQQI") if 0 < nid < 1 << 32 else None
        if data is None:
            return None
        tree = {f[0]: f[3] for f in self.folders() if not f[7]}
        for folder in [data[3]] if data[3] in tree else tree:
            try:
                for r in self.messages(folder, tree[folder]):
                    if r[0] == nid:
                        return r
            except (FormatError, NotFoundError):
                continue
        return None

    def details(self, relation: str, nids: list[int]) -> Iterator[tuple]:
        """Rows of bodies, recipients or attachments of messages; those that cannot be read have none."""
        for nid in nids:
            try:
                if relation == "attachments":
                    yield from self.attachments(nid)
                elif relation == "recipients":
                    yield from self.message(nid)["recipients"]
                else:
                    full = self.message(nid)
                    yield tuple(full.get(k) for k in BODIES.fieldNames())
            except (FormatError, NotFoundError):
                continue

    def detail(self, nid: int) -> dict:
        """A message with its recipients and attachments as a reply shows them: a descent to its node, no scan."""
        m = self.message(nid)
        times = {k: None if m[k] is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=m[k]) for k in ("delivered", "submitted", "modified")}
        return m | times | {"recipients": [r[2:] for r in m["recipients"]], "attachments": [dict(zip(ATTACHMENTS.fieldNames()[1:], a[1:])) for a in self.attachments(nid)]}

    def message(self, nid: int) -> dict:
        """Everything of a message but its payloads. The sender's name is its own, else that of whom it stands for, else the entry id's."""
        p = Properties(self.file, *self._node(nid))
        own = one_off_address(p.get("sender_entry")) or one_off_address(p.get("represented_entry")) or (None, None)
        people = []
        if RECIPIENT_TABLE in p.heap.sub:
            for i, (_, r) in enumerate(Table(self.file, *p.heap.sub[RECIPIENT_TABLE])):
                people.append((nid, i, r.get("recipient_type"), r.get("display_name"), r.get("smtp") or r.get("email")))
        return {
            "nid": nid, "internet_message_id": p.text("message_id"), "conversation_topic": p.text("topic"), "display_to": p.text("display_to"), "display_cc": p.text("display_cc"), "body_plain": p.text("body"),
            "body_html": p.text("html"), "body_rtf": plain_rtf(p.get("rtf")), "sender_name": next((x for x in (p.text("sender_name"), p.text("represented_name")) if x is not None), own[0]), "sender_email": p.text("sender_email") or own[1],
            "subject": plain_subject(p.text("subject")), "recipients": people, "delivered": to_micros(p.get("delivered")), "submitted": to_micros(p.get("submitted")), "modified": to_micros(p.get("modified")),
            "size": p.get("size"), "unread": None if p.get("flags") is None else not p.get("flags") & 1, "message_class": p.text("message_class"),
        }

    def attachments(self, nid: int) -> list[tuple]:
        """(message, nid, filename, mime, content id, declared size, payload size); the details first, the table as fallback."""
        p = Properties(self.file, *self._node(nid))
        if ATTACHMENT_TABLE not in p.heap.sub:
            return []
        out = []
        for at, r in Table(self.file, *p.heap.sub[ATTACHMENT_TABLE]):
            detail = None
            if at in p.heap.sub:
                try:
                    detail = Properties(self.file, *p.heap.sub[at])
                except FormatError:
                    pass
            get = detail.text if detail else lambda _: None
            data = detail.get("attach_data") if detail and detail.kind(P["attach_data"]) == BINARY else None
            filename = get("attach_long_filename") or get("attach_filename") or r.get("attach_long_filename") or r.get("attach_filename")
            size = r.get("attach_size") if r.get("attach_size") is not None else detail.get("attach_size") if detail else None
            out.append((nid, at, filename, get("attach_mime"), get("attach_content_id"), size, None if data is None else len(data)))
        return out

    def payload(self, nid: int, attachment: int) -> bytes:
        p = Properties(self.file, *self._node(nid))
        if attachment not in p.heap.sub:
            raise NotFoundError(f"attachment {nid}:{attachment}")
        detail = Properties(self.file, *p.heap.sub[attachment])
        kind = detail.kind(P["attach_data"])
        if kind is None:
            raise NotFoundError(f"attachment {nid}:{attachment} has no data")
        if kind == OBJECT:
            raise UnsupportedError("the attachment is an embedded message")
        return detail.get("attach_data") or b""
