"""Small synthetic stores, byte by byte, for tests and the registered queries of the sources. All names and addresses are invented."""

import sqlite3
import struct
import zlib
from pathlib import Path

from postlake.functions.scalars import ONE_OFF

FT = 133_444_736_000_000_000


class Heap:
    def __init__(self, client):
        self.client, self.items = client, []

    def add(self, data):
        self.items.append(data)
        return len(self.items) << 5

    def build(self, root):
        body, offsets = b"", []
        for d in self.items:
            offsets.append(12 + len(body))
            body += d
        offsets.append(12 + len(body))
        page = struct.pack(f"<HH{len(offsets)}H", len(self.items), 0, *offsets)
        return struct.pack("<HBBII", 12 + len(body), 0xEC, self.client, root, 0) + body + page


def value(kind, v):
    if kind == 0x1F:
        return v.encode("utf-16-le")
    if kind == 0x40:
        return struct.pack("<Q", v)
    return v


def properties(props):
    """props: (pid, kind, value)."""
    h = Heap(0xBC)
    h.add(b"")
    h.add(b"")
    rows = b""
    for pid, kind, v in sorted(props):
        inline = struct.pack("<i", v) if kind == 3 else struct.pack("<I", v) if kind in (0x0B, 0x0D) else struct.pack("<I", h.add(value(kind, v)))
        rows += struct.pack("<HH", pid, kind) + inline
    h.items[0] = struct.pack("<BBBBI", 0xB5, 2, 6, 0, 2 << 5)
    h.items[1] = rows
    return h.build(1 << 5)


def table(columns, rows):
    """columns: (pid, kind); rows: (row id, {pid: value})."""
    h = Heap(0x7C)
    for _ in range(4):
        h.add(b"")
    at, descs = 8, []
    for i, (pid, kind) in enumerate(columns):
        size = 8 if kind in (0x40, 0x14) else 1 if kind == 0x0B else 4
        descs.append((kind, pid, at, size, i))
        at += size
    bits = at
    size = bits + (len(columns) + 7) // 8
    matrix = b""
    for rid, cells in rows:
        row = bytearray(size)
        struct.pack_into("<I", row, 0, rid)
        for kind, pid, a, s, bit in descs:
            if pid not in cells:
                continue
            v = cells[pid]
            row[bits + bit // 8] |= 0x80 >> bit % 8
            if kind == 3:
                struct.pack_into("<i", row, a, v)
            elif kind == 0x40:
                struct.pack_into("<Q", row, a, v)
            elif kind == 0x0B:
                row[a] = v
            else:
                struct.pack_into("<I", row, a, h.add(value(kind, v)))
        matrix += bytes(row)
    info = struct.pack("<BB4HIII", 0x7C, len(columns), bits, bits, bits, size, 2 << 5, 4 << 5 if rows else 0, 0) + b"".join(struct.pack("<HHHBB", *d) for d in descs)
    # Ends of the groups: values of 4 bytes and more, of 2, of 1; then the whole row with its bits.
    h.items[0] = info
    h.items[1] = struct.pack("<BBBBI", 0xB5, 4, 4, 0, 3 << 5)
    h.items[2] = b"".join(struct.pack("<II", r, i) for i, (r, _) in enumerate(rows))
    h.items[3] = matrix
    return h.build(1 << 5)


def one_off(name, kind, address, wide=True):
    if wide:
        rest = b"".join(s.encode("utf-16-le") + b"\0\0" for s in (name, kind, address))
    else:
        rest = b"".join(s.encode() + b"\0" for s in (name, kind, address))
    return b"\0" * 4 + ONE_OFF + struct.pack("<HH", 0, 0x8000 if wide else 0) + rest


class Pst:
    """Nodes: nid -> (heap, {subnode nid: heap})."""

    def __init__(self, version=23, deflate=False):
        self.version, self.deflate, self.nodes = version, deflate, {}
        self.page = 512 if version == 23 else 4096

    def build(self):
        out, blocks, nodes, bid = bytearray(self.page * 4), [], [], 4

        def put(data, internal=False):
            nonlocal bid
            number, bid = bid | (2 if internal else 0), bid + 4
            if self.deflate and not internal:
                data = zlib.compress(data)
            blocks.append((number, len(out), len(data)))
            out.extend(data + b"\0" * (-len(data) % 64))
            return number

        for nid, (heap, subs) in sorted(self.nodes.items()):
            data, sub = put(heap), 0
            if subs:
                entries = [(s, put(h), 0) for s, h in sorted(subs.items())]
                sub = put(struct.pack("<BBHI", 2, 0, len(entries), 0) + b"".join(struct.pack("<QQQ", *e) for e in entries), True)
            nodes.append((nid, data, sub))

        def tree(rows, size):
            leaf = [rows[i : i + 6] for i in range(0, len(rows), 6)]
            made = []
            for group in leaf:
                made.append((group[0][:8], self._page(out, b"".join(group), len(group), size, 0)))
            top = b"".join(key + struct.pack("<QQ", 0, ib) for key, ib in made)
            return self._page(out, top, len(made), 24, 1)

        nbt = tree([struct.pack("<QQQII", n, d, s, 0, 0) for n, d, s in nodes], 32)
        bbt = tree([struct.pack("<QQHHI", b, ib, n, 2, 0) for b, ib, n in sorted(blocks)], 24)
        out[0:4], out[8:10] = b"!BDN", b"SM" if self.version == 23 else b"SO"
        struct.pack_into("<H", out, 10, self.version)
        struct.pack_into("<QQ", out, 0xD8, 1, nbt)
        struct.pack_into("<QQ", out, 0xE8, 1, bbt)
        return bytes(out)

    def _page(self, out, entries, count, size, level):
        out.extend(b"\0" * (-len(out) % self.page))
        ib, room = len(out), 488 if self.version == 23 else 4056
        page = bytearray(self.page)
        page[: len(entries)] = entries
        struct.pack_into("<BBBB" if self.version == 23 else "<HHBB", page, room, count, room // size, size, level)
        out.extend(page)
        return ib


def mailbox(version=23, deflate=False):
    """Root -> Inbox (two messages) -> Projects (none), and a search folder."""
    p = Pst(version, deflate)
    name, count, unread, sub = (0x3001, 0x1F), (0x3602, 3), (0x3603, 3), (0x360A, 0x0B)
    inbox, projects, search = 0x8022, 0x8042, 0x8063
    p.nodes[0x21] = properties([(0x3001, 0x1F, "Sample Store")]), {}
    p.nodes[0x122] = properties([(0x3001, 0x1F, "Top")]), {}
    p.nodes[0x12D] = table([name, count, unread, sub], [(inbox, {0x3001: "Inbox", 0x3602: 2, 0x3603: 1, 0x360A: 1}), (search, {0x3001: "Unread"}), (inbox, {0x3001: "again"})]), {}
    p.nodes[0x802D] = table([name, count], [(projects, {0x3001: "Projects"})]), {}
    columns = [(0x0037, 0x1F), (0x0C19, 0x102), (0x0E06, 0x40), (0x0E07, 3), (0x0E08, 3), (0x001A, 0x1F), (0x0039, 0x40)]
    p.nodes[0x802E] = (
        table(columns, [(0x200024, {0x0037: "\x01\x04RE: hello", 0x0C19: one_off("Ann Example", "SMTP", "ann@example.com"), 0x0E06: FT, 0x0E07: 0x11, 0x0E08: 900, 0x001A: "IPM.Note"}), (0x200044, {0x0E07: 0, 0x0E06: 0})]),
        {},
    )
    attach = table([(0x0E20, 3), (0x3704, 0x1F)], [(0x8025, {0x0E20: 30, 0x3704: "SHORT.TXT"}), (0x8045, {0x0E20: 5, 0x3704: "inner.msg"})])
    people = table([(0x0C15, 3), (0x3001, 0x1F), (0x39FE, 0x1F)], [(1, {0x0C15: 1, 0x3001: "Bob Example", 0x39FE: "bob@example.com"}), (2, {0x0C15: 9})])
    subs = {
        0x671: attach,
        0x692: people,
        0x8025: properties([(0x3701, 0x102, b"payload bytes"), (0x3707, 0x1F, "long name.txt"), (0x370E, 0x1F, "text/plain"), (0x3705, 3, 1)]),
        0x8045: properties([(0x3701, 0x0D, 7), (0x3705, 3, 5)]),
    }
    p.nodes[0x200024] = properties([(0x1000, 0x1F, "Body text"), (0x0037, 0x1F, "\x01\x04RE: hello"), (0x0C1A, 0x1F, "Ann Example"), (0x1035, 0x1F, "<1@example.com>"), (0x0070, 0x1F, "hello"), (0x0E06, 0x40, FT), (0x0E07, 3, 0x11), (0x0E08, 3, 900), (0x001A, 0x1F, "IPM.Note"), (0x0E04, 0x1F, "Bob Example")]), subs
    p.nodes[0x200044] = properties([(0x1013, 0x102, b"<p>html</p>"), (0x0042, 0x1F, "Ann Assistant"), (0x0041, 0x102, one_off("Ann Other", "SMTP", "other@example.com"))]), {}
    return p.build()


def hx_block(plain, kind=8):
    """A valid block of literals only."""
    n, head = len(plain), b""
    if n < 15:
        head = bytes([n << 4])
    else:
        head, rest = b"\xf0", n - 15
        while rest >= 255:
            head, rest = head + b"\xff", rest - 255
        head += bytes([rest])
    packed = head + plain
    tail = struct.pack("<QIIII", 0x5D0245643B706A05, kind, len(packed), n, 4) + b"\0" * 8
    body = struct.pack("<I", zlib.crc32(tail + packed)) + tail + packed
    return struct.pack("<I", zlib.crc32(body[: 0x20 - 4])) + body


def hx_header(version=b"i"):
    return b"Nostromo" + version + b"\0" * 0x2F + struct.pack("<Q", 4096)


def wide(*texts):
    return b"".join(t.encode("utf-16-le") + b"\0\0" for t in texts)


def hx_record(sender="ann@example.com", name="Ann Example", subject="Quarterly plan", preview="The plan for the next quarter is attached, please read it.", ticks=638_400_000_000_000_000, before=True, html=""):
    head = wide(sender, name) if before else b""
    tail = b"" if before else wide(sender, name)
    return head + wide("IPM.Note") + tail + wide("<a1@example.com>") + struct.pack("<Q", ticks) + wide(preview, "RE: " + subject, subject) + (wide(html) if html else b"")


def attachment_file(head=b'Content-type: text/plain; name="n.txt"', payload=b"aGVsbG8="):
    return bytes((0xD0, 0x0D, 0, 0)) + b"x" * 28 + head + b"\r\r" + payload


def profile(data: Path):
    """A Mac profile: three folders and a ring of two, one message with a body, an attachment and a source file."""
    (data / "Message Attachments").mkdir(parents=True)
    (data / "Messages/1").mkdir(parents=True)
    (data / "Messages/1/example.olk15Message").write_bytes(bytes((0x0D, 0, 0, 1)) + b"u" * 16 + b"<html>body</html>")
    (data / "Message Attachments/one").write_bytes(attachment_file())
    c = sqlite3.connect(data / "Outlook.sqlite")
    c.executescript(
        """CREATE TABLE Folders(Record_RecordID INTEGER PRIMARY KEY, Folder_ParentID INTEGER, Folder_Name TEXT, Folder_SpecialFolderType INTEGER);
        CREATE TABLE Mail(Record_RecordID INTEGER PRIMARY KEY, Record_FolderID INTEGER, Message_NormalizedSubject TEXT, Message_SenderList TEXT, Message_SenderAddressList TEXT, Message_TimeReceived INTEGER, Message_TimeSent INTEGER, Record_ModDate INTEGER, Message_Size INTEGER, Message_ReadFlag INTEGER, Message_HasAttachment INTEGER, PathToDataFile TEXT, Message_ThreadTopic TEXT);
        CREATE TABLE Blocks(BlockID BLOB PRIMARY KEY, PathToDataFile TEXT); CREATE TABLE Mail_OwnedBlocks(Record_RecordID INTEGER, BlockID BLOB);
        CREATE TABLE AccountsMail(Account_Name TEXT); CREATE TABLE AccountsExchange(Account_Name TEXT);
        INSERT INTO Folders VALUES (1,-2,'Placeholder_Inbox_Placeholder',1),(2,-2,'Team Project',0),(3,2,'Subfolder',0),(4,5,NULL,0),(5,4,'loop',0);
        INSERT INTO Mail VALUES (10,2,'Re: example','Sample Sender','sender@example.com',1700000000,1700000000,'1700000000.9',1024,0,1,'Messages/1/example.olk15Message','Example thread');
        INSERT INTO Blocks VALUES (X'AABBCC','Message Attachments/one'),(X'DDEEFF','Message Sources/two'); INSERT INTO Mail_OwnedBlocks VALUES (10,X'AABBCC'),(10,X'DDEEFF');
        INSERT INTO AccountsExchange VALUES ('Example Account');"""
    )
    c.commit()
    c.close()


def cache_file():
    """A block cache: a record in two revisions, a later one of another sender, a broken block and one with two senders behind the anchor."""
    broken = bytearray(hx_block(hx_record("eve@example.com", "Eve Example", "Lost")))
    broken[-1] ^= 1
    two = wide("IPM.Note") + wide("a@example.com", "Ann A", "b@example.com", "Bob B", "Normal", "image/png")
    blocks = [hx_record(html="<html><body>x</body> tail"), hx_record(preview="zz"), hx_record("bob@example.com", "Bob Example", "Other matter", ticks=638_500_000_000_000_000), two]
    return hx_header() + b"".join(hx_block(b) for b in blocks) + b"noise" + bytes(broken)
