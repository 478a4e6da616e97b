import struct
import zlib

import pytest

from postlake.sources import samples as stores
from postlake.errors import FormatError, IoError, NotFoundError, UnsupportedError
from postlake.sources import datasource, discover, hx, macdb, pff


@pytest.mark.parametrize(("version", "deflate"), [(23, False), (36, False), (36, True)])
def test_pst_reads_folders_messages_and_payloads(tmp_path, version, deflate):
    f = tmp_path / "a.pst"
    f.write_bytes(stores.mailbox(version, deflate))
    s = pff.Store(str(f))
    assert s.display_name() == "Sample Store"
    assert [(x[0], x[1], x[2], x[3], x[4], x[7]) for x in s.folders()] == [
        (0x122, None, "Top", "", None, False), (0x8022, 0x122, "Inbox", "/Inbox", 2, False), (0x8063, 0x122, "Unread", "/Unread", None, True), (0x8042, 0x8022, "Projects", "/Inbox/Projects", None, False),
    ]
    a, b = s.messages(0x8022, "/Inbox")
    assert a[:6] == (0x200024, 0x8022, "/Inbox", "RE: hello", "Ann Example", "ann@example.com")
    assert a[6] == 1_700_000_000_000_000 and a[9:] == (900, False, True, "IPM.Note")
    assert b[3:] == (None, None, None, None, None, None, None, True, False, None)
    full = s.message(0x200024)
    assert full["body_plain"] == "Body text" and full["internet_message_id"] == "<1@example.com>"
    assert full["recipients"] == [(0x200024, 0, 1, "Bob Example", "bob@example.com"), (0x200024, 1, 9, None, None)]
    assert s.message(0x200044)["body_html"] == "<p>html</p>"
    assert s.attachments(0x200024) == [(0x200024, 0x8025, "long name.txt", "text/plain", None, 30, 13), (0x200024, 0x8045, "inner.msg", None, None, 5, None)]
    assert s.payload(0x200024, 0x8025) == b"payload bytes"
    with pytest.raises(UnsupportedError):
        s.payload(0x200024, 0x8045)
    with pytest.raises(NotFoundError):
        s.payload(0x200024, 0x9999)
    with pytest.raises(NotFoundError):
        s.message(-5)
    with pytest.raises(NotFoundError):
        s.message((1 << 32) + 0x200024)


def test_pst_header_is_checked(tmp_path):
    good = bytearray(stores.mailbox())
    for change, error in ((((0, b"XXXX")), FormatError), ((8, b"ZZ"), FormatError), ((10, struct.pack("<H", 14)), UnsupportedError), ((10, struct.pack("<H", 99)), UnsupportedError), ((0x201, b"\1"), UnsupportedError)):
        bad = bytearray(good)
        bad[change[0] : change[0] + len(change[1])] = change[1]
        f = tmp_path / "x.ost"
        f.write_bytes(bad)
        with pytest.raises(error):
            pff.Pff(str(f))
    with pytest.raises(IoError):
        pff.Pff(str(tmp_path / "none.ost"))


@pytest.mark.parametrize("bits", [11, 14])
def test_heap_ids_are_split_by_their_layout(bits):
    # Five bits of type, then the index, then the block.
    for block, index in ((0, 1), (3, 77), (200, (1 << bits) - 1)):
        assert pff.split_hid(block << (5 + bits) | index << 5, bits) == (block, index)


def test_deflated_blocks_are_told_by_their_header():
    for level in (0, 1, 6, 9):
        packed = zlib.compress(b"some block " * 9, level)
        assert pff.looks_deflated(packed) and pff.inflated(packed) == b"some block " * 9
        # A header whose check bits or method are off is data.
        assert not pff.looks_deflated(packed[:1] + bytes((packed[1] ^ 1,)) + packed[2:]) and not pff.looks_deflated(bytes((packed[0] ^ 1,)) + packed[1:])
    assert not pff.looks_deflated(b"\x78") and pff.inflated(zlib.compress(b"x")[:4]) == zlib.compress(b"x")[:4]


def test_compressed_rtf():
    stored = struct.pack("<II4sI", 12 + 5, 5, b"MELA", 0) + b"{\\x}!"
    assert pff.plain_rtf(stored) == "{\\x}!"
    # One literal group, a reference into the initial dictionary, then the end mark.
    literal = b"{ab}"
    end = struct.pack(">H", (207 + 4 + 6) << 4)
    data = bytes([0b110000]) + literal + struct.pack(">H", 0 << 4 | 4) + end
    assert pff.plain_rtf(struct.pack("<II4sI", 12 + len(data), 10, b"LZFu", 0) + data) == "{ab}{\\rtf1"
    assert pff.plain_rtf(b"short") is None and pff.plain_rtf(b"\0" * 20) is None


def test_lz4():
    assert hx.lz4_block(b"\x50hello", 5) == b"hello"
    assert hx.lz4_block(b"\x40abcd\x04\x00", 8) == b"abcdabcd"
    assert hx.lz4_block(b"\x10x\x01\x00", 5) == b"xxxxx"
    assert hx.lz4_block(b"\xf0\x0a" + b"z" * 25, 25) == b"z" * 25
    for bad, size in ((b"\x50hello", 6), (b"\x10x\x05\x00", 5), (b"\x50hel", 5), (b"\xf0", 20)):
        assert hx.lz4_block(bad, size) is None


def test_hx_header_and_blocks():
    assert hx.file_header(stores.hx_header())["known"] and not hx.file_header(stores.hx_header(b"z"))["known"]
    assert hx.file_header(stores.hx_header())["page_size"] == 4096
    for bad in (b"short", b"X" * 0x40):
        with pytest.raises(FormatError):
            hx.file_header(bad)
    one, two = stores.hx_block(b"first block"), stores.hx_block(b"y" * 900, 16)
    flipped = bytearray(one)
    flipped[-1] ^= 1
    data = stores.hx_header() + one + b"noise" + struct.pack("<Q", 0x5D0245643B706A05) + bytes(flipped) + two + one[:-3]
    got = list(hx.scan(data))
    assert [(k, b) for _, k, b in got] == [(8, b"first block"), (16, b"y" * 900)]
    # Parts of a file give each block once.
    cuts = [0, 70, 150, len(data)]
    assert [x for a, b in zip(cuts, cuts[1:]) for x in hx.scan(data, a, b)] == got


def test_hx_records():
    (r,) = hx.records(stores.hx_record(html="<html><body>x</body> tail"))
    assert r[1:6] == ("ann@example.com", "Ann Example", "a1@example.com", "RE: Quarterly plan", "The plan for the next quarter is attached, please read it.")
    assert r[6] == "<html><body>x</body>" and r[7] == (638_400_000_000_000_000 - 621_355_968_000_000_000) // 10_000_000
    (behind,) = hx.records(stores.hx_record(before=False))
    assert behind[1:3] == ("ann@example.com", "Ann Example")
    both = stores.wide("IPM.Note") + stores.wide("a@example.com", "Ann A", "b@example.com", "Bob B")
    assert next(hx.records(both))[1] is None
    two = list(hx.records(stores.hx_record() + stores.hx_record("bob@example.com", "Bob Example", "Other matter", ticks=638_500_000_000_000_000)))
    assert [x[1] for x in two] == ["ann@example.com", "bob@example.com"]
    # A record's span begins at the anchor before it, and the earliest tick in it counts.
    assert two[0][7] == two[1][7]


def test_mac_bodies():
    head = bytes((0x0D, 0, 0, 1)) + b"u" * 16
    assert macdb.parse_body(head + b"junk<html>hi</HTML>{\"MessageCardSerialized\":1}") == ("html", "<html>hi</HTML>")
    assert macdb.parse_body(head + "<html>wide</html>".encode("utf-16-le")) == ("html", "<html>wide</html>")
    assert macdb.parse_body(head + b"BEGIN:VCALENDAR\nEND:VCALENDAR\nx") == ("calendar", "BEGIN:VCALENDAR\nEND:VCALENDAR")
    assert macdb.parse_body(head + "<html>K</body>tail\x00\x01\x02more".encode()) == ("html", "<html>K</body>")
    assert macdb.parse_body(head + b"plain only") is None and macdb.parse_body(b"") is None
    assert macdb.parse_source(b"\0\1From: a") == b"From: a" and macdb.parse_source(b"none") is None


def test_mac_attachments():
    data = bytes((0xD0, 0x0D, 0, 0)) + b"x" * 28 + b'Content-type: text/plain; name="a b.txt"\r\r' + b"aGVs\r\nbG8" + b"\0tail"
    assert macdb.attachment_metadata(data) == ("a b.txt", "text/plain")
    assert macdb.parse_attachment(data) == ("a b.txt", "text/plain", b"hello")
    for bad in (b"nope", bytes((0xD0, 0x0D, 0, 0)) + b"no end"):
        with pytest.raises(FormatError):
            macdb.attachment_metadata(bad)


@pytest.fixture
def profile(tmp_path):
    d = tmp_path / "Main" / "Data"
    stores.profile(d)
    return macdb.Profile(d)


def test_mac_profile(profile):
    f = {x[0]: x for x in profile.folders()}
    assert f[1][2:5] == ("Inbox", "/Inbox", 0)
    assert f[2][2:7] == ("Team Project", "/Team Project", 1, 1, True)
    assert f[3][1] == 2 and f[3][3] == "/Team Project/Subfolder"
    assert f[4][3].endswith("folder-4") and f[4][3].count("/") == 64
    (m,) = profile.messages(2, "/Team Project")
    assert m[:6] == (10, 2, "/Team Project", "Re: example", "Sample Sender", "sender@example.com") and m[6] == m[8] == 1_700_000_000_000_000 and m[10] is True and m[11] is True
    assert profile.message(10)["body_html"] == "<html>body</html>" and profile.display_name() == "Example Account"
    with pytest.raises(NotFoundError):
        profile.message(999)
    assert len(profile.blocks(10)) == 1 and len(profile.blocks(10, "Sources")) == 1
    (a,) = profile.attachments(10)
    assert a[2:4] == ("n.txt", "text/plain") and profile.payload(10, a[1]) == b"hello"
    for bad in ("../x", "/etc/passwd", "a/%2e%2e/../x"):
        with pytest.raises(FormatError):
            profile.read_file(bad)


def test_discovery(tmp_path, profile):
    (tmp_path / "b.OST").write_bytes(b"x" * 10)
    (tmp_path / "c.txt").write_bytes(b"x")
    got = discover.stores([tmp_path, tmp_path])
    assert [x.kind for x in got] == ["mac", "file"] and got[1].path.endswith("b.OST")
    assert discover.is_store("a.PST") and not discover.is_store("a.nst")
    for p in (profile.data_dir, profile.data_dir / "Outlook.sqlite", profile.data_dir.parent):
        assert discover.mac_data_dir(p) == profile.data_dir
    assert discover.mac_data_dir(tmp_path) is None


def test_store_as_a_data_source(spark, tmp_path):
    f = tmp_path / "a.pst"
    f.write_bytes(stores.mailbox(36, True))
    box = discover.open_store(spark, str(f))
    assert box.store_info()["kind"] == "ost-v36" and box.folders.count() == 4
    assert box.search()["row_count"] == 2
    got = box.get_message(0x200024)
    assert got["body"] == "Body text" and got["recipients"][0] == {"kind": "to", "name": "Bob Example", "email": "bob@example.com"} and got["recipients"][1]["kind"] == "9"
    assert got["delivered"] == "2023-11-14 22:13:20" and len(got["attachments"]) == 2
    assert box.read_attachment(0x200024, 0x8025)["text"] == "payload bytes"
    assert box.messages.where("folder_nid = 32802").count() == 2 and box.messages.where("folder_nid = 7").count() == 0
    assert box.sql("SELECT count(*) AS n FROM ost_attachments(message_nid => 2097188)")["rows"] == [{"n": 2}]
    out = tmp_path / "o.bin"
    assert box.save_attachment(0x200024, 0x8025, str(out))["bytes"] == 13 and out.read_bytes() == b"payload bytes"
    with pytest.raises(NotFoundError):
        box.list_attachments(5)


def test_mac_profile_with_its_cache(spark, profile):
    cache = profile.data_dir.parent / "HxStore.hxd"
    cache.write_bytes(stores.hx_header() + stores.hx_block(stores.hx_record()) + stores.hx_block(stores.hx_record(preview="zz")) + stores.hx_block(stores.hx_record("bob@example.com", "Bob Example", "Other matter", ticks=638_500_000_000_000_000)))
    box = discover.open_store(spark, str(profile.data_dir))
    assert box.kind == "mac" and {r["path"] for r in box.list_folders()["rows"]} >= {"/Inbox", "/Recovered"}
    rows = {r["nid"]: r for r in box.search()["rows"]}
    assert set(rows) == {10, -1_000_000, -1_000_001} and rows[-1_000_000]["sender_email"] == "bob@example.com"
    assert box.get_message(-1_000_001)["body"].startswith("The plan")
    # Lookups by key are one partition, however many folders there are.
    assert datasource.load(spark, str(profile.data_dir), "messages", prune=True).where("nid = 10").rdd.getNumPartitions() == 1
    # Without it, filters in two places do not touch each other.
    assert box.query("SELECT nid FROM messages WHERE nid = 10 UNION ALL SELECT nid FROM messages WHERE nid = 999").count() == 1
    assert box.get_message(10)["body"] == "<html>body</html>" and box.list_attachments(10)[0]["filename"] == "n.txt"
    assert box.list_attachments(999) == []
