"""Registered queries that read binary stores through the data source and the tools, with their rows stated by hand.

The stores are the samples, written to the shared folder when a query runs. DuckDB cannot read them: its text
lists the rows that must come out.
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import mcp, schema
from postlake.errors import MailboxError, UnsupportedError
from postlake.functions import scalars
from postlake.plans import guard
from postlake.plans.mailbox import RELATIONS
from postlake.session import scratch_path
from postlake.sources import datasource, discover, hx, macdb, pff, samples

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
_READ = "2023-11-14 22:13:20"


def _literal(v: object) -> str:
    return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def sample(columns: str, *rows: tuple) -> Callable:
    """Register a query under its function's name; ``rows`` are what it must give."""
    kinds = [c.split() for c in columns.split(", ")]

    def add(f: Callable[[SparkSession], DataFrame]) -> Callable:
        values = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
        ORACLES[f.__name__] = f"SELECT {', '.join(f'CAST({n} AS {_DUCK[k]}) AS {n}' for n, k in kinds)} FROM (VALUES {values}) t({', '.join(n for n, _ in kinds)})"
        QUERIES[f.__name__] = lambda spark, d: f(spark)
        return f

    return add


def _columns(of, *without: str) -> str:
    return ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in of.fields if x.name not in without)


def _place(spark: SparkSession, label: str) -> Path:
    """A new folder in the shared folder; the readers of stores open files, so it must be one of a file system."""
    path = scratch_path(spark, label)
    if "://" in path and not path.startswith("file://"):
        raise UnsupportedError("stores are read from mounted file systems only")
    made = Path("/" + path.removeprefix("file:").lstrip("/"))
    made.mkdir(parents=True)
    return made


def _store(spark: SparkSession, version: int = 36) -> str:
    at = _place(spark, "store") / "sample.pst"
    at.write_bytes(samples.mailbox(version, deflate=version == 36))
    return str(at)


def _profile(spark: SparkSession, cache: bool = False) -> str:
    data = _place(spark, "profile") / "Main" / "Data"
    samples.profile(data)
    if cache:
        (data.parent / "HxStore.hxd").write_bytes(samples.cache_file())
    return str(data)


_read = datasource.load


def _told(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    return spark.createDataFrame(rows, columns)


# Stores of the .ost and .pst family

_FOLDERS = ((290, None, "Top", "", None, None, True, False), (32802, 290, "Inbox", "/Inbox", 2, 1, True, False), (32867, 290, "Unread", "/Unread", None, None, False, True), (32834, 32802, "Projects", "/Inbox/Projects", None, None, False, False))
_ROWS = (
    (2097188, 32802, "/Inbox", "RE: hello", "Ann Example", "ann@example.com", _READ, None, None, 900, False, True, "IPM.Note"),
    (2097220, 32802, "/Inbox", None, None, None, None, None, None, None, True, False, None),
)
_FILES = ((2097188, 32805, "long name.txt", "text/plain", None, 30, 13), (2097188, 32837, "inner.msg", None, None, 5, None))


@sample(_columns(schema.FOLDERS) + ", version int", *[(*f, v) for v in (23, 36) for f in _FOLDERS])
def store_folders(spark: SparkSession) -> DataFrame:
    each = [_read(spark, _store(spark, v), "folders").withColumn("version", F.lit(v)) for v in (23, 36)]
    return each[0].unionByName(each[1])


@sample(_columns(schema.MESSAGES) + ", version int", *[(*r, v) for v in (23, 36) for r in _ROWS])
def store_messages(spark: SparkSession) -> DataFrame:
    each = [_read(spark, _store(spark, v), "messages").withColumn("version", F.lit(v)) for v in (23, 36)]
    return each[0].unionByName(each[1])


@sample(_columns(schema.MESSAGES), _ROWS[0])
def store_message_by_nid(spark: SparkSession) -> DataFrame:
    return _read(spark, _store(spark), "messages", prune=True).where("nid = 2097188")


@sample(_columns(schema.BODIES), (2097188, "<1@example.com>", "hello", "Bob Example", None, "Body text", None, None), (2097220, None, None, None, None, None, "<p>html</p>", None))
def store_bodies(spark: SparkSession) -> DataFrame:
    return _read(spark, _store(spark), "bodies")


@sample(_columns(datasource.RECIPIENTS), (2097188, 0, 1, "Bob Example", "bob@example.com"), (2097188, 1, 9, None, None))
def store_recipients(spark: SparkSession) -> DataFrame:
    return _read(spark, _store(spark), "recipients")


@sample(_columns(schema.ATTACHMENTS), *_FILES)
def store_attachments(spark: SparkSession) -> DataFrame:
    return _read(spark, _store(spark), "attachments")


@sample(_columns(schema.ATTACHMENTS) + ", asked bigint", *[(*f, 2097188) for f in _FILES])
def store_attachments_scoped(spark: SparkSession) -> DataFrame:
    """The table function on a store: an unknown message gives no rows and no error."""
    box = discover.open_store(spark, _store(spark))
    ask = lambda n: box.query(f"SELECT *, CAST({n} AS BIGINT) AS asked FROM ost_attachments(message_nid => {n})")
    return ask(2097188).unionByName(ask(5))


@sample("step string, outcome string", ("payload", "payload bytes"), ("embedded", "UnsupportedError"), ("no attachment", "NotFoundError"), ("no message", "NotFoundError"), ("saved", "13 bytes: payload bytes"))
def store_payloads(spark: SparkSession) -> DataFrame:
    box, out = discover.open_store(spark, _store(spark)), _place(spark, "saved") / "o.bin"
    told = [("payload", box.read_attachment(2097188, 32805)["text"])]
    for step, key in (("embedded", (2097188, 32837)), ("no attachment", (2097188, 1)), ("no message", (5, 1))):
        try:
            told.append((step, str(box.read_attachment(*key))))
        except MailboxError as e:
            told.append((step, type(e).__name__))
    told.append(("saved", f"{box.save_attachment(2097188, 32805, str(out))['bytes']} bytes: {out.read_text()}"))
    return _told(spark, told, "step string, outcome string")


@sample("case_name string, outcome string", ("good 23", "ost-v23"), ("good 36", "ost-v36"), ("no magic", "FormatError"), ("other client", "FormatError"), ("ansi", "UnsupportedError"), ("unknown version", "UnsupportedError"), ("encoded", "UnsupportedError"), ("missing", "IoError"))
def store_headers(spark: SparkSession) -> DataFrame:
    at, good, told = _place(spark, "headers"), samples.mailbox(), []
    changed = {"no magic": (0, b"XXXX"), "other client": (8, b"ZZ"), "ansi": (10, b"\x0e\0"), "unknown version": (10, b"\x63\0"), "encoded": (0x201, b"\1")}
    files = {"good 23": good, "good 36": samples.mailbox(36)} | {k: good[:i] + b + good[i + len(b) :] for k, (i, b) in changed.items()}
    for name, data in files.items():
        (at / f"{name}.ost").write_bytes(data)
    for name in [*files, "missing"]:
        try:
            told.append((name, pff.Pff(str(at / f"{name}.ost")).kind))
        except MailboxError as e:
            told.append((name, type(e).__name__))
    return _told(spark, told, "case_name string, outcome string")


# The classic Mac profile

_RINGS = "/loop/folder-4" * 32, "/folder-4/loop" * 32


@sample(
    _columns(schema.FOLDERS), (1, None, "Inbox", "/Inbox", 0, 0, False, False), (2, None, "Team Project", "/Team Project", 1, 1, True, False), (3, 2, "Subfolder", "/Team Project/Subfolder", 0, 0, False, False),
    (4, 5, None, _RINGS[0], 0, 0, True, False), (5, 4, "loop", _RINGS[1], 0, 0, True, False),
)
def mac_folders(spark: SparkSession) -> DataFrame:
    return _read(spark, _profile(spark), "folders")


_MAIL = (10, 2, "/Team Project", "Re: example", "Sample Sender", "sender@example.com", _READ, _READ, _READ, 1024, True, True, None)


@sample(_columns(schema.MESSAGES) + ", asked string", (*_MAIL, "folders"), (*_MAIL, "nid"))
def mac_messages(spark: SparkSession) -> DataFrame:
    path = _profile(spark)
    rows, by_key = _read(spark, path, "messages"), lambda n: _read(spark, path, "messages", prune=True).where(f"nid = {n}")
    return rows.withColumn("asked", F.lit("folders")).unionByName(by_key(10).withColumn("asked", F.lit("nid"))).unionByName(by_key(999).withColumn("asked", F.lit("none")))


@sample(_columns(schema.BODIES), (10, None, "Example thread", None, None, None, "<html>body</html>", None))
def mac_bodies(spark: SparkSession) -> DataFrame:
    return _read(spark, _profile(spark), "bodies")


@sample(_columns(schema.ATTACHMENTS) + ", content string", (10, 7857481840600092250, "n.txt", "text/plain", None, 80, None, "hello"))
def mac_attachments(spark: SparkSession) -> DataFrame:
    """The message owns a source file too, which is no attachment; the id is a hash of the block's."""
    path = _profile(spark)
    return _read(spark, path, "attachments").withColumn("content", F.lit(macdb.Profile(Path(path)).payload(10, 7857481840600092250).decode()))


@sample(
    "case_name string, outcome string", ("html with a card", "html: <html>hi</HTML>"), ("wide", "html: <html>wide</html>"), ("calendar", "calendar: BEGIN:VCALENDAR\nEND:VCALENDAR"), ("body end", "html: <html>K</body>"), ("no mark", "None"),
    ("source", "From: a"), ("attachment", "a b.txt, text/plain, hello"), ("no magic", "FormatError"), ("outside", "FormatError"), ("absolute", "FormatError"), ("encoded dots", "FormatError"),
)
def mac_files(spark: SparkSession) -> DataFrame:
    head = bytes((0x0D, 0, 0, 1)) + b"u" * 16
    body = {"html with a card": b'junk<html>hi</HTML>{"MessageCardSerialized":1}', "wide": "<html>wide</html>".encode("utf-16-le"), "calendar": b"BEGIN:VCALENDAR\nEND:VCALENDAR\nx", "body end": b"<html>K</body>tail\x00\x01\x02more", "no mark": b"plain only"}
    told = [(k, ": ".join(p) if (p := macdb.parse_body(head + v)) else "None") for k, v in body.items()]
    told.append(("source", macdb.parse_source(b"\0\1From: a").decode()))
    name, kind, data = macdb.parse_attachment(samples.attachment_file(b'Content-type: text/plain; name="a b.txt"', b"aGVs\r\nbG8\0tail"))
    told.append(("attachment", f"{name}, {kind}, {data.decode()}"))
    box = macdb.Profile(Path(_profile(spark)))
    for case, run in (("no magic", lambda: macdb.attachment_metadata(b"nope")), ("outside", lambda: box.read_file("../x")), ("absolute", lambda: box.read_file("/etc/passwd")), ("encoded dots", lambda: box.read_file("a/%2e%2e/../x"))):
        try:
            told.append((case, str(run())))
        except MailboxError as e:
            told.append((case, type(e).__name__))
    return _told(spark, told, "case_name string, outcome string")


# The block cache

_PLAN = "The plan for the next quarter is attached, please read it."


@sample(
    "sender_address string, sender_name string, internet_message_id string, subject string, preview string, html string, sent_unix bigint, n bigint",
    ("ann@example.com", "Ann Example", "a1@example.com", "RE: Quarterly plan", _PLAN, "<html><body>x</body>", 1704403200, 1), ("ann@example.com", "Ann Example", "a1@example.com", "RE: Quarterly plan", "Quarterly plan", None, 1704403200, 1),
    ("bob@example.com", "Bob Example", "a1@example.com", "RE: Other matter", _PLAN, None, 1714403200, 1), (None, None, None, None, "Bob B", None, None, 1),
)
def cache_records(spark: SparkSession) -> DataFrame:
    """A broken block gives nothing; two senders behind an anchor mean none; states and media types are no text."""
    cache = str(Path(_profile(spark, cache=True)).parent / "HxStore.hxd")
    return _read(spark, cache, "records").groupBy("sender_address", "sender_name", "internet_message_id", "subject", "preview", "html", "sent_unix").agg(F.count("*").alias("n"))


@sample("nid bigint, folder_path string, sender_email string", (10, "/Team Project", "sender@example.com"), (-1000000, "/Recovered", "bob@example.com"), (-1000001, "/Recovered", "ann@example.com"), (-1000002, "/Recovered", None))
def cache_union(spark: SparkSession) -> DataFrame:
    """Messages of a profile and those recovered from its cache: revisions merged, the newest first, unknown times last."""
    return discover.open_store(spark, _profile(spark, cache=True)).messages.select("nid", "folder_path", "sender_email")


@sample(
    "text string, address boolean, opaque boolean, person boolean, subject boolean", ("Anonymous", False, True, False, False), ("normal", False, True, False, False), ("image/png", False, True, False, False), ("eyJhIjoxfQ", False, True, False, False),
    ("Donaudampfschifffahrtsgesellschaft", False, False, True, True), ("0123456789abcdef01234567", False, True, False, False), ("{01234567-89ab-cdef-0123-456789abcdef}", False, True, False, False), ("Ann Example", False, False, True, True),
    ("a. b. c", False, False, False, False), ("ann@example.com", True, False, False, False), ("a!b@example.com", False, False, False, True), ("see http://x.example", False, False, True, False), ("12:30", False, False, False, False),
)
def cache_shapes(spark: SparkSession) -> DataFrame:
    texts = ["Anonymous", "normal", "image/png", "eyJhIjoxfQ", "Donaudampfschifffahrtsgesellschaft", "0123456789abcdef01234567", "{01234567-89ab-cdef-0123-456789abcdef}", "Ann Example", "a. b. c", "ann@example.com", "a!b@example.com", "see http://x.example", "12:30"]
    told = [(t, scalars.email_shaped(t), hx.opaque(t), hx.PERSON.fits(t), hx.SUBJECT.fits(t) and not scalars.email_shaped(t)) for t in texts]
    return _told(spark, told, "text string, address boolean, opaque boolean, person boolean, subject boolean")


@sample("case_name string, outcome string", ("literals", "hello"), ("reference", "abcdabcd"), ("overlap", "xxxxx"), ("wrong length", "None"), ("bad distance", "None"), ("crc", "CBF43926"), ("fnv", "0x2F63DC4C8601EC8C"), ("known header", "True 4096"), ("no header", "FormatError"))
def cache_codec(spark: SparkSession) -> DataFrame:
    import zlib

    packed = {"literals": (b"\x50hello", 5), "reference": (b"\x40abcd\x04\x00", 8), "overlap": (b"\x10x\x01\x00", 5), "wrong length": (b"\x50hello", 6), "bad distance": (b"\x10x\x05\x00", 5)}
    told = [(k, out.decode() if (out := hx.lz4_block(*v)) is not None else "None") for k, v in packed.items()]
    head = hx.file_header(samples.hx_header())
    told += [("crc", f"{zlib.crc32(b'123456789'):08X}"), ("fnv", f"0x{scalars.fnv1a_id(b'a'):016X}"), ("known header", f"{head['known']} {head['page_size']}")]
    try:
        hx.file_header(b"X" * 0x40)
    except MailboxError as e:
        told.append(("no header", type(e).__name__))
    return _told(spark, told, "case_name string, outcome string")


# Scalars that only stores reach


@sample("case_name string, outcome string", ("subject", "RE: hello"), ("plain subject", "plain"), ("filetime", _READ), ("no filetime", None), ("smtp", "Ann Example <ann@example.com>"), ("fax", "Ann Example <None>"), ("eight bits", "Bob <bob@example.com>"), ("other", "None"), ("before 1970", "1969-12-31 23:59:59"))
def store_scalars(spark: SparkSession) -> DataFrame:
    entries = {"smtp": samples.one_off("Ann Example", "SMTP", "ann@example.com"), "fax": samples.one_off("Ann Example", "FAX", "12"), "eight bits": samples.one_off("Bob", "smtp", "bob@example.com", wide=False), "other": b"\0" * 30}
    one = spark.createDataFrame([(k, bytearray(v)) for k, v in entries.items()], "case_name string, b binary").select("case_name", scalars.entry_id(F.col("b")).alias("e"))
    one = one.select("case_name", F.when(F.col("e.name").isNull(), "None").otherwise(F.concat("e.name", F.lit(" <"), F.coalesce("e.email", F.lit("None")), F.lit(">"))).alias("outcome"))
    texts = spark.createDataFrame([("subject", "\x01\x04RE: hello"), ("plain subject", "plain")], "case_name string, s string").select("case_name", scalars.clean_subject(F.col("s")).alias("outcome"))
    times = spark.createDataFrame([("filetime", samples.FT), ("no filetime", 0), ("before 1970", scalars.FILETIME_EPOCH - 10)], "case_name string, t long").select("case_name", scalars.format_time(scalars.micros_to_timestamp(scalars.filetime_to_us(F.col("t")))).alias("outcome"))
    return one.unionByName(texts).unionByName(times)


# Tools


def _facts(spark: SparkSession, reply: dict) -> DataFrame:
    return _told(spark, [(k, json.dumps(v, ensure_ascii=False)) for k, v in reply.items()], "field string, told string")


@sample(
    "field string, told string", ("nid", "2097188"), ("subject", '"RE: hello"'), ("sender_name", '"Ann Example"'), ("sender_email", "null"), ("to", '"Bob Example"'), ("cc", "null"), ("delivered", f'"{_READ}"'), ("submitted", "null"), ("modified", "null"), ("size", "900"), ("unread", "false"),
    ("message_class", '"IPM.Note"'), ("internet_message_id", '"<1@example.com>"'), ("conversation_topic", '"hello"'), ("body", '"Body"'), ("body_format", '"plain"'), ("body_truncated", "true"), ("bodies_available", '["plain"]'),
    ("recipients", '[{"kind": "to", "name": "Bob Example", "email": "bob@example.com"}, {"kind": "9", "name": null, "email": null}]'),
    ("attachments", '[{"nid": 32805, "filename": "long name.txt", "mime": "text/plain", "content_id": null, "declared_size": 30, "data_len": 13}, {"nid": 32837, "filename": "inner.msg", "mime": null, "content_id": null, "declared_size": 5, "data_len": null}]'),
)
def tool_get_message(spark: SparkSession) -> DataFrame:
    return _facts(spark, discover.open_store(spark, _store(spark)).get_message(2097188, 4))


@sample("nid bigint, sender_name string, sender_email string", (2097188, "Ann Example", None), (2097220, "Ann Assistant", "other@example.com"))
def tool_detail_sender(spark: SparkSession) -> DataFrame:
    """In details the message's own name comes first, then whom it stands for, then the entry id."""
    box = discover.open_store(spark, _store(spark))
    got = [box.get_message(n) for n in (2097188, 2097220)]
    return _told(spark, [(m["nid"], m["sender_name"], m["sender_email"]) for m in got], "nid long, sender_name string, sender_email string")


@sample("field string, told string", ("kind", '"ost-v36"'), ("display_name", '"Sample Store"'), ("folders", "4"), ("tables", json.dumps(list(schema.TABLES))))
def tool_store_info(spark: SparkSession) -> DataFrame:
    info = discover.open_store(spark, _store(spark)).store_info()
    return _facts(spark, {k: info[k] for k in ("kind", "display_name", "folders", "tables")})


@sample("place int, kind string, name string", (0, "mac", "Data"), (1, "file", "b.OST"))
def tool_discovery(spark: SparkSession) -> DataFrame:
    """Stores of a folder, the largest first, a folder named twice once; other files are none."""
    at = _place(spark, "found")
    samples.profile(at / "Main" / "Data")
    (at / "b.OST").write_bytes(b"x" * 10)
    (at / "c.txt").write_bytes(b"x" * 99)
    return _told(spark, [(i, f.kind, Path(f.path).name) for i, f in enumerate(discover.stores([at, at]))], "place int, kind string, name string")


_ASKED = (
    ("SELECT 1", True), ("(SELECT 1) UNION (SELECT 2)", True), ("select 1;", True), ("with a as (select nid from messages) select * from a", True), ("EXPLAIN SELECT 1", True), ("select 1; select 2", False), ("select ';'", False), ("CREATE TABLE t(a int)", False), ("COPY a TO 'b'", False),
    ("select java_method('java.lang.System', 'getenv', 'HOME')", False), ("select transform(nid) using 'cat' from messages", False), ("select * from parquet.`/tmp/x`", False), ("SELECT ', other as (' AS x, id FROM other", False), ("with a as (select 1) insert into messages select * from a", False), ("select input_file_name() from messages", False),
)


@sample("text string, allowed boolean", *_ASKED)
def tool_guard(spark: SparkSession) -> DataFrame:
    def allowed(text: str) -> bool:
        try:
            guard.check_plan(spark, guard.check_read_only(text), RELATIONS)
        except UnsupportedError:
            return False
        return True

    return _told(spark, [(t, allowed(t)) for t, _ in _ASKED], "text string, allowed boolean")


@sample(
    "id int, told string", (1, "postlake 2024-11-05"), (2, "store_info list_folders search sql get_message list_attachments read_attachment"), (3, "[[\"/Inbox\"]]"), (4, "-32602 message 5"), (5, "-32602 get_message needs nid"), (6, "-32601 no such method: resources/list"), (7, "2"), (None, "-32700 no JSON"),
)
def tool_mcp(spark: SparkSession) -> DataFrame:
    """A session over the protocol: a notification has no reply."""
    asked = [
        ("initialize", {"protocolVersion": "2024-11-05"}), ("tools/list", {}), ("tools/call", {"name": "sql", "arguments": {"query": "SELECT path FROM folders WHERE name = 'Inbox'"}}), ("tools/call", {"name": "get_message", "arguments": {"nid": 5}}),
        ("tools/call", {"name": "get_message", "arguments": {}}), ("resources/list", {}), ("tools/call", {"name": "list_attachments", "arguments": {"nid": 2097188}}),
    ]
    lines = [json.dumps({"jsonrpc": "2.0", "id": i, "method": m, "params": p}) for i, (m, p) in enumerate(asked, 1)] + ['{"jsonrpc": "2.0", "method": "notifications/initialized"}', "no json"]
    out = io.StringIO()
    mcp.serve(discover.open_store(spark, _store(spark)), io.StringIO("\n".join(lines)), out)
    told = []
    for r in map(json.loads, out.getvalue().splitlines()):
        if "error" in r:
            told.append((r["id"], f"{r['error']['code']} {r['error']['message']}"))
        elif "serverInfo" in r["result"]:
            told.append((r["id"], f"{r['result']['serverInfo']['name']} {r['result']['protocolVersion']}"))
        elif "tools" in r["result"]:
            told.append((r["id"], " ".join(t["name"] for t in r["result"]["tools"])))
        else:
            rows = r["result"]["structuredContent"]["rows"]
            told.append((r["id"], json.dumps([list(x.values()) for x in rows]) if "columns" in r["result"]["structuredContent"] else str(len(rows))))
    return _told(spark, told, "id int, told string")

