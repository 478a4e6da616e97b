import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake import cli
from postlake.errors import NotFoundError, UnsupportedError
from postlake.functions import scalars
from postlake.operators import asof, dedup, hierarchy, listing, recovery
from postlake.plans import dialect, guard, shape
from postlake.plans.mailbox import RELATIONS, Mailbox
from postlake.session import scratch_path

MESSAGES = "nid long, folder_nid long, folder_path string, subject string, sender_name string, sender_email string, delivered timestamp_ntz, size long, unread boolean, has_attachments boolean"


def one(df):
    return [tuple(r) for r in df.collect()]


# Scalars


def test_scalars(spark):
    df = spark.createDataFrame([("\x01\x04RE: hello", "abab", 116_444_736_000_000_000), ("plain", "aba", 0), (None, None, None), ("", "", 133_444_736_000_000_000)], "s string, d string, ft long")
    got = one(df.select(scalars.clean_subject(F.col("s")), scalars.undouble(F.col("d")), scalars.filetime_to_us(F.col("ft"))))
    assert got == [("RE: hello", "ab", 0), ("plain", "aba", None), (None, None, None), ("", "", 1_700_000_000_000_000)]
    t = spark.createDataFrame([(0,), (-1,), (1_700_000_000_999_999,), (None,)], "us long").select(scalars.format_time(scalars.micros_to_timestamp(F.col("us"))))
    assert one(t) == [("1970-01-01 00:00:00",), ("1969-12-31 23:59:59",), ("2023-11-14 22:13:20",), (None,)]
    s = spark.createDataFrame([("1700000000.9",), (" -5.7 ",), ("x",), (None,)], "v string").select(scalars.unix_seconds(F.col("v")))
    assert one(s) == [(1_700_000_000,), (-5,), (None,), (None,)]
    k = spark.createDataFrame([(1,), (2,), (3,), (7,), (None,)], "k int").select(scalars.recipient_kind(F.col("k")))
    assert one(k) == [("to",), ("cc",), ("bcc",), ("7",), ("unknown",)]


def test_reply_prefixes_and_addresses(spark):
    df = spark.createDataFrame([(" RE: Fwd: aw:  x ",), ("Report: re: x",), (None,)], "s string").select(scalars.strip_reply_prefix(F.col("s")))
    assert one(df) == [("x",), ("Report: re: x",), (None,)]
    cases = ["a@b.co", "a@b", "@b.co", "a@.b.co", "a@b.c0m", "a b@c.de", "x" * 250 + "@b.co", "a@b.abcdefghijklm", "", None, "a@@b.co", "a.b+c@d-e.example.org"]
    got = one(spark.createDataFrame([(c,) for c in cases], "e string").select(scalars.is_email(F.col("e"))))
    assert [g[0] for g in got] == [scalars.email_shaped(c) for c in cases] and sum(g[0] for g in got) == 3


def test_bodies_and_payloads(spark):
    df = spark.createDataFrame([("p", "h", None), (None, None, "r"), (None, None, None), ("", "h", None)], "p string, h string, r string")
    got = one(df.select(scalars.best_body(F.col("p"), F.col("h"), F.col("r")).alias("b"), scalars.bodies_available(F.col("p"), F.col("h"), F.col("r")).alias("a")).select("b.*", "a"))
    assert got == [("p", "plain", ["plain", "html"]), ("r", "rtf", ["rtf"]), (None, None, []), ("", "plain", ["plain", "html"])]
    b = spark.createDataFrame([(bytearray("ü".encode()),), (bytearray(b"a\0"),), (bytearray(b"\xff\xfe"),)], "b binary").select(scalars.text_or_base64(F.col("b")).alias("x")).select("x.*")
    assert one(b) == [("ü", None), (None, "YQA="), (None, "//4=")]
    assert shape.payload(b"abc", 2) == {"total_bytes": 3, "returned_bytes": 2, "truncated": True, "text": "ab"}
    assert shape.payload(b"a\0", 9)["base64"] == "YQA="


def test_entry_ids(spark):
    from postlake.sources.samples import one_off

    assert scalars.one_off_address(one_off("Ann", "smtp", "a@b.co")) == ("Ann", "a@b.co")
    assert scalars.one_off_address(one_off("Ann", "FAX", "a@b.co", False)) == ("Ann", None)
    assert scalars.one_off_address(one_off("", "SMTP", "no at")) == (None, None)
    assert scalars.one_off_address(b"\0" * 8) is None and scalars.one_off_address(None) is None
    df = spark.createDataFrame([(bytearray(one_off("Ann", "SMTP", "a@b.co")),), (None,)], "e binary").select(scalars.entry_id(F.col("e")).alias("x")).select("x.*")
    assert one(df) == [("Ann", "a@b.co"), (None, None)]


def test_percent_decoding():
    assert scalars.percent_decode("a%20b+c%zz%") == "a b+c%zz%" and scalars.percent_decode("%C3%BC%ff") == "ü�"
    assert scalars.fnv1a_id(b"") == 0xCBF29CE484222325 & 0x7FFFFFFFFFFFFFFF


# Structured queries


@pytest.fixture
def mails(spark):
    t = lambda d: None if d is None else dt.datetime(2024, 1, d)
    rows = [(1, 7, "/In/A", "Budget 50%", "Ann", "a@x.example", t(1), 10, True, True), (2, 7, "/In/A", "back\\slash", None, None, t(2), None, False, None), (3, 8, "/B", None, "Bo", "budget@x.example", None, 5, None, False), (4, 8, "/B", "", "Bo", "b@x.example", t(2), 1, True, True)]
    return spark.createDataFrame(rows, MESSAGES)


def test_search(mails):
    ids = lambda **k: [r["nid"] for r in listing.search(mails, **k).collect()]
    assert ids() == [2, 4, 1, 3] and ids(limit=2) == [2, 4]
    assert ids(text="BUDGET") == [1, 3] and ids(text="") == [2, 4, 1, 3]
    assert ids(text="\\") == [2] and ids(text="b%t") == [1, 3] and ids(folder="in/") == [2, 1]
    assert ids(since="2024-01-02") == [2, 4] and ids(until="2024-01-02") == [1]
    assert ids(with_attachments=True) == [4, 1] and len(ids(with_attachments=False)) == 4
    assert listing.clamp(None) == 200 and listing.clamp(0) == 1 and listing.clamp(10**9) == 5000
    with pytest.raises(Exception, match="(?i)cast"):
        ids(since="")
    assert "TakeOrderedAndProject" in listing.search(mails, limit=5)._jdf.queryExecution().executedPlan().toString()


def test_list_folders(spark):
    f = spark.createDataFrame([(1, None, "r", "", None, None, True, False), (2, 1, "b", "/b", 1, 0, False, False), (3, 1, None, "/a", 1, 0, False, True)], "nid long, parent_nid long, name string, path string, item_count long, unread_count long, has_subfolders boolean, is_search_folder boolean")
    assert [r["nid"] for r in listing.list_folders(f).collect()] == [1, 3, 2]
    assert [r["nid"] for r in listing.list_folders(f, "A").collect()] == [3]
    assert len(listing.list_folders(f, "").collect()) == 3


def test_tree_with_orphans_and_cycles(spark):
    f = spark.createDataFrame([(1, None, "root"), (2, 1, "a"), (3, 2, None), (4, 99, "lost"), (5, 6, "x"), (6, 5, "y")], "nid long, parent_nid long, name string")
    got = {r["nid"]: (r["level"], r["path"]) for r in hierarchy.tree(f).collect()}
    assert got == {1: (0, ""), 2: (1, "/a"), 3: (2, "/a/folder-3"), 4: (0, ""), 5: (64, "/y/x" * 32), 6: (64, "/x/y" * 32)}


def test_deep_tree_keeps_every_folder(spark):
    f = spark.createDataFrame([(n, n - 1 if n else None, f"f{n}") for n in range(70)], "nid long, parent_nid long, name string")
    got = {r["nid"]: (r["level"], r["path"]) for r in hierarchy.tree(f).collect()}
    assert len(got) == 70 and got[63] == (63, "".join(f"/f{n}" for n in range(1, 64))) and got[69] == (64, "".join(f"/f{n}" for n in range(6, 70)))


def test_special_names(spark):
    df = spark.createDataFrame([(1, "Placeholder_Inbox_Placeholder"), (0, "Placeholder_x_Placeholder"), (0, "Mine"), (0, ""), (None, None), (103, "x")], "c int, n string")
    assert [r[0] for r in one(df.select(hierarchy.special_name(F.col("c"), F.col("n"))))] == ["Inbox", None, "Mine", None, None, "Temporary Items"]


# Recovery


def test_merge_and_ids(spark):
    cols = "rec_id long, sender_address string, sender_name string, internet_message_id string, subject string, preview string, html string, sent_unix long"
    rows = [(2, "x@e", None, None, None, None, "<p>", 1), (1, "x@e", None, None, "s", None, None, 1), (3, None, None, None, "a", None, None, None), (4, None, None, None, "b", None, None, None), (5, "x@e", None, None, "later", None, None, 2)]
    m = recovery.merge_revisions(spark.createDataFrame(rows, cols))
    got = {(r["sender_address"], r["sent_unix"]): (r["subject"], r["html"], r["revisions"]) for r in m.collect()}
    assert got == {("x@e", 1): ("s", "<p>", 2), (None, None): ("a", None, 2), ("x@e", 2): ("later", None, 1)}
    ids = {r["sent_unix"]: r["nid"] for r in recovery.with_ids(m).collect()}
    assert ids == {2: -1_000_000, 1: -1_000_001, None: -1_000_002}
    empty = spark.createDataFrame([], cols)
    assert recovery.with_ids(recovery.merge_revisions(empty)).count() == 0


# Joins


def test_asof_against_brute_force(spark):
    rnd = random.Random(5)
    left = [(i, rnd.choice(["a", "b", None, "hot"]), rnd.choice([None, *range(60)])) for i in range(300)]
    right = [(rnd.choice(["a", "b", None, "hot", "hot"]), rnd.choice([None, *range(60)]), rnd.randrange(1000)) for _ in range(200)]
    ts = lambda x: None if x is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=x)
    l = spark.createDataFrame([(i, k, ts(t)) for i, k, t in left], "id long, k string, t timestamp_ntz")  # noqa: E741
    r = spark.createDataFrame([(k, ts(t), v) for k, t, v in right], "k string, at timestamp_ntz, v long")
    got = dict(one(asof.asof_join(l, r, ["k"], "t", "at", ["v"]).select("id", "v")))
    for i, k, t in left:
        seen = [(b, v) for q, b, v in right if k is not None and q == k and t is not None and b is not None and b <= t]
        assert got[i] == (max(seen)[1] if seen else None), i
    assert len(got) == 300


# Identifiers


def bodies_of(spark, rows):
    m = spark.createDataFrame([(n, us, b, "clash") for n, us, b, _ in rows], "nid long, delivered_us long, batch_id long, internet_message_id string")
    return m, spark.createDataFrame([(n, i) for n, _, _, i in rows], "nid long, internet_message_id string")


def canonical(raw):
    if raw is None:
        return None
    s = raw.strip(" \t\r\n <>[](){}")
    if not s:
        return None
    a, at, b = s.partition("@")
    return a + at + b.lower()


def dropped(rows):
    best, out = {}, []
    for n, us, _, raw in rows:
        i = canonical(raw)
        if i is not None:
            best[i] = min(best.get(i, (1, 0, 0)), (us is None, us or 0, n)) if i in best else (us is None, us or 0, n)
    for n, us, _, raw in rows:
        i = canonical(raw)
        if i is not None and best[i] != (us is None, us or 0, n):
            out.append(n)
    return sorted(out)


def test_further_copies_against_brute_force(spark):
    rnd = random.Random(3)
    ids = ["<a@X.example>", "a@x.example", " [a@X.EXAMPLE] ", "A@x.example", "<>", "", None, "b", "<B>", "hot@x"]
    rows = [(n, rnd.choice([None, *range(20)]), rnd.choice([None, 1, 2, 3, 4, 5, 6, 7]), rnd.choice([*ids, "hot@x", "hot@X", f"u{n}@x"])) for n in range(400)]
    m, b = bodies_of(spark, rows)
    assert sorted(r["nid"] for r in dedup.further_copies(m, b).collect()) == dropped(rows)
    assert dedup.deduplicated(m, b).count() == 400 - len(dropped(rows))


def test_index_takes_batches_one_after_the_other(spark):
    rnd = random.Random(4)
    rows = [(n, rnd.randrange(30), n % 6, f"i{rnd.randrange(60)}@x") for n in range(300)]
    m, b = bodies_of(spark, rows)
    keys = dedup.message_keys(m, b)
    path = scratch_path(spark, "test-ids")
    for batch in range(6):
        # Each batch finds what the ones before have stored: the index is opened anew from its folder.
        index = dedup.IdentifierIndex(spark, path, per_shard=5, chunk=7, merge_every=3, least_bits=1)
        index.ingest(keys.where(F.col("batch_id") == batch))
        assert len(index.state["runs"]) <= 4
    index = dedup.IdentifierIndex(spark, path, per_shard=5, chunk=7)
    assert index.state["runs"][0]["bits"] > 1
    kept = {r["nid"] for r in index.kept().collect()}
    assert sorted(n for n in range(300) if n not in kept) == dropped(rows) and len(index.state["runs"]) == 1


def test_stored_rows_are_sorted_and_cut_by_prefix():
    keys = np.array([bytes((n, n)) + b"k" * 14 for n in (3, 200, 90, 200)], "S16")
    rows = dedup._rows(dedup._best(keys, np.array([5, 4, 1, 2]), np.array([1, 2, 3, 4])), 1, 2)
    assert rows["shard"].tolist() == [0, 1] and rows["n"].tolist() == [2, 1]
    stored = [dedup._unpack(r) for r in rows.itertuples()]
    assert stored[1][2].tolist() == [4]
    batch = dedup._best(keys, np.array([9, 1, 9, 9]), np.array([7, 8, 9, 9]))
    assert dedup._novel(batch, stored[1]).tolist() == [True, True, True] and dedup._novel(batch, stored[0]).tolist() == [False, False, True]


def test_empty_tables(spark):
    m, b = bodies_of(spark, [])
    assert dedup.further_copies(m, b).count() == 0


# SQL


@pytest.fixture(scope="module")
def box(spark, sf):
    return Mailbox.from_parquet(spark, sf)


OK = [
    "with a as (select 1 as x), b as (select * from a) select * from b where exists (select 1 from a)", "select sum(size), upper(max(subject)) from messages",
    "SELECT 1", "  with x as (select 1 as a) select * from x", "(SELECT 1) UNION (SELECT 2)", "select count(*) from messages;", "TABLE folders", "DESCRIBE messages", "SHOW TABLES", "EXPLAIN SELECT 1", "SUMMARIZE messages", "PRAGMA table_info('folders')",
    "select * from ost_attachments(message_nid => 1)", "select nid from messages qualify row_number() over (partition by folder_nid order by nid) = 1", "select nid from messages where nid in (select message_nid from attachments) limit 1",
    "with recursive t(n) as (select 1 union all select n + 1 from t where n < 3) select * from t", "select * from folders f, lateral (select count(*) c from messages m where m.folder_nid = f.nid)", "select x from values (1), (2) t(x)",
]
REFUSED = [
    "SELECT ', other as (' AS x, id FROM other", "SELECT 1 AS x /* with other as ( */ FROM other", "SELECT * FROM (WITH other AS (SELECT 1 AS id) SELECT * FROM other) a, other b", "with a as (select * from b), b as (select 1 as x) select * from a", "select input_file_name() from messages",
    "select current_user()", "select no_such_function(1)",
    "CREATE TABLE t(a int)", "COPY x TO 'y'", "SELECT 1; SELECT 2", "SELECT ';'", "-- c\nSELECT 1", "", "select transform(nid) using 'cat' from messages", "select java_method('java.lang.System', 'getenv', 'HOME')", "select * from parquet.`/tmp/x`",
    "with a as (select 1) insert into folders select * from a", "select * from unknown_table", "select (select reflect('java.lang.Math', 'abs', 1))", "explain select java_method('a', 'b')", "select * from messages where nid in (select nid from csv.`/etc/passwd`)",
    "select * from messages where exists (select 1 from text.`/etc/passwd`)", "select input_file_name() from messages", "from messages", "values (1)", "summarize parquet.`/tmp/x`",
]


@pytest.mark.parametrize("sql", OK)
def test_guard_lets_reading_through(box, sql):
    assert box.sql(sql, 5)["row_count"] >= 0


@pytest.mark.parametrize("sql", REFUSED)
def test_guard_refuses(box, sql):
    with pytest.raises(UnsupportedError):
        box.sql(sql)


def test_windows_of_the_other_dialect(box):
    assert dialect.windows("select 'x groups between' from t") == "select 'x groups between' from t"
    assert dialect.windows("select last_value(a ignore nulls) over (order by b) from t") == "select last_value(a) ignore NULLS over (order by b) from t"
    box.spark.createDataFrame([(1, 1), (2, 1), (3, 5), (4, 9)], "nid long, b int").createOrReplaceTempView("folders")
    try:
        got = box.query("SELECT nid, sum(nid) OVER (ORDER BY b GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS s FROM folders ORDER BY nid")
        assert one(got) == [(1, 3), (2, 3), (3, 6), (4, 7)]
    finally:
        box.register()


def test_guard_text():
    assert guard.check_read_only("select 1 ;; ") == "select 1" and "messages" in RELATIONS
    assert dialect.qualify("select 1") == "select 1" and dialect.special("select 1") is None


def test_bound_parameters_and_limits(box):
    r = box.sql("SELECT nid FROM messages WHERE nid > ? ORDER BY nid", 3, [0])
    assert r["row_count"] == 3 and r["truncated"] and r["columns"] == ["nid"]


def test_json_values(box):
    r = box.sql("SELECT CAST(1 AS DECIMAL(38,0)) * 99999999999999999999 AS big, TIMESTAMP_NTZ'2024-01-02 03:04:05.9' AS t, X'0102' AS b, array(1, 2) AS a, named_struct('k', NULL) AS s, CAST('NaN' AS DOUBLE) AS f, 1.50 AS d")["rows"][0]
    assert r == {"big": "99999999999999999999", "t": "2024-01-02 03:04:05", "b": "<2 bytes>", "a": [1, 2], "s": {"k": None}, "f": "nan", "d": "1.50"}
    json.dumps(r)


def test_tools(box):
    info = box.store_info()
    assert info["folders"] == 18 and len(info["tables"]) == 3
    nid = box.attachments.where("message_nid > 0").select("message_nid").first()[0]
    got = box.get_message(nid, 10)
    assert got["nid"] == nid and len(got["body"] or "") <= 10 and got["attachments"] and "recipients" in got and "display_bcc" not in got
    assert box.list_attachments(nid) == got["attachments"]
    with pytest.raises(NotFoundError):
        box.get_message(-5)
    with pytest.raises(NotFoundError):
        box.list_attachments(-5)
    with pytest.raises(UnsupportedError):
        box.read_attachment(nid, got["attachments"][0]["nid"])
    assert cli.run(cli.parser().parse_args(["x", "--sql", "select 1 as a"]), box) == [{"a": 1}]
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["x", "--info", "--list"])


def test_attachments_pushdown(box, spark):
    plan = box.query("select * from ost_attachments(message_nid => 64000036)")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(message_nid,64000036)" in plan


# Streaming


def test_stream_passes_each_identifier_once(spark, tmp_path):
    from postlake.streaming import tail

    src = tmp_path / "in"
    rows = [(1, "<a@X>", "/f", "s", dt.datetime(2024, 1, 1), 5), (2, "a@x", "/f", "s", dt.datetime(2024, 1, 1), 5), (3, None, "/f", "s", dt.datetime(2024, 1, 1), 5), (4, None, "/g", "s", dt.datetime(2024, 1, 1), 5)]
    spark.createDataFrame(rows, tail.SCHEMA).write.parquet(str(src))
    q = tail.once(tail.incoming(spark, str(src))).writeStream.format("memory").queryName("t_once").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = {r["nid"] for r in spark.sql("select nid from t_once").collect()}
    assert len(got) == 3 and {3, 4} <= got
    q = tail.arrivals(tail.incoming(spark, str(src))).writeStream.outputMode("complete").format("memory").queryName("t_arr").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r["folder_path"], r["n"], r["bytes"]) for r in spark.sql("select * from t_arr").collect()} == {("/f", 3, 15), ("/g", 1, 5)}


# Contract


def test_every_query_agrees_with_its_sql(spark, sf):
    import math

    import duckdb

    from postlake.plans import core_queries

    con = duckdb.connect()
    for t in ("folders", "accounts", "messages", "message_bodies", "recipients", "attachments", "hx_messages", "documents", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    norm = lambda v: repr(round(v, 6)) if isinstance(v, float) and not math.isnan(v) else repr(v)
    for name, run in core_queries.QUERIES.items():
        df = run(spark, sf)
        cols = sorted(df.columns)
        got = sorted([norm(r[c]) for c in cols] for r in df.collect())
        if name in core_queries.ORACLES:
            res = con.execute(core_queries.ORACLES[name])
            at = [[x[0] for x in res.description].index(c) for c in cols]
            assert got == sorted([norm(r[i]) for i in at] for r in res.fetchall()), name


def test_facts_are_joined_back_to_hot_and_cold_rows(spark):
    from postlake.operators.skew import join_facts

    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 20}", i) for i in range(600)] + [(900, None, 1), (901, "lone", 1)], "id long, k string, clash long")
    facts = rows.where("k is not null and k <> 'lone'").groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    for parts in (2, 1000):
        for how in ("inner", "left"):
            got = {r["id"]: r["s"] for r in join_facts(rows, facts, ["k"], parts=parts, how=how).collect()}
            want = {r["id"]: r["s"] for r in rows.join(facts.drop("n"), "k", how).collect()}
            assert got == want
    assert join_facts(rows.limit(0), facts.limit(0), ["k"]).count() == 0
