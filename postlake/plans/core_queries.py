"""The registered queries of the core and their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.functions import scalars
from postlake.operators import asof, dedup, hierarchy, listing, recovery
from postlake.plans.mailbox import Mailbox
from postlake.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name, with the DuckDB text that gives the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_SPACE = r"[\s\x{00a0}\x{200b}\x{feff}<>\[\](){}]+"

P6_SQL = rf"""
WITH bare AS (
  SELECT nid, regexp_replace(regexp_replace(internet_message_id, '^{_SPACE}', ''), '{_SPACE}$', '') AS b FROM message_bodies),
ids AS (
  SELECT nid, CASE WHEN strpos(b, '@') > 0 THEN left(b, strpos(b, '@')) || lower(substr(b, strpos(b, '@') + 1)) ELSE b END AS i
  FROM bare WHERE length(b) > 0),
ranked AS (
  SELECT m.nid, row_number() OVER (PARTITION BY i ORDER BY delivered_us ASC NULLS LAST, m.nid) AS r
  FROM messages m JOIN ids ON ids.nid = m.nid)
SELECT nid FROM ranked WHERE r > 1
"""


@query(P6_SQL)
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return dedup.further_copies(table(spark, d, "messages"), table(spark, d, "message_bodies"))


# Structured queries

_SEARCH = "nid, folder_path, subject, sender_name, sender_email, delivered, size, unread, has_attachments"
_NEWEST = "ORDER BY delivered DESC NULLS LAST, nid"


def _t(spark: SparkSession, d: str, *names: str) -> tuple[DataFrame, ...]:
    return tuple(table(spark, d, n) for n in names)


def _views(spark: SparkSession, d: str) -> Mailbox:
    return Mailbox.from_parquet(spark, d)


def sql_query(name: str, spark_sql: str, duck: str | None = None) -> None:
    """A query whose Spark text goes through the guard, as a caller's would."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return _views(spark, d).query(spark_sql)

    QUERIES[name] = run
    ORACLES[name] = duck or spark_sql


@query("SELECT nid, path, name, item_count, unread_count, is_search_folder FROM folders")
def list_folders(spark: SparkSession, d: str) -> DataFrame:
    return listing.list_folders(table(spark, d, "folders"))


@query("SELECT nid, path, name, item_count, unread_count, is_search_folder FROM folders WHERE path ILIKE '%inbox%'")
def list_folders_contains(spark: SparkSession, d: str) -> DataFrame:
    return listing.list_folders(table(spark, d, "folders"), "inbox")


@query(f"SELECT {_SEARCH} FROM messages WHERE subject ILIKE '%budget%' OR sender_name ILIKE '%budget%' OR sender_email ILIKE '%budget%' {_NEWEST} LIMIT 200")
def search_text(spark: SparkSession, d: str) -> DataFrame:
    return listing.search(table(spark, d, "messages"), text="budget")


@query(f"SELECT {_SEARCH} FROM messages WHERE folder_path ILIKE '%projects%' {_NEWEST} LIMIT 500")
def search_folder(spark: SparkSession, d: str) -> DataFrame:
    return listing.search(table(spark, d, "messages"), limit=500, folder="projects")


@query(f"SELECT {_SEARCH} FROM messages WHERE delivered >= TIMESTAMP '2024-03-01' AND delivered < TIMESTAMP '2024-06-01' {_NEWEST} LIMIT 5000")
def search_date_range(spark: SparkSession, d: str) -> DataFrame:
    return listing.search(table(spark, d, "messages"), limit=9999, since="2024-03-01", until="2024-06-01")


@query(f"SELECT {_SEARCH} FROM messages WHERE has_attachments {_NEWEST} LIMIT 200")
def search_with_attachments(spark: SparkSession, d: str) -> DataFrame:
    return listing.search(table(spark, d, "messages"), with_attachments=True)


@query(f"SELECT {_SEARCH} FROM messages {_NEWEST} LIMIT 20")
def search_topk(spark: SparkSession, d: str) -> DataFrame:
    return listing.search(table(spark, d, "messages"), limit=20)


@query(
    """WITH RECURSIVE walk(nid, parent_nid, level, path) AS (
    SELECT nid, parent_nid, 0, '' FROM folders r WHERE parent_nid IS NULL OR NOT EXISTS (SELECT 1 FROM folders p WHERE p.nid = r.parent_nid)
    UNION ALL SELECT c.nid, c.parent_nid, w.level + 1, w.path || '/' || coalesce(c.name, 'folder-' || c.nid) FROM walk w JOIN folders c ON c.parent_nid = w.nid)
    SELECT nid, parent_nid, level, path FROM walk"""
)
def folder_tree(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.tree(table(spark, d, "folders")).select("nid", "parent_nid", "level", "path")


@query(
    """SELECT f.nid, f.path, coalesce(n, 0) AS items, coalesce(u, 0) AS unread_items FROM folders f LEFT JOIN
    (SELECT folder_nid, count(*) AS n, CAST(sum(CASE WHEN unread THEN 1 ELSE 0 END) AS BIGINT) AS u FROM messages GROUP BY 1) m ON m.folder_nid = f.nid"""
)
def folder_counts(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.counts(*_t(spark, d, "folders", "messages"))


@query("SELECT nid FROM folders f WHERE EXISTS (SELECT 1 FROM folders c WHERE c.parent_nid = f.nid)")
def folders_with_children(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.has_children(table(spark, d, "folders"))


@query("SELECT m.nid, f.path AS swept_path FROM messages m JOIN folders f ON f.nid = m.folder_nid WHERE NOT f.is_search_folder")
def message_sweep(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.sweep(*_t(spark, d, "folders", "messages")).select("nid", "swept_path")


@query("SELECT a.message_nid, a.nid, filename, mime, content_id, declared_size, data_len FROM attachments a WHERE EXISTS (SELECT 1 FROM messages m WHERE m.nid = a.message_nid)")
def attachments_sweep(spark: SparkSession, d: str) -> DataFrame:
    m, a = _t(spark, d, "messages", "attachments")
    return hierarchy.hooked_attachments(m, a).select("message_nid", "nid", "filename", "mime", "content_id", "declared_size", "data_len")


sql_query(
    "attachments_scoped",
    "SELECT a.* FROM (SELECT min(message_nid) AS k FROM attachments WHERE message_nid > 64000000) m, LATERAL (SELECT * FROM ost_attachments(message_nid => m.k)) a",
    "SELECT message_nid, nid, filename, mime, content_id, declared_size, data_len FROM attachments WHERE message_nid = (SELECT min(message_nid) FROM attachments WHERE message_nid > 64000000)",
)


@query("SELECT nid FROM messages m WHERE NOT EXISTS (SELECT 1 FROM attachments a WHERE a.message_nid = m.nid)")
def messages_without_attachments(spark: SparkSession, d: str) -> DataFrame:
    m, a = _t(spark, d, "messages", "attachments")
    return m.select("nid").join(a.select(F.col("message_nid").alias("nid")), "nid", "left_anti")


@query("SELECT nid, path FROM folders f WHERE EXISTS (SELECT 1 FROM messages m WHERE m.folder_nid = f.nid)")
def folders_with_mail(spark: SparkSession, d: str) -> DataFrame:
    f, m = _t(spark, d, "folders", "messages")
    return f.select("nid", "path").join(m.select(F.col("folder_nid").alias("nid")).distinct(), "nid", "left_semi")


# Recovery

_MERGE_DUCK = """SELECT sender_address, sent_unix, arg_min(sender_name, rec_id) FILTER (WHERE sender_name IS NOT NULL) AS sender_name,
  arg_min(internet_message_id, rec_id) FILTER (WHERE internet_message_id IS NOT NULL) AS internet_message_id, arg_min(subject, rec_id) FILTER (WHERE subject IS NOT NULL) AS subject,
  arg_min(preview, rec_id) FILTER (WHERE preview IS NOT NULL) AS preview, arg_min(html, rec_id) FILTER (WHERE html IS NOT NULL) AS html,
  min(rec_id) AS first_rec_id, count(*) AS revisions FROM hx_messages GROUP BY 1, 2"""


@query(_MERGE_DUCK)
def revision_merge(spark: SparkSession, d: str) -> DataFrame:
    return recovery.merge_revisions(table(spark, d, "hx_messages"))


@query(f"SELECT -1000000 - (row_number() OVER (ORDER BY sent_unix DESC NULLS LAST, first_rec_id) - 1) AS nid, CAST(-1 AS BIGINT) AS folder_nid, first_rec_id FROM ({_MERGE_DUCK})")
def recovered_ids(spark: SparkSession, d: str) -> DataFrame:
    return recovery.with_ids(recovery.merge_revisions(table(spark, d, "hx_messages"))).select("nid", "folder_nid", "first_rec_id")


_COVERED = ("sender_address", "sender_name", "internet_message_id", "subject", "preview", "html", "sent_unix")


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, round(avg(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END), 6) AS known FROM hx_messages" for c in _COVERED))
def coverage_profile(spark: SparkSession, d: str) -> DataFrame:
    return recovery.coverage(table(spark, d, "hx_messages"))


@query("SELECT nid FROM folders UNION ALL SELECT -1 WHERE EXISTS (SELECT 1 FROM hx_messages)")
def union_folders_recovered(spark: SparkSession, d: str) -> DataFrame:
    f, h = _t(spark, d, "folders", "hx_messages")
    return recovery.with_recovered_folder(f, h).select("nid")


@query(
    """SELECT m.nid, e.first_subject FROM (SELECT nid, sender_email, delivered FROM messages WHERE sender_email IS NOT NULL AND delivered IS NOT NULL) m
    ASOF LEFT JOIN (SELECT sender_email AS s, delivered AS t, max(subject) AS first_subject FROM messages WHERE has_attachments AND sender_email IS NOT NULL AND delivered IS NOT NULL AND subject IS NOT NULL GROUP BY 1, 2) e
    ON m.sender_email = e.s AND m.delivered >= e.t"""
)
def asof_last_with_attachment(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "messages").where("sender_email IS NOT NULL AND delivered IS NOT NULL")
    right = m.where("has_attachments AND subject IS NOT NULL").select("sender_email", F.col("delivered").alias("t"), F.col("subject").alias("first_subject"))
    return asof.asof_join(m.select("nid", "sender_email", "delivered"), right, ["sender_email"], "delivered", "t", ["first_subject"]).select("nid", "first_subject")


@query("SELECT e.event_id, max(o.ts) AS prev_signup FROM events e LEFT JOIN events o ON o.user_id = e.user_id AND o.event_type = 'signup' AND o.ts <= e.ts GROUP BY 1")
def asof_prev_signup(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    right = e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("at"), F.col("ts").alias("prev_signup"))
    return asof.asof_join(e.select("event_id", "user_id", "ts"), right, ["user_id"], "ts", "at", ["prev_signup"]).select("event_id", "prev_signup")


# Scalars

@query(
    """SELECT nid, coalesce(body_plain, body_html, body_rtf) AS body, CASE WHEN body_plain IS NOT NULL THEN 'plain' WHEN body_html IS NOT NULL THEN 'html' WHEN body_rtf IS NOT NULL THEN 'rtf' END AS body_format,
    concat_ws(',', CASE WHEN body_plain IS NOT NULL THEN 'plain' END, CASE WHEN body_html IS NOT NULL THEN 'html' END, CASE WHEN body_rtf IS NOT NULL THEN 'rtf' END) AS available FROM message_bodies"""
)
def body_choice(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "message_bodies")
    three = (F.col("body_plain"), F.col("body_html"), F.col("body_rtf"))
    return b.select("nid", scalars.best_body(*three).alias("c"), F.array_join(scalars.bodies_available(*three), ",").alias("available")).select("nid", "c.body", "c.body_format", "available")


@query("SELECT doc_id, left(text, 100) AS text, length(text) AS total, length(text) > 100 AS truncated FROM documents")
def body_truncate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", scalars.capped(F.col("text"), 100).alias("c")).select("doc_id", "c.*")


@query(r"SELECT nid, trim(regexp_replace(subject, '(?i)^\s*((re|fw|fwd|aw|tr):\s*)+', ''), ' ') AS bare FROM messages")
def reply_prefix_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").select("nid", scalars.strip_reply_prefix(F.col("subject")).alias("bare"))


@query(r"SELECT message_nid, ordinal, email, coalesce(length(email) <= 254 AND regexp_full_match(email, '[A-Za-z0-9._%+-]+@[A-Za-z0-9@_%+-][A-Za-z0-9@._%+-]*\.[A-Za-z]{2,12}'), false) AS ok FROM recipients")
def email_shape(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "recipients").select("message_nid", "ordinal", "email", scalars.is_email(F.col("email")).alias("ok"))


@query("SELECT message_nid, ordinal, CASE kind WHEN 1 THEN 'to' WHEN 2 THEN 'cc' WHEN 3 THEN 'bcc' ELSE coalesce(CAST(kind AS VARCHAR), 'unknown') END AS label FROM recipients")
def recipient_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "recipients").select("message_nid", "ordinal", scalars.recipient_kind(F.col("kind")).alias("label"))


@query("SELECT nid, strftime(delivered, '%Y-%m-%d %H:%M:%S') AS told FROM messages")
def format_time(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").select("nid", scalars.format_time(F.col("delivered")).alias("told"))


@query("SELECT nid, delivered AS decoded FROM messages")
def filetime_decode(spark: SparkSession, d: str) -> DataFrame:
    ft = F.coalesce(F.col("delivered_us") * 10 + scalars.FILETIME_EPOCH, F.lit(0))
    return table(spark, d, "messages").select("nid", scalars.micros_to_timestamp(scalars.filetime_to_us(ft)).alias("decoded"))


@query("SELECT rec_id, sent_unix AS seconds FROM hx_messages")
def ticks_decode(spark: SparkSession, d: str) -> DataFrame:
    ticks = F.col("sent_unix").cast("decimal(20,0)") * 10_000_000 + scalars.TICKS_EPOCH + 1234
    return table(spark, d, "hx_messages").select("rec_id", scalars.ticks_to_seconds(ticks).alias("seconds"))


@query("SELECT rec_id, subject AS text, CAST(NULL AS VARCHAR) AS base64 FROM hx_messages")
def text_payload(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "hx_messages").select("rec_id", scalars.text_or_base64(F.col("subject").cast("binary")).alias("p")).select("rec_id", "p.*")


@query("SELECT rec_id, base64(encode(chr(0) || subject)) AS base64 FROM hx_messages")
def base64_payload(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "hx_messages").select("rec_id", scalars.text_or_base64(F.concat(F.lit("\x00"), F.col("subject")).cast("binary")).alias("p")).select("rec_id", F.col("p.base64").alias("base64"))


@query("SELECT message_nid, nid, url_decode(filename) AS filename FROM attachments")
def attachment_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "attachments").select("message_nid", "nid", scalars.percent_decoded(F.col("filename")).alias("filename"))


@query("SELECT nid, (delivered_us % 2) = 0 AS unread, coalesce(has_attachments, (delivered_us & 16) <> 0) AS has_attachments FROM messages")
def message_flags(spark: SparkSession, d: str) -> DataFrame:
    flags = F.col("delivered_us")
    return table(spark, d, "messages").select("nid", scalars.is_unread(flags).alias("unread"), scalars.has_attachments(F.col("has_attachments"), flags).alias("has_attachments"))


@query(
    """SELECT column_name, count, CASE WHEN column_type = 'TIMESTAMP' THEN left(min, 19) ELSE min END AS least, CASE WHEN column_type = 'TIMESTAMP' THEN left(max, 19) ELSE max END AS most,
    CASE WHEN column_type IN ('BIGINT') THEN round(CAST(avg AS DOUBLE) / 1e6, 4) END AS mean, CASE WHEN column_type IN ('BIGINT') THEN round(CAST(std AS DOUBLE) / 1e3, 3) END AS spread, CAST(null_percentage AS DOUBLE) AS nulls FROM (SUMMARIZE messages)"""
)
def summarize_messages(spark: SparkSession, d: str) -> DataFrame:
    """Approximate columns (quartiles, distinct values) are left to summarize_estimates."""
    s = _views(spark, d).query("SUMMARIZE messages")
    moment = F.col("column_type").startswith("timestamp")
    short = lambda c: F.when(moment, F.substring(c, 1, 19)).otherwise(F.col(c))
    return s.select(
        "column_name", "count", short("min").alias("least"), short("max").alias("most"), F.round(F.col("avg").cast("double") / 1e6, 4).alias("mean"), F.round(F.col("std").cast("double") / 1e3, 3).alias("spread"), F.col("null_percentage").alias("nulls")
    )


@query(
    """SELECT 'nid' AS column_name, true AS near_distinct, true AS between_quartiles UNION ALL SELECT 'size', true, true"""
)
def summarize_estimates(spark: SparkSession, d: str) -> DataFrame:
    """Whether what SUMMARIZE estimates is near the exact value: distinct values within a tenth, quartiles within a hundredth of the ranks."""
    m = table(spark, d, "messages")
    s = _views(spark, d).query("SUMMARIZE messages").where("column_name IN ('nid', 'size')").select("column_name", "approx_unique", *[F.col(q).cast("double").alias(q) for q in ("q25", "q50", "q75")])
    exact = [m.agg(F.lit(c).alias("c"), F.count_distinct(c).alias("n"), F.percentile(c, F.array(*[F.lit(p) for p in (0.24, 0.26, 0.49, 0.51, 0.74, 0.76)])).alias("p")) for c in ("nid", "size")]
    both = s.join(exact[0].unionByName(exact[1]), F.col("c") == F.col("column_name"))
    inside = lambda q, i: F.col(q).between(F.col("p")[i], F.col("p")[i + 1])
    return both.select("column_name", (F.abs(F.col("approx_unique") - F.col("n")) <= 0.1 * F.col("n")).alias("near_distinct"), (inside("q25", 0) & inside("q50", 2) & inside("q75", 4)).alias("between_quartiles"))


sql_query("approx_distinct", "SELECT abs(approx_count_distinct(sender_email) - count(DISTINCT sender_email)) <= 0.1 * count(DISTINCT sender_email) AS near FROM messages", "SELECT true AS near")
sql_query(
    "groups_frame",
    "SELECT nid, count(*) OVER (PARTITION BY folder_nid ORDER BY batch_id GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM messages WHERE batch_id IS NOT NULL",
    "SELECT nid, count(*) OVER (PARTITION BY folder_nid ORDER BY batch_id GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM messages WHERE batch_id IS NOT NULL",
)
sql_query(
    "ignore_nulls_in_call",
    "SELECT nid, last_value(subject IGNORE NULLS) OVER (PARTITION BY folder_nid ORDER BY nid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_subject FROM messages",
)
sql_query("lateral_counts", "SELECT f.nid, c.n FROM folders f, LATERAL (SELECT count(*) AS n FROM messages m WHERE m.folder_nid = f.nid) c")
sql_query("sample_whole", "SELECT nid FROM messages TABLESAMPLE (100 PERCENT)", "SELECT nid FROM messages USING SAMPLE 100 PERCENT")
sql_query("recursive_levels", "WITH RECURSIVE t(nid, n) AS (SELECT nid, 0 FROM folders WHERE parent_nid IS NULL UNION ALL SELECT f.nid, t.n + 1 FROM folders f JOIN t ON f.parent_nid = t.nid) SELECT nid, n FROM t")


# What a caller's SQL reaches: each of these passes the guard

sql_query("unread_by_folder", "SELECT path, item_count, unread_count FROM folders WHERE unread_count > 0 ORDER BY unread_count DESC, path")
sql_query("top_senders", "SELECT sender_email, count(*) AS n FROM messages WHERE sender_email IS NOT NULL GROUP BY 1 ORDER BY n DESC, sender_email LIMIT 20")
sql_query("messages_by_month", "SELECT year(delivered) AS y, month(delivered) AS m, count(*) AS n FROM messages GROUP BY 1, 2")
sql_query("recent_per_folder", "SELECT nid, folder_nid, delivered FROM messages QUALIFY row_number() OVER (PARTITION BY folder_nid ORDER BY delivered DESC NULLS LAST, nid) <= 3")
sql_query(
    "lag_gap",
    "SELECT nid, timestampdiff(SECOND, lag(delivered) OVER (PARTITION BY folder_nid ORDER BY delivered NULLS LAST, nid), delivered) AS gap FROM messages WHERE delivered IS NOT NULL",
    "SELECT nid, datesub('second', lag(delivered) OVER (PARTITION BY folder_nid ORDER BY delivered NULLS LAST, nid), delivered) AS gap FROM messages WHERE delivered IS NOT NULL",
)
sql_query(
    "running_total",
    "SELECT nid, sum(size) OVER (PARTITION BY folder_nid ORDER BY delivered NULLS LAST, nid ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s FROM messages",
    "SELECT nid, CAST(sum(size) OVER (PARTITION BY folder_nid ORDER BY delivered NULLS LAST, nid ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS s FROM messages",
)
sql_query("rank_family", "SELECT nid, dense_rank() OVER w AS dr, ntile(4) OVER w AS quarter, round(cume_dist() OVER w, 9) AS cd, round(percent_rank() OVER w, 9) AS pr FROM messages WINDOW w AS (PARTITION BY folder_nid ORDER BY size NULLS LAST, nid)")
sql_query("range_frame", "SELECT nid, count(*) OVER (PARTITION BY folder_nid ORDER BY size RANGE BETWEEN 100 PRECEDING AND 100 FOLLOWING) AS near FROM messages WHERE size IS NOT NULL")
sql_query("rollup_folder_class", "SELECT folder_path, message_class, count(*) AS n FROM messages GROUP BY ROLLUP (folder_path, message_class)")
sql_query("cube_class_status", "SELECT message_class, unread, count(*) AS n, CAST(grouping(message_class) AS INTEGER) AS g FROM messages GROUP BY CUBE (message_class, unread)")
sql_query("grouping_sets", "SELECT folder_path, message_class, count(*) AS n FROM messages GROUP BY GROUPING SETS ((folder_path), (message_class), ())")
sql_query("distinct_senders", "SELECT count(DISTINCT sender_email) AS senders, count(DISTINCT lower(trim(sender_email))) AS folded FROM messages")
sql_query(
    "percentile_size",
    "SELECT folder_path, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY size), 6) AS p50, round(percentile_cont(0.9) WITHIN GROUP (ORDER BY size), 6) AS p90, round(median(size), 6) AS med FROM messages GROUP BY folder_path",
    "SELECT folder_path, round(quantile_cont(size, 0.5), 6) AS p50, round(quantile_cont(size, 0.9), 6) AS p90, round(median(size), 6) AS med FROM messages GROUP BY folder_path",
)
sql_query("moments", "SELECT folder_path, round(stddev(size), 4) AS sd, round(var_pop(size), 2) AS vp, bool_or(unread) AS any_unread, min_by(nid, delivered) AS first_nid FROM messages WHERE delivered IS NOT NULL GROUP BY folder_path")
sql_query(
    "string_agg_senders",
    "SELECT folder_path, array_join(array_sort(collect_set(message_class)), ',') AS classes FROM messages GROUP BY folder_path",
    "SELECT folder_path, coalesce(string_agg(DISTINCT message_class, ',' ORDER BY message_class), '') AS classes FROM messages GROUP BY folder_path",
)
sql_query("filtered_aggregates", "SELECT folder_path, count(*) FILTER (WHERE unread) AS unread_n, count(*) FILTER (WHERE has_attachments) AS with_n FROM messages GROUP BY folder_path HAVING count(*) > 10")
sql_query(
    "pivot_status",
    "SELECT * FROM (SELECT folder_path, CASE WHEN unread THEN 'u' WHEN NOT unread THEN 'r' END AS s FROM messages) PIVOT (count(*) FOR s IN ('u' AS unread_n, 'r' AS read_n))",
    "SELECT folder_path, nullif(count(*) FILTER (WHERE unread), 0) AS unread_n, nullif(count(*) FILTER (WHERE NOT unread), 0) AS read_n FROM messages GROUP BY 1",
)
sql_query("intersect_senders", "SELECT lower(trim(sender_email)) AS e FROM messages INTERSECT SELECT lower(trim(email)) AS e FROM recipients")
sql_query("except_senders", "SELECT lower(trim(email)) AS e FROM recipients EXCEPT SELECT lower(trim(sender_email)) AS e FROM messages")
sql_query("intersect_all_classes", "SELECT message_class FROM messages WHERE unread INTERSECT ALL SELECT message_class FROM messages WHERE has_attachments")
sql_query("except_all_classes", "SELECT message_class FROM messages EXCEPT ALL SELECT message_class FROM messages WHERE unread")
sql_query("union_addresses", "SELECT sender_email AS e FROM messages UNION SELECT email AS e FROM recipients")
sql_query("full_join_counts", "SELECT coalesce(a.k, b.k) AS k, a.n AS att, b.n AS rec FROM (SELECT message_nid AS k, count(*) AS n FROM attachments GROUP BY 1) a FULL JOIN (SELECT message_nid AS k, count(*) AS n FROM recipients GROUP BY 1) b ON a.k = b.k")
sql_query("using_join", "SELECT nid, subject, internet_message_id FROM messages JOIN message_bodies USING (nid) WHERE internet_message_id IS NULL")
sql_query("theta_join", "SELECT a.nid AS a, b.nid AS b FROM folders a JOIN folders b ON a.item_count < b.item_count AND a.parent_nid = b.parent_nid")
sql_query("cross_join", "SELECT a.nid AS a, b.nid AS b FROM folders a CROSS JOIN folders b WHERE a.is_search_folder AND NOT b.is_search_folder")
sql_query("not_in", "SELECT nid FROM messages WHERE nid NOT IN (SELECT message_nid FROM recipients)")
sql_query("scalar_subquery", "SELECT nid, (SELECT count(*) FROM recipients r WHERE r.message_nid = m.nid) AS n FROM messages m")
sql_query("null_ordering", "SELECT nid, item_count FROM folders ORDER BY item_count ASC NULLS LAST, nid LIMIT 5")
sql_query("limit_offset", "SELECT nid FROM messages ORDER BY nid LIMIT 50 OFFSET 100")
sql_query("case_between_in", "SELECT nid, CASE WHEN size BETWEEN 0 AND 2000 THEN 'small' WHEN size IS NULL THEN 'unknown' ELSE 'large' END AS band FROM messages WHERE message_class IN ('IPM.Note', 'IPM.Note.SMIME')")
sql_query("string_functions", "SELECT nid, upper(subject) AS u, left(subject, 5) AS l, right(subject, 5) AS r, lpad(left(subject, 3), 6, '*') AS p, replace(subject, ' ', '_') AS rep, split_part(subject, ' ', 1) AS first_word, reverse(subject) AS rev, md5(subject) AS h, concat_ws('|', subject, message_class) AS cw FROM messages")
sql_query("math_functions", "SELECT nid, round(sqrt(size), 6) AS rt, CAST(floor(size / 7.0) AS BIGINT) AS fl, mod(size, 97) AS md, sign(size - 3000) AS sg, greatest(size, 1000) AS gr, size & 255 AS lo, bit_count(size) AS bc FROM messages WHERE size IS NOT NULL", "SELECT nid, round(sqrt(size), 6) AS rt, CAST(floor(size / 7.0) AS BIGINT) AS fl, mod(size, 97) AS md, CAST(sign(size - 3000) AS DOUBLE) AS sg, greatest(size, 1000) AS gr, size & 255 AS lo, CAST(bit_count(size) AS INTEGER) AS bc FROM messages WHERE size IS NOT NULL")
sql_query("date_functions", "SELECT nid, CAST(delivered AS DATE) AS d, last_day(CAST(delivered AS DATE)) AS eom, extract(dayofweek_iso FROM delivered) AS dow, weekofyear(delivered) AS wk, CAST(date_trunc('month', delivered) AS TIMESTAMP_NTZ) AS mo FROM messages", "SELECT nid, CAST(delivered AS DATE) AS d, last_day(CAST(delivered AS DATE)) AS eom, CAST(isodow(delivered) AS INTEGER) AS dow, CAST(week(delivered) AS INTEGER) AS wk, CAST(date_trunc('month', delivered) AS TIMESTAMP) AS mo FROM messages")
sql_query("array_functions", "SELECT nid, size(split(subject, ' ')) AS n, array_join(array_sort(array_distinct(split(subject, ' '))), ' ') AS sorted FROM messages WHERE subject IS NOT NULL", "SELECT nid, CAST(len(string_split(subject, ' ')) AS INTEGER) AS n, array_to_string(list_sort(list_distinct(string_split(subject, ' '))), ' ') AS sorted FROM messages WHERE subject IS NOT NULL")
sql_query("unnest_words", "SELECT nid, w FROM messages LATERAL VIEW explode(split(subject, ' ')) t AS w", "SELECT nid, unnest(string_split(subject, ' ')) AS w FROM messages WHERE subject IS NOT NULL")
sql_query("try_casts", "SELECT nid, try_cast(split_part(subject, ' ', -1) AS BIGINT) AS tail, subject IS DISTINCT FROM message_class AS differs FROM messages", "SELECT nid, try_cast(split_part(subject, ' ', -1) AS BIGINT) AS tail, subject IS DISTINCT FROM message_class AS differs FROM messages")
sql_query("correspondents", "WITH people AS (SELECT lower(trim(email)) AS e, count(*) AS n FROM recipients WHERE kind = 1 GROUP BY 1), senders AS (SELECT lower(trim(sender_email)) AS e, count(*) AS n FROM messages GROUP BY 1) SELECT p.e AS e, p.n AS received, s.n AS sent FROM people p JOIN senders s ON s.e = p.e")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.v') AS v FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.v").alias("v"))


@query(r"SELECT nid, nullif(trim(regexp_extract(body_html, '(?is)<title[^>]*>(.*?)</title>', 1), ' '), '') AS title FROM message_bodies WHERE body_html IS NOT NULL")
def html_title(spark: SparkSession, d: str) -> DataFrame:
    title = F.trim(F.regexp_extract("body_html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    return table(spark, d, "message_bodies").where("body_html IS NOT NULL").select("nid", F.nullif(title, F.lit("")).alias("title"))


@query("SELECT nid, last_value(subject IGNORE NULLS) OVER (PARTITION BY folder_nid ORDER BY delivered NULLS LAST, nid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known FROM messages")
def last_known_subject(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("folder_nid").orderBy(F.col("delivered").asc_nulls_last(), "nid").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, d, "messages").select("nid", F.last("subject", ignorenulls=True).over(w).alias("known"))


@query("SELECT time_bucket(INTERVAL '6 hours', delivered, TIMESTAMP '2024-01-01') AS bucket, count(*) AS n FROM messages WHERE delivered IS NOT NULL GROUP BY 1")
def time_buckets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").where("delivered IS NOT NULL").groupBy(F.window("delivered", "6 hours").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("bucket"), "n")


@query("SELECT source, count(*) AS n, count(html) AS with_html, round(avg(length(preview)), 6) AS mean_chars FROM hx_messages GROUP BY source")
def record_histogram(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "hx_messages").groupBy("source").agg(F.count("*").alias("n"), F.count("html").alias("with_html"), F.round(F.avg(F.char_length("preview")), 6).alias("mean_chars"))


@query("SELECT doc_id, CASE WHEN length(text) > 0 AND length(text) % 2 = 0 AND left(text, length(text) // 2) = right(text, length(text) // 2) THEN left(text, length(text) // 2) ELSE text END AS half FROM (SELECT doc_id, title || title AS text FROM documents UNION ALL SELECT doc_id, title AS text FROM documents)")
def undoubled_titles(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents")
    both = t.select("doc_id", F.concat("title", "title").alias("text")).unionByName(t.select("doc_id", F.col("title").alias("text")))
    return both.select("doc_id", scalars.undouble(F.col("text")).alias("half"))


sql_query("map_struct_json", "SELECT nid, map('a', subject)['a'] AS m, named_struct('k', size).k AS s, get_json_object(to_json(named_struct('k', size)), '$.k') AS j FROM messages", "SELECT nid, map {'a': subject}['a'] AS m, {'k': size}.k AS s, json_extract_string(to_json({'k': size}), '$.k') AS j FROM messages")
sql_query("list_functions", "SELECT nid, element_at(split(subject, ' '), 1) AS first_word, slice(split(subject, ' '), 2, 2) AS middle, array_contains(split(subject, ' '), 'Meeting') AS meets, aggregate(transform(split(subject, ' '), w -> char_length(w)), 0, (a, b) -> a + b) AS letters FROM messages WHERE subject IS NOT NULL AND subject <> ''", "SELECT nid, string_split(subject, ' ')[1] AS first_word, list_slice(string_split(subject, ' '), 2, 3) AS middle, list_contains(string_split(subject, ' '), 'Meeting') AS meets, CAST(list_sum(list_transform(string_split(subject, ' '), lambda w: length(w))) AS INTEGER) AS letters FROM messages WHERE subject IS NOT NULL AND subject <> ''")
sql_query("attachment_types", "SELECT lower(mime) AS mime, count(*) AS n, sum(data_len) AS bytes, max(declared_size) AS largest FROM ost_attachments() GROUP BY 1", "SELECT lower(mime) AS mime, count(*) AS n, CAST(sum(data_len) AS BIGINT) AS bytes, max(declared_size) AS largest FROM attachments GROUP BY 1")
sql_query("topic_sizes", "SELECT conversation_topic, count(*) AS n FROM message_bodies WHERE conversation_topic IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
sql_query("first_value_per_sender", "SELECT DISTINCT sender_email, first_value(nid) OVER (PARTITION BY sender_email ORDER BY delivered NULLS LAST, nid) AS first_nid FROM messages WHERE sender_email IS NOT NULL")
sql_query("null_safe_equality", "SELECT count(*) AS n FROM messages WHERE sender_email IS NOT DISTINCT FROM sender_name")
sql_query("values_join", "SELECT m.nid, v.label FROM messages m JOIN (VALUES ('IPM.Note', 'mail'), ('IPM.Note.SMIME', 'signed')) AS v(c, label) ON v.c = m.message_class")
