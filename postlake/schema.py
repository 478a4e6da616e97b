"""The relations of a mailbox. Schemas are fixed, never inferred; NULL is never the empty string."""

from pyspark.sql import types as T

_S, _L, _B, _I, _TS = T.StringType(), T.LongType(), T.BooleanType(), T.IntegerType(), T.TimestampNTZType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in fields])


#: Names, order and types of the columns of each relation.
FOLDERS = _struct(
    ("nid", _L, False), ("parent_nid", _L, True), ("name", _S, True), ("path", _S, False), ("item_count", _L, True),
    ("unread_count", _L, True), ("has_subfolders", _B, False), ("is_search_folder", _B, False),
)

MESSAGES = _struct(
    ("nid", _L, False), ("folder_nid", _L, False), ("folder_path", _S, False), ("subject", _S, True), ("sender_name", _S, True),
    ("sender_email", _S, True), ("delivered", _TS, True), ("submitted", _TS, True), ("modified", _TS, True), ("size", _L, True),
    ("unread", _B, True), ("has_attachments", _B, True), ("message_class", _S, True),
)

ATTACHMENTS = _struct(
    ("message_nid", _L, False), ("nid", _L, False), ("filename", _S, True), ("mime", _S, True), ("content_id", _S, True),
    ("declared_size", _L, True), ("data_len", _L, True),
)

RECIPIENT = _struct(("kind", _I, True), ("name", _S, True), ("email", _S, True))

BODIES = _struct(
    ("nid", _L, False), ("internet_message_id", _S, True), ("conversation_topic", _S, True), ("display_to", _S, True),
    ("display_cc", _S, True), ("body_plain", _S, True), ("body_html", _S, True), ("body_rtf", _S, True),
)

HX_RECORDS = _struct(
    ("block_offset", _L, False), ("anchor", _L, False), ("sender_address", _S, True), ("sender_name", _S, True), ("internet_message_id", _S, True),
    ("subject", _S, True), ("preview", _S, True), ("html", _S, True), ("sent_unix", _L, True),
)

#: Ids of the recovered folder and of the newest recovered message; the others count down from it.
RECOVERED_FOLDER = -1
RECOVERED_BASE = -1_000_000

#: What store_info tells of the relations.
TABLES = (
    "folders(nid, parent_nid, name, path, item_count, unread_count, has_subfolders, is_search_folder)",
    "messages(nid, folder_nid, folder_path, subject, sender_name, sender_email, delivered, submitted, modified, size, unread, has_attachments, message_class)",
    "ost_attachments(message_nid => <nid>) -> (message_nid, nid, filename, mime, content_id, declared_size, data_len)",
)
