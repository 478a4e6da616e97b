"""Scalar functions of the mailbox, as column expressions wherever Spark can say them."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
#: 100 ns steps from 1601 and from year 1 to 1970.
FILETIME_EPOCH, TICKS_EPOCH = 116_444_736_000_000_000, 621_355_968_000_000_000
#: Prefixes that replies and forwards put before a subject.
REPLY_PREFIXES = ("re", "fw", "fwd", "aw", "tr")
_PREFIX_RE = rf"(?i)^\s*((?:{'|'.join(REPLY_PREFIXES)}):\s*)+"


def clean_subject(c: Column) -> Column:
    """A leading U+0001 marks a prefix length in the next character; both are dropped."""
    return F.regexp_replace(c, "(?s)^\x01.?", "")


def micros_to_timestamp(us: Column) -> Column:
    """TIMESTAMP_NTZ of microseconds since 1970."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def filetime_to_us(ft: Column) -> Column:
    """Microseconds since 1970 of a FILETIME; 0 means unset."""
    return F.when(ft != 0, F.floor((ft - F.lit(FILETIME_EPOCH)) / F.lit(10)).cast("long"))


def ticks_to_seconds(ticks: Column) -> Column:
    """Seconds since 1970 of .NET ticks, whole seconds."""
    return F.floor((ticks.cast("decimal(20,0)") - F.lit(TICKS_EPOCH)) / F.lit(10_000_000)).cast("long")


def unix_seconds(c: Column) -> Column:
    """A dynamically typed value (integer, real, text) as whole seconds, towards zero; NULL if it is no number."""
    return F.trim(c.cast("string")).try_cast("double").cast("long")


def format_time(ts: Column) -> Column:
    """YYYY-MM-DD HH:MM:SS; fractions are dropped downwards."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def is_unread(flags: Column) -> Column:
    return flags.bitwiseAND(1) == 0


def has_attachments(own: Column, flags: Column) -> Column:
    """The table's own column, else bit 4 of the flags."""
    return F.coalesce(own, flags.bitwiseAND(0x10) != 0)


def strip_reply_prefix(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _PREFIX_RE, ""))


def undouble(c: Column) -> Column:
    """A text that is twice the same half becomes that half."""
    half = (F.length(c) / 2).cast("int")
    left = F.substring(c, F.lit(1), half)
    return F.when((F.length(c) > 0) & (F.length(c) % 2 == 0) & (F.concat(left, left) == c), left).otherwise(c)


def recipient_kind(kind: Column) -> Column:
    """to, cc, bcc; another code as its number, a missing one as unknown."""
    return F.when(kind == 1, "to").when(kind == 2, "cc").when(kind == 3, "bcc").otherwise(F.coalesce(kind.cast("string"), F.lit("unknown")))


def best_body(plain: Column, html: Column, rtf: Column) -> Column:
    """Struct of body and body_format: plain text before HTML before RTF."""
    named = [(plain, "plain"), (html, "html"), (rtf, "rtf")]
    return F.struct(F.coalesce(plain, html, rtf).alias("body"), F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for c, n in named]).alias("body_format"))


def bodies_available(plain: Column, html: Column, rtf: Column) -> Column:
    return F.array_compact(F.array(*[F.when(c.isNotNull(), F.lit(n)) for c, n in ((plain, "plain"), (html, "html"), (rtf, "rtf"))]))


def capped(text: Column, most: int) -> Column:
    """Struct of text, its whole length and whether it was cut at ``most`` characters."""
    return F.struct(F.substring(text, 1, most).alias("text"), F.char_length(text).alias("total"), (F.char_length(text) > most).alias("truncated"))


def text_or_base64(data: Column) -> Column:
    """Struct of text and base64, one of them NULL: text if the bytes are UTF-8 without a NUL."""
    ok = F.try_validate_utf8(data.cast("string")).isNotNull() & ~F.contains(data.cast("string"), F.lit("\x00"))
    return F.struct(F.when(ok, data.cast("string")).alias("text"), F.when(~ok, F.base64(data)).alias("base64"))


# Shapes of strings

#: The shape of an address: most bytes, letters of the last label, allowed signs.
_MOST_ADDRESS, _ADDRESS_RE = 254, r"^[A-Za-z0-9._%+-]+@(?!\.)[A-Za-z0-9@._%+-]+\.[A-Za-z]{2,12}$"
_ADDRESS = re.compile(_ADDRESS_RE.replace("$", r"\Z"))


def email_shaped(s: str | None) -> bool:
    """Something before the first @ and a domain behind it that does not begin with a dot and ends in a label of letters."""
    return s is not None and len(s) <= _MOST_ADDRESS and bool(_ADDRESS.match(s))


def is_email(c: Column) -> Column:
    """The same rule as :func:`email_shaped`, JVM-side."""
    return F.coalesce((F.length(c) <= _MOST_ADDRESS) & F.regexp_like(c, F.lit(_ADDRESS_RE.replace("$", r"\z"))), F.lit(False))


def is_guid(c: Column) -> Column:
    return F.coalesce(F.regexp_like(c, F.lit(r"(?i)^\{?[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}\}?$")), F.lit(False))


def is_message_id(c: Column) -> Column:
    return F.coalesce(F.regexp_like(c, F.lit(r"^<[^ ]*@[^ ]*>$")), F.lit(False))


def fnv1a_id(data: bytes) -> int:
    """A positive 63-bit surrogate id: FNV-1a over the bytes."""
    h = 0xCBF29CE484222325
    for b in data:
        h = (h ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return h & 0x7FFFFFFFFFFFFFFF


def block_id(c: Column) -> Column:
    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else fnv1a_id(bytes(b)) for b in s], dtype="Int64")

    return run(c)


# One-off entry ids

#: Fixed value: the provider UID of one-off recipients.
ONE_OFF = bytes.fromhex("812B1FA4BEA310199D6E00DD010F5402")


def one_off_address(data: bytes | None) -> tuple[str | None, str | None] | None:
    """(name, address) of a one-off entry id, None for others. The address only if it is SMTP with an @."""
    if data is None or len(data) < 24 or bytes(data[4:20]) != ONE_OFF:
        return None
    wide = int.from_bytes(data[22:24], "little") & 0x8000
    rest, out = bytes(data[24:]), []
    for _ in range(3):
        if wide:
            end = next((i for i in range(0, len(rest) - 1, 2) if rest[i : i + 2] == b"\0\0"), len(rest))
            out.append(rest[:end].decode("utf-16-le", "replace"))
            rest = rest[end + 2 :]
        else:
            head, _, rest = rest.partition(b"\0")
            out.append(head.decode("utf-8", "replace"))
    name, kind, address = out
    return name or None, address if kind.upper() == "SMTP" and "@" in address else None


ONE_OFF_TYPE = T.StructType([T.StructField("name", T.StringType()), T.StructField("email", T.StringType())])


def entry_id(c: Column) -> Column:
    """Struct of name and email from an entry id."""

    @F.pandas_udf(ONE_OFF_TYPE)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one_off_address(b) or (None, None) for b in s], columns=["name", "email"])

    return run(c)


# Text that stands in percent signs

_ESCAPE = re.compile(rb"%([0-9A-Fa-f]{2})")


def percent_decode(s: str) -> str:
    """%XX escapes; others stay, + stays, bytes that are no UTF-8 become replacement signs."""
    return _ESCAPE.sub(lambda m: bytes([int(m.group(1), 16)]), s.encode("utf-8", "surrogatepass")).decode("utf-8", "replace")


def percent_decoded(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else percent_decode(x) if "%" in x else x)

    return run(c)
