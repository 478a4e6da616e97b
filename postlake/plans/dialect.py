"""Statements of the other dialect that Spark does not parse, as DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def summarize(df: DataFrame) -> DataFrame:
    """column_name, column_type, min, max, approx_unique, avg, std, q25, q50, q75, count, null_percentage.

    One aggregation over the rows, whatever the number of columns.
    """
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    per = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        num = isinstance(f.dataType, numeric)
        plain = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
        text = lambda e: e.cast("string")
        none = F.lit(None).cast("string")
        q = lambda p: text(F.percentile_approx(c, p)) if num else none  # noqa: B023, E731
        per.append(
            F.struct(
                F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"), (text(F.min(c)) if plain else none).alias("min"), (text(F.max(c)) if plain else none).alias("max"),
                (F.approx_count_distinct(c) if plain else F.lit(None).cast("long")).alias("approx_unique"), (text(F.avg(c)) if num else none).alias("avg"), (text(F.stddev(c)) if num else none).alias("std"),
                q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.75).alias("q75"), F.count("*").alias("count"),
                F.round(100 * F.avg(c.isNull().cast("int")), 2).alias("null_percentage"),
            )
        )
    return df.agg(F.array(*per).alias("a")).select(F.inline("a"))


def table_info(spark: SparkSession, df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString(), not f.nullable, None, False) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "cid int, name string, type string, notnull boolean, dflt_value string, pk boolean")


def special(sql: str) -> tuple[str, str] | None:
    """("summarize" or "table_info", what it is about) for the statements handled here."""
    m = re.fullmatch(r"(?is)\s*summarize\s+(.+)", sql)
    if m:
        rest = m.group(1).strip()
        return ("summarize", rest if re.match(r"(?i)(select|with|table)\b", rest) else f"TABLE {rest}")
    m = re.fullmatch(r"(?is)\s*pragma\s+table_info\s*\(\s*['\"]?(\w+)['\"]?\s*\)", sql) or re.fullmatch(r"(?is)\s*pragma\s+show\s*\(\s*['\"]?(\w+)['\"]?\s*\)", sql)
    if m:
        return "table_info", f"TABLE {m.group(1)}"
    if re.fullmatch(r"(?is)\s*pragma\s+show_tables\s*", sql):
        return "show_tables", ""
    return None


_QUOTED = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`")


def _outside_quotes(sql: str, change) -> str:
    """The text with ``change`` made where it is no literal or quoted name."""
    held: list[str] = []

    def hold(m: re.Match) -> str:
        held.append(m.group())
        return f"\x00{len(held) - 1}\x00"

    return re.sub(r"\x00(\d+)\x00", lambda m: held[int(m.group(1))], change(_QUOTED.sub(hold, sql)))


def windows(sql: str) -> str:
    """IGNORE NULLS inside a call moves behind it; GROUPS frames become RANGE frames over the number of the peer group.

    A query with GROUPS frames is one SELECT over FROM and WHERE, its frames alike in nothing but their bounds or
    not; the numbers are columns of a query below it.
    """

    def change(text: str) -> str:
        text = re.sub(r"(?is)(\w+\s*\([^()]*?)\s+(ignore|respect)\s+nulls\s*\)", r"\1) \2 NULLS", text)
        ranks: list[str] = []

        def frame(m: re.Match) -> str:
            part, order, bounds = m.group(1) or "", m.group(2), m.group(3)
            rank = f"dense_rank() OVER ({part}ORDER BY {order.strip()})"
            if rank not in ranks:
                ranks.append(rank)
            return f"OVER ({part}ORDER BY _group{ranks.index(rank)} RANGE {bounds}"

        text = re.sub(r"(?is)\bover\s*\(\s*(partition\s+by\s+[^()]*?\s+)?order\s+by\s+([^()]*?)\s+groups\s+(between\b|unbounded\b|current\b|\d)", frame, text)
        if not ranks:
            return text
        m = re.fullmatch(r"(?is)(\s*select\s.*?)\sfrom\s(.*?)((?:\sorder\s+by\s(?!.*\sfrom\s).*|\slimit\s.*)?)", text)
        if not m:
            return text
        return f"{m.group(1)} FROM (SELECT *, {', '.join(f'{r} AS _group{i}' for i, r in enumerate(ranks))} FROM {m.group(2)}){m.group(3)}"

    return _outside_quotes(sql, change)


def qualify(sql: str) -> str:
    """A trailing QUALIFY becomes a filter on the select it stands in, its windows named columns."""
    # Words at bracket depth 0, outside quotes.
    depth, quote, at = 0, "", {}
    for m in re.finditer(r"[()'\"`]|\b(?:from|qualify|order\s+by|limit)\b", sql, re.I):
        t = m.group().lower()
        if quote:
            quote = "" if t == quote else quote
        elif t in "'\"`":
            quote = t
        elif t in "()":
            depth += 1 if t == "(" else -1
        elif depth == 0:
            word = t.split()[0]
            if word == "from" or "qualify" in at or word == "qualify":
                at.setdefault(word, m.start())
    start = re.match(r"(?is)\s*select\s", sql)
    if not start or "qualify" not in at or "from" not in at:
        return sql
    stop = min([at[w] for w in ("order", "limit") if w in at], default=len(sql))
    head, items, rest = start.group(), sql[start.end() : at["from"]], " " + sql[at["from"] : at["qualify"]]
    cond, tail = sql[at["qualify"] + len("qualify") : stop].strip(), " " + sql[stop:]
    windows = re.findall(r"(?is)\w+\s*\([^()]*\)\s*over\s*\([^()]*\)", cond)
    names = []
    for i, w in enumerate(windows):
        cond = cond.replace(w, f"_q{i}")
        names.append(f"{w} AS _q{i}")
    extra = ", " + ", ".join(names) if names else ""
    drop = f" EXCEPT ({', '.join(f'_q{i}' for i in range(len(names)))})" if names else ""
    return f"SELECT *{drop} FROM ({head}{items}{extra}{rest}) WHERE {cond}{tail}"
