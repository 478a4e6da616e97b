"""The registered queries of this subpackage and their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlake.llm import conversations, markup, mixing, names, packing, pii, quoted, splitting, truncation
from postlake.plans import core_queries
from postlake.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def budget(spark: SparkSession, d: str, name: str) -> tuple[int, int]:
    """Capacity and overlap of a named row of token_budgets, a hand-written table."""
    r = table(spark, d, "token_budgets").where(f"budget = '{name}'").first()
    return r["capacity_tokens"], r["overlap_tokens"]


_PRE = r"(?i)^[\s\x{00a0}]*(?:(?:" + "|".join(conversations.PREFIXES) + r")[\s\x{00a0}]*(?:\[\d+\]|\(\d+\))?[\s\x{00a0}]*[:：][\s\x{00a0}]*)+"
_GAP = r"[\s\x{00a0}\x{200b}\x{feff}]+"

P3_SQL = rf"""
WITH said AS (
  SELECT m.nid, delivered_us, sender_email, subject, trim(internet_message_id) AS id0,
         CASE WHEN length(regexp_replace(conversation_topic, '{_GAP}', '', 'g')) > 0
              THEN lower(regexp_replace(regexp_replace(conversation_topic, '{_PRE}', ''), '{_GAP}', '', 'g')) END AS topic
  FROM messages m JOIN message_bodies b ON b.nid = m.nid
  WHERE length(regexp_replace(body_plain, '{_GAP}', '', 'g')) > 0
    AND m.nid NOT IN ({core_queries.P6_SQL})),
told AS (
  SELECT *, EXISTS (SELECT 1 FROM accounts a WHERE lower(trim(a.address)) = lower(trim(sender_email))) AS own,
         row_number() OVER (PARTITION BY topic ORDER BY delivered_us, nid) AS turn
  FROM said WHERE topic IS NOT NULL),
kept AS (
  SELECT topic, min(nid) AS conv_nid FROM told GROUP BY topic
  HAVING bool_and(sender_email IS NOT NULL AND length(regexp_replace(sender_email, '{_GAP}', '', 'g')) > 0 AND delivered_us IS NOT NULL)
     AND bool_or(own) AND bool_or(NOT own)
     AND NOT bool_or(turn = 1 AND coalesce(regexp_matches(subject, '{_PRE}'), false)))
SELECT conv_nid, CAST(turn AS INTEGER) AS turn, nid FROM told JOIN kept ON kept.topic = told.topic
"""


@query()
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return quoted.inherited_lines(table(spark, d, "messages"), table(spark, d, "message_bodies"))


@query()
def p1_text(spark: SparkSession, d: str) -> DataFrame:
    return quoted.own_text(table(spark, d, "messages"), table(spark, d, "message_bodies"))


def _people(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    return tuple(table(spark, d, t) for t in ("messages", "message_bodies", "recipients", "name_forms"))


@query()
def p1_evidence(spark: SparkSession, d: str) -> DataFrame:
    return quoted.evidence(table(spark, d, "messages"), table(spark, d, "message_bodies"))


@query()
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.found(*_people(spark, d))


@query()
def p2_text(spark: SparkSession, d: str) -> DataFrame:
    return pii.masked(*_people(spark, d))


@query(P3_SQL)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return conversations.conversations(table(spark, d, "messages"), table(spark, d, "message_bodies"), table(spark, d, "accounts")).select("conv_nid", "turn", "nid")


def _named(spark: SparkSession, d: str) -> DataFrame:
    return names.entities(table(spark, d, "messages"), table(spark, d, "recipients"), table(spark, d, "name_forms"))


@query()
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return names.pairs(_named(spark, d))


@query()
def p4_entities(spark: SparkSession, d: str) -> DataFrame:
    return _named(spark, d)


@query()
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_values(table(spark, d, "hx_messages"))


@query()
def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_report(table(spark, d, "hx_messages"))


@query()
def p5_evidence(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_evidence(table(spark, d, "hx_messages"))


@query()
def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), budget(spark, d, "pack-large")[0])


@query()
def p8_pack_small(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), budget(spark, d, "pack-small")[0])


@query()
def p8_pack_dot(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), budget(spark, d, "pack-large")[0], mode="dot")


@query()
def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    size = budget(spark, d, "pack-large")[0]
    return packing.fill_report(packing.pack(table(spark, d, "documents"), size), size)


@query()
def p9_select(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


@query()
def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


@query()
def p10_split(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split(table(spark, d, "documents"), *budget(spark, d, "split-small"))


@query()
def p10_split_large(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split(table(spark, d, "documents"), *budget(spark, d, "split-large"))


@query()
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.elements(table(spark, d, "message_bodies"))


@query()
def p7_text(spark: SparkSession, d: str) -> DataFrame:
    return markup.texts(table(spark, d, "message_bodies"))
