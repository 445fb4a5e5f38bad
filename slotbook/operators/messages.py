"""Delta messages: the text hand-off between the per-type stage and the
merge stage (P12-P16, K1, S7).

A message is ``rowKey`` + the 19 report items + its own field count (21),
joined by a separator.  The row key is the eight key parts and the slot
label joined by the key separator; the report's key items are left blank
in the message (the row key carries them) and only the measures of the
sending log type are filled, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotbook.functions import sql as Q
from slotbook.operators import aggregate as A
from slotbook.operators.parse import N_FIELDS, parse_lines
from slotbook.specs import (COST_SUM_TYPE, ESCAPE, FIRST, FIRST_ITEMS, KEY_PARTS, KEY_SEPARATOR, MEASURES, MERGE,
                            MERGE_ITEMS, MESSAGE_SEPARATOR, REPORT_ITEMS, ReportConfig)

# topics of the hand-off: deltas that are added up, and first arrivals that the merge stage compares
DELTA_TOPIC, FIRST_TOPIC = "merge", "first"


# what may not stand inside a key part, and the digit that stands for it after ESCAPE
ESCAPED = {ESCAPE: "0", KEY_SEPARATOR: "1", MESSAGE_SEPARATOR: "2", "\n": "3", "\r": "4"}


def escape_sql(x: str) -> str:
    for c, d in ESCAPED.items():          # the escape character itself first
        x = f"replace({x}, {Q.literal(c)}, {Q.literal(ESCAPE + d)})"
    return x


def unescape_sql(x: str) -> str:
    for c, d in reversed(ESCAPED.items()):
        x = f"replace({x}, {Q.literal(ESCAPE + d)}, {Q.literal(c)})"
    return x


def row_key_sql(cfg: ReportConfig) -> str:
    """Nine values in table order joined by the key separator (SQL text); key
    parts are free text, so what separates them is escaped inside."""
    parts = ", ".join([*map(escape_sql, KEY_PARTS), Q.slot_label("slot_ms", cfg.slot_minutes)])
    return f"concat_ws({Q.literal(KEY_SEPARATOR)}, {parts})"


def row_key(cfg: ReportConfig) -> Column:
    return F.expr(row_key_sql(cfg))


def encode(delta: DataFrame, cfg: ReportConfig, sep: str = MESSAGE_SEPARATOR,
           keep=()) -> DataFrame:
    """P12 + P13: one text message per key of a per-type delta (the output
    of ``aggregate.own_measures``); measures absent from ``delta`` are blank."""
    have = set(delta.columns)
    fields = [row_key_sql(cfg)]
    for item in REPORT_ITEMS:
        if item in MEASURES and item in have:
            fields.append(f"coalesce(CAST({item} AS STRING), '')")
        else:
            fields.append("''")
    fields.append(Q.literal(str(len(MERGE_ITEMS))))
    value = f"concat_ws({Q.literal(sep)}, {', '.join(fields)}) AS value"
    return delta.select(*keep, F.expr(value))


def decode(messages: DataFrame, cfg: ReportConfig, sep: str = MESSAGE_SEPARATOR) -> DataFrame:
    """P14 + P15 + P16: messages → typed delta rows (key parts, ``slot_ms``,
    every measure, blank → null so that sums skip it).  Messages that are not
    one of ours are left out; ``decode_rejects`` has them."""
    out = _place_sql(cfg) + [f"{_measure_sql(m)} AS {m}" for m in MEASURES]
    return _parsed(messages, sep).where(f"{_reason_sql(cfg)} IS NULL").selectExpr(*out)


def decode_rejects(messages: DataFrame, cfg: ReportConfig, sep: str = MESSAGE_SEPARATOR) -> DataFrame:
    """(reason, value) of the messages that ``decode`` leaves out: 'fields' (their number), 'row_key' (its
    parts), 'slot' (its label) or 'measure' (no number)."""
    return (_parsed(messages, sep).selectExpr(f"{_reason_sql(cfg)} AS reason", "value")
            .where("reason IS NOT NULL"))


def encode_first(arrived: DataFrame, cfg: ReportConfig, sep: str = MESSAGE_SEPARATOR) -> DataFrame:
    """One text message per first arrival (the output of ``dedup.first_arrivals``)."""
    fields = [row_key_sql(cfg), escape_sql("cookie"), escape_sql("dedup_order_id"), "CAST(log_ms AS STRING)",
              escape_sql("check_id"), Q.literal(str(len(FIRST_ITEMS)))]
    return arrived.select(F.expr(f"concat_ws({Q.literal(sep)}, {', '.join(fields)}) AS value"))


def decode_first(messages: DataFrame, cfg: ReportConfig, sep: str = MESSAGE_SEPARATOR) -> DataFrame:
    """First arrivals from their messages; ``first_rejects`` has those that cannot be read."""
    out = [f"{unescape_sql('cookie')} AS cookie", f"{unescape_sql('order_id')} AS dedup_order_id",
           "try_cast(log_time AS bigint) AS log_ms", f"{unescape_sql('check_id')} AS check_id", *_place_sql(cfg)]
    return _parsed(messages, sep, FIRST).where(f"{_first_reason_sql(cfg)} IS NULL").selectExpr(*out)


def first_rejects(messages: DataFrame, cfg: ReportConfig, sep: str = MESSAGE_SEPARATOR) -> DataFrame:
    """(reason, value) of the messages that ``decode_first`` leaves out; 'measure' is a time that is no number."""
    return (_parsed(messages, sep, FIRST).selectExpr(f"{_first_reason_sql(cfg)} AS reason", "value")
            .where("reason IS NOT NULL"))


def _parsed(messages: DataFrame, sep: str, spec=MERGE) -> DataFrame:
    p = parse_lines(messages, spec.with_separator(sep))
    return p.selectExpr("*", f"{Q.split_keep(Q.name('rowKey'), KEY_SEPARATOR)} AS _key")


def _place_sql(cfg: ReportConfig) -> list[str]:
    """Key parts and slot from a parsed row key."""
    return [*(f"{unescape_sql(f'get(_key, {i})')} AS {c}" for i, c in enumerate(KEY_PARTS)), f"{_slot_sql(cfg)} AS slot_ms"]


def _slot_sql(cfg: ReportConfig) -> str:
    return Q.label_to_slot_ms(f"get(_key, {len(KEY_PARTS)})", cfg.slot_minutes)


def _measure_sql(m: str) -> str:
    return f"try_cast(nullif({Q.name(m)}, '') AS {COST_SUM_TYPE if m == 'cost' else 'bigint'})"


def _reason_sql(cfg: ReportConfig) -> str:
    return _reason(cfg, len(MERGE_ITEMS), " OR ".join(
        f"({Q.name(m)} <> '' AND {_measure_sql(m)} IS NULL)" for m in MEASURES))


def _first_reason_sql(cfg: ReportConfig) -> str:
    return _reason(cfg, len(FIRST_ITEMS), "try_cast(log_time AS bigint) IS NULL")


def _reason(cfg: ReportConfig, width: int, bad: str) -> str:
    label, slots = f"get(_key, {len(KEY_PARTS)})", 60 // cfg.slot_minutes
    return (f"CASE WHEN {N_FIELDS} <> {width} OR log_length <> '{width}' THEN 'fields'"
            f" WHEN size(_key) <> {len(KEY_PARTS) + 1} THEN 'row_key'"
            f" WHEN NOT {label} RLIKE '^[0-9]{{11,12}}$' OR {_slot_sql(cfg)} IS NULL"
            f" OR CAST(substring({label}, 11, 2) AS INT) >= {slots} THEN 'slot'"
            f" WHEN {bad} THEN 'measure' END")


def merge(decoded: DataFrame) -> DataFrame:
    """A5 over decoded messages of all log types."""
    return A.sum_measures(decoded)


def kafka_records(messages: DataFrame, topic: str = DELTA_TOPIC) -> DataFrame:
    """K1: the Kafka sink's columns; the key is the message itself."""
    v = F.col("value")
    return messages.select(F.encode(v, "UTF-8").alias("key"), F.encode(v, "UTF-8").alias("value"),
                           F.lit(topic).alias("topic"))
