"""The scalar functions as SQL text, for building wide projections cheaply.

Each function here takes SQL expressions (text) and returns SQL text with
the same result as its ``Column`` twin in ``text.py`` / ``time.py``
(``tests/test_functions.py`` checks the pairs on edge rows).  A projection
of a dozen key columns built from ``Column`` functions costs hundreds of
calls into the JVM; the same projection as SQL text is one ``selectExpr``.
That matters in streaming, where every micro-batch builds its plan again.
"""

from __future__ import annotations

from slotbook.functions.text import _JTRIM_CHARS, quote_regex
from slotbook.specs import COST_TYPE

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def literal(s: str) -> str:
    """A SQL string literal holding exactly ``s`` (control characters escaped)."""
    out = []
    for ch in s:
        if ch in "\\'":
            out.append("\\" + ch)
        elif ord(ch) < 0x20 or ord(ch) == 0x7F:
            out.append("\\u%04x" % ord(ch))
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def name(column: str) -> str:
    """A column reference (declared names may hold spaces)."""
    return "`" + column.replace("`", "``") + "`"


_JTRIM = literal(_JTRIM_CHARS)
EMPTY = "''"


def jtrim(x: str) -> str:
    return f"btrim({x}, {_JTRIM})"


def blank_to_zero(x: str) -> str:
    return f"CASE WHEN {jtrim(f'coalesce({x}, {EMPTY})')} = '' THEN '0' ELSE {x} END"


def split_keep(x: str, sep: str) -> str:
    return f"split({x}, {literal(quote_regex(sep))}, -1)"


def part(arr: str, i: int) -> str:
    return f"coalesce(get({arr}, {int(i)}), '')"


def split_fixed(x: str, sep: str, length: int) -> list[str]:
    arr = split_keep(f"coalesce({x}, '')", sep)
    return [part(arr, i) for i in range(length)]


def first_element(x: str, sep: str) -> str:
    return part(split_keep(f"coalesce({x}, '')", sep), 0)


def url_domain(x: str) -> str:
    pos = f"instr({x}, '://')"
    return (f"CASE WHEN {pos} > 0 THEN substring_index(substr({x}, {pos} + 3), '/', 1)"
            f" WHEN {pos} = 0 THEN '' END")


def java_long(x: str) -> str:
    return f"CASE WHEN {x} RLIKE '^[+-]?[0-9]+$' THEN try_cast({x} AS BIGINT) END"


def decimal_or_null(x: str, dtype: str = COST_TYPE) -> str:
    return f"try_cast({jtrim(x)} AS {dtype})"


def decimal_fits(x: str, dtype: str = COST_TYPE) -> str:
    """Whether a numeric text keeps its value as ``dtype`` (no digit rounded off)."""
    return (f"({decimal_or_null(x, 'decimal(38,18)')} = {decimal_or_null(x, dtype)}"
            f" AND NOT {x} RLIKE '[.][0-9]{{18}}[0-9]*[1-9]')")


def pad_ms(x: str) -> str:
    return f"CASE WHEN length({x}) < 13 THEN rpad({x}, 13, '0') ELSE {x} END"


def log_ms(x: str) -> str:
    return f"try_cast({pad_ms(x)} AS BIGINT)"


def local_ms(ms: str, tz: str = "UTC") -> str:
    if tz.upper() in ("UTC", "Z", "GMT", "+00:00"):
        return ms
    ntz = ms_to_ntz(ms)
    return f"timestampdiff(MILLISECOND, {EPOCH_NTZ}, convert_timezone('UTC', {literal(tz)}, {ntz}))"


def slot_start_ms(ms: str, n: int, tz: str = "UTC") -> str:
    loc = local_ms(ms, tz)
    return f"({loc} - pmod({loc}, {int(n) * 60_000}))"


def ms_to_ntz(ms: str) -> str:
    return f"timestampadd(MILLISECOND, {ms}, {EPOCH_NTZ})"


def slot_start_text(slot_ms: str) -> str:
    return f"date_format({ms_to_ntz(slot_ms)}, 'yyyyMMddHHmmss')"


def slot_end_text(slot_ms: str, n: int) -> str:
    return f"date_format({ms_to_ntz(f'({slot_ms} + {int(n) * 60_000 - 1000})')}, 'yyyyMMddHHmmss')"


def hour_label(slot_ms: str) -> str:
    return f"date_format({ms_to_ntz(slot_ms)}, 'yyyyMMddHH')"


def slot_index(slot_ms: str, n: int) -> str:
    return f"CAST(floor(minute({ms_to_ntz(slot_ms)}) / {int(n)}) AS INT)"


def slot_label(slot_ms: str, n: int) -> str:
    return f"concat({hour_label(slot_ms)}, CAST({slot_index(slot_ms, n)} AS STRING))"


def label_to_slot_ms(label: str, n: int) -> str:
    hour = f"CAST(try_to_timestamp(substring({label}, 1, 10), 'yyyyMMddHH') AS TIMESTAMP_NTZ)"
    idx = f"try_cast(substring({label}, 11, 3) AS INT)"
    return f"(timestampdiff(MILLISECOND, {EPOCH_NTZ}, {hour}) + {idx} * {int(n) * 60_000})"
