"""Event-time slot functions.

Log times are epoch milliseconds carried as text.  A slot is a tumbling
window of ``n`` minutes (``n`` divides 60) aligned to the hour of a named
report zone.  The slot is held as one BIGINT, the local wall-clock
milliseconds of its start, so grouping on it shuffles 8 bytes; the text
forms are only made after aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _epoch() -> Column:
    return F.expr(EPOCH_NTZ)


def pad_ms(c: Column) -> Column:
    """F2's padding: text shorter than 13 characters is right-padded with
    '0' to 13 (seconds become milliseconds); longer text is kept."""
    return F.when(F.length(c) < 13, F.rpad(c, 13, "0")).otherwise(c)


def ms_to_ntz(ms: Column) -> Column:
    """Epoch milliseconds as a UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_add("MILLISECOND", ms, _epoch())


def ntz_to_ms(ts: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", _epoch(), ts)


def local_ms(ms: Column, tz: str = "UTC") -> Column:
    """Wall-clock milliseconds of instant ``ms`` in zone ``tz``."""
    if tz.upper() in ("UTC", "Z", "GMT", "+00:00"):
        return ms
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), ms_to_ntz(ms))
    return ntz_to_ms(local)


def slot_start_ms(ms: Column, n: int, tz: str = "UTC") -> Column:
    """Local wall-clock ms of the start of the ``n``-minute slot."""
    loc = local_ms(ms, tz)
    return loc - F.pmod(loc, F.lit(n * 60_000))


def slot_start_text(slot_ms: Column) -> Column:
    """F5 start: ``yyyyMMddHHmm00``."""
    return F.date_format(ms_to_ntz(slot_ms), "yyyyMMddHHmmss")


def slot_end_text(slot_ms: Column, n: int) -> Column:
    """F5 end: last second of the slot, ``yyyyMMddHHmm59``."""
    return F.date_format(ms_to_ntz(slot_ms + F.lit(n * 60_000 - 1000)), "yyyyMMddHHmmss")


def hour_label(slot_ms: Column) -> Column:
    """``yyyyMMddHH``."""
    return F.date_format(ms_to_ntz(slot_ms), "yyyyMMddHH")


def slot_index(slot_ms: Column, n: int) -> Column:
    """minute of the hour divided by ``n``."""
    return F.floor(F.minute(ms_to_ntz(slot_ms)) / F.lit(n)).cast("int")


def slot_label(slot_ms: Column, n: int) -> Column:
    """hour label followed by the unpadded slot index (``20240101003``)."""
    return F.concat(hour_label(slot_ms), slot_index(slot_ms, n).cast("string"))


def label_to_slot_ms(label: Column, n: int) -> Column:
    """Inverse of F4 for a valid label: the slot start in local ms."""
    hour = F.to_timestamp_ntz(F.substring(label, 1, 10), F.lit("yyyyMMddHH"))
    idx = F.substring(label, 11, 3).try_cast("int")
    return ntz_to_ms(hour) + idx * F.lit(n * 60_000)


def bounds_from_label(label: Column, n: int) -> tuple[Column, Column]:
    """F5 read from a label: (start ``…mm00``, end ``…mm59``)."""
    hour = F.substring(label, 1, 10)
    idx = F.substring(label, 11, 3).try_cast("int")
    start = F.concat(hour, F.lpad((idx * n).cast("string"), 2, "0"), F.lit("00"))
    end = F.concat(hour, F.lpad(((idx + 1) * n - 1).cast("string"), 2, "0"), F.lit("59"))
    return start, end


def format_ts(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """F8: a time stamp as text (week-year pattern fixed to ``yyyy``)."""
    return F.date_format(ts, pattern)
