"""First-of-group de-duplication.

The reference keeps an arbitrary record of each (cookie, order id) group
and builds the report key from it.  Here the kept record is the earliest
by ``(log_ms, check_id)`` and, on a full tie, the smallest key — so the
result is deterministic.

It is an aggregate, ``min(struct(order..., payload...))``, not a
``row_number`` window: the aggregate is computed partially on the map
side, so a hot group (one cookie may hold a third of all rows) reaches the
shuffle as one row per map task instead of being collected into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotbook.specs import KEY_PARTS

ORDER = ("log_ms", "check_id")
PAYLOAD = KEY_PARTS + ("slot_ms",)
# what arrivals of one (cookie, order id) are ordered by
FIRST = ORDER + PAYLOAD


def first_per_group(df: DataFrame, group: list[str] | tuple[str, ...],
                    order: tuple[str, ...] = ORDER,
                    payload: tuple[str, ...] = PAYLOAD) -> DataFrame:
    """One row per ``group``: the values of the row with the smallest ``order``."""
    fields = list(dict.fromkeys(list(order) + list(payload)))
    kept = df.groupBy(*group).agg(F.min(F.struct(*fields)).alias("_first"))
    return kept.select(*group, *[F.col(f"_first.{c}").alias(c) for c in fields])


def first_arrivals(keyed: DataFrame, scope_cols: tuple[str, ...] = ()) -> DataFrame:
    """One arrive record per (cookie, order id) — per file too when
    ``scope_cols`` names the file column (T5 ``scope='file'``)."""
    return first_per_group(keyed, list(scope_cols) + ["cookie", "dedup_order_id"])
