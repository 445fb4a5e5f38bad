"""Report-key builders of the four log types.

Each builder maps valid records to *keyed records*: the eight key parts
(blank parts already '0', Q5), ``slot_ms`` (local start of the event-time
slot, BIGINT) and ``log_ms``.  They are single projections over the
record; nothing here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotbook.functions import pad_ms
from slotbook.functions import sql as Q
from slotbook.specs import (ARRIVE_WINDOW_MS, KEY_PARTS, LEVEL1_SEPARATOR, LEVEL2_SEPARATOR,
                            LogSpec, ReportConfig)


def log_ms(c: Column) -> Column:
    """Event time in ms: the text padded to 13 digits (Q1: padded once and
    used for the slot, the hour and the arrival test alike)."""
    return pad_ms(c).try_cast("bigint")


def _keyed(df: DataFrame, keep, parts: list[str], ms: str, cfg: ReportConfig,
           extra: list = ()) -> DataFrame:
    """One projection: ``keep`` and ``extra`` (columns), the key parts (blank
    → '0'), ``slot_ms`` and ``log_ms``; ``parts`` and ``ms`` are SQL text."""
    assert len(parts) == len(KEY_PARTS)
    exprs = [f"{Q.blank_to_zero(p)} AS {n}" for p, n in zip(parts, KEY_PARTS)]
    exprs += [f"{Q.slot_start_ms(ms, cfg.slot_minutes, cfg.tz)} AS slot_ms", f"{ms} AS log_ms"]
    return df.select(*keep, *[F.expr(e) for e in exprs], *extra)


def _media(column: str, cfg: ReportConfig) -> str:
    return Q.url_domain(column) if cfg.media == "domain" else column


def expose_keys(valid: DataFrame, cfg: ReportConfig, keep=(), extra=()) -> DataFrame:
    """P6 (and P7 for click): material id := ad id, media := raw referer
    (Q6), ad-position id := represent_pos."""
    c = Q.name
    parts = [c("activity_id"), c("order_id"), c("ad_id"), c("ad_id"), c("size_id"),
             c("area_id"), _media(c("media_url"), cfg), c("represent_pos")]
    return _keyed(valid, keep, parts, Q.log_ms(c("log_time")), cfg, list(extra))


click_keys = expose_keys


def bid_keys(valid: DataFrame, cfg: ReportConfig, spec: LogSpec, keep=(), extra=()) -> DataFrame:
    """Only the first ad of ``bitted_ad_info`` counts (Q8); its parts
    0 ad (= material), 1 order, 2 activity, 5 size; the ad-position id is
    part ``spec.ad_pos_index`` of ``ad_pos_info`` (Q7); media is the domain."""
    c = Q.name
    ad = Q.split_fixed(Q.first_element(c("bitted_ad_info"), LEVEL1_SEPARATOR), LEVEL2_SEPARATOR, 6)
    pos = Q.split_fixed(c("ad_pos_info"), LEVEL2_SEPARATOR, max(5, spec.ad_pos_index + 1))
    parts = [ad[2], ad[1], ad[0], ad[0], ad[5], c("area_id"), Q.url_domain(c("media_url")),
             pos[spec.ad_pos_index]]
    return _keyed(valid, keep, parts, Q.log_ms(c("log_time")), cfg, list(extra))


def arrive_id_parts() -> list[str]:
    """The composite ``id`` (SQL text): time, domain, size, area, slot,
    activity, order, ad."""
    return Q.split_fixed(Q.name("id"), LEVEL1_SEPARATOR, 8)


def arrive_keys(valid: DataFrame, cfg: ReportConfig, keep=(), extra=()) -> DataFrame:
    """Key from the composite id; material := ad := part 7, media :=
    part 1, ad-position id := part 4; slot from the record's own log_time.
    Also carries what the arrival test and de-duplication need."""
    idp = arrive_id_parts()
    parts = [idp[5], idp[6], idp[7], idp[7], idp[2], idp[3], idp[1], idp[4]]
    id_ms = f"CASE WHEN {Q.jtrim(idp[0])} = '' THEN CAST(0 AS BIGINT) ELSE {Q.java_long(idp[0])} END"
    more = [F.expr(e) for e in (
        f"{Q.name('cookie')} AS cookie", f"{idp[6]} AS dedup_order_id", f"{id_ms} AS id_ms",
        f"coalesce({Q.name('check_id')}, '') AS check_id")]
    return _keyed(valid, keep, parts, Q.log_ms(Q.name("log_time")), cfg, more + list(extra))


def in_arrival_window(keyed: DataFrame) -> DataFrame:
    """``log_ms - 5 min <= id time`` (blank id time is 0, Q22); no lower bound."""
    return keyed.where(in_window())


def in_window() -> Column:
    return F.col("log_ms") - F.lit(ARRIVE_WINDOW_MS) <= F.col("id_ms")
