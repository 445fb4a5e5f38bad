"""Counting and summing per report key.

A *handler* maps the valid records of one log type to *contributions*:
key parts, ``slot_ms`` and the eight measures this record adds (its own
measures 1 or its cost, the others 0).  Because contributions of all log
types share one schema, the whole report is one ``unionByName`` and one
``groupBy``: Spark's partial + final hash aggregate is the reference's
two-phase (per file, then merge) aggregation without the second shuffle,
and hot keys are combined on the map side.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotbook.functions import sql as Q
from slotbook.functions.text import decimal_or_null
from slotbook.operators import dedup, keys
from slotbook.specs import COST_SUM_TYPE, COST_TYPE, KEY_PARTS, MEASURES, REPORT_OUTPUT, LogSpec, ReportConfig

GROUP = KEY_PARTS + ("slot_ms",)

Handler = Callable[[DataFrame, ReportConfig, LogSpec, tuple], DataFrame]
HANDLERS: dict[str, Handler] = {}
# log type -> (handler, keyed): ``keyed`` builds the keys of parsed records, good and bad, keeping the
# columns it is told to, so that whoever counts bad records too need not parse them again
KEYED: dict[str, tuple[Handler, Callable]] = {}
# the measures each log type produces; the first one counts its records
OWN_MEASURES: dict[str, tuple[str, ...]] = {}


def register(log_type: str, measures: tuple[str, ...], keyed: Callable | None = None):
    """Register the handler of a log type and the measures it fills;
    batch, streaming and metrics go by what is registered.  ``keyed(parsed, cfg, spec, keep)``, for a
    handler that makes one contribution of each valid record, gives its keys."""
    def deco(fn: Handler) -> Handler:
        HANDLERS[log_type] = fn
        OWN_MEASURES[log_type] = measures
        KEYED.pop(log_type, None)
        if keyed is not None:
            KEYED[log_type] = (fn, keyed)
        return fn
    return deco


def keyed_of(log_type: str) -> Callable | None:
    """The ``keyed`` function of the handler that is registered now, if it has one."""
    fn, keyed = KEYED.get(log_type, (None, None))
    return keyed if fn is not None and HANDLERS.get(log_type) is fn else None


def _referer_keys(parsed, cfg, spec, keep):
    return keys.expose_keys(parsed, cfg, keep=keep)


ONE = "CAST(1 AS BIGINT)"


def _zero(m: str) -> str:
    return f"CAST(0 AS {COST_TYPE})" if m == "cost" else "CAST(0 AS BIGINT)"


def with_measures(keyed: DataFrame, values: dict[str, str], keep=()) -> DataFrame:
    """P12 in typed form: every measure present, 0 where this type has none.
    ``values`` maps a measure to its SQL expression over ``keyed``."""
    return keyed.selectExpr(*keep, *GROUP,
                            *[f"{values.get(m, _zero(m))} AS {m}" for m in MEASURES])


# Q21: an expose counts as a bid success
@register("expose", ("expose_cnt", "bid_success_cnt", "cost"), _referer_keys)
def expose_contributions(valid, cfg, spec, scope=()):
    k = keys.expose_keys(valid, cfg, keep=scope,
                         extra=[decimal_or_null(valid["cost"]).alias("_cost")])
    return with_measures(k, {"bid_success_cnt": ONE, "expose_cnt": ONE, "cost": "_cost"})


@register("click", ("click_cnt",), _referer_keys)
def click_contributions(valid, cfg, spec, scope=()):
    k = keys.click_keys(valid, cfg, keep=scope)
    return with_measures(k, {"click_cnt": ONE})


@register("bid", ("bid_cnt",), lambda parsed, cfg, spec, keep: keys.bid_keys(parsed, cfg, spec, keep=keep))
def bid_contributions(valid, cfg, spec, scope=()):
    k = keys.bid_keys(valid, cfg, spec, keep=scope)
    return with_measures(k, {"bid_cnt": ONE})


@register("arrive", ("arrive_cnt",), lambda parsed, cfg, spec, keep: keys.arrive_keys(parsed, cfg, keep=keep))
def arrive_contributions(valid, cfg, spec, scope=()):
    """A4: arrival-window test, then one record per (cookie, order id)
    (per file with ``scope``), then count."""
    return with_measures(kept_arrivals(valid, cfg, scope), {"arrive_cnt": ONE})


def kept_arrivals(valid: DataFrame, cfg: ReportConfig, scope=()) -> DataFrame:
    """The arrivals that count: in the window, the first per (cookie, order id)."""
    k = keys.in_arrival_window(keys.arrive_keys(valid, cfg, keep=scope))
    return dedup.first_arrivals(k, scope if cfg.dedup_scope == "file" else ())


def contributions(valid: DataFrame, log_type: str, cfg: ReportConfig,
                  scope: tuple[str, ...] = ()) -> DataFrame:
    return HANDLERS[log_type](valid, cfg, cfg.specs[log_type], scope)


def sum_measures(contrib: DataFrame, group=GROUP) -> DataFrame:
    """One row per key with every measure summed."""
    return contrib.groupBy(*group).agg(*[F.expr(f"sum({m}) AS {m}") for m in MEASURES])


def own_measures(contrib: DataFrame, log_type: str) -> DataFrame:
    """A1-A4: per-type delta, only the measures this type produces."""
    own = OWN_MEASURES[log_type]
    return contrib.groupBy(*GROUP).agg(*[F.expr(f"sum({m}) AS {m}") for m in own])


def finish(agg: DataFrame, cfg: ReportConfig, measures=MEASURES, stored: bool = False) -> DataFrame:
    """The report form: the two slot times as text, counts BIGINT, cost DOUBLE (in
    the store, and for further adding up, a decimal)."""
    n = cfg.slot_minutes
    out = []
    for c in REPORT_OUTPUT:
        if c == "start_time":
            out.append(f"{Q.slot_start_text('slot_ms')} AS {c}")
        elif c == "end_time":
            out.append(f"{Q.slot_end_text('slot_ms', n)} AS {c}")
        elif c in KEY_PARTS:
            out.append(c)
        elif c in measures:
            t = (COST_SUM_TYPE if stored else "double") if c == "cost" else "bigint"
            out.append(f"CAST(coalesce({c}, {_zero(c)}) AS {t}) AS {c}")
    return agg.selectExpr(*out)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
