"""The report job: lines of the four log types → one report (§3.4).

``lines → parse → valid → handler → contributions → union → groupBy → report``.
The same functions run on a batch DataFrame and inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotbook.operators import aggregate as A
from slotbook.operators.parse import parse_lines, rejects, valid_records
from slotbook.specs import ReportConfig


def typed_lines(lines: DataFrame | dict[str, DataFrame], log_type: str) -> DataFrame:
    """Lines of one type: either a dict of per-type sources or one
    DataFrame with a ``log_type`` column."""
    if isinstance(lines, dict):
        return lines[log_type]
    return lines.where(F.col("log_type") == log_type)


def valid_of(lines, log_type: str, cfg: ReportConfig, keep=()) -> DataFrame:
    spec = cfg.specs[log_type]
    return valid_records(parse_lines(typed_lines(lines, log_type), spec, keep=keep), spec)


def rejects_of(lines, log_type: str, cfg: ReportConfig, keep=()) -> DataFrame:
    spec = cfg.specs[log_type]
    return rejects(parse_lines(typed_lines(lines, log_type), spec, keep=keep), spec, keep)


def contributions_of(lines, log_type: str, cfg: ReportConfig, scope=()) -> DataFrame:
    return A.contributions(valid_of(lines, log_type, cfg, keep=scope), log_type, cfg, scope)


def unknown_lines(lines: DataFrame, cfg: ReportConfig, keep=()) -> DataFrame:
    """Lines whose log type is not declared, in the rejects' form."""
    known = F.col("log_type").isin(*cfg.log_types)
    return lines.where(~F.coalesce(known, F.lit(False))).select(
        *keep, F.col("log_type"), F.lit("unknown_type").alias("reason"),
        F.lit(None).cast("int").alias("n_fields"), F.col("value"))


def all_rejects(lines: DataFrame, cfg: ReportConfig, keep=()) -> DataFrame:
    """Every line that no record is made of, with its reason."""
    return A.union_all([rejects_of(lines, t, cfg, keep) for t in cfg.log_types]
                       + [unknown_lines(lines, cfg, keep)])


def all_contributions(lines, cfg: ReportConfig, scope=(), types=None) -> DataFrame:
    present = [t for t in types or cfg.log_types if not isinstance(lines, dict) or t in lines]
    return A.union_all([contributions_of(lines, t, cfg, scope) for t in present])


def report_rows(lines, cfg: ReportConfig = ReportConfig(), scope=(), types=None) -> DataFrame:
    """A5 + A6 + U1: the report of a set of lines, aggregated with one shuffle
    (arrive de-duplication adds its own, on (cookie, order id))."""
    return A.sum_measures(all_contributions(lines, cfg, scope, types))


def report(lines, cfg: ReportConfig = ReportConfig(), scope=(), stored: bool = False) -> DataFrame:
    return A.finish(report_rows(lines, cfg, scope), cfg, stored=stored)


def type_delta(lines, log_type: str, cfg: ReportConfig = ReportConfig(), scope=()) -> DataFrame:
    """A1-A4: the per-type delta with only that type's measures."""
    agg = A.own_measures(contributions_of(lines, log_type, cfg, scope), log_type)
    return A.finish(agg, cfg, measures=A.OWN_MEASURES[log_type])
