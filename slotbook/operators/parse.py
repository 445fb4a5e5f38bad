"""Line parsing and validation.

``parse_lines`` turns a one-column text DataFrame into the declared string
columns; ``valid_records`` and ``rejects`` separate the records that pass the
checks from those that carry a reason.  Everything is one narrow
projection: no shuffle, whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotbook.functions import split_keep
from slotbook.functions import sql as Q
from slotbook.specs import LogSpec

N_FIELDS = "_n_fields"


def parse_lines(lines: DataFrame, spec: LogSpec, keep: tuple[str, ...] | list[str] = (),
                value: str = "value") -> DataFrame:
    """P1 + P2: split each line on the spec's separator keeping trailing empty
    fields, and bind positions to the declared names.  A line shorter than
    the declaration leaves the missing columns null; a longer one is cut.
    ``_n_fields`` holds the actual field count."""
    arr = split_keep(F.col(value), spec.separator)
    # The split is the output of a one-row generator, not a projection: the
    # optimizer pushes the validity filter below projections by inlining
    # their expressions, which would split each line once per field the
    # checks read.  A filter cannot pass a generator's output, so each line
    # is split exactly once.
    staged = lines.select(*keep, F.col(value), F.explode(F.array(arr)).alias("_f"))
    # one SQL expression per declared column: binding 34 columns costs one
    # call into the JVM each, not one per function of a Column expression
    return staged.selectExpr(
        *[quote_name(c) for c in (*keep, value)],
        f"size(_f) AS {N_FIELDS}",
        *[f"get(_f, {i}) AS {quote_name(name)}" for i, name in enumerate(spec.columns)],
    )


quote_name = Q.name


def _length_sql(spec: LogSpec) -> str:
    if not spec.check_length:
        return "true"
    return (f"coalesce({Q.jtrim(Q.name('log_length'))}"
            f" = CAST(least({N_FIELDS}, {spec.width}) AS STRING), false)")


def _missing_sql(spec: LogSpec) -> str:
    need = [c for c in dict.fromkeys(spec.key + spec.required) if c in spec.columns]
    return " OR ".join(f"{Q.name(c)} IS NULL" for c in need) or "false"


def _bad_number_sql(spec: LogSpec) -> str:
    checks = [f"{Q.java_long(Q.name(c))} IS NULL" for c in spec.long_columns if c in spec.columns]
    checks += [f"{Q.decimal_or_null(Q.name(c))} IS NULL"
               for c in spec.decimal_columns if c in spec.columns]
    for c, sep, i in spec.long_parts:
        if c in spec.columns:
            p = Q.part(Q.split_keep(Q.name(c), sep), i)
            checks.append(f"({Q.jtrim(p)} <> '' AND {Q.java_long(p)} IS NULL)")
    return " OR ".join(checks) or "false"


def _inexact_sql(spec: LogSpec) -> str:
    return " OR ".join(f"NOT coalesce({Q.decimal_fits(Q.name(c))}, false)"
                       for c in spec.decimal_columns if c in spec.columns) or "false"


def reject_reason_sql(spec: LogSpec) -> str:
    """'length', 'missing_key', 'bad_number', 'inexact_number' (more decimals than
    the cost type holds) or null for a good record (Q11), as one SQL
    expression over the parsed columns."""
    return (f"CASE WHEN NOT ({_length_sql(spec)}) THEN 'length'"
            f" WHEN {_missing_sql(spec)} THEN 'missing_key'"
            f" WHEN {_bad_number_sql(spec)} THEN 'bad_number'"
            f" WHEN {_inexact_sql(spec)} THEN 'inexact_number' END")


def length_ok(df: DataFrame, spec: LogSpec) -> Column:
    """``trim(log_length)`` as text equals min(declared, actual) count.

    Compared as text, so '023' fails (Q10); a line with extra fields passes
    when it declares the declared count (Q9)."""
    return F.expr(_length_sql(spec))


def reject_reason(df: DataFrame, spec: LogSpec) -> Column:
    """The reason of ``reject_reason_sql`` as a column."""
    return F.expr(reject_reason_sql(spec))


def valid_records(parsed: DataFrame, spec: LogSpec) -> DataFrame:
    """Records that pass every check (the input of the key builders)."""
    return parsed.where(reject_reason(parsed, spec).isNull())


def rejects(parsed: DataFrame, spec: LogSpec, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """The rejected lines with reason and actual field count."""
    r = reject_reason(parsed, spec)
    return parsed.where(r.isNotNull()).select(
        *keep, F.lit(spec.log_type).alias("log_type"), r.alias("reason"),
        F.col(N_FIELDS).alias("n_fields"), F.col("value"))


