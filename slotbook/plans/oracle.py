"""DuckDB SQL oracles for the registered queries.

Each oracle re-derives its answer in plain SQL from the ``events`` view
through the shared line fixture, independently of the Spark code: its own
string splitting, checks, key building, de-duplication (a window here) and
aggregation.  DuckDB-specific notes: lists are 1-based, ``string_split``
keeps trailing empty fields, sums of BIGINT are HUGEINT (cast back).
"""

from __future__ import annotations

from slotbook.sources.fixture import duckdb_lines_sql
from slotbook.specs import (ARRIVE, BID, CLICK, EXPOSE, KEY_PARTS, LOG_TYPES, MEASURES,
                            REPORT_OUTPUT)

N = 15
SLOT_MS = N * 60_000
SPECS = {"expose": EXPOSE, "click": CLICK, "bid": BID, "arrive": ARRIVE}
OWN = {"bid": ("bid_cnt",), "expose": ("bid_success_cnt", "expose_cnt", "cost"),
       "click": ("click_cnt",), "arrive": ("arrive_cnt",)}


def jtrim(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def nz(x: str) -> str:
    return f"CASE WHEN {jtrim(f'coalesce({x}, {chr(39)}{chr(39)})')} = '' THEN '0' ELSE {x} END"


def fld(t: str, name: str) -> str:
    return f"f[{SPECS[t].columns.index(name) + 1}]"


def part(x: str, sep: int, i: int) -> str:
    return f"coalesce(string_split(coalesce({x}, ''), chr({sep}))[{i + 1}], '')"


def is_long(x: str) -> str:
    return f"(regexp_full_match({x}, '[+-]?[0-9]+') AND TRY_CAST({x} AS BIGINT) IS NOT NULL)"


def log_ms(x: str) -> str:
    return f"CAST(CASE WHEN length({x}) < 13 THEN rpad({x}, 13, '0') ELSE {x} END AS BIGINT)"


def fmt(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y%m%d%H%M%S')"


def parsed(t: str, extra: str = "") -> str:
    """Lines of type t with their field list."""
    return (f"SELECT *, string_split(value, chr(2)) AS f, len(string_split(value, chr(2))) AS n"
            f" FROM lines WHERE log_type = '{t}' {extra}")


def reason(t: str) -> str:
    s = SPECS[t]
    w = s.width
    length = f"coalesce({jtrim('f[1]')} = CAST(least(n, {w}) AS VARCHAR), false)"
    need = list(dict.fromkeys(s.key + s.required))
    missing = " OR ".join(f"{fld(t, c)} IS NULL" for c in need)
    bad = [f"NOT {is_long(fld(t, 'log_time'))}"]
    if t == "expose":
        bad.append(f"TRY_CAST({jtrim(fld(t, 'cost'))} AS DECIMAL(28,8)) IS NULL")
    if t == "arrive":
        p = part(fld(t, "id"), 3, 0)
        bad.append(f"({jtrim(p)} <> '' AND NOT {is_long(p)})")
    fine = (f" WHEN regexp_matches({fld(t, 'cost')}, '[.][0-9]{{8}}[0-9]*[1-9]') THEN 'inexact_number'"
            if t == "expose" else "")
    return (f"CASE WHEN NOT {length} THEN 'length' WHEN {missing} THEN 'missing_key'"
            f" WHEN {' OR '.join(bad)} THEN 'bad_number'{fine} END")


def checked(t: str) -> str:
    """Lines of type t with their field list and reject reason."""
    return f"SELECT *, {reason(t)} AS reason FROM ({parsed(t)})"


def label(ms: str) -> str:
    return (f"strftime(make_timestamp(({ms}) * 1000), '%Y%m%d%H') || "
            f"CAST(CAST(floor(minute(make_timestamp(({ms}) * 1000)) / {N}) AS INTEGER) AS VARCHAR)")


def keyed(t: str, extra_cols: str = "") -> str:
    """Valid records of type t with the eight key parts and slot."""
    if t in ("expose", "click"):
        parts = [fld(t, "activity_id"), fld(t, "order_id"), fld(t, "ad_id"), fld(t, "ad_id"),
                 fld(t, "size_id"), fld(t, "area_id"), fld(t, "media_url"), fld(t, "represent_pos")]
    elif t == "bid":
        ad = f"string_split({fld(t, 'bitted_ad_info')}, chr(3))[1]"
        pos = fld(t, "ad_pos_info")
        parts = [part(ad, 4, 2), part(ad, 4, 1), part(ad, 4, 0), part(ad, 4, 0), part(ad, 4, 5),
                 fld(t, "area_id"), f"regexp_extract({fld(t, 'media_url')}, '://([^/]*)', 1)",
                 part(pos, 4, 1)]
    else:
        i = fld(t, "id")
        parts = [part(i, 3, 5), part(i, 3, 6), part(i, 3, 7), part(i, 3, 7), part(i, 3, 2),
                 part(i, 3, 3), part(i, 3, 1), part(i, 3, 4)]
    cols = ", ".join(f"{nz(p)} AS {k}" for p, k in zip(parts, KEY_PARTS))
    ms = log_ms(fld(t, "log_time"))
    more = ""
    if t == "expose":
        more = f", CAST({jtrim(fld(t, 'cost'))} AS DECIMAL(28,8)) AS cost_v"
    if t == "arrive":
        p0 = part(fld(t, "id"), 3, 0)
        more = (f", {fld(t, 'cookie')} AS cookie, {part(fld(t, 'id'), 3, 6)} AS oid,"
                f" CASE WHEN {jtrim(p0)} = '' THEN 0 ELSE TRY_CAST({p0} AS BIGINT) END AS id_ms,"
                f" coalesce({fld(t, 'check_id')}, '') AS check_id")
    return (f"SELECT {cols}, {ms} AS log_ms, {ms} - ({ms} % {SLOT_MS}) AS slot_ms{more}"
            f"{extra_cols} FROM ({parsed(t)}) WHERE ({reason(t)}) IS NULL")


def arrive_kept(scope: str = "all") -> str:
    part_by = "cookie, oid" + {"all": "", "file": ", file_no",
                               "file_early": ", file_no, early",
                               "early": ", early"}[scope]
    order = "log_ms, check_id, " + ", ".join(KEY_PARTS) + ", slot_ms"
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {part_by} ORDER BY {order})"
            f" AS rn FROM ({keyed('arrive', ', file_no, early')}) WHERE log_ms - 300000 <= id_ms) WHERE rn = 1")


def contributions(t: str, scope: str = "all", half: str = "") -> str:
    """Contributions of type t; ``half`` (a condition on ``early``) takes some of the lines."""
    vals = {m: ("CAST(0 AS DECIMAL(28,8))" if m == "cost" else "CAST(0 AS BIGINT)") for m in MEASURES}
    src = arrive_kept(scope) if t == "arrive" else keyed(t, ", early")
    for m in OWN[t]:
        vals[m] = "cost_v" if m == "cost" else "CAST(1 AS BIGINT)"
    ms = ", ".join(f"{v} AS {m}" for m, v in vals.items())
    return f"SELECT {', '.join(KEY_PARTS)}, slot_ms, {ms} FROM ({src})" + (f" WHERE {half}" if half else "")


def finish(src: str, measures=MEASURES) -> str:
    cols = []
    for c in REPORT_OUTPUT:
        if c == "start_time":
            cols.append(f"{fmt('slot_ms')} AS start_time")
        elif c == "end_time":
            cols.append(f"{fmt(f'slot_ms + {SLOT_MS - 1000}')} AS end_time")
        elif c in KEY_PARTS:
            cols.append(c)
        elif c in measures:
            t = "DOUBLE" if c == "cost" else "BIGINT"
            cols.append(f"CAST(coalesce(SUM({c}), 0) AS {t}) AS {c}")
    return f"SELECT {', '.join(cols)} FROM ({src}) GROUP BY {', '.join(KEY_PARTS)}, slot_ms"


def with_lines(body: str, variant: str | None = None) -> str:
    return f"WITH lines AS ({duckdb_lines_sql(variant)}) {body}"


def report_sql(scope: str = "all", where: str = "") -> str:
    union = " UNION ALL ".join(contributions(t, scope) for t in LOG_TYPES)
    return finish(union)


def type_delta_sql(t: str, scope: str = "all") -> str:
    return finish(contributions(t, scope), measures=OWN[t])
