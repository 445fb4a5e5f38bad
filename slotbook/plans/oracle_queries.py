"""Oracle SQL per registered query (keys equal ``slotbook.plans.queries``)."""

from __future__ import annotations

from slotbook.plans import oracle as O
from slotbook.specs import EXPOSE, KEY_PARTS, LOG_TYPES, MEASURES, REPORT_ITEMS, SPECS

ORACLES: dict[str, str] = {}
W = O.with_lines
FILE_NAME = "CAST(file_no AS VARCHAR) || '.log'"
REPORT = O.report_sql()
REPORT_FILE = O.report_sql("file")

# ---- parse
ORACLES["scan_log_lines"] = W(f"SELECT log_type, {FILE_NAME} AS file_name, value FROM lines")
ORACLES["kafka_lines"] = W("SELECT log_type, value FROM lines")
ORACLES["parse_expose"] = W(
    "SELECT CAST(n AS INTEGER) AS n_fields, "
    + ", ".join(f'f[{i + 1}] AS "{c}"' for i, c in enumerate(EXPOSE.columns))
    + f" FROM ({O.parsed('expose')})")
ORACLES["parse_all"] = W(" UNION ALL ".join(
    f"SELECT '{t}' AS log_type, CAST(n AS INTEGER) AS n_fields, concat_ws('|', "
    + ", ".join(f"'{i}=' || f[{i + 1}]" for i in range(SPECS[t].width)) + f") AS fields FROM ({O.parsed(t)})"
    for t in LOG_TYPES))
ORACLES["valid_logs"] = W(" UNION ALL ".join(
    f"SELECT '{t}' AS log_type, value FROM ({O.checked(t)}) WHERE reason IS NULL" for t in LOG_TYPES))
_rejected = " UNION ALL ".join(
    f"SELECT '{t}' AS log_type, reason, CAST(n AS INTEGER) AS n_fields, value"
    f" FROM ({O.checked(t)}) WHERE reason IS NOT NULL" for t in LOG_TYPES)
ORACLES["rejected_logs"] = W(_rejected)
_ad = f"string_split({O.fld('bid', 'bitted_ad_info')}, chr(3))[1]"
ORACLES["split_fixed"] = W(" UNION ALL ".join(
    f"SELECT '{name}' AS field, {O.fld(t, ident)} AS record, "
    + ", ".join((O.part(text, sep, i) if i < n else "''") + f" AS p{i}" for i in range(8))
    + f" FROM ({O.parsed(t)})" for t, name, text, sep, n, ident in (
        ("arrive", "id", O.fld("arrive", "id"), 3, 8, "check_id"),
        ("bid", "bitted_ad_info", _ad, 4, 6, "bit_id"),
        ("bid", "ad_pos_info", O.fld("bid", "ad_pos_info"), 4, 5, "bit_id"))))
ORACLES["spec_catalog"] = W(" UNION ALL ".join(
    f"SELECT '{t}' AS log_type, {SPECS[t].width} AS n_columns, '{','.join(SPECS[t].key)}' AS key_columns,"
    f" count(*) AS n_lines, count(*) FILTER (WHERE n = {SPECS[t].width}) AS n_full_width"
    f" FROM ({O.parsed(t)})" for t in LOG_TYPES))

# ---- scalars
ORACLES["url_domain"] = "SELECT page_id, regexp_extract(url, '://([^/]*)', 1) AS domain FROM pages"
RECORD_ID = {"bid": "bit_id", "expose": "expose_id", "click": "expose_id", "arrive": "check_id"}


def _time_slot(t: str) -> str:
    x = O.fld(t, "log_time")
    a, b = (f"({m} - ({m} % {O.SLOT_MS}))" for m in (O.log_ms(x), O.log_ms(f"substr({x}, 1, 10)")))
    return (f"SELECT '{t}' AS log_type, {O.fld(t, RECORD_ID[t])} AS record,"
            f" strftime(make_timestamp({a} * 1000), '%Y%m%d%H') AS hour_label,"
            f" CAST(floor(minute(make_timestamp({a} * 1000)) / {O.N}) AS INTEGER) AS slot_index,"
            f" {O.label(a)} AS slot_label, {O.label(b)} AS slot_label_sec"
            f" FROM ({O.checked(t)}) WHERE reason IS NULL")


ORACLES["time_slot"] = W(" UNION ALL ".join(map(_time_slot, RECORD_ID)))
_all = " UNION ALL ".join(O.contributions(t) for t in LOG_TYPES)
ORACLES["slot_bounds"] = W(
    f"SELECT {O.label('slot_ms')} AS slot_label, {O.fmt('slot_ms')} AS start_time,"
    f" {O.fmt(f'slot_ms + {O.SLOT_MS - 1000}')} AS end_time, count(*) AS n_records"
    f" FROM ({_all}) GROUP BY slot_ms")
ORACLES["blank_keys"] = W(
    "SELECT log_type, field, raw, " + O.nz("raw") + " AS part, count(*) AS n FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS log_type, '{c}' AS field, {O.fld(t, c)} AS raw FROM ({O.checked(t)})"
                         f" WHERE reason IS NULL" for t in LOG_TYPES for c in SPECS[t].key if c != "log_time")
    + ") GROUP BY log_type, field, raw")

# ---- keys
_parts = ", ".join(KEY_PARTS)
_times = f"{O.fmt('slot_ms')} AS start_time, {O.fmt(f'slot_ms + {O.SLOT_MS - 1000}')} AS end_time"
for _t, _id in (("expose", "expose_id"), ("click", "expose_id"), ("bid", "bit_id")):
    ORACLES[f"keys_{_t}"] = W(
        f"SELECT {_id}, {_parts}, {_times} FROM ({O.keyed(_t, f', {O.fld(_t, _id)} AS {_id}')})")
ORACLES["keys_arrive"] = W(
    f"SELECT check_id, {_parts}, {_times}, log_ms, id_ms FROM ({O.keyed('arrive')})")
ORACLES["arrive_in_window"] = W(
    f"SELECT check_id, log_ms, id_ms FROM ({O.keyed('arrive')}) WHERE log_ms - 300000 <= id_ms")
ORACLES["arrive_first"] = W(
    f"SELECT cookie, oid AS order_key, check_id, log_ms, {_parts}, {O.fmt('slot_ms')} AS start_time"
    f" FROM ({O.arrive_kept('all')})")
ORACLES["arrive_first_per_file"] = W(
    f"SELECT {FILE_NAME} AS file_name, cookie, oid AS order_key, check_id, log_ms, {_parts},"
    f" {O.fmt('slot_ms')} AS start_time FROM ({O.arrive_kept('file')})")

# ---- aggregates
for _name in ("report_batch", "merge_deltas"):
    ORACLES[_name] = W(REPORT)
ORACLES["message_roundtrip"] = W(REPORT, "odd")
ORACLES["cost_fine"] = W(
    "SELECT reason, count(*) AS n, CAST(sum(cost) AS VARCHAR) AS cost FROM (SELECT coalesce(reason, '') AS reason,"
    f" CASE WHEN reason IS NULL THEN CAST({O.jtrim(O.fld('expose', 'cost'))} AS DECIMAL(28,8)) ELSE 0 END AS cost"
    f" FROM ({O.checked('expose')})) GROUP BY reason", "fine")
_zeros = ", ".join("CAST(1 AS BIGINT) AS second_jump_cnt" if m == "second_jump_cnt" else
                   f"CAST(0 AS {'DECIMAL(28,8)' if m == 'cost' else 'BIGINT'}) AS {m}" for m in MEASURES)
ORACLES["report_plugin"] = W(O.finish(" UNION ALL ".join(
    [O.contributions(t, "file") for t in LOG_TYPES]
    + [f"SELECT {', '.join(KEY_PARTS)}, slot_ms, {_zeros} FROM ({O.keyed('click', ', event_id')}) WHERE event_id % 3 = 0"])))
# old and new halves are de-duplicated each on its own (dedup scope is the batch)
ORACLES["report_upsert"] = W(O.report_sql("early"))
for _t in LOG_TYPES:
    ORACLES[f"agg_{_t}"] = W(O.type_delta_sql(_t))


# ---- messages
def _message_sql(t: str) -> str:
    own = O.OWN[t]
    sums = ", ".join(f"CAST(SUM({m}) AS {'DECIMAL(38,8)' if m == 'cost' else 'BIGINT'}) AS {m}"
                     for m in own)
    fields = [f"concat_ws(chr(31), {_parts}, {O.label('slot_ms')})"]
    for item in REPORT_ITEMS:
        fields.append(f"CAST({item} AS VARCHAR)" if item in MEASURES and item in own else "''")
    fields.append("'21'")
    return (f"SELECT '{t}' AS log_type, concat_ws(chr(30), {', '.join(fields)}) AS value FROM ("
            f"SELECT {_parts}, slot_ms, {sums} FROM ({O.contributions(t)}) GROUP BY {_parts}, slot_ms)")


ORACLES["delta_message"] = W(" UNION ALL ".join(_message_sql(t) for t in LOG_TYPES))

ORACLES["two_stage_report"] = W(REPORT_FILE, "odd")
_clicks = f"(SELECT count(*) FROM (SELECT DISTINCT {_parts}, slot_ms FROM ({O.contributions('click')})))"
ORACLES["message_rejects"] = W(
    f"SELECT reason, n * {_clicks} AS n FROM (VALUES ('', 1), ('fields', 2), ('row_key', 1), ('slot', 1),"
    " ('measure', 1)) v(reason, n)")

# ---- files
ORACLES["pending_files"] = W(f"SELECT DISTINCT log_type, {FILE_NAME} AS name FROM lines WHERE file_no >= 2")
ORACLES["ledger_prune"] = W(f"SELECT DISTINCT log_type, {FILE_NAME} AS name FROM lines WHERE file_no < 2")
ORACLES["ledger_latest"] = W(
    "SELECT 'history_' || lpad(CAST(max(file_no) AS VARCHAR), 9, '0') || '.log' AS name FROM lines")
ORACLES["source_file_audit"] = W(
    f"SELECT log_type, {FILE_NAME} AS file_name, count(*) AS n_lines, true AS timed"
    " FROM lines GROUP BY log_type, file_no")

# ---- streaming
ORACLES["stream_file_ingest"] = ORACLES["scan_log_lines"]
ORACLES["stream_report"] = W(REPORT_FILE)
ORACLES["updated_keys"] = W(
    f"SELECT DISTINCT concat_ws(chr(31), {_parts}, start_time) AS row_key FROM ({REPORT_FILE})")
ORACLES["stream_late_data"] = W(O.report_sql("file_early"), "days")
_early = " UNION ALL ".join(O.contributions(t, "file_early", "early") for t in LOG_TYPES)
ORACLES["report_changes"] = W(
    f"SELECT r.* FROM ({O.report_sql('file_early')}) r SEMI JOIN (SELECT DISTINCT {_parts},"
    f" {O.fmt('slot_ms')} AS start_time FROM ({_early})) e USING ({_parts}, start_time)", "days")
ORACLES["stream_rejects"] = W(_rejected + " UNION ALL SELECT 'stray', 'unknown_type', NULL, value FROM lines"
                              " WHERE log_type = 'click' AND event_id % 5 = 0")
ORACLES["batch_timing"] = W(" UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS batch_id, count(*) AS n_rows, true AS timed FROM (SELECT DISTINCT {_parts}, slot_ms FROM ("
    + " UNION ALL ".join(O.contributions(t, "file_early", half) for t in LOG_TYPES) + "))"
    for i, half in enumerate(("NOT early", "early"))))
# with the scope 'stream' every (cookie, order id) counts once over all batches
ORACLES["report_changes_stream"] = ORACLES["two_stage_stream_report"] = W(REPORT, "days")
# keys touched: those of the other types, those where the second half's first arrivals count at first, and those
# where the first arrivals of all count in the end
_touched = " UNION ".join([
    *(f"SELECT {_parts}, slot_ms FROM ({O.contributions(t)})" for t in LOG_TYPES if t != "arrive"),
    f"SELECT {_parts}, slot_ms FROM ({O.contributions('arrive', 'early', 'NOT early')})",
    f"SELECT {_parts}, slot_ms FROM ({O.arrive_kept('all')})"])
ORACLES["updated_keys_stream"] = W(
    f"SELECT DISTINCT concat_ws(chr(31), {_parts}, {O.fmt('slot_ms')}) AS row_key FROM ({_touched})", "days")
_arrivals = O.finish(O.contributions("arrive"))
ORACLES["arrive_any_cap"] = W(" UNION ALL ".join(
    f"SELECT CAST({c} AS INTEGER) AS cap, * FROM ({_arrivals})" for c in (1, 3, 0)))
ORACLES["two_stage_any_cap"] = ORACLES["arrive_any_cap"]
ORACLES["arrive_late"] = W(
    f"SELECT cookie, oid AS order_key, check_id, log_ms, {_parts}, {O.fmt('slot_ms')} AS start_time"
    f" FROM ({O.arrive_kept('all')})", "days")
ORACLES["stream_arrive_dedup"] = W(
    f"SELECT cookie, oid AS order_key, check_id, log_ms FROM ({O.arrive_kept('all')})")


# ---- metrics
def _stage_sql(t: str, scope: str = "all", half: str = "") -> str:
    w = SPECS[t].width
    where = f" WHERE {half}" if half else ""
    length = f"coalesce({O.jtrim('f[1]')} = CAST(least(n, {w}) AS VARCHAR), false)"
    return (f"SELECT '{t}' AS log_type, stage, n_rows FROM (SELECT"
            f" CAST(count(*) AS BIGINT) AS s1, CAST(count(*) FILTER (WHERE {length}) AS BIGINT) AS s2,"
            f" CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS s3,"
            f" (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT {_parts}, slot_ms"
            f" FROM ({O.contributions(t, scope, half)}))) AS s4 FROM ({O.checked(t)}){where})"
            " UNPIVOT (n_rows FOR stage IN (s1 AS '1-createStream', s2 AS '2-log_length_filter_after',"
            " s3 AS '3-map_after', s4 AS '4-groupByKey_map_after'))")


def _stages_sql(scope: str = "all", half: str = "") -> str:
    merged = " UNION ALL ".join(O.contributions(t, scope, half) for t in LOG_TYPES)
    return " UNION ALL ".join([*(_stage_sql(t, scope, half) for t in LOG_TYPES),
                               "SELECT 'merge' AS log_type, '3-groupByKey_map_after' AS stage, CAST(count(*) AS BIGINT)"
                               f" AS n_rows FROM (SELECT DISTINCT {_parts}, slot_ms FROM ({merged}))"])


_stages = _stages_sql()
ORACLES["stage_counts"] = W(_stages)
ORACLES["metrics_message"] = W(
    f"SELECT concat_ws('%', log_type, CAST(n_rows AS VARCHAR), stage, 'batch-0',"
    f" '2024-01-01 00:00:00') AS value FROM ({_stages})")
# a line for every click: full files but for the last
def _files_sql(n: int, where: str = "true") -> str:
    return ("SELECT n_lines, count(*) AS n_files, CAST(sum(n_lines) AS BIGINT) AS n_different FROM (SELECT count(*) AS n_lines FROM ("
            f"SELECT row_number() OVER () - 1 AS i FROM lines WHERE log_type = 'click' AND {where}) GROUP BY i // {n}) GROUP BY n_lines")


ORACLES["metrics_archive"] = W(_files_sql(100))
_ok = "event_id % 7 <> 0"
ORACLES["metrics_stream"] = W(
    f"SELECT 'files of ' || n_lines AS what, n_files AS n, n_different AS total FROM ({_files_sql(50, _ok)})"
    f" UNION ALL SELECT 'parsed', count(*), CAST(sum(event_id) AS BIGINT) FROM lines WHERE log_type = 'click' AND {_ok}"
    " UNION ALL SELECT 'rejected: ' || r, count(*), 0 FROM (SELECT CASE event_id % 21 WHEN 0 THEN 'fields' WHEN 7 THEN 'count'"
    " ELSE 'time' END AS r FROM lines WHERE log_type = 'click' AND event_id % 7 = 0) GROUP BY r")
ORACLES["metrics_parse"] = W(
    f"SELECT log_type, n_rows, stage, 'batch-0' AS host, '2024-01-01 00:00:00' AS time FROM ({_stages})")
ORACLES["partition_counts"] = W(
    "SELECT log_type, CAST(count(*) AS BIGINT) AS n_rows, true AS counted FROM lines GROUP BY log_type")
# every (cookie, order id) once over all files
ORACLES["report_files_job"] = W(REPORT)
ORACLES["job_from_file"] = W(f"SELECT 'batch' AS started, * FROM ({REPORT}) UNION ALL SELECT 'topics', * FROM ({REPORT})")
ORACLES["stream_stage_metrics"] = W(" UNION ALL ".join(
    f"SELECT *, 'batch-{i}' AS host FROM ({_stages_sql('file_early', half)})"
    for i, half in enumerate(("NOT early", "early"))))
# with the scope 'stream': the keys of a batch's arrivals are where first arrivals begin or cease to count
def _scope_stages() -> str:
    second = f"SELECT {_parts}, slot_ms, cookie, oid, log_ms, check_id FROM ({O.arrive_kept('early')}) WHERE NOT early"
    whole = f"SELECT {_parts}, slot_ms, cookie, oid, log_ms, check_id, early FROM ({O.arrive_kept('all')})"
    moved = (f"SELECT {_parts}, slot_ms FROM ({whole}) WHERE early UNION SELECT s.{', s.'.join(KEY_PARTS)}, s.slot_ms"
             f" FROM ({second}) s JOIN ({whole}) w ON w.cookie = s.cookie AND w.oid = s.oid AND w.early")
    out = []
    for i, (half, keys) in enumerate((("NOT early", f"SELECT {_parts}, slot_ms FROM ({second})"), ("early", moved))):
        merged = " UNION ".join([*(f"SELECT {_parts}, slot_ms FROM ({O.contributions(t, 'file_early', half)})"
                                   for t in LOG_TYPES if t != "arrive"), keys])
        out.append(f"SELECT log_type, stage, n_rows, 'batch-{i}' AS host FROM ({_stage_sql('arrive', 'all', half)})"
                   " WHERE stage <> '4-groupByKey_map_after'")
        out.append(f"SELECT 'arrive', '4-groupByKey_map_after', count(*), 'batch-{i}' FROM (SELECT DISTINCT * FROM ({keys}))")
        out.append(f"SELECT 'merge', '3-groupByKey_map_after', count(*), 'batch-{i}' FROM (SELECT DISTINCT * FROM ({merged}))")
    return " UNION ALL ".join(out)


ORACLES["stream_scope_metrics"] = W(_scope_stages())
