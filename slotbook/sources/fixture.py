"""Ad-log lines rendered from the driver's ``events`` table.

The reference ships no data, so its four log types are rendered from
``events`` (FIXTURES.md §3): ``view`` → expose, ``click`` → click,
``signup`` → bid, ``purchase`` → arrive, ``error`` → malformed expose
lines.  The field recipes are written once as portable SQL expressions so
that Spark (for the queries) and DuckDB (for the oracle) render the very
same lines; only the two base columns ``k`` and ``ms`` need per-engine
text (DuckDB's ``epoch_ms`` rounds, Spark truncates).

This module is a test-data renderer, not an operator: the engine under
test only ever sees the rendered text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook import session as S

BASE = {
    "spark": {
        "k": "try_cast(regexp_extract(props, '(-?[0-9]+)', 1) AS INT)",
        "ms": ("1704067200000 + (timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
               " - 1704067200000) % 86400000"),
        "early": "ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'",
    },
    "duckdb": {
        "k": "TRY_CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS INTEGER)",
        "ms": "1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) % 86400000",
        "early": "ts < TIMESTAMP '2024-01-16 00:00:00'",
    },
}


# Fixed values of the fixture: events rendered into one log file, and the
# least number of files per log type (the per-file oracles count on it).
ROWS_PER_FILE = 1_000_000
MIN_FILES = 4
DATED = "2024-01-01/h00"
FILES_SQL = (f"(SELECT greatest({MIN_FILES}, CAST(ceil(count(*) / {ROWS_PER_FILE}.0) AS BIGINT))"
             " FROM events)")


def files_per_type(spark: SparkSession, sf_dir: str) -> int:
    """Log files per type: four, or more as the events table grows, so that
    no file (written by one task) holds more than ``ROWS_PER_FILE`` lines.
    The same rule as ``FILES_SQL`` for DuckDB."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    return max(MIN_FILES, -(-rows // ROWS_PER_FILE))


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


# portable derived columns, evaluated over (event_id, user_id, event_type, value, k, ms)
DERIVED = {
    "g": "k % 6",
    "area": f"CASE WHEN k % 11 = 0 THEN '' ELSE {_s('user_id % 2')} END",
    "dom": f"'m' || {_s('user_id % 2')} || '.example.com'",
    "cost": "CAST(CAST(value AS DECIMAL(18,2)) AS STRING)",
    "t": f"CASE WHEN k % 13 = 0 THEN '' ELSE {_s('ms - 6000 * k')} END",
    "opt_ms": f"CASE WHEN k % 5 = 0 THEN '' ELSE {_s('ms')} END",
}


# variants of the lines: finer costs (some too fine), separators inside the referer,
# and event times not folded into one day
VARIANTS = {
    "fine": {"cost": (f"{DERIVED['cost']} || CASE WHEN k % 17 = 0 THEN '000400001' ELSE '0004' END")},
    "odd": {"dom": f"{DERIVED['dom']} || chr(31) || 'q' || chr(30) || chr(27) || '1'"},
    "days": {},
}
UNFOLDED_MS = {"spark": "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)",
               "duckdb": "epoch_us(ts) // 1000"}


def _columns(engine: str, variant: str | None) -> tuple[dict, dict]:
    """Base and derived columns of a variant."""
    base = dict(BASE[engine])
    if variant == "days":
        base["ms"] = UNFOLDED_MS[engine]
    return base, {**DERIVED, **(VARIANTS[variant] if variant else {})}


def _join(fields: list[str], sep_code: int) -> str:
    return f"concat_ws(chr({sep_code}), " + ", ".join(fields) + ")"


def _expose(log_length: str = "'23'", cost: str = "cost") -> list[str]:
    return [log_length, "'1'", _s("ms"), cost, _s("event_id"), _s("g"), _s("g % 3"),
            _s("g % 2"), _s("user_id"), "''", "'u' || " + _s("user_id"), "''", "''", "''",
            "dom", "''", _s("g"), "''", "''", "area", _s("g % 2"), "'x' || " + _s("g"),
            "opt_ms"]


def _click() -> list[str]:
    return ["'23'", "'1'", _s("ms"), _s("event_id"), _s("g"), _s("g % 3"), _s("g % 2"),
            _s("user_id"), "''", "'u' || " + _s("user_id"), "''", "''", "''", "dom", "''",
            "''", _s("g"), "''", "''", "area", _s("g % 2"), "'x' || " + _s("g"), "opt_ms"]


def _bid() -> list[str]:
    ad_pos = _join(["'s'", _s("g"), "'p'", "'l'", "'1'"], 4)
    first_ad = _join([_s("g"), _s("g % 3"), _s("g % 2"), "'s'", "'1'", _s("g % 2")], 4)
    other_ad = _join(["'9'"] * 6, 4)
    ads = f"{first_ad} || CASE WHEN k % 2 = 0 THEN chr(3) || {other_ad} ELSE '' END"
    fields = (["'34'", "''", "''", _s("ms"), "''", _s("event_id"), "''", "area", "''", "''", "''",
               "'http://' || dom || '/p/' || " + _s("k"), "''", "''", "''", "''", "''", ad_pos,
               "''", ads] + ["''"] * 13 + [_s("ms")])
    assert len(fields) == 34
    return fields


def _arrive() -> list[str]:
    ident = _join(["t", "dom", _s("g % 2"), "area", _s("g"), _s("g % 2"), _s("g % 3"), _s("g")], 3)
    return ["'10'", "''", _s("ms"), "'u' || " + _s("user_id"), "''", _s("event_id"), "''", "''",
            ident, "''"]


def error_value_sql() -> str:
    """Malformed expose lines, by g: 0 short, 1 and 4 long but accepted,
    2 '023' length text, 3 short but self-consistent, 5 bad cost."""
    exp = _expose()
    extra = [chr(39) + "extra" + chr(39)] * 2
    return (
        "CASE g"
        f" WHEN 0 THEN {_join(exp[:10], 2)}"
        f" WHEN 1 THEN {_join(exp + extra, 2)}"
        f" WHEN 4 THEN {_join(exp + extra, 2)}"
        f" WHEN 2 THEN {_join(_expose(log_length=chr(39) + '023' + chr(39)), 2)}"
        f" WHEN 3 THEN {_join([chr(39) + '10' + chr(39)] + exp[1:10], 2)}"
        f" ELSE {_join(_expose(cost=chr(39) + 'abc' + chr(39)), 2)} END"
    )


# event type -> (log type, line text as portable SQL)
def renderings() -> dict[str, tuple[str, str]]:
    assert len(_expose()) == 23 and len(_click()) == 23 and len(_arrive()) == 10
    return {
        "view": ("expose", _join(_expose(), 2)),
        "click": ("click", _join(_click(), 2)),
        "signup": ("bid", _join(_bid(), 2)),
        "purchase": ("arrive", _join(_arrive(), 2)),
        "error": ("expose", error_value_sql()),
    }


def value_sql() -> str:
    """The line text of one event, as one portable SQL expression."""
    r = renderings()
    return "CASE event_type" + "".join(f" WHEN '{e}' THEN {v}" for e, (_, v) in r.items()) + " END"


LOG_TYPE_SQL = ("CASE event_type WHEN 'view' THEN 'expose' WHEN 'error' THEN 'expose'"
                " WHEN 'click' THEN 'click' WHEN 'signup' THEN 'bid'"
                " WHEN 'purchase' THEN 'arrive' END")


def duckdb_lines_sql(variant: str | None = None) -> str:
    """``lines(event_id, file_no, early, log_type, value)`` as DuckDB SQL."""
    b, d = _columns("duckdb", variant)
    derived = ", ".join(f"{v} AS {k}" for k, v in d.items())
    return (
        f"SELECT event_id, event_id % {FILES_SQL} AS file_no, early, log_type, value FROM ("
        f" SELECT event_id, early, {LOG_TYPE_SQL} AS log_type, {value_sql()} AS value FROM ("
        f"  SELECT *, {derived} FROM ("
        f"   SELECT event_id, user_id, event_type, value, {b['k']} AS k, {b['ms']} AS ms,"
        f"   {b['early']} AS early FROM events))) WHERE log_type IS NOT NULL"
    )


_SPLITS: dict[tuple[str, str], int] = {}


def spread(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` (a scan of ``path``) as is when the scan already yields a split
    per core; otherwise (a small file with one row group is read by one
    task) spread round-robin over the cores.  On large inputs this is a
    no-op: no extra shuffle.  The split count of a read-only input is
    planned once per application."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _SPLITS:
        _SPLITS[key] = df.rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    return df if _SPLITS[key] >= cores else df.repartition(cores)


def fixture_lines(spark: SparkSession, sf_dir: str, n_files: int = MIN_FILES,
                  variant: str | None = None) -> DataFrame:
    """``(event_id, file_no, early, log_type, value)``: one line per event,
    ``file_no`` = ``event_id % n_files``.

    One union branch per event type with a literal log type, so a filter on
    ``log_type`` prunes whole branches and each branch's projection stays
    small enough for whole-stage codegen."""
    b, derived = _columns("spark", variant)
    path = f"{sf_dir}/events.parquet"
    ev = spread(spark, spark.read.parquet(path), path).selectExpr(
        "event_id", "user_id", "event_type", "value",
        f"{b['k']} AS k", f"{b['ms']} AS ms", f"{b['early']} AS early")
    ev = ev.selectExpr("*", *[f"{v} AS {k}" for k, v in derived.items()])
    out = None
    for etype, (ltype, sql) in renderings().items():
        part = ev.where(F.col("event_type") == etype).selectExpr(
            "event_id", f"event_id % {int(n_files)} AS file_no", "early", f"'{ltype}' AS log_type",
            f"{sql} AS value")
        out = part if out is None else out.unionByName(part)
    return out


_FILE_CACHE: dict[tuple[str, str], str] = {}


def write_fixture_files(spark: SparkSession, sf_dir: str, reuse: bool = True,
                        where: str | None = None, root: str | None = None,
                        suffix: str = "", with_tmp: bool = True, variant: str | None = None) -> str:
    """Write the lines as files ``{root}/{log_type}/{file_no}{suffix}.log``, those with
    an odd number in a dated sub-folder, plus an in-progress ``_part.tmp``
    in each type's folder (must be skipped by readers).

    Spark writes the data (one task per type and file number, so one file
    each); the driver only renames the finished part files.  ``where``
    restricts the events (SQL over the fixture columns), ``root`` adds the
    files to an existing folder.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    cacheable = reuse and where is None and root is None and not suffix and with_tmp and not variant
    if cacheable and key in _FILE_CACHE and S.exists(spark, _FILE_CACHE[key]):
        return _FILE_CACHE[key]
    root = root or S.scratch_path(spark, "logs")
    staging = S.scratch_path(spark, "staging")
    lines = fixture_lines(spark, sf_dir, files_per_type(spark, sf_dir), variant)
    if where:
        lines = lines.where(where)
    # one task per (type, file): each writes at most ROWS_PER_FILE lines
    (lines.select("log_type", "file_no", "value")
     .repartition("log_type", "file_no")
     .write.partitionBy("log_type", "file_no").text(staging + "/files"))
    if with_tmp:
        (lines.where(F.col("file_no") == 0).select("log_type", "value")
         .repartition("log_type")
         .write.partitionBy("log_type").text(staging + "/tmp"))
    for t in ("bid", "expose", "click", "arrive"):
        type_dir = f"{staging}/files/log_type={t}"
        folders = S.list_dirs(spark, type_dir) if S.exists(spark, type_dir) else []
        for folder in folders:
            n = folder.rstrip("/").rsplit("=", 1)[-1]
            deep = f"{DATED}/" if int(n) % 2 else ""
            for j, p in enumerate(sorted(S.list_files(spark, folder))):
                S.rename(spark, p, f"{root}/{t}/{deep}{n}{suffix}{'' if j == 0 else f'-{j}'}.log")
        tmp_dir = f"{staging}/tmp/log_type={t}"
        if with_tmp and S.exists(spark, tmp_dir):
            for j, p in enumerate(sorted(S.list_files(spark, tmp_dir))):
                S.rename(spark, p, f"{root}/{t}/_part{j or ''}.tmp")
    if cacheable:
        _FILE_CACHE[key] = root
    return root
