"""Declared log layouts, report layout and the job settings.

A ``LogSpec`` is the declaration of one log type: its ordered column list,
the columns its report key is built from, and its field separator.  Specs
are plain Python values; ``read_specs_xml`` loads the same declarations
from an XML file with Spark's built-in XML reader (S10).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the declarations the log producers use.
# Column lists are in the order of the fields on a line.
# ---------------------------------------------------------------------------
CLICK_COLUMNS = (
    "log_length,log_version,log_time,expose_id,ad_id,order_id,activity_id,"
    "exchange_uid,user_gender,cookie,source,client_id,user_agent,media_url,"
    "landpage_urls,represent_type,represent_pos,page_type,interest_type,area_id,"
    "size_id,ad_pos_id,bit_time"
)
EXPOSE_COLUMNS = (
    "log_length,log_version,log_time,cost,expose_id,ad_id,order_id,activity_id,"
    "exchange_uid,user_gender,cookie,source,client_id,user_agent,media_url,"
    "represent_type,represent_pos,page_type,interest_type,area_id,size_id,"
    "ad_pos_id,bid_time"
)
BID_COLUMNS = (
    "log_length,log_version,log_type,log_time,exchange_id,bit_id,client_ip,area_id,"
    "exchange_uid,user_agent,user_gender,media_url,media_type,page_type,web_keys,"
    "interest_type,exclude_info,ad_pos_info,bitted_ad_num,bitted_ad_info,is_table,"
    "is_pay_app,app_id,app_name,device_type,os,ctr_value,mobile,device_id,mac,"
    "connection type,carrier,app category,process_time"
)
ARRIVE_COLUMNS = (
    "log_length,log_version,log_time,cookie,gif_name,check_id,user_agent,media_url,id,ip"
)
REPORT_COLUMNS = (
    "id,activity_id,order_id,material_id,ad_id,size_id,area_id,start_time,end_time,"
    "media,ad_pos_id,bid_cnt,bid_success_cnt,expose_cnt,click_cnt,arrive_cnt,"
    "second_jump_cnt,trans_cnt,cost"
)
CLICK_KEY = "log_time,ad_id,order_id,activity_id,media_url,area_id,size_id,represent_pos"
EXPOSE_KEY = "log_time,ad_id,order_id,activity_id,media_url,area_id,size_id,represent_pos"
BID_KEY = "log_time,area_id,media_url,ad_pos_info,bitted_ad_info"
ARRIVE_KEY = "log_time,id"
# the ten columns a report row is upserted on, the slot's two times last
KEY_COLUMNS = (
    "activity_id", "order_id", "material_id", "ad_id", "size_id", "area_id",
    "media", "ad_pos_id", "start_time", "end_time",
)
MEASURES = (
    "bid_cnt", "bid_success_cnt", "expose_cnt", "click_cnt", "arrive_cnt",
    "second_jump_cnt", "trans_cnt", "cost",
)
LINE_SEPARATOR = "\x02"      # default field separator of a log line
LEVEL1_SEPARATOR = "\x03"    # list inside a composite field
LEVEL2_SEPARATOR = "\x04"    # parts of one list element
DEFAULT_SLOT_MINUTES = 15
ARRIVE_WINDOW_MS = 5 * 60 * 1000
# ---------------------------------------------------------------------------

# Separators of this engine's own wire messages, and the character that escapes
# them where they occur in the data.
KEY_SEPARATOR = "\x1f"
MESSAGE_SEPARATOR = "\x1e"
ESCAPE = "\x1b"

# Cost values are exact decimals; a text with more decimals is rejected, not rounded.
COST_SCALE = 8
COST_TYPE = f"decimal(28,{COST_SCALE})"
COST_SUM_TYPE = f"decimal(38,{COST_SCALE})"

REPORT_ITEMS = tuple(REPORT_COLUMNS.split(","))
# the eight key parts that come from a record (the slot gives the two times)
KEY_PARTS = KEY_COLUMNS[:8]
COUNT_MEASURES = MEASURES[:-1]
# report column order without the database's own auto-increment id
REPORT_OUTPUT = tuple(c for c in REPORT_ITEMS if c != "id")
# a delta message: row key, the table items, and its own field count
MERGE_ITEMS = ("rowKey",) + REPORT_ITEMS + ("log_length",)


@dataclass(frozen=True)
class LogSpec:
    """Declaration of one log type."""

    log_type: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    separator: str = LINE_SEPARATOR
    check_length: bool = True
    # columns that must be present beyond the key (a handler reads them)
    required: tuple[str, ...] = ()
    # columns that must parse as a Java long / as a decimal number
    long_columns: tuple[str, ...] = ("log_time",)
    decimal_columns: tuple[str, ...] = ()
    # (column, separator, index): composite parts that, when not blank, must be a long
    long_parts: tuple[tuple[str, str, int], ...] = ()
    # bid only: where the ad-position id sits in ad_pos_info (comment says 2, code uses 1)
    ad_pos_index: int = 1

    @property
    def width(self) -> int:
        return len(self.columns)

    def with_separator(self, sep: str | None) -> "LogSpec":
        return replace(self, separator=sep or LINE_SEPARATOR)


def _cols(text: str) -> tuple[str, ...]:
    return tuple(text.split(","))


EXPOSE = LogSpec("expose", _cols(EXPOSE_COLUMNS), _cols(EXPOSE_KEY),
                 required=("cost",), decimal_columns=("cost",))
CLICK = LogSpec("click", _cols(CLICK_COLUMNS), _cols(CLICK_KEY))
BID = LogSpec("bid", _cols(BID_COLUMNS), _cols(BID_KEY))
ARRIVE = LogSpec("arrive", _cols(ARRIVE_COLUMNS), _cols(ARRIVE_KEY),
                 required=("cookie",), long_parts=(("id", LEVEL1_SEPARATOR, 0),))
MERGE = LogSpec("merge", MERGE_ITEMS, ("rowKey",), separator=MESSAGE_SEPARATOR,
                check_length=False, long_columns=())

# a first arrival on its way to the merge stage: where it counts, whose it is, and when it was
FIRST_ITEMS = ("rowKey", "cookie", "order_id", "log_time", "check_id", "log_length")
FIRST = LogSpec("first", FIRST_ITEMS, ("rowKey",), separator=MESSAGE_SEPARATOR, check_length=False)

SPECS: dict[str, LogSpec] = {s.log_type: s for s in (BID, EXPOSE, CLICK, ARRIVE, MERGE)}
LOG_TYPES = ("bid", "expose", "click", "arrive")


@dataclass(frozen=True)
class ReportConfig:
    """Job settings shared by every log type."""

    slot_minutes: int = DEFAULT_SLOT_MINUTES
    tz: str = "UTC"
    # 'raw' keeps expose/click media as the referer text; 'domain' extracts its host
    media: str = "raw"
    # arrive de-duplication scope: 'batch' (all lines given at once; no stream takes it),
    # 'file', 'stream' (over all batches of a store), or 'micro_batch' (each micro-batch
    # by itself, so that the result depends on how files fall into batches)
    dedup_scope: str = "batch"
    specs: dict = field(default_factory=lambda: dict(SPECS))

    def __post_init__(self):
        n = self.slot_minutes
        if n <= 0 or 60 % n:
            raise ValueError(f"slot minutes must divide 60, got {n}")
        if self.media not in ("raw", "domain"):
            raise ValueError("media must be 'raw' or 'domain'")
        if self.dedup_scope not in ("batch", "file", "stream", "micro_batch"):
            raise ValueError("dedup_scope must be 'batch', 'file', 'stream' or 'micro_batch'")

    @property
    def log_types(self) -> tuple[str, ...]:
        """The log types of the job: those declared, but for the merge stage's."""
        return tuple(t for t in self.specs if t != MERGE.log_type)

    def with_spec(self, spec: "LogSpec") -> "ReportConfig":
        """A job with one more log type (its handler is registered by the same name)."""
        return replace(self, specs={**self.specs, spec.log_type: spec})


def read_specs_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<log>`` declaration of an XML job file.

    Columns: log_type, items (array), key (array), separator (blank → 0x02),
    slot_minutes.  Uses Spark's built-in XML source, so spec files on any
    Hadoop filesystem work and nothing is parsed by hand.
    """
    raw = (spark.read.format("xml").option("rowTag", "log")
           .option("inferSchema", "false").load(path))
    names = set(raw.columns)

    def text(c: str):
        return F.col(c).cast("string") if c in names else F.lit(None).cast("string")

    sep = text("separator")
    return raw.select(
        text("topicLogType").alias("log_type"),
        F.split(text("items"), ",", -1).alias("items"),
        F.split(text("rowKey"), ",", -1).alias("key"),
        F.when(sep.isNull() | (sep == ""), F.lit(LINE_SEPARATOR)).otherwise(sep).alias("separator"),
        text("logSpace").try_cast("int").alias("slot_minutes"),
    )


def write_specs_xml(spark: SparkSession, specs, path: str, slot_minutes: int = DEFAULT_SLOT_MINUTES) -> None:
    """Declarations as an XML job file (``<logs><log>…</log></logs>``), the
    form ``read_specs_xml`` reads.  The default separator is written blank:
    control characters cannot appear in XML text."""
    rows = [(s.log_type, ",".join(s.columns), ",".join(s.key),
             "" if s.separator == LINE_SEPARATOR else s.separator, str(slot_minutes))
            for s in specs]
    (spark.createDataFrame(rows, "topicLogType string, items string, rowKey string,"
                                 " separator string, logSpace string")
     .coalesce(1).write.format("xml").option("rootTag", "logs").option("rowTag", "log")
     .mode("overwrite").save(path))


def select_spec(spec_rows: DataFrame, log_type: str) -> LogSpec:
    """Pick the one declaration of ``log_type``; fail on none or several.

    Spec tables hold one row per declared log type, so collecting the
    filtered rows is bounded by the number of declarations.
    """
    rows = spec_rows.where(F.col("log_type") == log_type).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one spec for {log_type!r}, found {len(rows)}")
    r = rows[0]
    base = SPECS.get(log_type)
    kw = dict(log_type=log_type, columns=tuple(r["items"]), key=tuple(r["key"]),
              separator=r["separator"])
    return replace(base, **kw) if base else LogSpec(**kw)
