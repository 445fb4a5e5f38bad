"""Named queries: one per operator group of the survey's inventory.

Every query takes ``(spark, sf_dir)``, reads the driver's tables (the line
fixture rendered from ``events``, or ``pages``) and returns a DataFrame; none
collects data.  Column names equal those of the oracle SQL in
``slotbook.plans.oracle_queries``.  File and streaming queries write the
fixture lines as files in a fresh folder under the shared checkpoint folder
and return what Spark read or wrote back.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotbook import job, session as S
from slotbook.functions import (blank_to_zero, bounds_from_label, first_element, hour_label, pad_ms,
                                slot_end_text, slot_index, slot_label, slot_start_ms,
                                slot_start_text, split_fixed, url_domain)
from slotbook.operators import aggregate as A
from slotbook.operators import dedup, keys, messages, metrics
from slotbook.operators.parse import N_FIELDS, parse_lines
from slotbook.functions import sql as Q
from slotbook.operators.upsert import COUNTS_SOMETHING, ReportStore, published, upsert
from slotbook.plans import report as R
from slotbook.sources import files as FS
from slotbook.sources import kafka, publish
from slotbook.sources.fixture import fixture_lines, write_fixture_files
from slotbook.specs import (COST_TYPE, EXPOSE, KEY_PARTS, KEY_SEPARATOR, LEVEL1_SEPARATOR,
                            LEVEL2_SEPARATOR, LOG_TYPES, MEASURES, MESSAGE_SEPARATOR, REPORT_OUTPUT, SPECS, ReportConfig,
                            read_specs_xml, write_specs_xml)
from slotbook.streaming import report_stream as RS

CFG = ReportConfig()
FILE_CFG = ReportConfig(dedup_scope="file")
STREAM_CFG = ReportConfig(dedup_scope="stream")
# the column that tells records of a type apart
RECORD_ID = {"bid": "bit_id", "expose": "expose_id", "click": "expose_id", "arrive": "check_id"}
# a log type of its own, declared like click
JUMP = replace(SPECS["click"], log_type="jump")
N = CFG.slot_minutes

QUERIES: dict = {}
VERSION_WIDTH = 9   # digits of a ledger version name


@A.register("jump", ("second_jump_cnt",))
def jump_contributions(valid, cfg, spec, scope=()):
    return A.with_measures(keys.click_keys(valid, cfg, keep=scope), {"second_jump_cnt": A.ONE})


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_lines(spark, sf_dir)


def _key_out(df: DataFrame, id_col: str) -> DataFrame:
    """Keyed records in report-key form (times as text)."""
    return df.select(
        F.col(id_col), *KEY_PARTS,
        slot_start_text(F.col("slot_ms")).alias("start_time"),
        slot_end_text(F.col("slot_ms"), N).alias("end_time"))


# ---------------------------------------------------------------- parse


@query("scan_log_lines")
def q_scan_log_lines(spark, sf_dir):
    """S1 + S3: text files of each log folder, in-progress files skipped."""
    root = write_fixture_files(spark, sf_dir)
    return FS.scan_lines(spark, root).select("log_type", "file_name", "value")


@query("kafka_lines")
def q_kafka_lines(spark, sf_dir):
    """Lines decoded from Kafka-shaped records (topic = log type)."""
    src = lines(spark, sf_dir).select(
        F.lit(None).cast("binary").alias("key"), F.encode("value", "UTF-8").alias("value"),
        F.col("log_type").alias("topic"), F.col("file_no").cast("int").alias("partition"),
        F.col("event_id").alias("offset"))
    return kafka.decode(src).select("log_type", "value")


@query("parse_expose")
def q_parse_expose(spark, sf_dir):
    """P1 + P2: expose lines split (trailing empties kept) and bound to names."""
    p = parse_lines(R.typed_lines(lines(spark, sf_dir), "expose"), EXPOSE)
    return p.select(F.col(N_FIELDS).alias("n_fields"), *EXPOSE.columns)


@query("parse_all")
def q_parse_all(spark, sf_dir):
    """P1 + P2 + F7 over all four types: fields by number, '\x02'-free text."""
    frames = []
    for t in LOG_TYPES:
        p = parse_lines(R.typed_lines(lines(spark, sf_dir), t), SPECS[t])
        named = F.concat_ws("|", *[F.concat(F.lit(f"{i}="), F.col(f"`{c}`"))
                                   for i, c in enumerate(SPECS[t].columns)])
        frames.append(p.select(F.lit(t).alias("log_type"), F.col(N_FIELDS).alias("n_fields"),
                               named.alias("fields")))
    return A.union_all(frames)


@query("valid_logs")
def q_valid_logs(spark, sf_dir):
    """Lines that pass the length, key and number checks."""
    ls = lines(spark, sf_dir)
    return A.union_all([R.valid_of(ls, t, CFG).select(F.lit(t).alias("log_type"), "value")
                        for t in LOG_TYPES])


@query("rejected_logs")
def q_rejected_logs(spark, sf_dir):
    """P4 + F6 + Q11: rejected lines with reason and field count."""
    ls = lines(spark, sf_dir)
    return A.union_all([R.rejects_of(ls, t, CFG) for t in LOG_TYPES])


@query("split_fixed")
def q_split_fixed(spark, sf_dir):
    """P10: the composite fields - the arrive id (8 parts), bid's first ad (6) and its
    ad position (5) - as parts, missing ones ''."""
    frames = []
    for t, column, sep, n, ident in (("arrive", "id", LEVEL1_SEPARATOR, 8, "check_id"),
                                     ("bid", "bitted_ad_info", LEVEL2_SEPARATOR, 6, "bit_id"),
                                     ("bid", "ad_pos_info", LEVEL2_SEPARATOR, 5, "bit_id")):
        p = parse_lines(R.typed_lines(lines(spark, sf_dir), t), SPECS[t])
        text = first_element(p[column], LEVEL1_SEPARATOR) if column == "bitted_ad_info" else p[column]
        parts = split_fixed(text, sep, n) + [F.lit("")] * (8 - n)
        frames.append(p.select(F.lit(column).alias("field"), F.col(ident).alias("record"),
                               *[c.alias(f"p{i}") for i, c in enumerate(parts)]))
    return A.union_all(frames)


@query("spec_catalog")
def q_spec_catalog(spark, sf_dir):
    """The declarations with the lines of each type that match their width."""
    # the declarations go through a job file, as the reference's do
    path = S.scratch_path(spark, "logconf")
    write_specs_xml(spark, [SPECS[t] for t in LOG_TYPES], path)
    specs = read_specs_xml(spark, path).select(
        "log_type", F.size("items").alias("n_columns"),
        F.concat_ws(",", "key").alias("key_columns"))
    stats = A.union_all([
        parse_lines(R.typed_lines(lines(spark, sf_dir), t), SPECS[t]).agg(
            F.lit(t).alias("log_type"), F.count(F.lit(1)).alias("n_lines"),
            F.count(F.when(F.col(N_FIELDS) == SPECS[t].width, 1)).alias("n_full_width"))
        for t in LOG_TYPES])
    # one declaration row per log type: a bounded, tiny side
    return stats.join(F.broadcast(specs), "log_type").select(
        "log_type", "n_columns", "key_columns", "n_lines", "n_full_width")


# ---------------------------------------------------------------- scalars


@query("url_domain")
def q_url_domain(spark, sf_dir):
    """F1 over every page URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return pages.select("page_id", url_domain(F.col("url")).alias("domain"))


@query("time_slot")
def q_time_slot(spark, sf_dir):
    """F2-F4 over every type's log times, also read as 10-digit seconds (padding)."""
    frames = []
    for t, ident in RECORD_ID.items():
        p = R.valid_of(lines(spark, sf_dir), t, CFG)
        ms = keys.log_ms(p["log_time"])
        sec_ms = pad_ms(F.substring(p["log_time"], 1, 10)).try_cast("bigint")
        s1, s2 = slot_start_ms(ms, N), slot_start_ms(sec_ms, N)
        frames.append(p.select(
            F.lit(t).alias("log_type"), p[ident].alias("record"), hour_label(s1).alias("hour_label"),
            slot_index(s1, N).alias("slot_index"), slot_label(s1, N).alias("slot_label"),
            slot_label(s2, N).alias("slot_label_sec")))
    return A.union_all(frames)


@query("slot_bounds")
def q_slot_bounds(spark, sf_dir):
    """start and end of every slot label seen, read from the label text."""
    c = R.all_contributions(lines(spark, sf_dir), CFG)
    labels = c.groupBy("slot_ms").agg(F.count(F.lit(1)).alias("n_records"))
    lab = slot_label(F.col("slot_ms"), N)
    start, end = bounds_from_label(lab, N)
    return labels.select(lab.alias("slot_label"), start.alias("start_time"),
                         end.alias("end_time"), "n_records")


@query("blank_keys")
def q_blank_keys(spark, sf_dir):
    """P17 + Q5: raw text of every declared column → key part ('' and '0' meet in one
    group), all types."""
    ls = lines(spark, sf_dir)
    frames = []
    for t in LOG_TYPES:
        v = R.valid_of(ls, t, CFG)
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").alias("v"))
                                    for c in SPECS[t].key if c != "log_time"]))
        frames.append(v.select(cells.alias("x")).select(
            F.lit(t).alias("log_type"), F.col("x.c").alias("field"), F.col("x.v").alias("raw"),
            blank_to_zero(F.col("x.v")).alias("part")))
    return (A.union_all(frames).groupBy("log_type", "field", "raw", "part")
            .agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- keys


@query("keys_expose")
def q_keys_expose(spark, sf_dir):
    v = R.valid_of(lines(spark, sf_dir), "expose", CFG)
    return _key_out(keys.expose_keys(v, CFG, keep=[v["expose_id"]]), "expose_id")


@query("keys_click")
def q_keys_click(spark, sf_dir):
    v = R.valid_of(lines(spark, sf_dir), "click", CFG)
    return _key_out(keys.click_keys(v, CFG, keep=[v["expose_id"]]), "expose_id")


@query("keys_bid")
def q_keys_bid(spark, sf_dir):
    v = R.valid_of(lines(spark, sf_dir), "bid", CFG)
    return _key_out(keys.bid_keys(v, CFG, SPECS["bid"], keep=[v["bit_id"]]), "bit_id")


@query("keys_arrive")
def q_keys_arrive(spark, sf_dir):
    v = R.valid_of(lines(spark, sf_dir), "arrive", CFG)
    k = keys.arrive_keys(v, CFG)
    return k.select("check_id", *KEY_PARTS,
                    slot_start_text(F.col("slot_ms")).alias("start_time"),
                    slot_end_text(F.col("slot_ms"), N).alias("end_time"), "log_ms", "id_ms")


@query("arrive_in_window")
def q_arrive_in_window(spark, sf_dir):
    """Arrivals within five minutes of their id time (no lower bound)."""
    v = R.valid_of(lines(spark, sf_dir), "arrive", CFG)
    return keys.in_arrival_window(keys.arrive_keys(v, CFG)).select("check_id", "log_ms", "id_ms")


def _first(keyed: DataFrame, scope=()) -> DataFrame:
    kept = dedup.first_arrivals(keys.in_arrival_window(keyed), scope)
    return kept.select(*scope, "cookie", F.col("dedup_order_id").alias("order_key"), "check_id",
                       "log_ms", *KEY_PARTS,
                       slot_start_text(F.col("slot_ms")).alias("start_time"))


@query("arrive_first")
def q_arrive_first(spark, sf_dir):
    """Earliest arrival per (cookie, order id)."""
    v = R.valid_of(lines(spark, sf_dir), "arrive", CFG)
    return _first(keys.arrive_keys(v, CFG))


@query("arrive_first_per_file")
def q_arrive_first_per_file(spark, sf_dir):
    """T5: the same, de-duplicated within each source file."""
    root = write_fixture_files(spark, sf_dir)
    src = {"arrive": FS.scan_lines(spark, {"arrive": f"{root}/arrive"}).select("value", "file_name")}
    v = R.valid_of(src, "arrive", FILE_CFG, keep=("file_name",))
    return _first(keys.arrive_keys(v, FILE_CFG, keep=("file_name",)), ("file_name",))


# ---------------------------------------------------------------- aggregates


@query("report_batch")
def q_report_batch(spark, sf_dir):
    """Flagship: the four log types → one report."""
    return R.report(lines(spark, sf_dir), CFG)


for _t in LOG_TYPES:
    def _mk(t):
        def q(spark, sf_dir):
            return R.type_delta(lines(spark, sf_dir), t, CFG)
        q.__name__ = f"q_agg_{t}"
        q.__doc__ = f"A1-A4: the {t} delta per report key."
        return q
    query(f"agg_{_t}")(_mk(_t))


@query("merge_deltas")
def q_merge_deltas(spark, sf_dir):
    """A5: per-type deltas first (as the reference sends them), then summed."""
    ls = lines(spark, sf_dir)
    deltas = [A.own_measures(R.contributions_of(ls, t, CFG), t) for t in LOG_TYPES]
    wide = [A.with_measures(d, {m: m for m in A.OWN_MEASURES[t]})
            for d, t in zip(deltas, LOG_TYPES)]
    return A.finish(A.sum_measures(A.union_all(wide)), CFG)


@query("report_upsert")
def q_report_upsert(spark, sf_dir):
    """Report of the first half-month, then the second added to it."""
    ls = lines(spark, sf_dir)
    old = R.report(ls.where(F.col("early")), CFG, stored=True)
    new = R.report(ls.where(~F.col("early")), CFG, stored=True)
    return published(upsert(old, new))


@query("cost_fine")
def q_cost_fine(spark, sf_dir):
    """A2 + F6: costs of six decimals add up exactly, those of eleven are rejected."""
    ls = fixture_lines(spark, sf_dir, variant="fine")
    kept = R.valid_of(ls, "expose", CFG).select(
        F.lit("").alias("reason"), F.expr(Q.decimal_or_null("cost")).alias("cost"))
    gone = R.rejects_of(ls, "expose", CFG).select("reason", F.lit(0).cast(COST_TYPE).alias("cost"))
    return kept.union(gone).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cost").cast("string").alias("cost"))


@query("report_plugin")
def q_report_plugin(spark, sf_dir):
    """A fifth log type - declared like click, counted as second jumps - by its
    declaration and handler alone; batch and stream give one report (the stream's here)."""
    root = write_fixture_files(spark, sf_dir)
    click = fixture_lines(spark, sf_dir).where("log_type = 'click' AND event_id % 3 = 0").select("value")
    jumps = S.scratch_path(spark, "jump-logs")
    click.write.text(jumps)
    store = ReportStore(spark, S.scratch_path(spark, "plugin-report"))
    cfg = FILE_CFG.with_spec(JUMP)
    RS.run_report_stream(spark, {**FS.type_folders(root), "jump": jumps}, store,
                         S.scratch_path(spark, "plugin-ckpt"), cfg, max_files=3)
    return RS.stream_report(store, cfg)


# ---------------------------------------------------------------- messages


def _delta_messages(ls: DataFrame) -> DataFrame:
    return A.union_all([
        messages.encode(A.own_measures(R.contributions_of(ls, t, CFG), t), CFG,
                        keep=[F.lit(t).alias("log_type")])
        for t in LOG_TYPES])


@query("delta_message")
def q_delta_message(spark, sf_dir):
    """P12 + P13: one 21-field text message per key and log type."""
    return _delta_messages(lines(spark, sf_dir))


@query("message_rejects")
def q_message_rejects(spark, sf_dir):
    """Messages that are cut short, have a bad label, key or measure, by reason."""
    msgs = _delta_messages(lines(spark, sf_dir)).where("log_type = 'click'").select("value")
    sep, ks = MESSAGE_SEPARATOR, KEY_SEPARATOR
    bad = A.union_all([msgs, *(msgs.select(e.alias("value")) for e in (
        F.lit("garbage"), F.substring_index("value", sep, 20),
        F.concat(F.lit(ks), "value"), F.regexp_replace("value", f"{ks}[0-9]+{sep}", f"{ks}2024019999{sep}"),
        F.regexp_replace("value", f"{sep}([0-9]+){sep}", f"{sep}$1x{sep}")))])
    return (messages.decode_rejects(bad, CFG).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
            .union(messages.decode(bad, CFG).select(F.lit("").alias("reason"))
                   .groupBy("reason").agg(F.count(F.lit(1)).alias("n"))))


@query("two_stage_report")
def q_two_stage_report(spark, sf_dir):
    """T6 + K1 + S7: a stream of lines → records with Kafka's columns → a second stream → the
    report, with every separator inside the referer."""
    root = write_fixture_files(spark, sf_dir, variant="odd")
    topic = S.scratch_path(spark, "merge-topic")
    RS.run_delta_stream(RS.file_lines_stream(spark, root, 5), topic, S.scratch_path(spark, "stage1-ckpt"), FILE_CFG)
    store = ReportStore(spark, S.scratch_path(spark, "two-stage"), compact_every=2)
    RS.run_merge_stream(topic_records(spark, topic, 8), store, S.scratch_path(spark, "stage2-ckpt"), FILE_CFG,
                        rejects_dir=S.scratch_path(spark, "stage2-rejects"))
    return RS.stream_report(store, FILE_CFG)


@query("two_stage_any_cap")
def q_two_stage_any_cap(spark, sf_dir):
    """T5 + T6: with the scope 'stream' the two stages give one report - each (cookie, order id) once over
    all batches - whatever the caps of either stage on files a batch."""
    root = write_fixture_files(spark, sf_dir)
    frames = []
    for cap in (1, 3, None):
        topic = S.scratch_path(spark, "first-topic")
        # one arrival file a batch at least; the other types' lines do not matter here
        RS.run_delta_stream(RS.file_lines_stream(spark, FS.type_folders(root, ("arrive",)), cap), topic,
                            S.scratch_path(spark, "cap1-ckpt"), STREAM_CFG)
        store = ReportStore(spark, S.scratch_path(spark, "two-stage-cap"), compact_every=2)
        RS.run_merge_stream(topic_records(spark, topic, cap), store, S.scratch_path(spark, "cap2-ckpt"), STREAM_CFG)
        frames.append(RS.stream_report(store, STREAM_CFG).select(F.lit(cap or 0).alias("cap"), "*"))
    return A.union_all(frames)


def topic_records(spark, folder: str, max_files: int | None = None) -> DataFrame:
    """Written records with Kafka's columns as a stream."""
    r = spark.readStream.schema("key binary, value binary, topic string").option("recursiveFileLookup", "true")
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).parquet(folder)


@query("two_stage_stream_report")
def q_two_stage_stream_report(spark, sf_dir):
    """T5 + T6: the whole report through both stages with the scope 'stream', second half-month's files first: arrivals
    counted are taken back where earlier ones come late."""
    root, topic = S.scratch_path(spark, "late2"), S.scratch_path(spark, "late-topic")
    store = ReportStore(spark, S.scratch_path(spark, "late2-report"), compact_every=3)
    one, two = S.scratch_path(spark, "late2-1"), S.scratch_path(spark, "late2-2")
    for where, suffix in (("NOT early", ""), ("early", "-late")):
        write_fixture_files(spark, sf_dir, where=where, root=root, suffix=suffix, with_tmp=False, variant="days")
        RS.run_delta_stream(RS.file_lines_stream(spark, root, 6), topic, one, STREAM_CFG)
        RS.run_merge_stream(topic_records(spark, topic, 5), store, two, STREAM_CFG)
    return RS.stream_report(store, STREAM_CFG)


@query("message_roundtrip")
def q_message_roundtrip(spark, sf_dir):
    """P14-P16 + T6: messages decoded and merged give the report, whatever the referer holds."""
    msgs = _delta_messages(fixture_lines(spark, sf_dir, variant="odd")).select("value")
    return A.finish(messages.merge(messages.decode(msgs, CFG)), CFG)


# ---------------------------------------------------------------- files


def _ledger(spark, sf_dir):
    """A ledger holding files 0 and 1 of each type and one vanished file
    (a name no log file has)."""
    root = write_fixture_files(spark, sf_dir)
    listing = FS.listing(spark, root)
    ledger_dir = S.scratch_path(spark, "ledger")
    taken = listing.where(F.col("name").isin("0.log", "1.log")).select("path")
    FS.append_ledger(taken, ledger_dir)
    FS.append_ledger(listing.where(F.col("name") == "0.log")
                     .select(F.regexp_replace("path", r"0\.log$", "vanished.log").alias("path")),
                     ledger_dir)
    return root, listing, FS.read_ledger(spark, ledger_dir)


@query("pending_files")
def q_pending_files(spark, sf_dir):
    """Files not yet in the ledger."""
    _, listing, ledger = _ledger(spark, sf_dir)
    return FS.pending(listing, ledger).select("log_type", "name")


@query("ledger_prune")
def q_ledger_prune(spark, sf_dir):
    """Ledger entries whose file still exists."""
    root, listing, ledger = _ledger(spark, sf_dir)
    kept = FS.prune(ledger, listing)
    return kept.select(FS.type_below(spark, F.col("path"), root).alias("log_type"),
                       FS.base_name(F.col("path")).alias("name"))


@query("ledger_latest")
def q_ledger_latest(spark, sf_dir):
    """L2: one ledger version ``history_<n>.log`` per file number n, plus a
    newer version that is still empty; the latest non-empty one is taken.
    Version names have a fixed width (as time-stamped names do), so the
    greatest name is the latest version however many there are."""
    root = write_fixture_files(spark, sf_dir)
    listing = FS.listing(spark, root)
    hist = S.scratch_path(spark, "history")
    staging = S.scratch_path(spark, "history-staging")
    (listing.where(F.col("name").rlike(r"^[0-9]+[.]log$"))
     .select(F.regexp_extract("name", r"^([0-9]+)", 1).alias("v"), "path")
     .repartition("v").write.partitionBy("v").text(staging))
    for d in S.list_dirs(spark, staging):
        v = d.rstrip("/").rsplit("=", 1)[-1]
        for j, p in enumerate(sorted(S.list_files(spark, d))):
            S.rename(spark, p, f"{hist}/history_{int(v):0{VERSION_WIDTH}d}{'' if j == 0 else f'-{j}'}.log")
    S.touch(spark, f"{hist}/history_{'9' * VERSION_WIDTH}.log")
    return FS.latest_version(FS.listing(spark, hist))


@query("source_file_audit")
def q_source_file_audit(spark, sf_dir):
    """K5: each source file taken, with its line count, and that its time is known and past."""
    root = write_fixture_files(spark, sf_dir)
    audit = FS.audit(FS.scan_lines(spark, root))
    return audit.select("log_type", "file_name", "n_lines",
                        F.coalesce(F.col("file_modified") <= F.current_timestamp(), F.lit(False)).alias("timed"))


# ---------------------------------------------------------------- streaming


@query("stream_file_ingest")
def q_stream_file_ingest(spark, sf_dir):
    """Every new file taken once, at most 10 per micro-batch."""
    root = write_fixture_files(spark, sf_dir)
    sink, ckpt = S.scratch_path(spark, "ingest"), S.scratch_path(spark, "ingest-ckpt")
    RS.run_ingest_stream(spark, root, sink, ckpt, max_files=10)
    return spark.read.parquet(sink).select("log_type", "file_name", "value")


def _stream_store(spark, sf_dir, **dirs):
    root = write_fixture_files(spark, sf_dir)
    # compacted every two micro-batches, as a long-running stream would be
    store = ReportStore(spark, S.scratch_path(spark, "report"), compact_every=2)
    RS.run_report_stream(spark, root, store, S.scratch_path(spark, "report-ckpt"), FILE_CFG, max_files=5, **dirs)
    return store


@query("stream_report")
def q_stream_report(spark, sf_dir):
    """The report built micro-batch by micro-batch (5 files each)."""
    return RS.stream_report(_stream_store(spark, sf_dir), FILE_CFG)


@query("updated_keys")
def q_updated_keys(spark, sf_dir):
    """K3: the keys each micro-batch updated (distinct over batches)."""
    audit_dir = S.scratch_path(spark, "updated")
    _stream_store(spark, sf_dir, audit_dir=audit_dir)
    return spark.read.text(audit_dir).select(F.col("value").alias("row_key")).distinct()


@query("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    """The lines each micro-batch rejected, and those of a folder that is no log type."""
    root = write_fixture_files(spark, sf_dir, reuse=False)
    fixture_lines(spark, sf_dir).where("log_type = 'click' AND event_id % 5 = 0").select("value").write.text(
        f"{root}/stray/deep")
    out = S.scratch_path(spark, "rejects")
    store = ReportStore(spark, S.scratch_path(spark, "rejects-report"))
    RS.run_report_stream(spark, root, store, S.scratch_path(spark, "rejects-ckpt"), FILE_CFG, max_files=7,
                         rejects_dir=out)
    return (spark.read.schema("log_type string, reason string, n_fields int, value string")
            .option("basePath", out).parquet(out).select("log_type", "reason", "n_fields", "value"))


def _two_runs(spark, sf_dir, cfg, variant=None, max_files=None, **dirs):
    """Second-half-month files first, then first-half files arriving late."""
    root = S.scratch_path(spark, "late")
    store = ReportStore(spark, S.scratch_path(spark, "late-report"), compact_every=2)
    ckpt = S.scratch_path(spark, "late-ckpt")
    for where, suffix in (("NOT early", ""), ("early", "-late")):
        write_fixture_files(spark, sf_dir, where=where, root=root, suffix=suffix, with_tmp=False, variant=variant)
        RS.run_report_stream(spark, root, store, ckpt, cfg, max_files=max_files, **dirs)
    return store


@query("stream_late_data")
def q_stream_late_data(spark, sf_dir):
    """T4: late files add to the old rows of their slots, over all days of the month."""
    return RS.stream_report(_two_runs(spark, sf_dir, FILE_CFG, "days"), FILE_CFG)


@query("report_changes")
def q_report_changes(spark, sf_dir):
    """K2: the current rows of the keys the last batch touched: what is published after it."""
    store = _two_runs(spark, sf_dir, FILE_CFG, "days")
    return published(store.changed(1))


@query("report_changes_stream")
def q_report_changes_stream(spark, sf_dir):
    """K2 + K3: with the scope 'stream' the changed rows of each batch, applied by value one batch after the
    other - the last value of a key counts, a row of zeros removes it - give the report."""
    feed = S.scratch_path(spark, "changes")
    _two_runs(spark, sf_dir, STREAM_CFG, "days", max_files=4, changes_dir=feed)
    rows = spark.read.option("basePath", feed).parquet(feed)
    key = [c for c in REPORT_OUTPUT if c not in MEASURES]
    last = rows.groupBy(*key).agg(F.max(F.struct("batch_id", *MEASURES)).alias("r"))
    return last.select(*[F.col(c) if c in key else F.col(f"r.{c}") for c in REPORT_OUTPUT]).where(COUNTS_SOMETHING)


@query("updated_keys_stream")
def q_updated_keys_stream(spark, sf_dir):
    """K3: the audit names every key whose row changed, those too that an arrival came to or left (distinct over batches)."""
    audit_dir = S.scratch_path(spark, "updated-stream")
    _two_runs(spark, sf_dir, STREAM_CFG, "days", max_files=None, audit_dir=audit_dir)
    return spark.read.text(audit_dir).select(F.col("value").alias("row_key")).distinct()


@query("arrive_any_cap")
def q_arrive_any_cap(spark, sf_dir):
    """T5: with the scope 'stream', the report is the same for every cap on files a batch."""
    root = write_fixture_files(spark, sf_dir)
    frames = []
    for cap in (1, 3, None):
        store = ReportStore(spark, S.scratch_path(spark, "cap-report"), compact_every=2)
        RS.run_report_stream(spark, FS.type_folders(root, ("arrive",)), store, S.scratch_path(spark, "cap-ckpt"),
                             STREAM_CFG, max_files=cap)
        frames.append(RS.stream_report(store, STREAM_CFG).select(F.lit(cap or 0).alias("cap"), "*"))
    return A.union_all(frames)


@query("arrive_late")
def q_arrive_late(spark, sf_dir):
    """T5: earlier arrivals that come in later files take the place of those kept so far;
    none is dropped as late."""
    store = _two_runs(spark, sf_dir, STREAM_CFG, "days", max_files=3)
    return store.arrivals().select("cookie", F.col("dedup_order_id").alias("order_key"), "check_id", "log_ms",
                                   *KEY_PARTS, slot_start_text(F.col("slot_ms")).alias("start_time"))


@query("stream_arrive_dedup")
def q_stream_arrive_dedup(spark, sf_dir):
    """T5 across micro-batches: one arrive file per batch (the same cookie and
    order recur in several files), each (cookie, order id) kept once over
    the stream, with the record that was kept."""
    root = write_fixture_files(spark, sf_dir)
    store = ReportStore(spark, S.scratch_path(spark, "arrive-dedup"))
    RS.run_report_stream(spark, FS.type_folders(root, ("arrive",)), store,
                         S.scratch_path(spark, "arrive-dedup-ckpt"), STREAM_CFG, max_files=1)
    return store.arrivals().select("cookie", F.col("dedup_order_id").alias("order_key"), "check_id", "log_ms")


@query("stream_stage_metrics")
def q_stream_stage_metrics(spark, sf_dir):
    """M1-M3 in the stream: the stage counts of each micro-batch, archived as metric
    messages and parsed back (batch 0: second half-month, batch 1: first)."""
    metrics_dir = S.scratch_path(spark, "stream-metrics")
    _two_runs(spark, sf_dir, FILE_CFG, metrics_dir=metrics_dir)
    return metrics.parse_messages(spark.read.text(metrics_dir)).select("log_type", "stage", "n_rows", "host")


@query("stream_scope_metrics")
def q_stream_scope_metrics(spark, sf_dir):
    """M1 with the scope 'stream': the merge stage's keys of each batch are those its delta has, arrivals that moved
    included (batch 0: second half-month, batch 1: first)."""
    metrics_dir = S.scratch_path(spark, "scope-metrics")
    _two_runs(spark, sf_dir, STREAM_CFG, metrics_dir=metrics_dir)
    return metrics.parse_messages(spark.read.text(metrics_dir)).where(
        "log_type IN ('arrive', 'merge')").select("log_type", "stage", "n_rows", "host")


@query("batch_timing")
def q_batch_timing(spark, sf_dir):
    """The changed rows of each micro-batch written by value, as the writers of its partitions report them
    (the times vary: that each partition has one)."""
    timing_dir = S.scratch_path(spark, "timing")
    _two_runs(spark, sf_dir, FILE_CFG, changes_dir=S.scratch_path(spark, "timed-changes"), timing_dir=timing_dir)
    return publish.timing(spark, timing_dir).groupBy("batch_id").agg(
        F.sum("n_rows").alias("n_rows"), F.min(F.col("write_ms") >= 0).alias("timed"))


# ---------------------------------------------------------------- metrics


def _metric_ts():
    """A fixed report time so the messages are comparable (default: now)."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


@query("stage_counts")
def q_stage_counts(spark, sf_dir):
    """M1: rows at each named stage per log type."""
    return metrics.stage_counts(lines(spark, sf_dir), CFG)


@query("metrics_message")
def q_metrics_message(spark, sf_dir):
    """M2: stage counts as '%'-joined messages."""
    return metrics.messages(metrics.stage_counts(lines(spark, sf_dir), CFG), 0, _metric_ts())


@query("metrics_parse")
def q_metrics_parse(spark, sf_dir):
    """M3: metric messages parsed back to typed columns."""
    msgs = metrics.messages(metrics.stage_counts(lines(spark, sf_dir), CFG), 0, _metric_ts())
    return metrics.parse_messages(msgs)


@query("metrics_archive")
def q_metrics_archive(spark, sf_dir):
    """K4: every valid click's line as a metric line, archived 100 to a file over three batches, from many tasks: the files
    by number of lines, with how many different lines they hold."""
    archive = metrics.Archive(spark, S.scratch_path(spark, "metrics"), 100)
    msgs = _click_metrics(spark, sf_dir)
    for i in range(3):
        some = msgs.where(F.col("event_id") % 3 == i).select("value")
        for _ in range(1 + i % 2):                # the second batch is replayed
            archive.append(some.repartition(7), i)
    return _archived(archive)


def _click_metrics(spark, sf_dir) -> DataFrame:
    """A metric message for every click event."""
    return lines(spark, sf_dir).where("log_type = 'click'").select(
        "event_id", F.concat(F.lit("click%"), F.col("event_id").cast("string"),
                             F.lit("%1-createStream%batch-0%2024-01-01 00:00:00")).alias("value"))


def _archived(archive) -> DataFrame:
    files = archive.read().groupBy("file_no").agg(F.count(F.lit(1)).alias("n_lines"),
                                                  F.count_distinct("value").alias("n_different"))
    return files.groupBy("n_lines").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_different").alias("n_different"))


@query("metrics_stream")
def q_metrics_stream(spark, sf_dir):
    """Metric messages as a stream of records with Kafka's columns, every seventh spoiled in one of three ways:
    archived lines by file size, parsed messages, and rejects by reason."""
    bad = F.when(F.col("event_id") % 21 == 0, "junk").when(F.col("event_id") % 21 == 7, F.regexp_replace(
        "value", "click%", "click%x")).otherwise(F.regexp_replace("value", "2024-01-01", "yesterday"))
    src = S.scratch_path(spark, "metric-topic")
    (_click_metrics(spark, sf_dir).select(
        F.lit(None).cast("binary").alias("key"), F.encode(F.when(F.col("event_id") % 7 == 0, bad).otherwise(
            F.col("value")), "UTF-8").alias("value"), F.lit("report").alias("topic"))
     .repartition(9).write.parquet(src))
    archive = metrics.Archive(spark, S.scratch_path(spark, "metric-archive"), 50)
    parsed, rejects = S.scratch_path(spark, "metric-parsed"), S.scratch_path(spark, "metric-rejects")
    metrics.run_metric_stream(topic_records(spark, src, 2), archive, parsed, rejects, S.scratch_path(spark, "metric-ckpt"))
    ok = spark.read.option("basePath", parsed).parquet(parsed).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_rows").alias("total"))
    gone = spark.read.option("basePath", rejects).parquet(rejects).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return A.union_all([
        _archived(archive).select(F.concat(F.lit("files of "), F.col("n_lines").cast("string")).alias("what"),
                                  F.col("n_files").alias("n"), F.col("n_different").alias("total")),
        ok.select(F.lit("parsed").alias("what"), "n", "total"),
        gone.select(F.concat(F.lit("rejected: "), "reason").alias("what"), "n", F.lit(0).cast("bigint").alias("total"))])


@query("partition_counts")
def q_partition_counts(spark, sf_dir):
    """Lines per partition and type, summed: every line is in one partition."""
    counts = metrics.per_partition(lines(spark, sf_dir).select("log_type"), "log_type")
    return counts.groupBy("log_type").agg(F.sum("n_rows").alias("n_rows"),
                                          (F.count(F.lit(1)) > 0).alias("counted"))


@query("job_from_file")
def q_job_from_file(spark, sf_dir):
    """A job file - folders, cap, slots, declarations, table, topics - read back by Spark's XML source, starts the
    batch over its folders, and the processes of its topics; both reports, marked."""
    root = write_fixture_files(spark, sf_dir)
    path = S.scratch_path(spark, "job-file")
    job.write_job(spark, path, FS.type_folders(root), max_files=4, topics={**dict.fromkeys(LOG_TYPES, 2), "merge": 5})
    j = job.read_job(spark, path)
    stores = [ReportStore(spark, S.scratch_path(spark, f"job-{kind}"), compact_every=2) for kind in ("batch", "topics")]
    job.run_batch(spark, j, stores[0], S.scratch_path(spark, "job-ckpt"))
    once = {"availableNow": True}
    hand_off = S.scratch_path(spark, "job-topic")
    for f in j.folders:
        records = spark.readStream.format("text").option("recursiveFileLookup", "true").load(f.path)
        job.run_topic(records, j, f.log_type, f"{hand_off}/{f.log_type}", S.scratch_path(spark, "job-topic-ckpt"), once)
    job.run_merge(topic_records(spark, hand_off, 3), j, stores[1], S.scratch_path(spark, "job-merge-ckpt"), once)
    return A.union_all([RS.stream_report(s, j.config).select(F.lit(kind).alias("started"), "*")
                        for kind, s in zip(("batch", "topics"), stores)])


@query("report_files_job")
def q_report_files_job(spark, sf_dir):
    """§3.2: the batch job over watched folders: every pending file, ten a batch, then stop."""
    root = write_fixture_files(spark, sf_dir)
    store = ReportStore(spark, S.scratch_path(spark, "job-report"), compact_every=2)
    ckpt = S.scratch_path(spark, "job-ckpt")
    for _ in range(2):          # the second launch finds no new file
        RS.run_report_stream(spark, FS.type_folders(root), store, ckpt, STREAM_CFG, max_files=10)
    return RS.stream_report(store, STREAM_CFG)
