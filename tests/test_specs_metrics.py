"""Declarations from XML (S10), partition counts (A8) and the metric archive (K4)."""

import pytest
from pyspark.sql import functions as F

from slotbook import session as S
from slotbook.operators import metrics
from slotbook.sources.fixture import fixture_lines
from slotbook.specs import LINE_SEPARATOR, LOG_TYPES, SPECS, read_specs_xml, select_spec


def _xml(specs, extra=""):
    def one(s, sep):
        return (f"<log><topicLogType>{s.log_type}</topicLogType><items>{','.join(s.columns)}</items>"
                f"<rowKey>{','.join(s.key)}</rowKey><separator>{sep}</separator>"
                f"<logSpace>15</logSpace></log>")
    return "<logs>" + "".join(one(s, "") for s in specs) + extra + "</logs>"


def test_specs_from_xml(spark, tmp_path):
    path = tmp_path / "logconf.xml"
    path.write_text(_xml([SPECS[t] for t in LOG_TYPES]))
    rows = read_specs_xml(spark, str(path))
    for t in LOG_TYPES:
        got = select_spec(rows, t)
        assert got.columns == SPECS[t].columns and got.key == SPECS[t].key, t
        assert got.separator == LINE_SEPARATOR            # blank separator -> 0x02
    assert "connection type" in select_spec(rows, "bid").columns
    with pytest.raises(ValueError):
        select_spec(rows, "merge")                        # not declared
    twice = tmp_path / "twice.xml"
    twice.write_text(_xml([SPECS["bid"], SPECS["bid"]]))
    with pytest.raises(ValueError):
        select_spec(read_specs_xml(spark, str(twice)), "bid")


def test_per_partition_counts(spark, sf_dir):
    ls = fixture_lines(spark, sf_dir)
    parts = metrics.per_partition(ls.repartition(3))
    assert parts.count() == 3 and parts.agg(F.sum("n_rows")).first()[0] == ls.count()


def test_archive_fills_files_across_tasks(spark):
    """One-line partitions: files hold seven lines all the same, and every line is there once."""
    archive = metrics.Archive(spark, S.scratch_path(spark, "t-archive"), 7)
    archive.append(spark.range(40).selectExpr("CAST(id AS STRING) AS value").repartition(40), 0)
    rows = archive.read().collect()
    assert sorted(int(r.value) for r in rows) == list(range(40))
    per_file = sorted(sum(r.file_no == f for r in rows) for f in {r.file_no for r in rows})
    assert per_file == [5, 7, 7, 7, 7, 7]


def test_specs_xml_round_trip(spark):
    from slotbook.specs import write_specs_xml
    path = S.scratch_path(spark, "t-logconf")
    write_specs_xml(spark, [SPECS[t] for t in LOG_TYPES], path)
    rows = read_specs_xml(spark, path)
    for t in LOG_TYPES:
        got = select_spec(rows, t)
        assert (got.columns, got.key, got.separator) == (SPECS[t].columns, SPECS[t].key,
                                                         SPECS[t].separator)
    assert {r.slot_minutes for r in rows.collect()} == {15}
