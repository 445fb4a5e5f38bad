"""Parsing and validation rows."""

from slotbook.operators.parse import parse_lines, rejects, valid_records
from slotbook.specs import EXPOSE, LogSpec

SPEC5 = LogSpec("t5", ("log_length", "a", "b", "c", "d"), ("a",), long_columns=())


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_trailing_empties_kept(spark):
    p = parse_lines(lines(spark, "5\x02x\x02\x02\x02"), SPEC5).first()
    assert (p["_n_fields"], p["a"], p["b"], p["c"], p["d"]) == (5, "x", "", "", "")


def test_length_check(spark):
    df = lines(spark, "", " 5 \x02x\x02\x02\x02", "5\x02x\x02\x02\x02\x02\x02\x02",
               "05\x02x\x02\x02\x02", "2\x02x")
    p = parse_lines(df, SPEC5)
    ok = {r["value"] for r in valid_records(p, SPEC5).collect()}
    # blank line rejected; trimmed count accepted; extra fields cut; '05' ≠ '5';
    # a short but self-consistent line passes the length check
    assert ok == {" 5 \x02x\x02\x02\x02", "5\x02x\x02\x02\x02\x02\x02\x02", "2\x02x"}
    reasons = {r["value"]: r["reason"] for r in rejects(p, SPEC5).collect()}
    assert reasons == {"": "length", "05\x02x\x02\x02\x02": "length"}


def test_missing_key_and_bad_number(spark):
    sep = "\x02"
    good = ["23", "1", "1704067200000", "1.5"] + ["x"] * 19
    short = ["10"] + good[1:10]
    bad_cost = list(good)
    bad_cost[3] = "abc"
    bad_time = list(good)
    bad_time[2] = "17040672000x"
    df = lines(spark, *(sep.join(v) for v in (good, short, bad_cost, bad_time)))
    p = parse_lines(df, EXPOSE)
    got = sorted(r["reason"] for r in rejects(p, EXPOSE).collect())
    assert got == ["bad_number", "bad_number", "missing_key"]
    assert valid_records(p, EXPOSE).count() == 1


def test_slot_minutes_must_divide_an_hour():
    import pytest

    from slotbook.specs import ReportConfig
    for n in (1, 5, 10, 12, 15, 20, 30, 60):
        assert ReportConfig(slot_minutes=n).slot_minutes == n
    for n in (0, 7, 25, 45, 90, -15):       # 25 would end its last slot at :74:59 (Q18)
        with pytest.raises(ValueError):
            ReportConfig(slot_minutes=n)


def test_media_raw_or_domain(spark):
    """Q6: expose media is the raw referer unless the spec asks for its domain."""
    from slotbook.operators import keys
    from slotbook.specs import ReportConfig
    fields = dict.fromkeys(EXPOSE.columns, "1")
    fields.update(log_length="23", log_time="1704067200000", cost="0.5",
                  media_url="http://a.example.com:8080/p?q=1", area_id=" ")
    line = "\x02".join(fields[c] for c in EXPOSE.columns)
    v = valid_records(parse_lines(lines(spark, line), EXPOSE), EXPOSE)
    raw = keys.expose_keys(v, ReportConfig()).first()
    dom = keys.expose_keys(v, ReportConfig(media="domain")).first()
    assert raw["media"] == "http://a.example.com:8080/p?q=1"
    assert dom["media"] == "a.example.com:8080"
    assert raw["area_id"] == dom["area_id"] == "0"          # blank key part (P17)
    assert raw["slot_ms"] == 1704067200000
