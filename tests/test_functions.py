"""Hand-worked rows for the scalar functions and the reference's quirks."""

from pyspark.sql import functions as F

from slotbook.functions import (blank_to_zero, bounds_from_label, java_long, jtrim, pad_ms,
                                slot_end_text, slot_label, slot_start_ms, slot_start_text,
                                split_fixed, split_keep, url_domain)


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_domain_edge_rows(spark):
    cases = {"http://a.b:80/x?y": "a.b:80", "a.b/x": "", "https://h?q=1/z": "h?q=1",
             "s:///p": "", "x://u://v/w": "u:"}
    for url, want in cases.items():
        assert one(spark, url_domain, url) == want, url


def test_pad_ms(spark):
    assert one(spark, pad_ms, "1406196299") == "1406196299000"
    assert one(spark, pad_ms, "1406196299123") == "1406196299123"
    assert one(spark, pad_ms, "14061962991234") == "14061962991234"


def test_slot_utc(spark):
    df = spark.createDataFrame([(1406196299000,)], "ms long")
    s = slot_start_ms(F.col("ms"), 15)
    r = df.select(slot_label(s, 15).alias("l"), slot_start_text(s).alias("a"),
                  slot_end_text(s, 15).alias("b")).first()
    assert (r.l, r.a, r.b) == ("20140724100", "20140724100000", "20140724101459")


def test_slot_other_zone_and_sizes(spark):
    # Kathmandu is +5:45, so local slots are not aligned to UTC quarter hours
    df = spark.createDataFrame([(1406196299000,)], "ms long")
    s = slot_start_ms(F.col("ms"), 15, "Asia/Kathmandu")
    assert df.select(slot_start_text(s)).first()[0] == "20140724154500"
    for n, start, end in ((5, "20140724100000", "20140724100459"),
                          (20, "20140724100000", "20140724101959"),
                          (60, "20140724100000", "20140724105959")):
        s = slot_start_ms(F.col("ms"), n)
        r = df.select(slot_start_text(s), slot_end_text(s, n)).first()
        assert (r[0], r[1]) == (start, end)


def test_bounds_from_label(spark):
    df = spark.createDataFrame([("20140724103",)], "l string")
    a, b = bounds_from_label(F.col("l"), 15)
    r = df.select(a, b).first()
    assert (r[0], r[1]) == ("20140724104500", "20140724105959")


def test_split_fixed(spark):
    sep = "\x04"
    df = spark.createDataFrame([("abc" + sep * 4,), ("",), (sep * 3,)], "x string")
    rows = df.select(*split_fixed(F.col("x"), sep, 5)).collect()
    assert list(rows[0]) == ["abc", "", "", "", ""]
    assert list(rows[1]) == [""] * 5
    assert list(rows[2]) == [""] * 5


def test_split_keeps_trailing_empties(spark):
    df = spark.createDataFrame([("a\x02b\x02\x02\x02",)], "x string")
    assert df.select(F.size(split_keep(F.col("x"), "\x02"))).first()[0] == 5


def test_jtrim_and_blank_keys(spark):
    assert one(spark, jtrim, "\t 23 \x01") == "23"
    assert one(spark, blank_to_zero, " \t") == "0"
    assert one(spark, blank_to_zero, None) == "0"
    assert one(spark, blank_to_zero, "7") == "7"


def test_java_long(spark):
    assert one(spark, java_long, "+12") == 12
    assert one(spark, java_long, " 12") is None
    assert one(spark, java_long, "1.5") is None
    assert one(spark, java_long, "99999999999999999999") is None


def test_domain_of_null_is_null(spark):
    assert one(spark, url_domain, None) is None
    assert one(spark, url_domain, "") == ""


def test_split_on_any_separator_is_literal(spark):
    # one regex metacharacter, one plain character, several characters, and a
    # separator that holds the quoting sequence itself
    for sep in ("|", ".", "\\", "*", "%", "\x02", "::", "a\\Eb", "$^"):
        text = sep.join(["x", "", "y-z", ""])
        df = spark.createDataFrame([(text,)], "x string")
        got = df.select(split_keep(F.col("x"), sep)).first()[0]
        assert got == ["x", "", "y-z", ""], sep


def test_jtrim_matches_java_trim(spark):
    # Java's String.trim strips U+0000..U+0020 at both ends and nothing else
    for text in ("\x00a\x1f", "\x7fz\x7f", "a b", "", " ", " x ", "\x21!\x21"):
        want = text.strip("".join(chr(i) for i in range(0x21)))
        assert one(spark, jtrim, text) == want, repr(text)


def test_sql_forms_equal_column_forms(spark):
    """Each SQL-text function gives what its Column twin gives."""
    from slotbook.functions import sql as Q
    from slotbook.functions import first_element, slot_start_ms
    from slotbook.functions.text import decimal_or_null
    texts = [None, "", " ", "\x00a\x1f", " 12 ", "+12", "1.5", "abc", "0", "http://a.b:80/x?y",
             "a.b/x", "https://h?q=1/z", "s:///p", "x://u://v/w", "1406196299",
             "1406196299123", "14061962991234", "a\x03b\x04c\x03d", "\x03\x03", "x\x04y\x04z"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    x = F.col("x")
    pairs = {
        "jtrim": (jtrim(x), Q.jtrim("x")),
        "blank": (blank_to_zero(x), Q.blank_to_zero("x")),
        "domain": (url_domain(x), Q.url_domain("x")),
        "long": (java_long(x), Q.java_long("x")),
        "dec": (decimal_or_null(x), Q.decimal_or_null("x")),
        "pad": (pad_ms(x), Q.pad_ms("x")),
        "first": (first_element(x, "\x03"), Q.first_element("x", "\x03")),
    }
    for i, (a, b) in enumerate(zip(split_fixed(x, "\x04", 4), Q.split_fixed("x", "\x04", 4))):
        pairs[f"part{i}"] = (a, b)
    ms = java_long(x)
    for tz in ("UTC", "Asia/Kathmandu"):
        pairs["slot_" + tz] = (slot_start_ms(ms, 15, tz), F.expr(Q.slot_start_ms(Q.java_long("x"), 15, tz)))
    pairs["start"] = (slot_start_text(ms), F.expr(Q.slot_start_text(Q.java_long("x"))))
    pairs["end"] = (slot_end_text(ms, 15), F.expr(Q.slot_end_text(Q.java_long("x"), 15)))
    pairs["label"] = (slot_label(ms, 15), F.expr(Q.slot_label(Q.java_long("x"), 15)))
    from slotbook.functions import label_to_slot_ms
    lab = slot_label(ms, 15)
    pairs["unlabel"] = (label_to_slot_ms(lab, 15),
                        F.expr(Q.label_to_slot_ms(Q.slot_label(Q.java_long("x"), 15), 15)))
    cols = []
    for k, (a, b) in pairs.items():
        cols += [a.alias(k + "_c"), (F.expr(b) if isinstance(b, str) else b).alias(k + "_s")]
    for r in df.select(*cols).collect():
        for k in pairs:
            assert r[k + "_c"] == r[k + "_s"], (k, r)


def test_file_path_parts(spark):
    from slotbook.sources.files import base_name, type_below
    cases = {("/tmp/a", "file:///tmp/a/bid/0.log"): ("bid", "0.log"),
             ("/x/y", "hdfs://nn:8020/x/y/expose/2024-01-01/h03/12.log"): ("expose", "12.log"),
             ("/k/", "s3a://b/k/click/_part.tmp"): ("click", "_part.tmp"),
             ("/tmp/r s", "file:/tmp/r%20s/arrive/a%20b.log"): ("arrive", "a%20b.log"),
             ("/tmp/a", "file:///tmp/a/0.log"): (None, "0.log")}
    for (root, path), want in cases.items():
        assert (one(spark, lambda c, r=root: type_below(spark, c, r), path), one(spark, base_name, path)) == want, path
