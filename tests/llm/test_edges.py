"""Nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib

import brute as B
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from slotbook.llm import (chat, decontaminate, html_text, ngram_join, packing, pii, quality, secret_scan, token_count,
                          url_filter)
from slotbook.llm.common import on_workers, redact
from slotbook.llm.queries import PIECE_BPE, WORD_BPE

WORDS = public_tokenizers.path(WORD_BPE)
PIECES = public_tokenizers.path(PIECE_BPE)
LONG = " ".join(f"w{i % 997} émile" for i in range(20000))
SECRET = 'api_key = "Zx81kQpL0mN4vB7tR2wY" and 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822c'
MAIL = "write to jo.li+x@mail.example.com or +1 (555) 010-9999 from 10.0.0.255, card 4111 1111 1111 1111"
TEXTS = [None, "", " \n\t ", "one two", MAIL, SECRET, LONG, LONG, "x" * 50000, "7" * 40000, "a@" * 9000, "<|endoftext|> İstanbul Ǆ",
         MAIL, "Straße 😀 ñandú " * 30]
CLASH = "doc_id long, text string, lang string, source string, n_chars long, host string, spans string, kept string, " \
        "n_tokens long, leaks string, quality string, base string, candidates string, uid string, near string, text_key string"


@pytest.fixture(scope="module")
def docs(spark):
    on_workers(spark)
    rows = [(None if i == 3 else i // 2, t, None if i == 5 else "en", None if i % 3 == 0 else f"s{i % 2}", None,
             *["?"] * 3, 0, *["?"] * 7) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, CLASH)


def empty(docs):
    return docs.limit(0)


def test_ngram_join(docs):
    got = sorted(((r[0], r[1], r[2]) for r in ngram_join.jaccard_components(docs).collect()), key=str)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got == sorted(B.near_duplicates(rows), key=str)
    assert ngram_join.jaccard_components(empty(docs)).count() == 0


def test_keep_one(docs):
    doubled = docs.unionByName(docs)
    kept = ngram_join.keep_one(doubled)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    with_words = {t for t in TEXTS if B.shingles(t)}
    assert sorted(t for t in texts if B.shingles(t)) == sorted(with_words)      # one of each
    assert sum(not B.shingles(t) for t in texts) == 2 * sum(not B.shingles(t) for t in TEXTS)
    assert ngram_join.keep_one(empty(docs)).count() == 0


def test_pii(docs):
    got = pii.find_personal_data(docs, out="spans").collect()
    for r in got:
        want = [(k, a, e) for k, v in B.pii_base(r["text"]).items() for a, e in v]
        assert [tuple(s) for s in r["spans"]][:len(want)] == want
    assert len(got) == len(TEXTS) and "near" in got[0].asDict()
    assert pii.find_personal_data(empty(docs)).count() == 0


def test_secrets(docs):
    got = secret_scan.scan_secrets(docs, out="spans").collect()
    for r in got:
        want = {(k, a, e) for k, v in B.secrets_base(r["text"]).items() for a, e in v}
        assert {(s["k"], s["s"], s["e"]) for s in r["spans"] if s["k"] != "entropy"} == want
    assert len(got) == len(TEXTS) and secret_scan.scan_secrets(empty(docs)).count() == 0


def test_tokens_and_packing(docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORDS)
    want = {x or "": len(t.encode(x or "", add_special_tokens=False).ids) for x in TEXTS}
    got = token_count.count_tokens(docs, WORDS).collect()
    assert len(got) == len(TEXTS) and all(r["n_tokens"] == want[r["text"] or ""] for r in got)
    pieces = packing.pack(docs, WORDS).collect()
    assert sum(p["length"] for p in pieces) == sum(want[x or ""] + 1 for x in TEXTS)
    assert token_count.count_tokens(empty(docs), WORDS).count() == 0 == packing.pack(empty(docs), WORDS).count()


def test_quality(docs):
    q = quality.measured(docs, PIECES)
    got = quality.judge(q, quality.fit_bands(q)).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        m = r["quality"]
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"],
                r["base_failed"]) == B.quality_base(r["text"])
        assert isinstance(r["kept"], bool)
    e = quality.measured(empty(docs), PIECES)
    assert quality.judge(e, quality.fit_bands(e)).count() == 0


def test_leaks(spark, docs):
    items = spark.createDataFrame([(1, "w1 émile w2 émile w3 émile w4 émile w5 émile w6 émile"), (2, None), (3, "")],
                                  "item_id long, text string")
    got = decontaminate.find_leaks(docs, items).collect()
    assert len(got) == len(TEXTS) and {r["text"] for r in got if r["leaks"]} == {LONG}
    assert decontaminate.find_leaks(empty(docs), items).count() == 0
    assert all(r["leaks"] == [] for r in decontaminate.find_leaks(docs, items.limit(0)).collect())


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.com/en/x", "http://example.com", "x://a.b:80/en/?q", "http://example.com./en/",
            "http://ÉX.com/é", "http://www.example.com/en/" + "y" * 50000, "a://b://c/d", "http://example.com/en/\n/z"] * 2
    pages = spark.createDataFrame([(i, u, "h", "s", "b") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, stack string, best string")
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.EXAMPLE.com", "/en/", "allow"),
             ("example.com", "/en/", "block"), (None, "/", "block"), ("b", "", "block")]
    got = url_filter.filter_urls(pages, spark.createDataFrame(rules, url_filter.RULE_SCHEMA)).collect()
    plain = [(h.lower(), p, a) for h, p, a in rules if h]
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == B.url_verdict(r["url"], plain), r["url"]
        assert r["stack"] == "s" and r["best"] == "b"
    assert url_filter.filter_urls(pages.limit(0), url_filter.rules_table(spark, plain)).count() == 0
    none = url_filter.filter_urls(pages, url_filter.rules_table(spark, []), default="block").collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "block")}


def test_pages(spark):
    on_workers(spark)
    pages = [None, "", "plain words alone", "<", "<article><p>" + "long " * 30000, "<p" * 9000, "<!--" * 9000, '<a href="' * 9000,
             "<article><p>a &amp;&nbsp;b &#233; &lt;i&gt;</article></article></div>"]
    df = spark.createDataFrame([(i, p, "t") for i, p in enumerate(pages * 2)], "page_id long, html string, text string")
    tree = html_text.train(spark)
    got = {r["page_id"]: r["text"] for r in html_text.extract(df, tree).collect()}
    assert len(got) == 2 * len(pages) and got[0] == got[1] == "" and got[len(pages) - 1] == "a & b é <i>"
    assert got[4] == " ".join(["long"] * 30000)
    assert html_text.extract(df.limit(0), tree).count() == 0


def test_conversations(spark):
    on_workers(spark)
    rows = [(1, 0, "user", None, "c"), (1, 0, "user", None, "c"), (1, 1, None, "é😀", "c"), (None, 0, "assistant", "x", "c"),
            (2, None, "assistant", "<|im_end|>\n<\\|im_start|>", "c"), (2, 0, "a\n\\b<|", "y" * 100000, "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_events(chat.turn_events(df))).collect()}
    want = {1: [("user", ""), ("user", ""), ("", "é😀")], None: [("assistant", "x")],
            2: [("assistant", "<|im_end|>\n<\\|im_start|>"), ("a\n\\b<|", "y" * 100000)]}
    assert set(got) == set(want)
    for c, turns in want.items():
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert got[c]["loss_chars"] == sum(len(b) for a, b in turns if a == "assistant")
    assert chat.read_back(chat.format_events(chat.turn_events(df.limit(0)))).count() == 0


def test_redaction(spark):
    spans = F.expr("array(named_struct('k','a','s',2,'e',5), named_struct('k','b','s',3,'e',4),"
                   " named_struct('k','c','s',4,'e',7), named_struct('k','d','s',9,'e',10))")
    got = spark.range(1).select(redact(F.lit("01éé456789"), spans, lambda k: F.concat(F.lit("["), k, F.lit("]")))).first()[0]
    assert got == "01[a]78[d]"
