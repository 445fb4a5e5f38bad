"""Disclosing terms and hints against point-wise mutual information in plain Python."""

import math
import random
import re
from collections import defaultdict

import brute as B
from pyspark.sql import functions as F

from slotbook.llm import pii
from slotbook.llm import queries as Q
from slotbook.llm.common import on_workers, table

TERM = re.compile(r"(?<![^\W_])(?<![@.%+-])(?<!_)[^\W\d_]{3,}(?![^\W_]|@|[._%+-][^\W_])")


def entities(text):
    out = set()
    for kind, spans in B.pii_base(text).items():
        for a, e in spans:
            v = text[a:e]
            v = v if kind == "ip" else v.lower() if kind == "email" else re.sub("[^0-9]", "", v)
            group = {"email": v.split("@")[-1], "ip": ".".join(v.split(".")[:2]), "card": v[:6], "phone": v[:4]}[kind]
            out |= {(f"{kind}:={v}", False), (f"{kind}:~{group}", True), (f"{kind}:", True)}
    return out


def disclosed(texts, d):
    """{term: whether a class alone} by counting all pairs of all documents."""
    n_e, n_t, n_te, seen = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set)
    for t in texts:
        words = {w.lower() for w in TERM.findall(t or "")}
        found = entities(t or "")
        for w in words:
            n_t[w] += 1
        for e in found:
            n_e[e] += 1
            for w in words:
                n_te[e, w] += 1
                seen[e, w].add(t)
    out = {}
    for (e, w), n in n_te.items():
        info = math.log2(len(texts) / n_e[e])
        pmi = math.log2(n * len(texts) / (n_t[w] * n_e[e]))
        if info > 0 and pmi >= d.alpha * info - 1e-12 and len(seen[e, w]) >= (d.class_support if e[1] else d.support):
            out[w] = out.get(w, True) and e[1]
    return out


def spans_of(text, flagged):
    found = [(m[0].lower(), *m.span()) for m in TERM.finditer(text or "")]
    return ([("term", a, e) for w, a, e in found if flagged.get(w) is False]
            + [("hint", a, e) for w, a, e in found if flagged.get(w) is True])


def corpus():
    rng = random.Random(4)
    words = ["river", "stone", "lamp", "cloud", "tree", "Über", "wheel", "glass", "sand", "field"]
    out = []
    for i in range(300):
        body = " ".join(rng.choice(words) for _ in range(60))
        if i % 20 == 0:      # a value that recurs, far from the word that gives it away
            body = f"Kowalski wrote {body} to ann@corp.example.org about it"
        elif i % 23 == 1:    # a class: values differ, the word is the same
            body = f"{body} payroll of 10.7.{i}.9 and more"
        elif i == 7 or i == 8:
            body += " Kowalski payroll"        # without any mention
        out.append(body)
    return [*out, None, "", out[0], out[0]]


def test_terms_equal_all_pairs(spark):
    on_workers(spark)
    texts, d = corpus(), pii.Disclosure()
    want = disclosed(texts, d)
    assert want["kowalski"] is False and want["payroll"] is True and "river" not in want
    got = pii.find_personal_data(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    for r in got:
        base = [(k, a, e) for k, v in B.pii_base(r["text"]).items() for a, e in v]
        assert [tuple(s) for s in r["pii_spans"]] == base + spans_of(r["text"], want), r["doc_id"]
    clean = pii.sanitised(F.col("text"), F.col("pii_spans"))
    text = pii.find_personal_data(spark.createDataFrame([(t,) for t in texts], "text string")).select(clean).collect()
    assert not any("kowalski" in (t[0] or "").lower() or "payroll" in (t[0] or "") for t in text)
    assert any("[HINT] of [IP]" in (t[0] or "") for t in text)


def test_terms_of_the_given_documents(spark):
    """sf0.1: the flagged terms are those of all pairs, there are some, and documents without an entity stay nearly
    all clean."""
    sf = "/root/testdata/sf0.1"
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    want = disclosed([t for _, t in docs], pii.Disclosure())
    got = {r["doc_id"]: r for r in Q.QUERIES["op2_pii"](spark, sf).collect()}
    for d, t in docs:
        spans = spans_of(t, want)
        assert (got[d]["n_term"], got[d]["n_hint"]) == (sum(s[0] == "term" for s in spans), sum(s[0] == "hint" for s in spans)), d
    assert want
    clean = [r for r in got.values() if r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] == 0]
    assert sum(r["n_term"] + r["n_hint"] > 0 for r in clean) <= len(clean) / 1000
