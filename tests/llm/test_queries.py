"""Every registered query of the subpackage on the smallest tables, against plain Python."""

import hashlib
import os
from collections import defaultdict

import brute as B
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from slotbook.llm import queries as Q
from slotbook.llm.common import table, written

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


def rows(spark, sf_dir, name):
    return [r.asDict() for r in Q.QUERIES[name](spark, sf_dir).collect()]


def token_ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path(Q.WORD_BPE))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def spans_text(spans, order):
    return [f"{k}:{a}:{e}" for k in order for a, e in spans[k]]


def test_registered_names():
    import __spark_entry__ as E
    assert {f"op{i}_" for i in range(1, 14)} <= {n.split("_")[0] + "_" for n in E.queries()}
    assert "pipeline" in E.queries()


def test_ngram_join(spark, sf_dir, docs):
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(spark, sf_dir, "op1_ngram_join"))
    assert got == sorted(B.near_duplicates(docs))


def test_pii(spark, sf_dir, docs):
    got = {r["doc_id"]: r for r in rows(spark, sf_dir, "op2_pii")}
    assert len(got) == len(docs)
    for d, text in docs:
        want = B.pii_base(text)
        assert [got[d][f"n_{k}"] for k in want] == [len(v) for v in want.values()], d
        assert got[d]["base_sha256"] == B.digest(spans_text(want, want)), d
        assert got[d]["spans"].split(",")[:sum(map(len, want.values()))] == (spans_text(want, want) or got[d]["spans"].split(",")[:0])


def test_url_filter(spark, sf_dir):
    urls = dict(tuple(r) for r in table(spark, sf_dir, "pages").select("page_id", "url").collect())
    rules = [(h, p, a) for h, p, a in Q.URL_RULES]
    for r in rows(spark, sf_dir, "op3_url_filter"):
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == B.url_verdict(urls.pop(r["page_id"]), rules)
    assert not urls


def test_token_count(spark, sf_dir, docs):
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows(spark, sf_dir, "op4_token_count")}
    ids = token_ids([t for _, t in docs])
    assert got == {d: (len((t or "").encode()), len(i), len(i) > 2048) for (d, t), i in zip(docs, ids, strict=True)}


def check_pieces(pieces, ids, window=4096):
    """Every id in one piece, sequences gapless, padding only where there is no power of two."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        whole = [*ids[r["doc_id"]], 2]
        assert r["doc_tokens"] == len(whole)
        assert r["ids_crc32"] == B.crc(whole[r["start"]:r["start"] + r["length"]])
    assert set(by_doc) == set(ids)
    for d, some in by_doc.items():
        at = 0
        for r in sorted(some, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0
            at += r["length"]
        assert at == len(ids[d]) + 1
    for some in by_seq.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at == window or at < window and at & (at - 1) == 0


def test_packing(spark, sf_dir, docs):
    ids = dict(zip([d for d, _ in docs], token_ids([t for _, t in docs]), strict=True))
    check_pieces(rows(spark, sf_dir, "op5_packing"), ids)


def test_quality(spark, sf_dir, docs):
    got = {r["doc_id"]: r for r in rows(spark, sf_dir, "op6_quality")}
    labels = dict(tuple(r) for r in table(spark, sf_dir, "labels").select("doc_id", "quality").collect())
    for d, text in docs:
        r = got[d]
        base = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert base == B.quality_base(text), d
        assert not (r["base_failed"] and r["kept"])
        if labels.get(d) == 1 and not r["base_failed"]:
            assert r["kept"], d        # clean documents stay


def test_html_text(spark, sf_dir):
    import html
    import re
    pages = dict(tuple(r) for r in table(spark, sf_dir, "pages").select("page_id", "html").collect())
    for r in rows(spark, sf_dir, "op7_html_text"):
        article = re.search(r"(?s)<article>(.*?)(</article>|$)", pages.pop(r["page_id"]))[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
    assert not pages


def test_secret_scan(spark, sf_dir, docs):
    got = {r["doc_id"]: r for r in rows(spark, sf_dir, "op8_secret_scan")}
    order = ["assign", "access", "hex"]
    for d, text in docs:
        want = B.secrets_base(text)
        spans = [f"{k}:{a}:{e}" for a, _, k, e in sorted((a, order.index(k), k, e) for k in order for a, e in want[k])]
        assert [got[d][f"n_{k}"] for k in order] == [len(want[k]) for k in order], d
        assert got[d]["base_sha256"] == B.digest(spans), d
        assert set(spans) <= set(got[d]["spans"].split(",")) | ({""} if not spans else set()), d


def test_chat_format(spark, sf_dir):
    conv = defaultdict(list)
    for r in table(spark, sf_dir, "conversations").orderBy("conv_id", "turn").collect():
        conv[r["conv_id"]].append((r["role"], r["text"] or ""))
    conv[-1] = [("user", Q.PLANTED_TURN), ("assistant", Q.PLANTED_TURN)]
    for r in rows(spark, sf_dir, "op9_chat_format"):
        turns = conv.pop(r["conv_id"])
        learnt = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
        assert r["formatted_chars"] > sum(len(t) for _, t in turns)
    assert not conv


def holders(docs, items, share=0.5):
    """(doc, item) pairs that share that part of the item's 3-word sequences."""
    import re
    words = lambda s: re.findall(r"[^\W_]+", (s or "").lower())
    grams = lambda w: {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    inside = [(d, grams(words(t))) for d, t in docs]
    return {(d, i) for i, t in items for d, g in inside if (w := grams(words(t))) and len(w & g) >= share * len(w)}


def test_decontaminate(spark, sf_dir, docs):
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in rows(spark, sf_dir, "op10_decontaminate")}
    assert got == holders(docs, items)


def test_pipeline_stage_by_stage(spark, sf_dir):
    """Each stage against plain Python over what its predecessor kept."""
    read = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    at = table(spark, sf_dir, "documents")
    (_, quality), (_, join), (_, bench), (_, secrets), (_, pack) = corpus_pipeline.STAGES
    before, kept = read(at), written(quality(spark, at, sf_dir), "t")
    after = read(kept)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert all(after[d] == before[d] for d in after)
    assert not any(B.quality_base(t)[-1] for t in after.values())
    labels = dict(tuple(r) for r in table(spark, sf_dir, "labels").select("doc_id", "quality").collect())
    assert all(d in after for d, t in before.items() if labels.get(d) == 1 and not B.quality_base(t)[-1])
    one = written(join(spark, kept, sf_dir), "t")
    groups = B.near_duplicates(list(after.items()))
    assert read(one) == {d: after[d] for d, _, c in groups if d == c}
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    clean = written(bench(spark, one, sf_dir), "t")
    leaks = {d for d, _ in holders(list(read(one).items()), items)}
    assert read(clean) == {d: t for d, t in read(one).items() if d not in leaks}
    safe = written(secrets(spark, clean, sf_dir), "t")
    for d, t in read(safe).items():
        assert not any(B.secrets_base(t).values()), d
        if not any(B.secrets_base(read(clean)[d]).values()) and "[SECRET]" not in t:
            assert t == read(clean)[d]
    assert safe.filter(F.length("text") != F.col("n_chars")).count() == 0
    final = [r.asDict() for r in pack(spark, safe, sf_dir).collect()]
    texts = read(safe)
    check_pieces(final, dict(zip(texts, token_ids(texts.values()), strict=True)))
    whole = [r.asDict() for r in corpus_pipeline.run(spark, sf_dir).collect()]
    key = lambda r: (r["doc_id"], r["start"])
    assert [(key(r), r["length"], r["ids_crc32"]) for r in sorted(whole, key=key)] == [
        (key(r), r["length"], r["ids_crc32"]) for r in sorted(final, key=key)]
