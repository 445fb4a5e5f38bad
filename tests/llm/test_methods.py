"""Operators on small tables that were made to exercise their methods."""

import random

import brute as B
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from slotbook.llm import chat, decontaminate, html_text, ngram_join, packing, pii, secret_scan, token_count, url_filter
from slotbook.llm.common import on_workers
from slotbook.llm.queries import WORD_BPE

WORDS = public_tokenizers.path(WORD_BPE)


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    on_workers(spark)


def test_join_of_large_groups_and_shared_passages(spark):
    """More near copies than a rare token may have nodes, and passages that many texts share."""
    r = random.Random(5)

    def some(n):
        return [f"w{r.randrange(10 ** 6)}" for _ in range(n)]

    base, passage, docs = some(120), some(60), []
    for _ in range(40):
        t = list(base)
        for _ in range(r.randrange(7)):
            t[r.randrange(len(t))] = f"e{r.randrange(10 ** 6)}"
        docs.append(t)
    docs += [passage + some(r.randrange(5, 60)) for _ in range(30)]
    docs += [passage + base[:r.randrange(20, 120)] for _ in range(25)] + [some(r.randrange(1, 80)) for _ in range(20)]
    rows = [(i, " ".join(t)) for i, t in enumerate([*docs, *docs[:9]])]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                                        rules=ngram_join.JoinRules(rare=4))
    assert sorted(tuple(x) for x in got.collect()) == sorted(B.near_duplicates(rows))


def test_huge_texts_are_cut_and_spliced(spark):
    """Texts far over the limit, some without a boundary in the overlap."""
    from tokenizers import Tokenizer
    r = random.Random(2)
    texts = [" ".join("".join(r.choice("abcé'.9") for _ in range(r.randrange(1, 9))) for _ in range(n)) for n in (30, 300, 900)]
    texts += ["z" * 700 + " end", "ab " * 50 + "y" * 900 + " cd" * 90, " " * 800, "<|endoftext|>" * 60]
    df = spark.createDataFrame(list(enumerate(texts * 2)), "uid long, text string")
    got = token_count.count_tokens(df, WORDS, cutting=token_count.Cutting(huge=200, step=128, overlap=16)).collect()
    t = Tokenizer.from_file(WORDS)
    assert len(got) == len(texts) * 2
    assert all(x["n_tokens"] == len(t.encode(x["text"], add_special_tokens=False).ids) for x in got)


def test_packing_to_given_weights(spark):
    rows = [(i, "a" if i % 4 else "b", f"word {i} " * 40) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    p = packing.Packing(window=512, packet=16)
    got = packing.pack(df, WORDS, p, weights={"a": 1.0, "b": 1.0}).collect()
    kind = {i: s for i, s, _ in rows}
    early = [r for r in got if r["sequence_id"] < 8]        # both queues still hold tokens
    shares = [sum(r["length"] for r in early if kind[r["doc_id"]] == s) / (8 * 512) for s in "ab"]
    assert all(abs(s - 0.5) < 0.05 for s in shares)


def test_terms_that_disclose_an_entity(spark):
    near = "the surgeon Quillfeather answers at q.f@clinic.example.com every day"
    rows = [(i, f"{near} note {'abcdefgh'[i]}") for i in range(6)]
    rows += [(100 + i, f"the day is long and every surgeon answers letters {i}") for i in range(300)]
    rows += [(500, "Quillfeather alone"), (501, "write to once@x.example.org the day")]
    got = {r["doc_id"]: r for r in pii.find_personal_data(
        spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", "text", "pii_spans", pii.sanitised(F.col("text"),
                                                     F.col("pii_spans")).alias("safe")).collect()}
    words = {got[0]["text"][s["s"]:s["e"]] for s in got[0]["pii_spans"] if s["k"] == "term"}
    assert "Quillfeather" in words and not words & {"the", "day", "every", "surgeon", "answers"}
    assert got[0]["safe"].startswith("the surgeon  answers at [EMAIL] every day")
    assert not got[100]["pii_spans"] and [s["k"] for s in got[501]["pii_spans"]] == ["email"]


def test_entropy_and_its_allow_list(spark):
    token = "Zx81kQpL0mN4vB7tR2wY"
    cases = {f"key {token} end": [token], "id 123e4567-e89b-12d3-a456-426614174000": [], "0123456789abcdefghij": [],
             "aaaaaaaaaaaaaaaaaaaaaaaaaaaa1": [], "internationalization2024": [], f"xxEXAMPLE{token}": [],
             "9f86d081884c7d659a2feaa0c55ad015": ["9f86d081884c7d659a2feaa0c55ad015"],
             "2024-01-01_2024-02-02_2024-03-03": []}
    got = secret_scan.scan_secrets(spark.createDataFrame([(t,) for t in cases], "text string")).collect()
    for r in got:
        assert [r["text"][s["s"]:s["e"]] for s in r["secret_spans"] if s["k"] == "entropy"] == cases[r["text"]], r["text"]


def test_many_nested_url_rules(spark):
    r = random.Random(4)
    names = ["com", "a.com", "b.a.com", "c.b.a.com", "x-a.com", "aa.com", "net", "a.net", "-.net"]
    rules = [(h, p, r.choice(["allow", "block"])) for h in names for p in ("/", "/e", "/e/f", "") if r.random() < 0.5]
    urls = [f"s://{r.choice(['', 'w.', 'b.', 'c.b.'])}{r.choice(names)}{r.choice(['', '/', '/e', '/e/f/g', '/x?e'])}" for _ in range(300)]
    got = url_filter.filter_urls(spark.createDataFrame([(u,) for u in urls], "url string").repartition(3),
                                 url_filter.rules_table(spark, rules)).collect()
    assert len(got) == 300
    for x in got:
        assert (x["host"], x["path"], x["rule"], x["verdict"]) == B.url_verdict(x["url"], rules), x["url"]


def test_regenerated_turns_void_what_followed(spark):
    rows = [(1, 0, 0, "start", "user", "q"), (1, 1, 1, "start", "assistant", "a"), (1, 2, 2, "start", "user", "r"),
            (1, 3, 3, "start", "assistant", "s"), (1, 1, 4, "regenerate", None, "b"), (1, 2, 5, "start", "user", "t")]
    got = chat.format_events(spark.createDataFrame(
        rows, "conv_id long, turn long, seq long, kind string, role string, text string")).collect()
    assert [chat.parse(x["piece"]) for x in got] == [("user", "q"), ("assistant", "b"), ("user", "t")]
    assert [x["piece_start"] for x in got] == [0, len(got[0]["piece"]), len(got[0]["piece"]) + len(got[1]["piece"])]


def test_paraphrased_items_are_found_and_clean_texts_left(spark):
    """Copies, copies with a sixth of the words changed, and texts that share only common words."""
    r = random.Random(9)
    common = [f"c{i}" for i in range(40)]

    def prose(n):
        return [r.choice(common) if r.random() < 0.5 else f"w{r.randrange(3000)}" for _ in range(n)]

    items = [(i, prose(r.randrange(14, 60))) for i in range(40)]
    docs, planted = [], set()
    for d in range(240):
        t = prose(r.randrange(40, 300))
        if d % 3 == 0:
            i, w = items[r.randrange(40)]
            w = [x if d % 2 or r.random() > 1 / 6 else f"n{r.randrange(10 ** 6)}" for x in w]
            at = r.randrange(len(t))
            t = t[:at] + w + t[at:]
            planted.add((d, i))
        docs.append((d, " ".join(t)))
    found = decontaminate.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame([(i, " ".join(w) + ".") for i, w in items], "item_id long, text string"))
    got = {(x["doc_id"], y["item_id"]) for x in found.collect() for y in x["leaks"]}
    assert got <= planted and len(got) >= 0.9 * len(planted)


def test_pages_of_other_shapes(spark):
    tree = html_text.train(spark)
    p = "<p>" + "a sentence of running text that goes on for a while " * 3 + "</p>"
    body = " ".join("a sentence of running text that goes on for a while".split() * 3)
    links = "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(5))
    for page in (f"<header><h1>Site</h1><ul>{links}</ul></header><main>{p}{p}</main><footer>{p}</footer>",
                 f"<ul class=menu>{links}</ul><div id=content>{p}<div class='ad banner'>{p}</div>{p}</div><div class=comments>{p}</div>",
                 f"<table><tr><td>{links}</td><td>{p}{p}</td></tr></table>",
                 f"<article>{p}<form>{p}</form>{p}<aside>{p}</aside></article><section class=related><a href=/>{p}</a></section>"):
        assert html_text.main_text(f"<html><body>{page}</body></html>", tree) == f"{body}\n{body}"
