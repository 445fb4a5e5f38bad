
import random

import pytest

from slotbook.llm import decontaminate, html_text, pii, secret_scan
from slotbook.llm.common import on_workers


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    on_workers(spark)


def leaks(spark, docs, items):
    found = decontaminate.find_leaks(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
                                     spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    return {(r["doc_id"], x["item_id"]): x["lcs"] for r in found.collect() for x in r["leaks"]}


def test_op10_a_quote_does_not_hide_the_whole_item(spark):
    """A 16-word stretch of the item first, the whole item far after it."""
    r = random.Random(1)

    def some(n):
        return [f"x{r.randrange(10 ** 6)}" for _ in range(n)]

    item = [f"w{i}" for i in range(39)]
    docs = [some(40) + item[8:24] + some(pad) + item + some(30) for pad in (100, 101, 102, 103)]
    docs += [some(40) + item[8:24] + some(150), some(200)]
    got = leaks(spark, [" ".join(d) for d in docs], [" ".join(item)])
    assert got == {(d, 0): 1.0 for d in range(4)}


def test_op10_rare_words_in_place_of_an_item_s_own_do_not_hide_it(spark):
    """Words of no other text stand for 3 in 10 of the item's; most plain weight is theirs. Short items too."""
    r = random.Random(2)
    common = [f"c{i}" for i in range(60)]
    items = [[r.choice(common) for _ in range(n)] for n in (40, 32, 24, 6, 4)]
    docs, want = [], set()
    for i, w in enumerate(items[:3]):
        for _ in range(6):
            want.add((len(docs), i))
            copy = [f"rare{r.randrange(10 ** 9)}" if j % 10 in (2, 5, 8) else x for j, x in enumerate(w)]
            docs.append([f"u{r.randrange(10 ** 9)}" for _ in range(30)] + copy + [f"u{r.randrange(10 ** 9)}" for _ in range(30)])
    for i in (3, 4):
        want.add((len(docs), i))
        docs.append([f"u{r.randrange(10 ** 9)}" for _ in range(30)] + items[i] + [f"u{r.randrange(10 ** 9)}" for _ in range(30)])
    docs += [[r.choice(common) for _ in range(3)] + [f"f{r.randrange(10 ** 9)}" for _ in range(20)] for _ in range(400)]
    got = leaks(spark, [" ".join(d) for d in docs], [" ".join(w) for w in items])
    assert set(got) >= want and all(share >= 0.5 for share in got.values())


def test_op10_what_is_skipped_cannot_hold_a_leak():
    """The bound on an item's rarest words against a count of all of them."""
    import numpy as np
    r = random.Random(3)
    for _ in range(500):
        counts = np.array([r.choice([1, 1, 2, 5]) for _ in range(r.randrange(1, 12))])
        need = 0.5 * counts.sum()
        rare, least = decontaminate.telling(counts, np.array([r.random() for _ in counts]), need)
        for _ in range(30):
            held = [w for w in range(len(counts)) if r.random() < 0.5]
            assert counts[held].sum() < need or len(set(held) & set(rare)) >= least >= 1


def test_op7_unclosed_elements_do_not_swallow_the_page(spark):
    tree = html_text.train(spark)
    body = " ".join("a sentence of running text that goes on for a while".split() * 3)
    for before in ("<html><head><title>x</title>", "<html><head><meta charset=u><title>x</title><style>p{}</style>",
                   "<html><body><svg>", "<body><math>", "<body><object>", "<head></head><title>", "<body><template><iframe>"):
        assert html_text.main_text(f"{before}<article><p>{body}</p></article></html>", tree).endswith(body), before
    page = f"<body><article><p>{body} <math><mi>x</mi></math> and <object data=a>the rest</object></p></article></body>"
    assert html_text.main_text(page, tree) == f"{body} x and the rest"
    assert html_text.main_text(f"<body><article><p>{body}</p><script>var x = 1;", tree) == body
    assert html_text.main_text("<head>" * 9000 + "<svg>" * 9000 + "<title>" * 9000, tree) == ""


def test_op8_a_name_beside_a_secret_does_not_hide_it(spark):
    token, letters = "Zx81kQpL0mN4vB7tR2wY", "ZxQkpLvmNqBtRwYhGdJs"
    cases = {f"SAMPLE_APP_SIGNING={token}": token, f"APP_SIGNING={token}": token, f"see /examples/{token} now": token,
             f"/srv/dummy-{token}": token, f"{token}/sample": token, f"key {letters} end": letters, f"xxEXAMPLE{token}": None,
             "example_sample-placeholder/dummy": None, "getElementsByClassNameAndIndex": None,
             "/usr/share/applications/default-programs": None, "internationalization_of_words": None,
             "\U0001f600 sample=" + token: token, "sample" + "=" * 30000: None}
    got = secret_scan.scan_secrets(spark.createDataFrame([(t,) for t in cases], "text string")).collect()
    assert len(got) == len(cases)
    for r in got:
        spans = [r["text"][s["s"]:s["e"]] for s in r["secret_spans"] if s["k"] == "entropy"]
        want = cases[r["text"]]
        assert not spans if want is None else len(spans) == 1 and want in spans[0], (r["text"][:80], spans)


def test_op2_other_numbers_do_not_cut_a_mention_s_surroundings(spark):
    near = "\U0001f600 Kowalski, born 1971, card 4111 1111 1111 1111, house 12, street Lindenhof"
    rows = [f"{'é' * 1990 + ' ' if i % 2 else ''}{near} note {'abcdefgh'[i]}" for i in range(6)]
    rows += [f"born in a house on the street, note and card {i}" for i in range(300)]
    got = pii.find_personal_data(spark.createDataFrame([(t,) for t in rows], "text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        terms = {r["text"][s["s"]:s["e"]] for s in r["pii_spans"] if s["k"] == "term"}
        # the padding, where there is some, is a word that only these texts hold
        own = {"Kowalski", "Lindenhof"} | ({"é" * 1990} if r["text"].startswith("é") else set())
        assert terms == (own if "Kowalski" in r["text"] else set())
