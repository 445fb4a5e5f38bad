"""Main text of pages whose wrappers carry furniture names, and of pages without names."""

import pytest

from slotbook.llm import html_text as H

P1, P2 = ("First paragraph of the story that runs over enough words to be seen as running text by anyone.",
          "Second paragraph of it, which also runs on for a good number of words, and then some more of them.")
BODY = f"<h1>A head line</h1><p>{P1}</p><p>Short one.</p><p>{P2}</p>"
TEXT = f"A head line\n{P1}\nShort one.\n{P2}"
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(5)) + "</ul>"
COMMENTS = "<div class=comments>" + "".join(f"<article><p>{P1} {P2}</p></article>" for _ in range(9)) + "</div>"


@pytest.fixture(scope="module")
def tree(spark):
    return H.train(spark)


@pytest.mark.parametrize("page", [
    f"<body class='single has-sidebar'><nav>{MENU}</nav><article>{BODY}</article><footer>Owner and year</footer></body>",
    f"<body><nav>{MENU}</nav><article class='post comments-open'>{BODY}</article><footer>Owner and year</footer></body>",
    f"<body><nav>{MENU}</nav><main class='page notice'>{BODY}</main></body>",
    f"<body><nav>{MENU}</nav><div class='post share-enabled'>{BODY}</div></body>",
    f"<body><form id=aspnetForm><nav>{MENU}</nav><article>{BODY}</article></form></body>",
    f"<body><div id=page-with-banner><div id=menu>{MENU}</div><div>{BODY}</div></div></body>",
    f"<body><article>{BODY}</article>{COMMENTS}</body>",
    f"<body><div class=post>{BODY}<div class=ad>Buy this today</div></div><aside><p>{P1}</p></aside></body>",
    f"<body>{MENU}{BODY}{MENU}</body>",
    f"<body><table><tr><td>{MENU}</td><td>{BODY}</td></tr></table>{MENU}<p><a href=/>Home</a></p></body>",
])
def test_article_of_the_page(tree, page):
    assert H.main_text(page, tree) == TEXT


def test_tree_goes_by_words_and_links_of_block_and_neighbours(tree):
    used = set()

    def walk(t):
        if len(t) > 1:
            used.add(H.FEATURES[t[0]])
            walk(t[2])
            walk(t[3])
    walk(tree)
    assert {"words", "links"} <= used
    assert used & {"words_before", "words_after"} and used & {"links_before", "links_after"}


def test_held_out_unnamed_pages(tree):
    """Pages of other sizes than the tree was trained on: at least 95 % of blocks right."""
    right = total = 0
    for page, labels in H.varied_pages(160, named=False)[80:]:
        got = [H.is_content(tree, x) for x in H.features(H.blocks_of(page))]
        right += sum(g == (y == "1") for g, y in zip(got, labels, strict=True))
        total += len(labels)
    assert right >= 0.95 * total
