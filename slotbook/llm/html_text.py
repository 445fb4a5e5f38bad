"""Main text of HTML pages from flat text blocks and a decision tree.

Markup is read once into flat blocks: the text between two block-level tags.
A block's features are its number of words and its link density, those of the
block before and after it, and whether an enclosing element is named as content
or as page furniture.  A name counts for the element's own part of the page alone: an
element around the page's main heading, or around nearly all its words, is no furniture whatever
it is called, and where a name of content stands beside one of furniture the former counts.
A small labelled table of pages (below), with and without names, trains a decision tree on
these features; blocks that it takes for content, in page order, are the text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Elements and name parts of HTML pages.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir
    div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li
    main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul""".split())
NESTED = frozenset("""article aside blockquote body button details dialog div dl fieldset figure footer
    form header html main menu nav ol section select table td ul""".split())
UNSEEN = frozenset("head iframe noscript script style svg template textarea title".split())
RAW = frozenset("script style".split())               # all that follows is no markup until the end tag
HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())
FURNITURE_TAGS = frozenset("aside button dialog footer form menu nav select".split())
CONTENT_TAGS = frozenset("article main".split())
FURNITURE = frozenset("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs
    comment comments consent cookie cookies disqus footer login masthead menu modal nav navbar navigation
    newsletter notice notices pagination popup promo related replies reply respond share sharing sidebar
    signup social sponsor sponsored subscribe toolbar widget""".split())
CONTENT = frozenset("article content entry main post story".split())
PAGE_TAGS = frozenset("article body html main".split())      # never furniture by a name
WRAPPER = 0.9        # share of a page's words from which an element is around the page

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
    |<[!?/][^>]*>
    |<(?P<odd>[a-zA-Z])[^>]*>""", re.S | re.X)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after",
            "in_content", "in_furniture")


@dataclass
class Block:
    text: str
    words: int
    links: float          # share of words inside links
    content: bool
    furniture: bool


def _names(attrs: str) -> set[str]:
    found = (a or b or c for a, b, c in NAMED.findall(attrs))
    return {x for f in found for x in re.split(r"[^a-z0-9]+", f.lower())}


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []       # tag, in content, number of the element
    elements: list[list] = []                     # [furniture, enclosing element, words inside, holds the main heading]
    within: list[int] = []                        # the element that each block lies in
    heading = False
    parts: list[tuple[str, bool]] = []
    in_link, at, n = False, 0, len(page)
    last = page.rfind(">")                        # no tag ends after it
    unclosed: set[str] = set()                    # elements without an end tag from here on

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
            if text:
                words = len(text.split(" "))
                linked = sum(len(t.split()) for t, link in parts if link)
                _, content, number = stack[-1] if stack else ("", False, -1)
                out.append(Block(text, words, min(1.0, linked / words), content, False))
                within.append(number)
                while number >= 0:
                    elements[number][2] += words
                    number = elements[number][1]
            parts.clear()

    while at < n:
        m = TOKEN.search(page, at) if at <= last else None
        if m is None:
            cut = page.find("<!--", at)           # a comment that is never closed
            parts.append((page[at:] if cut < 0 else page[at:cut], in_link))
            break
        if m.start() > at:
            parts.append((page[at:m.start()], in_link))
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in UNSEEN and not m["end"]:
            if not m["attrs"].endswith("/"):
                close = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if close:
                    at = close.end()
                elif tag in RAW:
                    at = n
                else:                              # never closed: empty, but for a head's own elements
                    unclosed.add(tag)
                    at = _head_end(page, at) if tag == "head" else at
            continue
        if tag == "a":
            in_link = not m["end"]
        elif tag == "br":
            parts.append((" ", in_link))
        elif tag in BLOCKS:
            flush()
            in_link = False
            if tag == "h1" and not m["end"] and not heading:
                heading, number = True, stack[-1][2] if stack else -1
                while number >= 0:
                    elements[number][3] = True
                    number = elements[number][1]
            if tag in NESTED:
                if m["end"]:
                    if any(t == tag for t, _, _ in stack):
                        while stack.pop()[0] != tag:
                            pass
                elif not m["attrs"].endswith("/"):
                    _, content, number = stack[-1] if stack else ("", False, -1)
                    names = _names(m["attrs"]) if "=" in m["attrs"] else set()
                    own = tag in CONTENT_TAGS or not names.isdisjoint(CONTENT)
                    head = tag == "header" or "header" in names
                    named = not names.isdisjoint(FURNITURE) and not own and tag not in PAGE_TAGS
                    elements.append([tag in FURNITURE_TAGS or named or (head and not content), number, 0, False])
                    stack.append((tag, content or own, len(elements) - 1))
    flush()
    total = sum(b.words for b in out)
    furniture: list[bool] = []
    for named, around, words, main in elements:           # enclosing elements come first
        wrapper = main or words > WRAPPER * total
        furniture.append((named and not wrapper) or (around >= 0 and furniture[around]))
    for b, number in zip(out, within, strict=True):
        b.furniture = number >= 0 and furniture[number]
    return out


def _head_end(page: str, at: int) -> int:
    """Where an unclosed head ends: at the first tag of another element, or text outside of its own."""
    unclosed: set[str] = set()
    while at < len(page):
        m = TOKEN.search(page, at) if page.find(">", at) >= 0 else None
        if m is None or page[at:m.start()].strip():
            return at
        tag = (m["tag"] or "").lower()
        if tag and tag not in HEAD:
            return m.start()
        at = m.end()
        if tag in UNSEEN and tag != "head" and not m["end"] and not m["attrs"].endswith("/") and tag not in unclosed:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if close:
                at = close.end()
            elif tag in RAW:
                return len(page)
            else:
                unclosed.add(tag)
    return at


def features(blocks: list[Block]) -> list[tuple[float, ...]]:
    """One row of ``FEATURES`` per block; a missing neighbour counts as empty."""
    size = [(float(b.words), b.links) for b in blocks]
    none = (0.0, 0.0)
    return [(*size[i], *(size[i - 1] if i else none), *(size[i + 1] if i + 1 < len(size) else none),
             float(b.content), float(b.furniture)) for i, b in enumerate(blocks)]


_P = "<p>" + "words of running text in a paragraph " * 5 + "</p>"
_S = "<p>Two words.</p>"
_L = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(4))
_W = "some words of an advert or of a notice that sits between the menu and the text".split()
_N = "".join(f"<div class='{c}'>{' '.join(_W[:n])}</div>" for n, c in (
    (2, "ad"), (4, "notice"), (5, "banner"), (7, "ad"), (9, "cookie-bar"), (12, "promo"), (17, "sidebar")))
#: Pages and, for each of their blocks, 1 for main text and 0 for the rest.
LABELLED = (
    (f"<body><nav><ul>{_L}</ul></nav><div class=ad>Buy it now here today.</div><article><h1>A short head"
     f"</h1>{_P}{_S}{_P}</article><footer>Owner and year of page</footer></body>", "0000" "0" "1111" "0"),
    (f"<body><header><p>Site name</p><ul>{_L}</ul></header><main><h1>Head</h1>{_S}{_S}{_P}</main>"
     f"<aside><p>About us</p>{_P}</aside><footer>{_P}</footer></body>", "00000" "1111" "00" "0"),
    (f"<body><div id=menu>{_L}</div><div class=post><h2>Head of it</h2>{_P}{_P}<ul><li>first point of it</li>"
     f"<li>second</li></ul></div><div class=comments>{_P}{_S}</div></body>", "0000" "11111" "00"),
    (f"<body><ul>{_L}</ul><h1>Head without a name</h1>{_P}{_P}{_P}<ul>{_L}</ul></body>", "0000" "1111" "0000"),
    (f"<body><table><tr><td>{_L}</td><td>{_P}{_P}</td></tr></table><p>Owner and year</p></body>", "0000" "11" "0"),
    (f"<body><article><p>{_S}</p><form>{_P}Send it off</form>{_P}<div class='cookie-notice'>{_P}</div>"
     f"<section id=comments><article>{_P}</article></section></article></body>", "1" "00" "1" "0" "0"),
    (f"<body><main><p><a href=/x>All of it one link</a></p>{_P}{_S}</main><div class=sidebar>{_P}<ul>{_L}</ul>"
     f"</div><div class='newsletter'>Sign up for the letter</div></body>", "111" "00000" "0"),
    (f"<body><p>Share</p><p>Print</p>{_P}{_P}<p>Top</p><p><a href=/>Home</a></p></body>", "00" "11" "00"),
    (f"<body><article>{_S}</article><footer>Owner</footer></body>", "1" "0"),
    (f"<body><nav>{_L}</nav><article>{_P}<ul>{_L}</ul>{_S}</article></body>", "0000" "1" "1111" "1"),
    (f"<body>{_N}<div>{_P}{_P}</div>{_N}</body>", "0000000" "11" "0000000"),
    (f"<body><main>{_N}<h1>Head of the page</h1>{_P}{_N}{_S}</main></body>", "0000000" "11" "0000000" "1"),
    (f"<body><div>Four words stand here</div><div>{_P}</div><div>Four words stand here</div></body>", "010"),
)


def varied_pages(n: int = 80, named: bool = True) -> list[tuple[str, str]]:
    """Labelled pages: menus and lists of links before and after, a line of site or owner, lone links, a
    heading, paragraphs long and short, a short line between, links inside running text.  On half of them (on all,
    unless ``named``) no element has a name, so that words and link density of a block and of its neighbours are
    what separates; on the others the article, or what stands around it, has one."""
    word, pages = "text", []

    def block(words: int, linked: int = 0, tag: str = "p") -> str:
        a = f"<a href=/x>{' '.join([word] * linked)}</a> " if linked else ""
        return f"<{tag}>{a}{' '.join([word] * (words - linked))}</{tag}>"

    for i in range(n):
        menu = [block(1 + (i + j) % 3, 1 + (i + j) % 3, "li") for j in range(3 + i % 6)]
        line = [block(2 + (3 * i) % 9)] if i % 3 else []          # the site's name, beside the menu
        body = [block(2 + i % 8, tag=f"h{1 + i % 3}")]
        for j in range(3 + i % 4):
            body.append(block(14 + (7 * i + 23 * j) % 90, (i + j) % 4))
            if (i + j) % 3 == 0:
                body.append(block(2 + (i + j) % 7))               # a short line between paragraphs
            if (i + j) % 5 == 1:
                body.append(block(2 + j, tag="h2"))
        body.append(block(12 + (11 * i) % 40))
        lone = [block(1 + j % 2, 1 + j % 2) for j in range(i % 3)]
        more = [block(2 + (i + j) % 6, 2 + (i + j) % 6, "li") for j in range(2 + i % 5)]
        owner = [block(3 + i % 9, i % 2)] if i % 4 else []
        before = menu + line if i % 3 else line + menu
        after = [] if i % 7 == 0 else lone + more + owner
        if i % 11 == 0:
            before = []
        kind = i % 4 if named else 0
        if kind == 1:           # a named article, which may hold lists of links and short lines at its ends
            body += [[], [block(2 + i % 3, 2, "li")] * 3, [block(3 + i % 5)]][i // 4 % 3]
        inner = "".join(body)
        page = ("".join(before) + (f"<article>{inner}</article>" if kind == 1 else inner) + "".join(after) if kind != 3 else
                f"<nav>{''.join(before)}</nav><div>{inner}</div><div class=related>{''.join(after)}{block(30)}</div>")
        pages.append((f"<body>{page}</body>", "0" * len(before) + "1" * len(body) + "0" * (len(after) + (kind == 3))))
    return pages


def train(spark: SparkSession, labelled=None, depth: int = 8) -> tuple:
    """The decision tree as nested tuples: (feature, limit, left, right) or (0 or 1,).

    The labelled table is bounded: the rows given, by default those above and of ``varied_pages``.
    """
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors
    rows = []
    for page, labels in labelled or [*LABELLED * 2, *varied_pages()]:
        f = features(blocks_of(page))
        rows += [(float(y), Vectors.dense(x)) for x, y in zip(f, labels, strict=True)]
    table = spark.createDataFrame(rows, ["label", "features"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(table)

    def node(n) -> tuple:
        if n.numDescendants() == 0:
            return (int(n.prediction()),)
        s = n.split()
        return s.featureIndex(), s.threshold(), node(n.leftChild()), node(n.rightChild())

    return node(model._call_java("rootNode"))


def is_content(tree: tuple, x: tuple[float, ...]) -> bool:
    while len(tree) > 1:
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree[0] == 1


def main_text(page: str, tree: tuple) -> str:
    blocks = blocks_of(page)
    return "\n".join(b.text for b, x in zip(blocks, features(blocks), strict=True) if is_content(tree, x))


def extract(pages: DataFrame, tree: tuple, source: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``: the main text of each page ('' for null or empty html, and for pages
    without content blocks).  Other columns and repeated rows are kept; a column
    called ``out`` is replaced."""
    cols = [F.col(f"`{c}`") for c in pages.columns if c != out]
    return pages.select(*cols, text_of(F.col(source), tree).alias(out))


def text_of(page: Column, tree: tuple) -> Column:
    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "", tree) for p in column], pa.string())

    return text(page)
