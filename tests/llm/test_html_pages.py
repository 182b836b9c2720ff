"""Main texts through a DataFrame: layout classes, wrapping forms, several articles and sections, deep nesting; a plain scorer."""

import random
import time

import pytest

from tidewater.llm import common, html

PARAS = [f"Paragraph number {i}, with commas, and enough words to count as prose in a text." for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PARAS)
TEXT = "\n".join(PARAS)
SIDE = "<div class='sidebar'><p>Read this, and that, and more of the same, in the side bar of the page.</p></div><footer><p>All rights, and so on, reserved to the one who owns the page here.</p></footer>"
MENU = "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>"


def wrapped(name):
    return f"<html><body>{MENU}<div class='{name}'>{BODY}</div>{SIDE}</body></html>"


CASES = [
    *[(wrapped(n), TEXT) for n in ("content", "content has-sidebar", "has-sidebar", "no-comments", "search-results", "share-story", "tags-news", "page-with-menu widget")],
    (f"<body>{MENU}<form action=/x id=aspnet><div>{BODY}</div></form>{SIDE}", TEXT),
    (f"<body><form class='has-sidebar'>{MENU}<article>{BODY}</article><div class='comments'><p>Nice, very nice, thanks for the text that you wrote here today.</p></div></form>", TEXT),
    (f"<body><div class='sidebar main-sidebar'><main>{BODY}</main></div>{SIDE}", TEXT),
    (f"<body><article>{BODY}</article><article>{BODY}</article><article class='related'><p>Other text, of other pages, that one may also like to read.</p></article>", TEXT + "\n" + TEXT),
    (f"<body><div><section>{BODY}</section><section><h3>Short</h3><p>A short one here.</p></section><section><h3>List</h3><ul><li>one</li><li>two</li></ul></section></div>{SIDE}",
     TEXT + "\nShort\nA short one here.\nList\none\ntwo"),
    (f"<body><article></article>{SIDE}", ""),
    (f"<body><article>{BODY}<section id='comments'>" + "<p>I think, that, it is great, indeed so, and so on.</p>" * 50 + "</section></article>", TEXT),
    ("<body><div hidden><p>Hidden, text, that nobody should ever read at all.</p></div>", ""),
    (None, ""), ("", ""), ("<p></p>", ""), ("plain", "plain"),
]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship_package(spark)


def test_pages_through_a_frame(spark):
    rows = [(h, i, f"u{i}", "clash", 1) for i, (h, _) in enumerate(CASES)] + [(CASES[0][0], 0, "u0", "clash", 1), (CASES[0][0], None, None, None, None)]
    df = spark.createDataFrame(rows, "html string, page_id long, url string, text string, n_chars int").repartition(3)
    found = html.main_texts(df).collect()
    assert len(found) == len(rows)
    for r in found:
        want = CASES[r.page_id or 0][1]
        assert (r.page_id, r.text) == (r.page_id, want) and r.n_chars == len(want)


def test_long_and_deep_pages_take_linear_time(spark):
    long = "<div id=content>" + BODY * 2500 + "</div>" + SIDE
    assert len(long) > 4 * (1 << 18)
    deep = "<div><p>Some words, more words, and so on until there is enough.</p>" * 100_000
    start = time.time()
    found = {r.page_id: r.text for r in html.main_texts(spark.createDataFrame([(1, "u", long), (2, "u", deep)], "page_id long, url string, html string")).collect()}
    assert time.time() - start < 120  # a walk to the root for every block would take over half an hour
    assert found[1] == "\n".join([TEXT] * 2500) and found[2].count("\n") == 99_999


def plain_scores(page):
    """Points, characters and linked characters of every element by a walk to the root for each block."""
    gone = page.dropped()
    out = {id(n): [0.0, 0, 0] for n in page.nodes}
    for holder, text, linked in page.blocks:
        if gone[id(holder)]:
            continue
        node = holder
        while node is not None:
            out[id(node)][1] += len(text)
            out[id(node)][2] += linked
            node = node.parent
        if holder.tag in html.PARAGRAPHS and len(text) >= 25:
            node = holder.parent if holder.tag in ("p", "pre", "blockquote", "li", "td", "dd") else holder
            points = 1 + sum(text.count(c) for c in ",、，") + min(len(text) / 100, 3)
            while node is not None:
                out[id(node)][0] += points
                node, points = node.parent, points / 2
    return out


def test_sums_equal_a_plain_scorer():
    r = random.Random(11)
    for _ in range(60):
        parts = []
        for _ in range(80):
            tag = r.choice(["div", "p", "section", "span", "ul", "li", "a href=/x", "article", "td", "table", "div class=comments", "form", "footer"])
            parts.append(r.choice([f"<{tag}>", f"</{tag.split()[0]}>", "word, " * r.randrange(20), "text "]))
        page = html.Page("".join(parts))
        want = plain_scores(page)
        page.main_text()
        for n in page.nodes:
            if any(want[id(page.root)][:2]):
                assert n.points == pytest.approx(want[id(n)][0]) and [n.chars, n.linked] == want[id(n)][1:]
