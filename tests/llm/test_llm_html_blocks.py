"""Main text of pages whose answer was written by hand, none of them in the labelled table."""

import pytest

from dimflow.llm import html_blocks as H

ARTICLE = "<article><h1>Head</h1><p>This is the text of the article that must stay here.</p><p>Short one.</p></article>"
TEXT = "Head\n\nThis is the text of the article that must stay here.\n\nShort one."


@pytest.fixture(scope="module")
def tree():
    return H.trained_tree()


@pytest.mark.parametrize(
    "page",
    [
        '<body class="single has-sidebar">%s</body>',
        '<div id="content" class="no-sidebar">%s</div>',
        '<body class="ad-free">%s</body>',
        '<div class="layout with-widget">%s</div>',
        '<div class="social-science">%s</div>',
        '<form id="aspnetForm">%s</form>',
        '<body class="sidebar"><main class="widget">%s</main></body>',
        '<html class="no-js menu"><body id="page-menu">%s',
        '<div class="sidebar-left">Some words of a box</div>%s<div class="ad-slot">Buy a bicycle of the best make now, before all of them are sold out for good</div>',
        '<form action="/search">Search all of the pages that we have written since we began</form>%s<footer>x</footer>',
    ],
)
def test_wrappers_do_not_hide_an_article(tree, page):
    assert H.main_text(page % ARTICLE, tree) == TEXT


@pytest.mark.parametrize(
    "inside, text",
    [
        ('There is <span class="alert">danger</span> in it for us.', "There is danger in it for us."),
        ('There is <span class="ad">buy <span>now</span></span> danger in it.', "There is danger in it."),
        ("There is <b hidden>no</b> danger in it for us.", "There is danger in it for us."),
        ('There is <em style="display: none">no</em>danger <i class="note">in</i> it.', "There is danger in it."),
        ('There <span class="ad">is no end.', "There"),
    ],
)
def test_inline_elements_stay_in_their_sentence(tree, inside, text):
    got = H.main_text(f"<article><p>{inside}</p><p>The next paragraph comes whole, with all of its words.</p></article>", tree)
    assert got == text + "\n\nThe next paragraph comes whole, with all of its words."


def depth_first(tree):
    return [] if isinstance(tree, bool) else [H.FEATURES[tree[0]], *depth_first(tree[2]), *depth_first(tree[3])]


def test_links_and_neighbours_decide(tree):
    used = depth_first(tree)
    assert "links" in used and {"before", "before_links", "after", "after_links"} & set(used)


UNMARKED = [
    (
        "<div><a href=/a>Home</a> <a href=/b>Contact</a></div><div>The bridge over the gorge was finished a year late, since the rock "
        "on its eastern side had to be blasted twice.</div><div>It opened without a speech.</div><div>Since then the way to the mill "
        "takes ten minutes, where before it took an hour and a half by the ford.</div><div><a href=/1>Older</a> <a href=/2>Newer</a></div>",
        [1, 2, 3],
    ),
    (
        "<p><a href=/>Index</a><p>Bees find their way home by the sun, and on grey days by the light that comes through the clouds.<p>How "
        "they do it at night is not known.<p>A hive that is moved by a few feet stays empty, while one that is moved by miles is found "
        "again by all of its bees.<p><a href=/x>More on bees and wasps</a><p><a href=/y>Honey</a>",
        [1, 2, 3],
    ),
]


@pytest.mark.parametrize("page, content", UNMARKED)
def test_pages_without_marks(tree, page, content):
    found = H.blocks(page)
    assert [H.is_content(tree, row) for row in H.features(found)] == [k in content for k in range(len(found))]


def test_ties_repeats_and_odd_pages(spark):
    pages = [(1, "u", ARTICLE), (1, "u", ARTICLE), (2, None, None), (None, "v", ""), (3, "w", "<"), (4, "x", "<p><a href='"), (5, "y", "<article>" + "word " * 200_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = sorted(map(tuple, H.extract(df).collect()), key=repr)
    long = ("word " * 200_000).strip()
    want = [(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "<", 1), (4, "x", "", 0), (5, "y", long, len(long))]
    assert [r for r in got if r[0] != 3] == sorted([r for r in want if r[0] != 3], key=repr)
    assert H.extract(df.limit(0)).count() == 0
