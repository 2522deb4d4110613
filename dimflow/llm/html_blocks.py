"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once into flat blocks: runs of text between block-level tags. Each
has its word count and link density, those of its two neighbours, and marks of its
surroundings (inside an article, inside a menu, form, advert, comment list or the
like by tag, class, id or role). A decision tree over these, trained on the small
labelled table below, tells content from the rest.

Pages are independent: no shuffle, and a task holds one page at a time.

Defined results: a null or empty page has an empty text. Pages cut off anywhere are
read as far as they go; an unfinished tag at the end is dropped. Repeated rows are
extracted alike. Other columns aren't read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of HTML: elements whose content is no text, elements without content,
# and elements that stay within a block.
RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "math", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
#: Elements that close an open one of their own kind.
SELF_CLOSING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}

#: Elements and words of class, id or role that mark what isn't the article.
ASIDE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu"}
#: Elements that hold a page or its article, whatever their class says.
PAGE_TAGS = {"html", "body", "main", "article"}
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay dialog newsletter subscribe subscription "
    "signup sidebar side widget widgets menu menubar nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "topbar toolbar comment comments commentlist disqus respond reply replies share sharing social related "
    "recommended recommendations login search pagination pager skip complementary contentinfo".split()
)
#: Parts that may stand beside such a word in a name; one with any other part, as in has-sidebar, marks nothing.
PLAIN_PARTS = set(
    "area article articles bar block bottom box button buttons container content cta footer global group header holder "
    "home in inline inner item items js label left link links list main mobile outer page panel posts primary right "
    "row secondary section site slot small stories text title top unit wide wrap wrapper".split()
)
#: Words that mark an inline element as an advert; any other one is part of its sentence.
INLINE_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored"}
#: As above, but only outside an article: an article's own header is part of it.
HEADER_WORDS = {"header", "banner"}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_START = re.compile(r"<(?=[a-zA-Z/!?])")
_ATTR = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: What a form that wraps a page's article holds.
_ARTICLE = re.compile(r"<(?:article|main|h1)\b", re.I)
_FORM_END = re.compile(r"</form\b", re.I)

FEATURES = ("words", "links", "before", "before_links", "after", "after_links", "article", "aside", "page_article")


class Block:
    __slots__ = ("text", "words", "linked", "article", "aside", "label")

    def __init__(self, text: str, linked: int, article: bool, aside: bool):
        self.text, self.words, self.linked = text, len(text.split()), linked
        self.article, self.aside = article, aside


def _hidden(name: str, value: str) -> bool:
    if name == "hidden" or (name == "aria-hidden" and value == "true"):
        return True
    return name == "style" and "display:none" in value.replace(" ", "")


def _marked(value: str, article: bool) -> bool:
    """Whether a name in a class, id or role says that an element isn't the article."""
    for name in value.split():
        parts = {x.lower() for x in _PART.findall(name)}
        marks = parts & ASIDE_WORDS | (set() if article else parts & {"header"})
        if article:
            marks -= HEADER_WORDS
        if marks and parts <= ASIDE_WORDS | PLAIN_PARTS:
            return True
    return False


def _attributes(attrs: str) -> Iterator[tuple[str, str]]:
    for name, value in _ATTR.findall(attrs):
        yield name.lower(), value.strip("\"'")


def _aside(tag: str, attrs: str, article: bool) -> bool:
    if tag in ASIDE_TAGS or (tag == "header" and not article):
        return True
    for name, value in _attributes(attrs):
        if _hidden(name, value.lower()):
            return True
        if name in ("class", "id", "role") and tag not in PAGE_TAGS and _marked(value, article):
            return True
    return False


def _dropped(attrs: str) -> bool:
    """Whether an inline element is hidden or an advert."""
    for name, value in _attributes(attrs):
        if _hidden(name, value.lower()):
            return True
        if name in ("class", "id") and any({x.lower() for x in _PART.findall(v)} & INLINE_WORDS and _marked(v, False) for v in value.split()):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in its order."""
    out: list[Block] = []
    text: list[str] = []
    linked: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # tag, inside an article, aside
    in_link = False
    skip: list = []  # tag, depth and open elements of an inline element whose text is left out
    pos, n = 0, len(page)

    def flush() -> None:
        words = " ".join(html.unescape("".join(text)).split())
        if words:
            article, aside = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
            out.append(Block(words, len(html.unescape("".join(linked)).split()), article, aside))
        text.clear()
        linked.clear()

    def say(part: str) -> None:
        if skip:
            return
        text.append(part)
        if in_link:
            linked.append(part)

    while pos < n:
        m = _START.search(page, pos)
        say(page[pos : m.start()] if m else page[pos:])
        if not m:
            break
        pos = m.start()
        if page.startswith("<!--", pos):
            end = page.find("-->", pos + 4)
            pos = end + 3 if end >= 0 else n
            continue
        if page[pos + 1] in "!?":
            end = page.find(">", pos)
            pos = end + 1 if end >= 0 else n
            continue
        tag_ = _TAG.match(page, pos)
        if not tag_:
            end = page.find(">", pos)
            pos = end + 1 if end >= 0 else n
            continue
        pos = tag_.end()
        closing, tag, attrs = tag_[1], tag_[2].lower(), tag_[3]
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            if tag in ("br", "img"):
                say(" ")
            if tag in VOID or attrs.endswith("/"):
                continue
            if skip and tag == skip[0]:
                skip[1] += -1 if closing else 1
                if not skip[1]:
                    skip.clear()
            elif not skip and not closing and attrs and _dropped(attrs):
                skip[:] = [tag, 1, len(open_)]
            continue
        if tag in RAW and not closing:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        flush()
        if tag in VOID:
            continue
        if closing:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag:
                    del open_[k:]
                    break
            in_link = False
            if skip and len(open_) < skip[2]:  # what held the inline element has ended
                skip.clear()
            continue
        if open_ and open_[-1][0] == "p" or (tag in SELF_CLOSING and open_ and open_[-1][0] == tag):
            open_.pop()
        article, aside = (open_[-1][1], open_[-1][2]) if open_ else (False, False)
        if tag == "form" and not aside:
            end = _FORM_END.search(page, pos)
            aside = not _ARTICLE.search(page, pos, end.start() if end else n)
        else:
            aside = (aside and tag != "main") or _aside(tag, attrs, article)
        article = article or tag in ("article", "main") or bool(re.search(r"\b(?:articleBody|role\s*=\s*[\"']?main)\b", attrs))
        if not attrs.endswith("/"):
            open_.append((tag, article, aside))
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block."""
    own = np.array([(b.words, b.linked / b.words) for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    before, after = np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])
    marks = np.array([(b.article, b.aside, any(x.article for x in found)) for b in found], float).reshape(-1, 3)
    return np.hstack([own, before, after, marks])


#: Blocks of the table in a leaf of the tree, at least.
LEAF = 5


def train(rows: np.ndarray, labels: np.ndarray, depth: int = 6):
    """A binary decision tree by Gini impurity: (feature, threshold, below, above) or a label; ties go to the first."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return bool(share >= 0.5)
    best = None
    for k in range(rows.shape[1]):
        values = np.unique(rows[:, k])
        for cut in (values[:-1] + values[1:]) / 2:
            low = rows[:, k] <= cut
            if min(low.sum(), (~low).sum()) < LEAF:
                continue
            p, q = labels[low].mean(), labels[~low].mean()
            cost = low.sum() * p * (1 - p) + (~low).sum() * q * (1 - q)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, k, cut, low)
    if best is None:
        return bool(share >= 0.5)
    _, k, cut, low = best
    below, above = train(rows[low], labels[low], depth - 1), train(rows[~low], labels[~low], depth - 1)
    return below if below is above else (k, float(cut), below, above)


def is_content(tree, row: np.ndarray) -> bool:
    while not isinstance(tree, bool):
        k, cut, below, above = tree
        tree = below if row[k] <= cut else above
    return tree


# The labelled table: invented pages; a block that begins with + is content, one with - isn't.
LABELLED = [
    """<body><header><a href=/>- The Harbour Post</a></header><nav><ul><li><a href=/a>- Home</a><li><a href=/b>- Local
    news today</a></ul></nav><article><h1>+ Ferry resumes</h1><p>+ The night ferry runs again after a winter of repairs
    to the northern pier, the port office said.<p>+ Yes.<p>+ See the <a href=/t>timetable of the port</a></article>
    <aside><h3>- Most read</h3><p>- A long story on the price of fish that many people read over the last few days</aside>
    <footer>- &copy; Harbour Post, all rights reserved, printed by the harbour press on its own machines</footer>""",
    """<main><h2>+ Bread</h2><p>+ Mix flour, water and salt; let it rest for an hour.<ul><li>+ flour<li>+ salt</ul>
    <div class="ad">- Buy the new oven now and get a second tray for free this week only</div><p>+ Bake.</p>
    <div class="newsletter-signup">- Get our letter every week</div><p>+ <a href=/x>More bread</a></p></main>
    <div id="comments"><p>- I tried this and it was very good, thank you for the recipe and the pictures</p><p>- Nice</p></div>""",
    """<div class="cookie-notice"><p>- We use cookies to make this site work and to count how many people visit it</p></div>
    <div><p>+ The committee met on Tuesday and agreed on a plan for the bridge that has been closed since spring.</p>
    <p>+ Work is to begin in May and will take about eight months, according to the engineer in charge of it.</p></div>
    <div><a href=/1>- Next</a> <a href=/2>- Previous</a> <a href=/3>Index</a></div><div>- Print</div>
    <form><p>- Write your name and your address below so that we can send you a printed copy of the report</p></form>""",
    """<div><a href=/>- Start</a></div><div><a href=/m>- Map of all pages</a></div><p>+ Owls hunt at night and hear a mouse
    under the snow from a great distance, because their ears sit at different heights.</p><p>+ Their feathers make no sound
    in flight, so that the mouse hears nothing until it is far too late for it.</p><div>- <a href=/c>Contact us</a></div>
    <div>- Back to top</div>""",
    """<article><header><h1>+ On tides</h1></header><p>+ The moon pulls.</p><blockquote>+ So it does.</blockquote>
    <div class="share">- Share this</div><section class="comments"><p>- First comment of a reader about the moon and the
    tides and much else besides</p></section><p>+ End.</p><footer>- Filed under water</footer></article><div class=sidebar>
    <p>- Short</p><p>- Another box of text with a fair number of words that has nothing to do with tides</p></div>""",
    # Pages that mark nothing: links and neighbours tell.
    """<table><tr><td><a href=/>- Home</a> <a href=/f>Forum</a> <a href=/s>Shop</a><tr><td>+ The kiln<tr><td>+ A kiln has
    to be heated slowly, or the clay cracks where the water in it turns to steam too fast for its pores.<tr><td>+ Leave the
    door ajar for the first two hours and look at the cones through the hole at its side every now and then.<tr><td>+ Then
    close it.<tr><td>+ After the last cone has bent, let it cool for a day before you open it, however curious you are.
    <tr><td>- <a href=/1>Glazes</a> <a href=/2>Clays</a> <a href=/3>Wheels</a> <a href=/4>Tools</a><tr><td>- <a href=/5>About
    us</a> and <a href=/6>imprint</a><tr><td>- Version 3</table>""",
    """<div>- <a href=/a>News</a> | <a href=/b>Weather</a> | <a href=/c>Sport</a></div><div>- Tuesday</div><div>+ Snow falls on
    the pass</div><div>+ The road over the pass was closed at noon after a foot of snow had fallen within a few hours.</div>
    <div>+ Drivers were led back to the valley, where the school gave them room for the night and hot soup from its kitchen.
    </div><div>+ "We were lucky"</div><div>+ said a driver who had been on the way to the south with a load of oranges and three
    dogs on the seat beside him.</div><div>- <a href=/d>Slopes open early this year, says the head of the lift company</a>
    </div><div>- <a href=/e>Ten things to do on a long evening without electric light in a hut</a></div><div>- <a href=/f>Where
    to buy boots</a></div><div>- Phone 12 34</div>""",
    """<center>- <a href=/>Index</a> <a href=/m>Mail</a></center><p>+ My uncle built boats, and when I was small he let me hold
    the lamp while he bent the planks over the steam.<p>+ He never measured twice, which my aunt held to be a sin, and his
    boats were all a little different from each other.<p>+ One still floats.<p>+ It lies at the old quay with a new name, and
    the man who owns it says that it leaks no more than other boats of that age do.<hr><center>- <a href=/b>back</a></center>
    <center>- visitor 4711</center>""",
    """<ul><li><a href=/1>- Bread and rolls</a><li><a href=/2>- Cakes</a><li><a href=/3>- Opening hours and how to find us</a>
    </ul><p>+ Rye needs acid to rise, and that is what the sour dough is for, besides the taste that most people know it by.
    <ul><li>+ a pound of rye<li>+ two cups of water<li>+ a spoon of salt</ul><p>+ Mix all of it in the evening, cover it with
    a cloth, and don't look at it before the next morning, even if it smells.<p>+ Bake it hot and long, then wrap it in a
    towel and wait until it is cold, which is the hardest part of all.<ul><li><a href=/4>- More on rye</a><li><a href=/5>- Print
    this page</a><li><a href=/6>- Send it to a friend of yours</a></ul><div>- All prices include tax</div>""",
    """<div>- Sign in</div><div>- 0 items</div><div>- <a href=/x>Boots</a> <a href=/y>Coats</a></div><div>+ Wool that has been
    boiled keeps out wind and rain for hours, since its fibres have grown into each other like those of felt.</div><div>+ It
    was worn by shepherds, who slept in it on the bare ground and never took it off before the summer came.</div><div>+ See
    the <a href=/w>chapter on wool</a> and that on <a href=/l>looms</a> for how it is made, step by step and by hand.</div>
    <div>- <a href=/1>1</a> <a href=/2>2</a> <a href=/3>3</a></div><div>- Top</div>""",
    """<blockquote>+ A river is never the same, an old man told me, and then he threw his hat into it to show me what he meant.
    </blockquote><p>+ We watched it go.</p><p>+ It passed the mill and the bridge, turned once around itself and went under just
    where the water is deepest and the boys like to swim.</p><p>- <a href=/p>Previous</a> <a href=/n>Next</a></p><p>- <a
    href=/r>Other tales of rivers</a> <a href=/q>Tales of the sea</a></p><p>- 2004</p>""",
    # Long asides, and pages that end with their text.
    """<div class="ad">- Our shoes are sewn by hand from the best leather that we could find, and they last for ten years or
    more if you grease them every spring and autumn.</div><p>+ Moss grows on the north side of trees only where the sun is
    strong, and in deep woods it grows all round them.<p>+ So don't trust it.<p>+ A compass is light, costs little, and has
    saved more walkers than all the moss and all the stars of the sky together.""",
    """<header><p>- This paper has been printed every week since the bridge was built, and it is still owned by the family of
    the man who founded it</p></header><div>+ The mill burns</div><div>+ Nobody was hurt when the old mill at the ford burned
    down to its stones in the night from Sunday to Monday.</div><div>+ The miller had gone to a wedding and came home when the
    roof was already falling in, as did most of the village.</div><aside>- In other news the council has decided that the clock
    on the town hall will be set right at last, after forty years</aside><div class="comments"><div>- I remember how my
    grandmother took me there with a sack on her back when I was not yet in school</div><div>- It is a shame that nobody looked
    after the place, and now it is too late for that</div></div>""",
    """<nav><p>- You are here: start page, then the chapter on animals, then that on birds, then the page on birds of prey and
    owls</p></nav><p>+ Kestrels stand still in the air against the wind and look for mice, which they see by the traces these
    leave.<p>+ They nest in towers.<p>+ Whoever hangs a box under the roof of a barn may have a pair of them in the second or
    third year, if no cat can climb to it.<div id="related-articles">- Read on about hawks, about falcons that live in large
    cities, and about what to do when a young owl sits on the ground</div><footer><p>- All texts on these pages may be copied
    for use in schools, as long as you say where you found them and change nothing</p></footer>""",
    """<div class="cookie-notice">- This site stores small files on your machine so that it knows you when you come back, which
    you can forbid with the button below</div><h1>+ Salt</h1><p>+ Salt was carried over the mountains on the backs of mules,
    forty of them in a row, and each of them knew its place.<p>+ It was worth its weight.<form><p>- Leave your address here and
    we will send you a letter on every first Monday of the month with all that is new on our pages</p></form><p>+ The last
    caravan came through in the year in which the railway was opened, and the inn was closed in the same winter.""",
    """<article><h1>+ Knots</h1><p>+ A knot weakens the rope it is tied in by a third or more, since the fibres at its bends
    carry most of the load.</p><div class="advert">- The new rope from our works holds a bull, floats on water, and comes in
    five colours that don't fade in the sun</div><p>+ Splices do better.</p></article><section class="comments"><p>- You forgot
    the bowline, which any sailor would have put first in such a list, and rightly so</p><p>- Thanks</p></section><footer>- The
    rope works have been in this street since the harbour was dug, and they can be visited on the first Sunday of each
    month</footer>""",
    # Articles that end their page with a few words.
    """<article><h1>+ Fog</h1><p>+ Fog is a cloud that lies on the ground, and from the hill above it you can see the tops of
    the poplars.<p>+ Then it lifts.</article>""",
    """<ul><li><a href=/>- Start</a><li><a href=/t>- Tales</a></ul><main><p>+ She sold the house.<p>+ She kept the key, though,
    and wore it on a string until the day on which the new owners changed the lock.<p>+ They were kind.<p>+ So was she.</main>""",
    """<article><p>+ "Stop!"<p>+ Nobody did, for the band had begun to play, and the dancers had come a long way to hear it.
    <p>+ (to be continued)</article>""",
    """<article><h1>+ Ice</h1><p>+ Skate.<p>+ But not alone.<p>+ Black ice bears a man at two inches, while white ice needs twice
    as much, and wet ice should not be trusted at all.<p>+ Old rule:<ul><li>+ one inch<li>+ keep off<li>+ two inches<li>+ one may
    <li>+ three inches<li>+ small groups<li>+ four<li>+ all can</ul><p>+ So they say.</article><div class="menu-links"><a href=/q>-
    Home</a></div>""",
    """<div><a href=/>- Top</a></div><main><h1>+ Letters</h1><h2>+ The first</h2><p>+ Dear A.<p>+ I am well.<p>+ The hens lay again,
    and the roof that you mended last summer has held through all the storms of the winter.<h2>+ The second</h2><p>+ Come.<p>+ B.
    </main><div><a href=/n>- Next page</a></div><div><a href=/n>- Last page of all</a></div>""",
    """<nav><a href=/>- Home</a></nav><article><h1><a href=/s>+ Sources of the old maps</a></h1><p>+ The maps were drawn after
    these books, all of which can be read in the hall of the library.<ul><li><a href=/1>+ A voyage to the south</a><li><a
    href=/2>+ Tides and winds, second part</a><li>+ the <a href=/3>log of the Anna</a><li><a href=/4>+ Letters from the cape</a>
    <li>+ and a <a href=/5>chart without a name</a></ul><p><a href=/6>+ More on each of them</a><p>+ Ask at the desk.</article>
    <div><a href=/7>- Other maps</a></div><div><a href=/8>- Opening hours of the library</a></div>""",
]


def trained_tree():
    rows, labels = [], []
    for page in LABELLED:
        found = [b for b in blocks(page) if b.text[0] in "+-"]
        for b in found:
            b.words -= 1
        rows.append(features(found))
        labels += [b.text[0] == "+" for b in found]
    return train(np.vstack(rows), np.array(labels))


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return "\n\n".join(b.text for b, row in zip(found, features(found)) if is_content(tree, row))


def _extract(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), tree) for page in batch.column(2)]
            chars = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), chars],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def extract(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, `text`, `n_chars` of every page."""
    rows = pages.select("page_id", "url", "html")
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(_extract(trained_tree()), f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
