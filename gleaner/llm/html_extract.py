"""Main text of web pages by tree scoring.

One pass over the tokens of a page builds its tree and its blocks (paragraphs,
headings, items, cells).  Menus, page headers, footers, asides, forms, scripts,
styles, hidden elements, and blocks whose class, id or role names an advert, a
notice, a sidebar or reader comments are left out with all they hold; inline
elements, paragraphs and headings are not judged by their names, nor are headers
inside an article.  A name counts as a whole: all its words, as in ``comment-list``, have
to be such words or words of layout, so ``side-effects`` says nothing.  Words that may as well
be an article's subject (``discussion``, ``popular``) leave a block out only if its text agrees:
many links, or short texts (``UNSURE``).

Each block of some length gives points, 1 and one for each comma and each 100
characters (three at most), to its container, half to the container's parent, and
less to those above (``SHARES``); a block's points are discounted by the share of its
text that is in links, and a container's total by the link density of all it holds.  The
best container is kept, widened to the article element that holds it, and so are
its siblings with a fifth of its score or that are long paragraphs almost free of
links.  The kept blocks are joined in page order.

Defined cases: a null or empty page, and one without text outside what is left
out, gives an empty text; a page that is cut off counts as closed there; a page of
any depth takes a time in proportion to its length; repeated rows each give a row; an
empty table gives an empty result; other columns are ignored; where no block is long enough to score, the article or main element is kept, or else all
blocks that are not mostly links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..markup.tokens import START, TEXT, VOID, attributes, tokens
from ..session import ship
from . import _text as T

RESULT = "page_id long, url string, text string, n_chars long"

BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre address figure figcaption header footer aside nav form fieldset details summary hr hgroup center".split()
)
CONTAINER = frozenset("html body article main section div td blockquote table tbody ul ol dl tr details center figure header".split())
LEFT_OUT = frozenset("head title nav footer aside form script style noscript template iframe object embed svg canvas button select textarea input label dialog menu audio video map datalist".split())
#: Words in a class, an id or a role by which a block is left out.
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promoted cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall"
    " sidebar aside rail widget widgets menu menubar nav navbar navigation breadcrumb breadcrumbs pager pagination toolbar"
    " footer bottombar copyright newsletter subscribe subscription signup login complementary contentinfo".split()
)
#: The same for headers, which inside an article or a post are a part of it.
HEADS = frozenset("header masthead topbar banner".split())
ARTICLE = frozenset("article main post entry story content".split())
COMMENTS = frozenset("comment comments commentlist disqus".split())
#: Words that leave a block out only if more than LINKED of its text is in links, or its texts (headings aside) have fewer than SHORT characters on average.
UNSURE = frozenset("side foot skip related recommended recommendations trending popular share sharing social follow search promotion disclaimer respond reply replies discussion feedback".split())
LINKED, SHORT = 0.25, 60
#: Words of layout, which say nothing by themselves.
LAYOUT = frozenset(
    "area bar body bottom box bubble button buttons card center col column container content float form fixed full group header holder icon icons inner item items left layout link links list main mid module outer panel"
    " posts article articles right row section slot small sticky text thread title top unit wide wrap wrapper".split()
)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_]+")
#: An open element of these ends where another one of the same family starts; a block ends an open paragraph.
_FAMILY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("html body article main section div table td th ul ol dl blockquote figure".split())
BASE = {"article": 25, "main": 20, "div": 5, "section": 5, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Shares of a block's points for its container, that one's parent, and so on.
SHARES = (1, 1 / 2, 1 / 6, 1 / 9, 1 / 12, 1 / 15)


def names(a: dict[str, str]) -> set[str]:
    """Words of those names among the attributes of an element that are made of known words alone."""
    out: set[str] = set()
    for name in " ".join(a.get(k, "") for k in ("class", "id", "role", "itemprop")).split():
        own = {x.lower() for x in _NAMES.findall(name)}
        whole = name.lower().strip("-_")
        if whole in UNLIKELY or whole in COMMENTS:
            out.add(whole)
        elif own <= UNLIKELY | HEADS | ARTICLE | COMMENTS | UNSURE | LAYOUT:
            out |= own
    return out


def judged(tag: str, raw: str, in_article: bool) -> str:
    """What an element's tag and names say of it: "out", "unsure" or "" (nothing)."""
    if tag in LEFT_OUT or tag == "header" and not in_article:
        return "out"
    if not raw or tag in ("html", "body"):
        return ""
    a = attributes(raw)
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        return "out"
    if tag not in BLOCK or tag == "p" or tag in HEADINGS:  # names of these say how they look, not what they are
        return ""
    own = names(a)
    if own & COMMENTS:
        return "out"
    if tag in ("article", "main") or own & {"article", "main"} and not own & UNLIKELY:
        return ""
    if own & UNLIKELY or not in_article and not own & ARTICLE and own & HEADS:
        return "out"
    return "unsure" if own & UNSURE else ""


class _Page:
    """The elements and blocks of a page, in page order.  Each token takes a time that does not grow with what is open."""

    def __init__(self):
        self.tag, self.parent, self.out, self.article, self.link = ["#"], [-1], [False], [False], [False]
        self.block_of, self.container = [0], [0]  # nearest block, and nearest container, itself included
        self.open = [0]
        self.at: dict[str, list[int]] = {}  # places in open of the open elements of each tag
        self.open_blocks = [0]  # the same of all open blocks
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.parts: list[str] | None = None
        self.owner = self.linked = 0
        self.unsure: list[int] = []  # elements that their text decides on

    def add_text(self, raw: str) -> None:
        top = self.open[-1]
        if self.out[top]:
            return
        if self.parts is None:
            if not raw.strip():
                return
            self.owner, self.parts, self.linked = self.block_of[top], [], 0
        text = unescape(raw)
        self.parts.append(text)
        if self.link[top]:
            self.linked += len(text)

    def end_block(self) -> None:
        if self.parts is not None:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((self.owner, text, min(self.linked, len(text))))
            self.parts = None

    def close_to(self, i: int) -> None:
        """Closes the open elements from place i on."""
        for k in reversed(self.open[i:]):
            self.at[self.tag[k]].pop()
        if self.open_blocks[-1] >= i:
            self.end_block()
            while self.open_blocks[-1] >= i:
                self.open_blocks.pop()
        del self.open[i:]

    def last(self, tags) -> int:
        """The innermost place of an open element of these tags, 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def start(self, name: str, raw: str) -> None:
        if name in BLOCK:
            # An open paragraph, and an open element of the same family, ends here, unless another element stands between.
            ends = _FAMILY.get(name, frozenset())
            fence = self.last(_SCOPE - ends)
            if (i := self.last(("p",))) > fence:
                self.close_to(i)
            if (i := self.last(ends)) > fence:
                self.close_to(i)
            self.end_block()
        elif name == "br" and self.parts is not None:
            self.parts.append(" ")
        if name in VOID:
            return
        top, i = self.open[-1], len(self.tag)
        said = "out" if self.out[top] else judged(name, raw, self.article[top])
        if said == "unsure":
            self.unsure.append(i)
        self.tag.append(name)
        self.parent.append(top)
        self.out.append(said == "out")
        self.article.append(self.article[top] or name in ("article", "main"))
        self.link.append(self.link[top] or name == "a")
        self.block_of.append(i if name in BLOCK else self.block_of[top])
        self.container.append(i if name in CONTAINER else self.container[top])
        if not raw.endswith("/") or name in BLOCK or name == "a":
            self.at.setdefault(name, []).append(len(self.open))
            if name in BLOCK:
                self.open_blocks.append(len(self.open))
            self.open.append(i)

    def end(self, name: str) -> None:
        """Closes the innermost open element of the name; an inline one only within its block."""
        i = self.last((name,))
        if i and (name in BLOCK or i > self.open_blocks[-1]):
            self.close_to(i)


    def decide(self) -> None:
        """Leaves out the blocks of unsure elements whose text is mostly links or short."""
        if not self.unsure:
            return
        n = len(self.tag)
        length, linked, count, size = [0] * n, [0] * n, [0] * n, [0] * n
        for owner, text, link in self.blocks:
            length[owner] += len(text)
            linked[owner] += link
            if self.tag[owner] not in HEADINGS:
                count[owner] += 1
                size[owner] += len(text)
        for sums in (length, linked, count, size):
            for i in range(n - 1, 0, -1):  # an element comes after its parent
                sums[self.parent[i]] += sums[i]
        for i in self.unsure:
            self.out[i] = self.out[i] or linked[i] > LINKED * length[i] or size[i] < SHORT * count[i]
        for i in range(1, n):
            self.out[i] = self.out[i] or self.out[self.parent[i]]
        self.blocks = [b for b in self.blocks if not self.out[b[0]]]


def read(html: str) -> _Page:
    page, field = _Page(), False
    for kind, name, raw in tokens(html):
        if field:  # what stands in a text field is no markup
            if name == "textarea" and kind not in (TEXT, START):
                page.end(name)
                field = False
        elif kind == TEXT:
            page.add_text(name)
        elif kind == START:
            page.start(name, raw)
            field = name == "textarea" and page.tag[page.open[-1]] == name
        else:
            page.end(name)
    page.end_block()
    page.decide()
    return page


def extract(html: str | None) -> str:
    """The main text of a page, one block a line."""
    if not html:
        return ""
    page = read(html)
    return "\n".join(text for (_, text, _), k in zip(page.blocks, kept(page), strict=True) if k)


def points(page: _Page) -> tuple[dict[int, float], list[int], list[int]]:
    """The score of each container with points, and of each element the length of its text and of that in links."""
    n = len(page.tag)
    length, linked = [0] * n, [0] * n
    score: dict[int, float] = {}
    for owner, text, link in page.blocks:
        length[owner] += len(text)
        linked[owner] += link
        if len(text) < 25 or page.tag[owner] in HEADINGS:
            continue
        own = (1 + text.count(",") + min(len(text) // 100, 3)) * (1 - link / len(text))
        i = page.container[owner]
        for share in SHARES:
            if not i:
                break
            score[i] = score.get(i, BASE.get(page.tag[i], 0)) + own * share
            i = page.container[page.parent[i]]
    for i in range(n - 1, 0, -1):  # an element comes after its parent
        length[page.parent[i]] += length[i]
        linked[page.parent[i]] += linked[i]
    for i in score:
        score[i] *= 1 - linked[i] / max(1, length[i])
    return score, length, linked


def kept(page: _Page) -> list[bool]:
    """Which blocks belong to the best container or a sibling that is kept."""
    tag, parent, n = page.tag, page.parent, len(page.tag)
    score, length, linked = points(page)
    if score:
        best = max(score, key=lambda i: (score[i], -i))
    else:
        best = next((i for i in range(n) if tag[i] in ("article", "main") and not page.out[i] and length[i]), 0)
        if not best:
            return [link * 2 < len(text) for _, text, link in page.blocks]
    i = best
    while i > 0:  # widened to the article, or else the main element, that holds it
        if tag[i] == "article" or tag[i] == "main" and tag[best] != "article":
            best = i
        i = parent[i]
    limit = max(10.0, score.get(best, 0) / 5)
    inside = [False] * n
    inside[best] = True
    if tag[best] not in ("html", "body"):
        for i in range(n):
            if parent[i] == parent[best] and (score.get(i, 0) >= limit or tag[i] == "p" and length[i] > 80 and linked[i] / length[i] < 0.25):
                inside[i] = True
    for i in range(1, n):
        inside[i] = inside[i] or inside[parent[i]]
    return [inside[owner] for owner, _, _ in page.blocks]


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of pages (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "html"):
                text = [extract(h) for h in part.column("html").to_pylist()]
                yield pa.record_batch(
                    [part.column("page_id"), part.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    ship(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, RESULT)
