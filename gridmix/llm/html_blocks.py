"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into text blocks at the tags that break lines.  A block is described by its words, the share of them inside
links, the same of its two neighbours, and whether it lies inside an article or inside a part that is named as
something else (menu, footer, advert, comments ...).  Where a page has no element for its article, words and link
densities decide.  Inside an article only class names and roles that are or begin with such a word name such a part, or any name of
adverts, notices and comments: other ids, and headings, speak of its matter.  A form that holds an article, or all of the page, is not such a part.  A decision tree says which blocks are main text.  It is trained
on the small labelled table below and on the same pages without their elements for the article, every time, in a few milliseconds.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined by a line feed
in page order.  Nothing else is dropped or cut.

Defined results: a null or empty html, or one without main text, gives the empty text; broken and unfinished
markup is read as far as it goes; rows that repeat are extracted each; a null id or url is kept; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text of the page and, by the rules of HTML, no markup either: without its
#: end tag, one goes on to the page's end.
RAW = "iframe script style textarea title".split()
#: Elements with markup inside that is no text of the page.  One ends at its end tag; without one, its start tag is passed over,
#: and what follows is the page's.
PASSED = "noscript object select svg template".split()
#: Elements that break the line.
BREAKS = ("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
          "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary "
          "table tbody td tfoot th thead tr ul").split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
#: Elements that end an open paragraph, and what a paragraph's end doesn't reach across.
SCOPES = "article aside body blockquote dd div fieldset figure footer form header html li main nav section table td th".split()
ARTICLE = "article main".split()
OTHER = "aside button dialog footer menu nav".split()
#: What a form that holds the page has inside, if outside an article.
IN_PAGE_FORM = "article main nav".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
#: Words of class, id and role that name a part as something other than the main text.
HINTS = ("ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments complementary consent "
         "contentinfo cookie cookies copyright dialog disqus footer gdpr login menu modal nav navbar navigation newsletter "
         "notice notices popup promo related replies reply respond search share sharing sidebar signup social sponsor "
         "sponsored subscribe toolbar widget").split()
#: Those of them that never speak of an article's own matter: inside an article they tell in any class name and in ids too.
NEVER_MATTER = frozenset("ad ads advert advertisement adverts comment comments consent cookie cookies disqus gdpr newsletter popup promo "
                         "signup sponsor sponsored subscribe".split())
#: Words that add nothing to such a word in the same class name ("comments-area").
PLAIN = ("area article articles bar block box button buttons container content entry form inner link links list page post posts "
         "section site story wrapper").split()
#: Such words where they stand outside an article (an article has headings of its own).
PAGE_HINTS = "header masthead topbar".split()
HINTS_AND_PLAIN = frozenset(HINTS + PLAIN)
#: Words that make a name speak of the layout, not of the part ("has-sidebar", "ad-free").
LAYOUT = "disabled enabled free has layout no not theme with without".split()
#: Words that name an article, and those that make such a name another part.
BODY_HINTS = "article articlebody entry post story".split()
NOT_BODY = "author card date footer grid list meta nav tags teaser teasers thumbnail".split()

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?>[^<>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z|(?=<))"
    r"|</[^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_PARTS = re.compile(r"[a-z]+")


def _attributes(attrs: str) -> dict[str, str]:
    """The attributes of a start tag by their names in lower case; of those that repeat, the first."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _hidden(of: dict[str, str]) -> bool:
    names = of.get("class", "").lower().split()
    return ("hidden" in of or of.get("aria-hidden", "").strip().lower() == "true"
            or bool(_NO_DISPLAY.search(of.get("style", "")))
            or "hidden" in names and not any(":" in n for n in names))  # "hidden md:block" is hidden on some screens


@lru_cache(maxsize=len(RAW))
def _ending(name: str) -> "re.Pattern":
    return re.compile(rf"</{name}\s*(?:>|\Z)", re.I)


class _Endings:
    """Where elements of PASSED end in a page: inner ones of the same name, raw contents and comments are passed over."""

    def __init__(self, html: str):
        self.html, self.ends = html, None

    def __call__(self, start: int) -> int | None:
        """End of the element whose start tag begins there, None if it has no end tag."""
        if self.ends is None:
            self.ends = self._all()
        return self.ends.get(start)

    def _all(self) -> dict[int, int]:
        """One reading for all elements of the page."""
        ends, opened, at = {}, {name: [] for name in PASSED}, 0
        while m := _TOKEN.search(self.html, at):
            at, name = max(m.end(), m.start() + 1), (m["name"] or "").lower()
            if name in RAW and not m["close"] and not m["attrs"].endswith("/"):
                end = _ending(name).search(self.html, at)
                at = end.end() if end else len(self.html)
            elif name in opened and m["close"]:
                if opened[name]:
                    ends[opened[name].pop()] = m.end()
            elif name in opened and not m["attrs"].endswith("/"):
                if name == "select":
                    opened[name].clear()  # a select in a select ends the first one
                opened[name].append(m.start())
        return ends


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    other: bool
    heading: bool
    forms: tuple[int, ...] = ()

    @property
    def density(self) -> float:
        return self.linked / max(1, self.words)


@dataclass
class _Open:
    """Where a page's reading stands: open elements with what they say, and the block under way."""

    names: list[str] = field(default_factory=list)
    article: list[bool] = field(default_factory=list)
    other: list[bool] = field(default_factory=list)
    linked: list[bool] = field(default_factory=list)
    headed: list[bool] = field(default_factory=list)
    forms: list[tuple[int, ...]] = field(default_factory=list)
    n_forms: int = 0
    page_forms: set[int] = field(default_factory=set)
    parts: list[tuple[str, bool]] = field(default_factory=list)
    done: list[Block] = field(default_factory=list)

    def push(self, name: str, attrs: str) -> None:
        inside, astray = bool(self.article and self.article[-1]), bool(self.other and self.other[-1])
        forms = self.forms[-1] if self.forms else ()
        body = elsewhere = False
        of = _attributes(attrs) if attrs else {}
        if of and name not in ("html", "body", "main"):
            named = [(a, one, set(_PARTS.findall(one))) for a in ("class", "id", "role") for one in of.get(a, "").lower().split()]
            named = [(a, one, words) for a, one, words in named if words.isdisjoint(LAYOUT)]
            body = any(not words.isdisjoint(BODY_HINTS) and words.isdisjoint(NOT_BODY) and words.isdisjoint(HINTS)
                       for _, _, words in named)
            for a, one, words in named:
                if a == "id" and name in HEADINGS:
                    continue
                if not (inside or body or name in ARTICLE):
                    elsewhere |= not words.isdisjoint(HINTS) or not words.isdisjoint(PAGE_HINTS)
                elif not (inside and name in HEADINGS):
                    first = _PARTS.search(one)
                    elsewhere |= (not words.isdisjoint(NEVER_MATTER) or a != "id" and not words.isdisjoint(HINTS) and (
                        words.issubset(HINTS_AND_PLAIN) or inside and first[0] in HINTS))
        if name == "form":
            self.n_forms += 1
            forms += (self.n_forms,)
        elif forms and not inside and (name in IN_PAGE_FORM or body and not elsewhere):
            self.page_forms.update(forms)
        # a header belongs to the page unless it is an article's
        says = name in OTHER or name == "header" and not inside or elsewhere or bool(of) and _hidden(of)
        self.names.append(name)
        self.article.append(inside or name in ARTICLE or body)
        self.other.append(astray or says)
        self.linked.append(name == "a" or bool(self.linked and self.linked[-1]))
        self.headed.append(name in HEADINGS or bool(self.headed and self.headed[-1]))
        self.forms.append(forms)

    def close(self, at: int) -> None:
        del self.names[at:], self.article[at:], self.other[at:], self.linked[at:], self.headed[at:], self.forms[at:]

    def last(self, name: str, within: tuple | list = ()) -> int:
        """Position of the innermost open element of that name, -1 if there is none inside these scopes."""
        for n in range(len(self.names) - 1, -1, -1):
            if self.names[n] == name:
                return n
            if self.names[n] in within:
                return -1
        return -1

    def flush(self) -> None:
        if not self.parts:
            return
        parts = [(unescape(t), linked) for t, linked in self.parts]
        self.parts = []
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            self.done.append(Block(text, text.count(" ") + 1, sum(len(t.split()) for t, linked in parts if linked),
                                   bool(self.article and self.article[-1]), bool(self.other and self.other[-1]),
                                   bool(self.headed and self.headed[-1]), self.forms[-1] if self.forms else ()))

    def end(self) -> list[Block]:
        """The blocks; those in a form that doesn't hold the page belong to something else."""
        self.flush()
        if self.n_forms and self.done:
            self.page_forms.update(set(self.done[0].forms).intersection(*[b.forms for b in self.done]))
            for b in self.done:
                b.other |= not self.page_forms.issuperset(b.forms)
        return self.done


def blocks(html: str) -> list[Block]:
    """The text blocks of a page, in order."""
    page, at, ending = _Open(), 0, _Endings(html)
    while True:
        m = _TOKEN.search(html, at)
        if (m.start() if m else len(html)) > at:
            page.parts.append((html[at:m.start() if m else len(html)], bool(page.linked and page.linked[-1])))
        if m is None:
            break
        at, name = m.end(), (m["name"] or "").lower()
        if not name or m.end() == m.start():
            at = max(at, m.start() + 1)
            continue
        if name == "br":
            page.parts.append((" ", False))
        elif name == "head":  # it holds no text but that of raw elements
            page.parts.append((" ", False))
        elif name in PASSED:
            if not m["close"] and not m["attrs"].endswith("/"):
                at = ending(m.start()) or at
            page.parts.append((" ", False))
        elif name in RAW:
            if not m["close"] and not m["attrs"].endswith("/"):
                end = _ending(name).search(html, at)
                at = end.end() if end else len(html)
            page.parts.append((" ", False))
        elif m["close"]:
            if name in BREAKS:
                page.flush()
            if (n := page.last(name, () if name in BREAKS else SCOPES)) >= 0:
                page.close(n)
        else:
            if name in BREAKS:
                page.flush()
                if (n := page.last("p", SCOPES)) >= 0:
                    page.close(n)
                if name in ("li", "td", "th", "tr", "dd", "dt") and (n := page.last(
                        name, ("ul", "ol", "table", "dl"))) >= 0:
                    page.close(n)
            if name not in VOID and not m["attrs"].endswith("/"):
                page.push(name, m["attrs"])
    return page.end()


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "article", "other",
            "heading")


def features(page: list[Block]) -> np.ndarray:
    """(blocks, FEATURES); a page's ends count as blocks of no words."""
    own = np.array([(min(b.words, 1000), b.density) for b in page], float).reshape(-1, 2)
    none = np.zeros((1, 2))
    told = np.array([(b.article, b.other, b.heading) for b in page], float).reshape(-1, 3)
    return np.hstack([own, np.vstack([none, own])[:-1], np.vstack([own, none])[1:], told])


@dataclass
class Tree:
    """A node: ``answer`` in a leaf, else a feature, a threshold and two trees (up to it, above it)."""

    answer: bool = False
    feature: int = -1
    threshold: float = 0.0
    low: "Tree | None" = None
    high: "Tree | None" = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.answer)
        below = x[:, self.feature] <= self.threshold
        out = np.empty(len(x), bool)
        out[below], out[~below] = self.low(x[below]), self.high(x[~below])
        return out


def train(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Tree:
    """A tree that splits where Gini impurity falls most; ties go to the first feature and threshold."""
    leaf = Tree(answer=bool(2 * y.sum() > len(y)))
    if not depth or y.all() or not y.any():
        return leaf
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for threshold in (values[:-1] + values[1:]) / 2:
            below = x[:, f] <= threshold
            impurity = sum(side.sum() * p * (1 - p) for side in (below, ~below) for p in [y[side].mean()])
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, threshold, below)
    if best is None:
        return leaf
    _, f, threshold, below = best
    return Tree(leaf.answer, f, float(threshold), train(x[below], y[below], depth - 1),
                train(x[~below], y[~below], depth - 1))


#: Words of main text that a page needs to tell something without an element for its article.
PLAIN_WORDS = 20
_LONG = "A paragraph tells of the matter at some length, in whole sentences, and goes on for a while. " * 2
_MID = "This sentence stands for the usual text of a page."
_LINKS = "<ul><li><a href='/a'>Start</a></li><li><a href='/b'>News of the day</a></li><li><a href='/c'>About</a></li></ul>"

#: The labelled table: pages as parts of markup, each with the label of all blocks in it (1: main text).
LABELLED = (
    (("<body><nav>" + _LINKS + "</nav><div class='ad'>Buy our fine things today.</div>", 0),
     ("<article><h1>A title</h1><p>" + _LONG + "</p><p>" + _MID + "</p><p>Short.</p></article>", 1),
     ("<footer>&copy; example &middot; " + _MID + "</footer></body>", 0)),
    (("<header><h2>The site</h2><p>Its motto in a few words</p></header>" + _LINKS, 0),
     ("<main><h1>Head line</h1><p>" + _MID + "</p><ul><li>first point</li><li>second point</li></ul><p>" + _LONG + "</p></main>", 1),
     ("<aside><h3>Most read</h3><p>" + _MID + "</p></aside><footer><p>" + _LONG + "</p></footer>", 0)),
    (("<div id='cookie-notice'><p>" + _LONG + "</p><button>Accept</button></div>", 0),
     ("<article><p>One.</p><p>" + _LONG + "<a href='/x'>a link</a></p><blockquote>" + _MID + "</blockquote></article>", 1),
     ("<section class='comments'><h3>Comments</h3><p>" + _LONG + "</p><p>Thanks!</p></section>", 0),
     ("<form><p>Write to us at any time, we read it all.</p><input><button>Send</button></form>", 0)),
    (("<div class='menu'><a href='/1'>One</a> <a href='/2'>Two</a></div><p><a href='/h'>Back to the list of all entries</a></p>", 0),
     ("<div><p>" + _LONG + "</p><p>" + _LONG + "</p><h2>Further on</h2><p>" + _LONG + "</p><p>" + _MID + "</p></div>", 1),
     ("<div><a href='/p'>Previous page</a></div><div><a href='/n'>Next page</a></div><p>Contact</p>", 0)),
    (("<div><a href='/'>Home</a> | <a href='/s'>Sections</a> | <a href='/z'>Archive</a></div>", 0),
     ("<h1>What the page is about</h1><p>" + _LONG + "</p><table><tr><td>" + _MID + "</td></tr></table><p>" + _LONG + "</p>", 1),
     ("<div class='sidebar'><p>" + _LONG + "</p><p>" + _MID + "</p></div><p><a href='/t'>Terms</a> <a href='/i'>Imprint</a></p>", 0)),
    (("<p>Menu</p><p>Log in</p>", 0),
     ("<article><header><h1>Title of it</h1><p>By somebody</p></header><section><p>" + _LONG + "</p><p>Yes.</p><p>No.</p></section>", 1),
     ("<div class='advert'><p>" + _LONG + "</p></div>", 0),
     ("<p>" + _MID + "</p><p><a href='/q'>A source</a></p></article>", 1),
     ("<div class='related'>" + _LINKS + "</div>", 0)),
    (("<article><h1>Title</h1><p>One.</p><p><a href='/all'>All of it is a link</a></p></article>", 1),),
    (("<main><p><a href='/s'>Source</a></p><ul><li><a href='/1'>first</a></li><li>x</li></ul><p>" + _MID + "</p></main>", 1),
     ("<p>Log in</p>", 0)),
    (("<article><p>Hi</p></article>", 1),),
    (("<article><p>" + _LONG + "</p><p><a href='/l'>" + _MID + "</a></p><p>The last words of it</p></article>", 1),),
    (("<article><h1><a href='/self'>" + _MID + "</a></h1><p>" + _LONG + "</p><p><a href='/m'>more</a></p></article>", 1),),
    (("<div class='banner'>" + _MID + "</div>", 0),
     ("<article><p><a href='/o'>one</a></p><p>two</p><p><a href='/t'>three</a></p></article>", 1), (_LINKS, 0)),
    (("<article><pre>a | b | c</pre><h2>End</h2></article>", 1), ("<footer>Imprint</footer>", 0)),
    (("<article><p>" + _LONG + "</p>", 1), ("<aside><p>" + _MID + "</p></aside>", 0), ("<p>And on.</p></article>", 1)),
    (("<p>" + _LONG + "</p><p>" + _MID + "</p>", 1),),
    (("<p>" + _MID + "</p>", 1),),
    (("<p>Title of a plain page</p><p>" + _LONG + "</p><p>Fine.</p><p>" + _LONG + "</p>", 1),),
    (("<p><a href='/en'>English</a></p><p>Search</p>", 0),),
)


def plain(pages=LABELLED) -> tuple:
    """The pages with their ``article`` and ``main`` elements made ``div``; those whose article is a few words only would then
    tell nothing, and are left out."""
    told = [page for page in pages if sum(len(re.sub(r"<[^>]*>", " ", m).split()) for m, label in page if label) >= PLAIN_WORDS]
    names = {0: "article|main", 1: "article|main|header"}  # an article's own header would be the page's
    return tuple(tuple((re.sub(rf"(</?)(?:{names[label]})\b", r"\1div", m), label) for m, label in page) for page in told)


def labelled(pages=LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the pages' blocks.  A part of the markup has a run of blocks with its label."""
    xs, ys = [], []
    for page in pages:
        cuts, so_far = [0], ""
        for markup, _ in page:
            so_far += markup
            cuts.append(len(blocks(so_far)))
        xs.append(features(blocks(so_far)))
        ys.append(np.repeat([bool(label) for _, label in page], np.diff(cuts)))
    return np.vstack(xs), np.concatenate(ys)


@lru_cache(maxsize=1)
def tree() -> Tree:
    return train(*labelled(LABELLED + plain()))


def main_text(html: str | None, model: Tree) -> str:
    page = blocks(html or "")
    if not page:
        return ""
    return "\n".join(b.text for b, main in zip(page, model(features(page))) if main)


def extract(pages: DataFrame, model: Tree | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    model = model or tree()
    rows = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, model).encode("utf-8", "replace").decode() for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def block_table(pages: DataFrame) -> DataFrame:
    """(page_id, nr, text, main, and the features) of every block."""
    model = tree()
    rows = pages.select("page_id", "html")
    names = ["page_id", "nr", "text", "main", *FEATURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id, html in zip(batch.column("page_id"), batch.column("html").to_pylist()):
                page = blocks(html or "")
                x = features(page)
                main = model(x) if page else np.empty(0, bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([id.as_py()] * len(page), batch.column("page_id").type), pa.array(range(len(page)), pa.int32()),
                     pa.array([b.text for b in page], pa.string()), pa.array(main), *[pa.array(c) for c in x.T]], names=names)

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, nr int, text string, main boolean, "
                           + ", ".join(f"{f} double" for f in FEATURES))
