"""Main text of web pages by the distribution of line blocks.

A page is read once, tag by tag, into lines (one per block element).  Lines
inside menus, headers, footers, side bars, notices, adverts, forms and reader
comments are dropped: by element, by role, or by a class or id whose name says
so -- as a whole or as its head noun (``post-comments``, ``sidebar-wrap``; not
``share-price`` or ``related-work``).  Headings and elements within a line are
never judged by class or id inside an article, and headings never by id.  An id counts only on a
container whose own heading does not read the same (site generators make ids
from headings), and inside an article only if the container holds reader
comments or mostly links.  A form or a marked container is not dropped if it
holds the article or most of the page's letters outside links.  Where the
page marks its article (``article``, ``main``) the lines in it are the text.
Elsewhere letters outside links are summed over a sliding window of lines: the
text starts where the sum first surges, with the short lines right before, and
dives where no line of the next ``DIVE`` has a letter outside links; what comes
after a dive belongs to the text only if the sum surges again, and then so does
all between.  Lines at the end that only state a copyright go.

What is lost: on a page without a marked article, short lines after a long list
of links, and a short article whose lines never surge above half of the
largest window elsewhere.

Defined results: a null page gives an empty text; text outside any tag is a
line; unclosed and cut-off tags end with the page; repeated rows and rows
without id give a row each; an empty table gives an empty one; further columns
are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

from pyspark.sql import DataFrame

from .common import arrow_map, pick

#: lines of a window
WINDOW = 3
#: weight a window must exceed for a surge on a page without a marked article
SURGE = 80
#: lines without a letter outside links that make a dive
DIVE = 6

# fixed values: element names of the HTML standard
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big button cite code data del dfn em font i img ins kbd label mark meter output progress q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr "
                    "math merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup "
                    "mtable mtd mtext mtr munder munderover semantics".split())
_RAW = frozenset("script style textarea title xmp".split())
_DROPPED = frozenset("nav footer aside form select option datalist dialog menu noscript template iframe object svg canvas audio video "
                     "map head header annotation annotation-xml".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: blocks of running text, in which a button is a word among others
_RUNNING = frozenset(("p", "li", "dd", "dt", "td", "th", "blockquote", "figcaption", "pre", *_HEADINGS))
_ENDED_BY_BLOCK = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd", "li", "td", "th", "tr", "option"))
_SECTIONS = frozenset(("html", "body", "main", "article"))
#: words of class and id names, and roles, that mark what is not the article
_SIGNS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
                   "alert popup modal overlay sidebar aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs header masthead "
                   "footer comment comments disqus respond replies reply share sharing social related recommended recommendations newsletter "
                   "subscribe subscription signup login search pagination pager toolbar skip".split())
#: words of a name that say nothing of what is in the element
_HOLDERS = frozenset("wrap wrapper container box area section block list inner outer item items link links bar panel form group row col column slot unit "
                     "button buttons icon icons top bottom left right main primary secondary previous next layout x px post posts article articles entry "
                     "entries stories reading content holder region zone space placeholder mobile desktop title".split())
_COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b)[^\n]{0,150}(?:19|20)[0-9]{2}|all rights reserved", re.IGNORECASE)
#: signs that no wrapper of an article has, and words that tell an article's header from the site's
_READERS = frozenset("comment comments disqus respond replies reply related recommended recommendations".split())
_OWN = frozenset("entry post article story content main page title headline".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())

_OPEN = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|!--|[!?])")
_REST = re.compile(r"[^\"'>]*(?:\"[^\"]*\"[^\"'>]*|'[^']*'[^\"'>]*)*>")
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def tokens(html: str):
    """(kind, value): ("text", raw), ("open", (name, attributes)) or ("close", name)."""
    at, n, quoted = 0, len(html), True
    while at < n:
        m = _OPEN.search(html, at)
        if not m:
            yield "text", html[at:]
            return
        if m.start() > at:
            yield "text", html[at: m.start()]
        if m[2] is None:
            comment = m[0] == "<!--"
            end = html.find("-->" if comment else ">", m.end())
            at = n if end < 0 else end + (3 if comment else 1)
            continue
        name = m[2].lower()
        rest = _REST.match(html, m.end()) if quoted else None
        if rest:
            end = rest.end()
        else:                                     # a quote that never closes: tags end at the next >
            quoted = False
            end = html.find(">", m.end()) + 1 or n
        if m[1]:
            yield "close", name
        else:
            yield "open", (name, html[m.end(): end - 1])
            if name in _RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, end)
                end = n if not close else close.start()      # its text is skipped
        at = end


def _sign(one: str) -> tuple[str, list[str]]:
    """The sign that a class or id name is, or has as its head noun (else ""), and its words."""
    words = _WORD.findall(_CAMEL.sub("-", one).lower())
    head = len(words)
    while head > 1 and words[head - 1] in _HOLDERS:
        head -= 1
    noun = words[head - 1] if head else ""
    if noun not in _SIGNS or head > 1 and words[head - 2] in ("has", "with", "no", "without"):
        return "", words
    return noun, words


def _mark(name: str, attributes: str) -> str:
    """How surely the element does not belong to an article: "" (it may), "hard",
    "soft" (class, id or form: also wrappers of a whole page), "reader" (soft, of
    reader comments or related pages), "header" (soft, nothing but a header),
    "title" (that of an article), "inline" (a class on a heading or within a line) or "button"; with "#" where only an id says so."""
    if name == "button":
        return "button"
    if not attributes:
        return "soft" if name == "form" else "hard" if name in _DROPPED else ""
    if name in _SECTIONS and "role" not in attributes:
        return ""
    by = {"class": set(), "id": set()}
    own = False
    for key, *values in _ATTR.findall(attributes):
        key, value = key.lower(), next(filter(None, values), "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" and name not in _INLINE:
            return "hard"
        if key == "role" and value.strip().lower() in _ROLES:
            return "hard"
        if key == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return "hard"
        if key in by and name not in _SECTIONS:
            for one in value.split():
                sign, words = _sign(one)
                if sign:
                    by[key].add(sign)
                    own = own or not _OWN.isdisjoint(words)
    if name in _HEADINGS or name in _INLINE:
        return "inline" if by["class"] else ""
    signs = by["class"] or by["id"]
    if name == "header":
        return "title" if signs == {"header"} and own else "hard"
    if name in _DROPPED and name != "form":
        return "hard"
    some = "" if by["class"] or not by["id"] or name == "form" else "#"
    if some and name in _RUNNING:
        return ""
    if signs == {"header"} and name != "form":
        return "title" if own else "header" + some
    return ("reader" if signs & _READERS else "soft" if signs or name == "form" else "") + some


class _Page:
    """Where the elements of a page end, and what they hold."""

    def __init__(self, items):
        self.items = items
        self.ends: dict[int, int] = {}             # index of the opening tag -> of the closing one
        self.mass = [0]                            # letters outside links before each item
        self.every = [0]                           # and all letters
        self.at: dict[str, list[int]] = {"article": [], "main": [], "h1": []}
        opened: dict[str, list[int]] = {}
        in_link = 0
        for i, (kind, value) in enumerate(items):
            letters = 0
            if kind == "text":
                letters = len("".join((unescape(value) if "&" in value else value).split()))
            else:
                name = value if kind == "close" else value[0]
                if name == "a":
                    in_link = kind == "open"
                if kind == "open":
                    if name not in _VOID:
                        opened.setdefault(name, []).append(i)
                    if name in self.at:
                        self.at[name].append(i)
                elif opened.get(name):
                    self.ends[opened[name].pop()] = i
            self.mass.append(self.mass[-1] + (0 if in_link and kind == "text" else letters))
            self.every.append(self.every[-1] + letters)

    def end(self, start: int, name: str) -> int:
        """Where an element that is dropped from ``start`` on stops being dropped."""
        if name not in _ENDED_BY_BLOCK:
            return self.ends.get(start, len(self.items))
        for i in range(start + 1, len(self.items)):
            kind, value = self.items[i]
            other = value if kind == "close" else value[0] if kind == "open" else "b"
            if other not in _INLINE and other not in _RAW and (kind == "close" or name in ("p", "li") or other == name):
                return i
        return len(self.items)

    def named_after_heading(self, start: int, end: int) -> bool:
        """Whether the first heading of an element reads like its id."""
        own = next((next(filter(None, v), "") for k, *v in _ATTR.findall(self.items[start][1][1]) if k.lower() == "id"), "")
        for i in range(start + 1, min(end, start + 40)):
            kind, value = self.items[i]
            if kind == "open" and value[0] in _HEADINGS:
                stop = min(self.ends.get(i, i + 20), i + 20)
                text = "".join(unescape(v) for k, v in self.items[i + 1: stop] if k == "text")
                return _WORD.findall(text.lower()) == _WORD.findall(own.lower())
            if kind == "text" and value.strip():
                return False
        return False

    def spared(self, start: int, name: str, mark: str, inside: bool, kept: int, article: bool) -> bool:
        """Whether a marked element holds the article, or most of the page.
        ``kept``: letters kept if all marked ones are dropped; ``article``: of an article."""
        if mark == "inline":
            return inside
        only_id, mark = mark.endswith("#"), mark.rstrip("#")
        if mark == "hard" or mark == "header" and inside:
            return mark == "header"
        end = self.end(start, name)
        if only_id:
            if self.named_after_heading(start, end):
                return True
            if inside and mark != "reader" and 2 * (self.mass[end] - self.mass[start]) >= self.every[end] - self.every[start]:
                return True                         # less than half of it is links

        def holds(what):
            places = self.at[what]
            i = bisect_left(places, start)
            return i < len(places) and places[i] < end

        if mark == "title":
            return inside or holds("h1")
        if holds("main"):
            return True
        mass = self.mass[end] - self.mass[start]
        if mark == "reader" and (inside or not holds("h1")):
            return False
        return 2 * mass > self.mass[-1] or not article and mass > kept and holds("article")


def lines(html: str) -> list[tuple[str, int, bool, bool]]:
    """(text, letters inside links, dropped, inside article or main) per block, in page order."""
    items = list(tokens(html))
    marks = {i: m for i, (kind, value) in enumerate(items) if kind == "open" and value[0] not in _VOID and (m := _mark(*value))}
    found = _lines(items, marks, None)
    if all(m in ("hard", "button") for m in marks.values()):
        return found
    article = any(a and not d for _, _, d, a in found)
    kept = sum(len("".join(t.split())) - n for t, n, d, a in found if not d and (a or not article))
    page = _Page(items)
    return _lines(items, marks, lambda i, name, inside: page.spared(i, name, marks[i], inside, kept, article))


def _lines(items, marks: dict[int, str], spared) -> list[tuple[str, int, bool, bool]]:
    closes: dict[str, list[int]] = {}
    for i, (kind, value) in enumerate(items):
        if kind == "close":
            closes.setdefault(value, []).append(i)
    out: list[tuple[str, int, bool, bool]] = []
    texts: list[str] = []
    links = inside = in_link = 0
    skip, depth = "", 0                            # the dropped element we are in
    running = False                                # in a block of running text

    def flush():
        nonlocal links
        text = " ".join("".join(texts).split())
        if text:
            out.append((text, links, bool(skip), inside > 0))
        texts.clear()
        links = 0

    for i, (kind, value) in enumerate(items):
        if kind == "text":
            text = unescape(value) if "&" in value else value
            texts.append(text)
            if in_link:
                links += len("".join(text.split()))
            continue
        name = value if kind == "close" else value[0]
        if name == "a":
            in_link = kind == "open"
        if name in _RAW:
            continue
        if name not in _INLINE:
            running = kind == "open" and (name in _RUNNING or running and name in _VOID)
            flush()
            if skip in _ENDED_BY_BLOCK and (kind == "open" and (skip in ("p", "li") or name == skip) or kind == "close" and name != skip):
                skip, depth = "", 0
        if kind == "open":
            if skip:
                depth += name == skip and name not in _VOID
            elif i in marks and not (name == "header" and inside) and not (
                    inside and running if marks[i] == "button" else inside and marks[i] == "inline" or spared and spared(i, name, inside > 0)):
                later = closes.get(name, ())
                if name in _ENDED_BY_BLOCK or later and later[-1] > i:      # an element that never ends hides nothing
                    flush()
                    skip, depth = name, 1
            if name in ("article", "main") and not skip:
                inside += 1
        else:
            if name == skip:
                depth -= 1
                if not depth:
                    flush()
                    skip = ""
            elif name in ("article", "main") and not skip:
                inside = max(0, inside - 1)
    flush()
    return out


def span(weights: list[int], threshold: int, window: int = WINDOW, dive: int = DIVE) -> tuple[int, int]:
    """The lines [from, to) between the first surge (the window sum exceeds the
    threshold, or half the largest sum where that is less) and the last dive
    (``dive`` lines without weight).  Lines with a weight right before the surge
    belong to the text; after a dive it goes on only where the sum surges again."""
    n = len(weights)
    sums = [0] * (n + 1)
    for i, w in enumerate(weights):
        sums[i + 1] = sums[i] + w
    blocks = [sums[min(n, i + window)] - sums[i] for i in range(n)]
    threshold = min(threshold, max(blocks, default=0) // 2)
    start = next((i for i, block in enumerate(blocks) if weights[i] and block > threshold), n)
    if start == n:
        return n, n
    while start and weights[start - 1]:
        start -= 1
    end = start
    for i in range(start, n):
        if weights[i] and (i - end < dive or blocks[i] > threshold):
            end = i + 1
    return start, end


def main_text(html: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    found = [x for x in lines(html or "") if not x[2]]
    if any(inside for *_, inside in found):
        return " ".join(text for text, _, _, inside in found if inside)
    start, end = span([max(0, len("".join(text.split())) - links) for text, links, *_ in found], surge, window)
    while end - start > 1 and len(found[end - 1][0]) < 200 and _COPYRIGHT.match(found[end - 1][0]):
        end -= 1
    return " ".join(x[0] for x in found[start:end])


def extract(pages: DataFrame, window: int = WINDOW, surge: int = SURGE, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batch):
        texts = [main_text(h, window, surge) for h in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    return arrow_map(pick(pages, page_id=id_col, url=url_col, html=html_col), run, "page_id long, url string, text string, n_chars long")
