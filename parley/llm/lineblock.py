"""Main text of web pages by line-block distribution (operator 5).

Markup is stripped into lines, one per block element; a line of a menu, header, footer,
sidebar, notice, advert, form or reader comment is not one of the article.  The lengths
are summed over a sliding window of WINDOW lines: where the sum rises from nothing is a
surge point, where it falls back is a dive point.  What is between the first surge and the
last dive is kept: of the article element if there is one, else of the stretches that
reach SURGE_CHARS and of the container that holds them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of the sliding window.
WINDOW = 3
#: Without an article or main element, the text starts at the first and ends at the last
#: stretch that has so many characters in a window or is in the container of those.
SURGE_CHARS = 60

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Fixed values of HTML: element names by their role in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript template iframe xmp noframes noembed svg math canvas object audio video".split())
_NESTED = frozenset("svg math canvas object audio video".split())
_HEAD = frozenset("title meta link style script base noscript template".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody tfoot thead tr ul button".split())
_SPACE = frozenset("br td th wbr img input".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
_LISTS = frozenset("ul ol dl table select menu div section article main body html".split())
_CONTAINERS = frozenset("div section center".split())

# Words that tell what is not the article: elements, roles and parts of classes and ids.
_OFF_ELEMENTS = frozenset("nav aside footer form menu dialog button select head".split())
_OFF_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_OFF_PARTS = frozenset(
    "ad ads adv adbox adunit advert adverts advertisement advertising adsense adslot sponsor sponsored promo promos promoted promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup signin login sidebar sidenav nav navbar navigation copyright "
    "menu menus breadcrumb breadcrumbs pagination pager footer masthead topbar share sharing social related recommended recommendations widget widgets "
    "toolbar search skip paywall".split())
_COMMENT_PARTS = frozenset("comment comments disqus respond reply replies discussion commentlist".split())
_PREFIXES = frozenset("has with no without is not".split())
#: Elements of an article's own text: one word of a slug (related-work) does not judge them,
#: only a token all of whose words do, or which adds no more than such a plain word.
_PROSE = frozenset("h1 h2 h3 h4 h5 h6 p section".split())
#: Elements that wrap either: a token judges them by its last word that is not plain
#: (fb-comments, ad-728x90, comments-section, but not social-impact or menu-prices).
_WRAPPERS = frozenset("div ul ol table figure blockquote".split())
_PLAIN_PARTS = frozenset(
    "area articles article bar block body bottom box button buttons by center col column container content coverage cta danger dark default desktop email facebook fixed form "
    "group here holder icons info inline inner item items label large left light line link links list main message mobile module news now outer page panel placement post posts "
    "primary reader readers reading right row secondary section site slot small sticky stories story strip success text thread title toggle top twitter unit us user users "
    "warning whatsapp wrap wrapper".split())
_NUMBER = re.compile(r"\d+(?:x\d+)?")
#: Whole ids that are headings of articles as well.
_SLUGS = frozenset("discussion respond response reply replies".split())
#: With these, a header is that of the article.
_TITLES = frozenset("article content entry post story title".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _role(name: str, attrs: str) -> str:
    """'article' or 'main' for such an element, or one of that role; else ''."""
    if name in ("article", "main"):
        return name
    m = re.search(r"\brole\s*=\s*[\"']?(article|main)\b", attrs, re.I)
    return m[1].lower() if m else ""


def _kind(name: str, attrs: str, in_article: bool, role: str) -> str:
    """What an element makes of its text: '' nothing special, 'off' not the article, 'form'
    not the article unless an article is inside, 'comment' reader comments."""
    kind = "form" if name == "form" else "off" if name in _OFF_ELEMENTS or (name == "header" and not in_article) else ""
    if not attrs.strip() or name in ("html", "body"):
        return kind
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attrs)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        return "off"
    parts: set[str] = set()
    for attribute in ("class", "id"):
        for token in found.get(attribute, "").split():
            split = [x for x in re.split(r"[-_]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", unescape(token)).lower()) if x]
            # what follows "with" and the like says what is inside, or not there
            split = split[: next((i for i, x in enumerate(split) if x in _PREFIXES), len(split))]
            if name in _PROSE:
                if not all(x in _OFF_PARTS or x in _COMMENT_PARTS or x in _PLAIN_PARTS or _NUMBER.fullmatch(x) for x in split):
                    continue
                if attribute == "id" and len(split) == 1 and (split[0] in _OFF_PARTS or split[0] in _SLUGS):
                    continue
            elif name in _WRAPPERS:
                telling = [x for x in split if x not in _PLAIN_PARTS and not _NUMBER.fullmatch(x)]
                if telling and telling[-1] == "header" and _TITLES & set(split):
                    continue
                split = telling[-1:]
            parts.update(split)
    if parts & _COMMENT_PARTS:
        return "comment"
    if role:
        return kind
    if found.get("role", "").lower() in _OFF_ROLES or parts & _OFF_PARTS or ("header" in parts and not in_article):
        return kind or "form"
    return kind


def _raw_end(html: str, name: str, attrs: str, at: int, unclosed: set[str]) -> int:
    """Where the page goes on after the start tag of a raw element that ends at ``at``.

    An element of text only ends at its first closing tag, or with the page.  The others
    (svg, math, object ...) may be nested or empty; without a closing tag the page goes on
    after the start tag, and ``unclosed`` keeps the name, so that the rest is searched once.
    """
    if name not in _NESTED:
        close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
        return close.end() if close else len(html)
    if attrs.rstrip().endswith("/") or name in unclosed:
        return at
    depth, ends = 1, at
    for m in _TOKEN.finditer(html, at):
        if (m["name"] or m["name2"] or "").lower() != name:
            continue
        if m["end"] or m["end2"]:
            depth, ends = depth - 1, m.end()
        elif not (m["attrs"] or m["attrs2"] or "").rstrip().endswith("/"):
            depth += 1
        if not depth:
            return m.end()
    if ends == at:
        unclosed.add(name)
    return ends


@dataclass(slots=True)
class _Line:
    """A line of a page; ``node`` is the innermost container that it is in."""

    text: str
    links: int  # characters within links
    article: bool
    main: bool
    counted: bool  # not of a menu, header ...
    node: int


class _Lines:
    """The lines of a page, and its containers in page order: ``parents`` gives the one
    around each, ``ends`` the last one inside it (0 is the page).

    What is asked about the open elements is counted as they open and close, so the time
    is in proportion to the page however many are open.
    """

    def __init__(self, html: str):
        self.lines: list[_Line] = []
        self.parents, self.ends = [0], [0]
        self._text: list[str] = []
        self._links = 0
        self._stack: list[list] = []  # [element, kind, role, container around it]
        self._node = 0
        self._at: dict[str, list[int]] = {}  # places of the open elements of each name
        self._blocks: list[int] = []
        self._lists: list[int] = []
        self._forms: list[int] = []
        self._kinds = 0
        self._roles = {"article": 0, "main": 0}
        self._run(html)
        self._line()
        self._pop(0)
        self.ends[0] = len(self.parents) - 1

    def _line(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.lines.append(_Line(text, self._links, self._roles["article"] > 0, self._roles["main"] > 0, not self._kinds, self._node))
        self._text, self._links = [], 0

    def _push(self, name: str, kind: str, role: str) -> None:
        at = len(self._stack)
        self._stack.append([name, kind, role, self._node])
        self._at.setdefault(name, []).append(at)
        if name in _BLOCK:
            self._blocks.append(at)
        if name in _LISTS:
            self._lists.append(at)
        if kind:
            self._kinds += 1
            if kind == "form":
                self._forms.append(at)
        if role:
            self._roles[role] += 1
        if name in _CONTAINERS:
            self.parents.append(self._node)
            self._node = len(self.parents) - 1
            self.ends.append(self._node)

    def _pop(self, at: int) -> None:
        while len(self._stack) > at:
            name, kind, role, around = self._stack.pop()
            self._at[name].pop()
            self._kinds -= bool(kind)
            if role:
                self._roles[role] -= 1
            if name in _CONTAINERS:
                self.ends[self._node] = len(self.parents) - 1
                self._node = around
        for places in (self._blocks, self._lists, self._forms):
            while places and places[-1] >= at:
                places.pop()

    def _last(self, names) -> int:
        """The place of the innermost open element of these names, -1 if there is none."""
        return max((self._at[n][-1] for n in names if self._at.get(n)), default=-1)

    def _open(self, name: str, attrs: str) -> None:
        if self._at.get("head") and name not in _HEAD and name != "head":
            self._pop(self._at["head"][0])
        if name in _BLOCK and (p := self._last(("p",))) >= 0 and p == self._blocks[-1]:
            self._pop(p)  # an open paragraph ends here
        if name in _CLOSES and (i := self._last(_CLOSES[name])) > (self._lists[-1] if self._lists else -1):
            self._pop(i)
        role = _role(name, attrs)
        kind = _kind(name, attrs, any(self._roles.values()), role)
        if role and not kind:  # an article in a form or a wrapper is one
            for i in self._forms:
                self._stack[i][1] = ""
            self._kinds -= len(self._forms)
            self._forms = []
        if name not in _VOID:
            self._push(name, kind, role)

    def _close(self, name: str) -> None:
        if self._at.get(name):
            self._pop(self._at[name][-1])

    def container(self, a: int, b: int) -> int:
        """The innermost container around the containers ``a`` to ``b``."""
        while not a <= b <= self.ends[a]:
            a = self.parents[a]
        return a

    def _run(self, html: str) -> None:
        at, n, unclosed = 0, len(html), set()
        while at < n:
            m = _TOKEN.search(html, at)
            text = html[at : m.start() if m else n]
            if text:
                text = unescape(text)
                self._text.append(text)
                if self._at.get("a"):
                    self._links += len(text.strip())
            if not m:
                break
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                continue
            if name in _BLOCK:
                self._line()
            elif name in _SPACE:
                self._text.append(" ")
            if m["end"] or m["end2"]:
                self._close(name)
            else:
                attrs = m["attrs"] or m["attrs2"] or ""
                if name in _RAW:
                    at = _raw_end(html, name, attrs, at, unclosed)
                else:
                    self._open(name, attrs)


def stretches(lengths: list[int], surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(surge, dive) places of a distribution of line lengths: a stretch starts where the sum
    of a window rises from 0, ends where it is 0 again, and reaches ``surge`` in between."""
    n, out, i = len(lengths), [], 0
    while i < n:
        if lengths[i]:
            j, most = i, 0
            while j < n and (total := sum(lengths[j : j + window])):
                j, most = j + 1, max(most, total)
            if most >= surge:
                out.append((i, j))
            i = j
        i += 1
    return out


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in page order, joined by two line feeds.

    In an article element, else a main element, every line counts.  On a page without
    either, a line with half or more of its characters in links counts no characters, so
    that it cannot start or end the text, but is kept inside it.  A stretch below
    SURGE_CHARS is kept between others, and in the container (an element within the page's
    body) around all that reach it.
    """
    page = _Lines(html or "")
    counted = [x for x in page.lines if x.counted]
    own = [x for x in counted if x.article] or [x for x in counted if x.main]
    if own:
        lengths = [len(x.text) for x in own]
        found = stretches(lengths, 1)
    else:
        own = counted
        lengths = [len(x.text) if 2 * x.links < len(x.text) else 0 for x in own]
        found = stretches(lengths, SURGE_CHARS)
        if found:
            nodes = [own[i].node for a, b in found for i in range(a, b) if lengths[i]]
            around = page.container(min(nodes), max(nodes))
            if around:
                inside = [(a, b) for a, b in stretches(lengths, 1) if around <= own[a].node <= page.ends[around]]
                found = sorted({*found, *inside})
        else:
            found = stretches(lengths, 1)
    if not found:
        return ""
    last = max(i for i in range(*found[-1]) if lengths[i])
    return "\n\n".join(x.text for x in own[found[0][0] : last + 1])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (empty if there is none) and n_chars
    (its code points).

    A null or empty page has no text; a page cut off in the middle is read to its end;
    equal rows get equal results; an empty table gives no rows; other columns are ignored.
    """
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
