"""Main text of web pages by line-block distribution.

Markup is stripped to lines: paragraphs, headings, list items and table rows end a line; containers (div, section, table
and the like) leave an empty line at either end besides; inline tags leave nothing; references are decoded and white
space becomes one space. Tags that say themselves that they have no content (scripts, forms, navigation, footers) are
stripped with their text.

Every line has a weight: its length, of which characters in links count a fifth. Weights are summed over sliding windows of
lines. The sums dive to zero at a gap of empty lines, and surge where they reach the page's threshold: ``SURGE_SHARE`` of the
greatest sum, ``SURGE_CHARS`` at most. Each stretch between two dives that surges is text and is kept whole, all others
(menus, rows of links, adverts, short notices) go. Lines inside an article or main element always reach the threshold,
and what stands outside of such an element weighs less. At the edges of a stretch outside of one, lines that are mostly links go
too.

An element whose class, id or role names it as no content (an advert, readers' comments) has windows of its own, weighs
``NAMED_WEIGHT`` and has to reach ``SURGE_CHARS``: 5,000 characters within a window, or 20,000 beside an article, are no
notice, whatever the name says. Names count only if every part of a whole name is a word for such elements, and never on
a paragraph or heading, nor on an article or main element outside of another one.

Defined cases: null and empty html, pages without text and pages cut off anywhere (inside a tag, a reference, an
element) give what stands before the cut, or an empty text; equal rows and ties give equal rows; an empty table gives an empty
result; extra columns are left alone. Very long pages: memory and time follow the longest page.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldspark.llm.spans import bound_batches

WINDOW_LINES = 2
SURGE_SHARE, SURGE_CHARS = 0.3, 100
LINK_WEIGHT = 0.2  # of a character in a link
OUTSIDE_WEIGHT = 0.25  # of a line outside the article of a page that has one
NAMED_WEIGHT = 0.02  # of a line in an element whose name says that it is no content

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre tr td th thead tbody tfoot caption figcaption hr address".split())
NO_CONTENT = frozenset(
    "nav header footer aside form menu dialog template noscript iframe object svg canvas audio video select button "
    "label input fieldset head".split()
)
NEVER_NAMED = frozenset("p h1 h2 h3 h4 h5 h6 body html".split())
RAW = ("script", "style", "textarea", "title", "xmp", "noembed")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset(("article", "main"))
SECTIONS = CONTENT | {"body", "html"}
# Words for elements that are no content, and words that may stand beside them in a name.
NO_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements adsense sponsor sponsored sponsors promo promos promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar sidebars widget widgets related share "
    "sharing social comment comments disqus respond reply replies cookie cookies consent gdpr notice notices popup modal newsletter subscribe "
    "login search pagination pager toolbar skip".split()
)
BESIDE_WORDS = frozenset(
    "site main top bottom left right side box wrap wrapper container block section area bar list item items links link inner outer "
    "buttons button form slot unit group content panel global primary secondary user post reader posts stories articles".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
_ATTRIBUTES = r"(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + rf")\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<more>{_ATTRIBUTES})(?:>|\Z)|</?\Z",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"(?:^|[\s/])(class|id|role|href|name)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*))", re.IGNORECASE)
NAME_PART = re.compile(r"[a-z]+|[0-9]+")


def attributes(more: str) -> dict[str, str]:
    """The attributes of a tag that say what it is."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(more):
        found.setdefault(name.lower(), "".join(values))
    return found


def _no_content_name(token: str) -> bool:
    parts = NAME_PART.findall(token.lower())
    words = [p for p in parts if not p.isdigit()]
    return any(w in NO_CONTENT_WORDS for w in words) and all(w in NO_CONTENT_WORDS or w in BESIDE_WORDS for w in words)


def named_no_content(name: str, more: str) -> bool:
    """Whether class, id or role name an element that is no content."""
    if name in NEVER_NAMED or "=" not in more:
        return False
    of = attributes(more)
    tokens = [*of.get("class", "").split(), *of.get("id", "").split()]
    return of.get("role", "").lower() in ROLES or any(_no_content_name(t) for t in tokens)


class Line(NamedTuple):
    text: str
    linked: int  # characters inside links
    content: bool  # inside an article or main element
    flow: int  # 0, or the number of the element by whose name it is no content


class _Lines:
    """Collects the lines of a page while its tokens are read."""

    def __init__(self):
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.linked = 0
        self.in_link = False
        self.inside = 0  # open article and main elements
        self.skipped: str | None = None  # name of the element that is being stripped
        self.depth = 0
        self.named: str | None = None  # name of the element that is no content by its class, id or role
        self.named_depth = 0
        self.flows = 0

    def add(self, raw: str) -> None:
        if raw and self.skipped is None:
            text = references.unescape(raw)
            self.parts.append(text)
            if self.in_link:
                self.linked += len(text.strip())

    def end(self, gap: int = 0) -> None:
        """Ends the line, if it has text, and leaves ``gap`` empty ones. A link ends with its line."""
        text = " ".join("".join(self.parts).split())
        flow = self.flows if self.named else 0
        if text:
            self.lines.append(Line(text, min(self.linked, len(text)), self.inside > 0 and not flow, flow))
        self.lines += [Line("", 0, False, flow)] * gap
        self.parts.clear()
        self.linked = 0
        self.in_link = False

    def strip(self, name: str) -> None:
        self.end()
        self.skipped, self.depth = name, 1

    def _leaves(self, name: str, closing: bool, more: str) -> bool:
        """Whether a tag ends an element that is not closed: where an article begins, or with what surrounds it."""
        return name in SECTIONS and (closing or name != "html" and not named_no_content(name, more))

    def in_stripped(self, name: str, closing: bool, more: str) -> bool:
        """Whether the tag belongs to the stripped element, as its end tag does."""
        self.depth += _nesting(self.skipped, name, closing, more)
        if self.depth and not self._leaves(name, closing, more):
            return True
        self.skipped = None
        self.end()
        return name not in SECTIONS

    def watch_named(self, name: str, closing: bool, more: str) -> None:
        """Ends the named element with its end tag or, if it has none, like a stripped one."""
        self.named_depth += _nesting(self.named, name, closing, more)
        if not self.named_depth or self._leaves(name, closing, more):
            self.end()
            self.named = None

    def name_flow(self, name: str) -> None:
        if self.named is None:
            self.end()
            self.flows += 1
            self.named, self.named_depth = name, 1

    def inline(self, name: str, closing: bool, more: str) -> None:
        if name == "br":
            self.parts.append(" ")
        elif name == "a":
            of = {} if closing or "=" not in more else attributes(more)
            anchor = "href" not in of and ("name" in of or "id" in of)
            self.in_link = not closing and not anchor
        if not closing and name not in VOID and named_no_content(name, more):
            self.name_flow(name)

    def block(self, name: str, closing: bool, more: str) -> None:
        if name in CONTENT:
            self.end(1)
            if not closing and self.inside and named_no_content(name, more):
                self.name_flow(name)
            self.inside = max(0, self.inside + (-1 if closing else 1))
            return
        self.end(0 if name in FLOW or name in VOID else 1)
        if closing or name in VOID or name in SECTIONS or more.rstrip().endswith("/"):
            return
        # A header inside an article is the article's own.
        own_header = self.inside and (name == "header" or "header" in attributes(more).get("class", "").lower().split())
        if own_header:
            return
        if name in NO_CONTENT:
            self.strip(name)
        elif named_no_content(name, more):
            self.name_flow(name)


def _nesting(element: str | None, name: str, closing: bool, more: str) -> int:
    """How a tag changes the depth of open elements of the same name."""
    if name != element or name in VOID:
        return 0
    return -1 if closing else 0 if more.rstrip().endswith("/") else 1


def lines(page: str) -> list[Line]:
    """All lines of a page in order; containers and stripped elements leave empty ones."""
    state, at = _Lines(), 0
    for token in TOKEN.finditer(page):
        state.add(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        closing, more = bool(token["close"]), token["more"] or ""
        if state.skipped is not None and state.in_stripped(name, closing, more):
            continue
        if state.named is not None:
            state.watch_named(name, closing, more)
        (state.inline if name in INLINE else state.block)(name, closing, more)
    state.add(page[at:])
    state.end()
    return state.lines


def weights(rows: list[Line]) -> list[float]:
    """What each line counts in the sums of its windows."""
    outside = OUTSIDE_WEIGHT if any(r.content for r in rows) else 1.0

    def weight(r: Line) -> float:
        if r.content:
            return float(SURGE_CHARS + len(r.text))
        return outside * (NAMED_WEIGHT if r.flow else 1.0) * (len(r.text) - r.linked + LINK_WEIGHT * r.linked)

    return [weight(r) for r in rows]


def _without_edge_links(rows: list[Line], stretch: list[int]) -> list[int]:
    """The lines of a stretch that have text, without those at its edges that are mostly links."""
    kept = [k for k in stretch if rows[k].text]
    links = [not rows[k].content and 2 * rows[k].linked > len(rows[k].text) for k in kept]
    first = next((k for k, link in enumerate(links) if not link), len(kept))
    last = next((k for k in range(len(kept), first, -1) if not links[k - 1]), first)
    return kept[first:last]


def main_text(page: str | None) -> str:
    """The text between surges and dives of the line-block distribution."""
    rows = lines(page or "")
    own = weights(rows)
    flows: dict[int, list[int]] = {}
    for k, row in enumerate(rows):
        flows.setdefault(row.flow, []).append(k)
    blocks = [(at, [sum(own[k] for k in at[i : i + WINDOW_LINES]) for i in range(len(at))]) for at in flows.values()]
    greatest = max((max(sums) for at, sums in blocks if not rows[at[0]].flow), default=0.0)
    kept: list[int] = []
    for at, sums in blocks:
        surge = SURGE_CHARS if rows[at[0]].flow else min(SURGE_CHARS, SURGE_SHARE * greatest)
        i = 0
        while i < len(at):
            dive = i
            while dive < len(at) and sums[dive]:
                dive += 1
            if dive > i and max(sums[i:dive]) >= surge:
                kept += _without_edge_links(rows, at[i:dive])
            i = max(dive, i + 1)
    return "\n".join(rows[k].text for k in sorted(kept))


SCHEMA = "page_id long, url string, text string, n_chars long"


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    bound_batches(pages.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                texts = [main_text(page) for page in part.column(2).to_pylist()]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(extract, SCHEMA)
