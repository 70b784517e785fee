"""Main text of web pages from streaming parser events.

The standard library's parser sends its events to a small collector that cuts
the page into lines (the text of one block element each) and counts, for each
line, the characters of text and the tags met.  The text-to-tag ratios of the lines are
smoothed with a Gaussian and clustered by a threshold (their mean less half a deviation,
never more than what one plain sentence reaches); a region is the element that parts
the page: an ``article`` or ``main``, else the nearest section or division.  A
region with a line in the content cluster is content, with all its lines, so
that short paragraphs and headings stay.

Parts that are never content don't take part: navigation, headers, footers, sidebars,
forms, and elements whose class, id or role names an advert, a notice, a menu or comments.
What an element is called is weaker than what it holds, so this is decided when the
whole page is known:

* an element that holds ``main``, the page's article, or, unless it is navigation,
  header, footer or aside by its tag, more than half of the page's text, stays;
* names that only tell of a layout (``has-sidebar``, ``no-sidebar``, ``comment-free``) say nothing;
* one that is never closed ends where a block begins that can't belong to it: an
  article or ``main``; for a menu also a paragraph, a first heading, a quotation or a table;
* of an article's own header, the headings stay.

Each row is parsed whole and on its own, in time that follows its length: no
shuffle, memory of one batch.

Defined cases: a null or empty page has the empty text; very long pages and deep
nesting are parsed whole; a tag that the page's
end cuts off is dropped; unclosed elements end with their region; lines with equal
ratios (ties) are alike; repeated rows
are extracted one by one; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_batches

#: Elements by their part in the page.
SILENT = frozenset("head title script style noscript template iframe object svg canvas button select textarea audio video map".split())
NEVER = frozenset("nav header footer aside form fieldset dialog menu".split())
#: Those of them whose tag outweighs the share of the text they hold.
ALWAYS = frozenset("nav header footer aside menu dialog".split())
REGIONS = frozenset("article main section div body td".split())
BLOCKS = REGIONS | NEVER | frozenset("html p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption blockquote pre figure "
                                     "figcaption address details summary hr center".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What can't be part of a menu.
NO_MENU = frozenset("p h1 blockquote pre table tr th td".split())
MENU_NAMES = re.compile(r"(?:^|[\s_-])(?:nav\w*|menu\w*|breadcrumbs?|toolbar)(?=$|[\s_-])", re.I)
OTHER_PARTS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?\w*|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"nav\w*|menu\w*|breadcrumbs?|sidebar|side|widget\w*|header|masthead|footer|foot|copyright|comments?|commentlist|disqus|replies|"
    r"respond|share\w*|sharing|social\w*|related|recommend\w*|newsletter|subscribe\w*|signup|login|search\w*|pagination|pager|toolbar|"
    r"skip\w*|contentinfo|complementary|navigation|hidden)(?=$|[\s_-])", re.I)
#: Themes name layouts on these elements; an article only says so of itself.
UNNAMED = frozenset(("main", "body", "html"))
OTHER_ARTICLES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|reply|replies|related|recommend\w*|teaser)(?=$|[\s_-])", re.I)
#: A layout's features, not an element's part.
LAYOUT = re.compile(r"(?:^|\s)(?:(?:has|no|with|without|not)[_-]\S*|\S*[_-](?:free|less|enabled|disabled))(?=$|\s)", re.I)
SPACE = re.compile(r"\s+")
CUT_TAG = re.compile(r"<(?:[A-Za-z!/?][^<>]*)?\Z")
SIGMA = 1.0
SENTENCE = 20.0


class Collector(HTMLParser):
    """Lines of (text, tags, element, block) and the elements that part the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, str]] = []
        # Elements in the order they begin; 0 is the page.
        self.tag, self.parent, self.closed = [""], [-1], [True]
        self.other, self.menu = [False], [False]  # a part that is never content, by tag or name; a menu
        self.named_article = [False]
        self._open: list[int] = [0]
        self._count: Counter[str] = Counter()
        self._silent: list[str] = []
        self._block = ""
        self._text: list[str] = []
        self._tags = 0

    def end_line(self) -> None:
        text = SPACE.sub(" ", "".join(self._text)).strip()
        if text:
            self.lines.append((text, self._tags, self._open[-1], self._block))
        if text or not self._text:
            self._tags = 0
        self._text = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SILENT:
            self._silent.append(tag)
            return
        if tag in BLOCKS:
            self.end_line()
            self._block = tag
            if self._silent:
                self._silent = [t for t in self._silent if t not in ("button", "select", "map", "object")]  # unclosed: they hold no blocks
        self._tags += 1
        if tag in VOID:
            if tag == "br":
                self._text.append(" ")
            return
        said = " ".join(LAYOUT.sub(" ", v) for k, v in attrs if k in ("class", "id", "role") and v) if tag not in UNNAMED else ""
        hidden = tag not in UNNAMED and any(k == "hidden" for k, _ in attrs)
        named = bool(said and (OTHER_ARTICLES if tag == "article" else OTHER_PARTS).search(said))
        other = tag in NEVER or named or hidden
        if not other and tag not in REGIONS:
            return  # only what parts the page is followed; the rest may stay unclosed
        if other and tag not in BLOCKS:
            self.end_line()
        self._open.append(len(self.tag))
        self._count[tag] += 1
        self.tag.append(tag)
        self.parent.append(self._open[-2])
        self.closed.append(False)
        self.other.append(other)
        self.menu.append(tag in ("nav", "menu") or bool(said and MENU_NAMES.search(said)))
        self.named_article.append(bool(said and OTHER_ARTICLES.search(said)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            if tag in self._silent:
                del self._silent[self._silent.index(tag):]
            return
        if tag in BLOCKS or self._count[tag]:
            self.end_line()
            self._block = ""
        self._tags += 1
        if self._count[tag]:
            while True:
                at = self._open.pop()
                self._count[self.tag[at]] -= 1
                if self.tag[at] == tag:
                    self.closed[at] = True
                    return

    def handle_data(self, data: str) -> None:
        if not self._silent:
            self._text.append(data)

    def content(self) -> tuple[list[tuple[str, int, int]], set[int]]:
        """Lines of (text, tags, region) outside the parts that are never content, and
        the regions of the page's articles or ``main``."""
        n = len(self.tag)
        chars = [0] * n
        for text, _, at, _ in self.lines:
            chars[at] += len(text)
        for at in range(n - 1, 0, -1):
            chars[self.parent[at]] += chars[at]
        # The outermost article or main around each element; articles among comments and the
        # like count only where there is no other.
        inside, aside = [0] * n, [False] * n
        for at in range(1, n):
            up = self.parent[at]
            aside[at] = aside[up] or self.named_article[at] or self.tag[at] in ("aside", "footer")
            inside[at] = inside[up] or (at if self.tag[at] in ("article", "main") else 0)
        roots = {at for at in inside if at and chars[at]}
        mains = {at for at in roots if self.tag[at] == "main"}
        articles = roots - mains
        plain = {at for at in articles if not aside[at]}
        best = max(plain or articles, key=lambda at: (chars[at], -at), default=0)
        holds = [False] * n  # holds main or the page's article
        for at in (*mains, best):
            while at > 0 and not holds[at]:
                holds[at] = True
                at = self.parent[at]
        # From which line on an unclosed part doesn't apply any more.
        ends: dict[int, int] = {at: -1 for at in range(1, n) if self.other[at] and not self.closed[at]}
        above = [0] * n  # the nearest unclosed part around each element
        for at in range(1, n):
            above[at] = at if at in ends else above[self.parent[at]]
        for i, (_, _, at, block) in enumerate(self.lines):
            part = above[at]
            while part and ends[part] < 0:
                if inside[at] > part or self.menu[part] and block in NO_MENU:
                    ends[part] = i
                    part = above[self.parent[part]]
                else:
                    break
        # An element's lines before this one belong to a part that is never content.
        until, headed = [-1] * n, [False] * n
        most = chars[0] / 2
        for at in range(1, n):
            up = self.parent[at]
            until[at], headed[at] = until[up], headed[up]
            if not self.other[at]:
                continue
            if self.tag[at] == "header" and inside[up] and not headed[at]:
                headed[at] = True
            elif not holds[at] and (self.tag[at] in ALWAYS or chars[at] <= most or chars[up] == chars[at] and self.tag[up] in ALWAYS):
                end = ends.get(at, -1)
                until[at] = max(until[at], end if end >= 0 else len(self.lines))
        region = [0] * n
        for at in range(1, n):
            up = self.parent[at]
            opens = self.tag[at] in ("article", "main") or self.tag[at] in REGIONS and not inside[at]
            region[at] = at if opens else region[up]
        kept = [(text, tags, region[at]) for i, (text, tags, at, block) in enumerate(self.lines)
                if i >= until[at] and (not headed[at] or block in HEADINGS)]
        wanted = mains | plain or articles
        return kept, {region[at] for at in range(1, n) if inside[at] in wanted}


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - reach), min(len(values), i + reach + 1)
        weights = kernel[lo - i + reach:hi - i + reach]
        out.append(sum(v * w for v, w in zip(values[lo:hi], weights, strict=True)) / sum(weights))
    return out


def extract(html: str) -> str:
    """The main text, its blocks joined by line feeds."""
    page = Collector()
    page.feed(CUT_TAG.sub("", html))
    page.close()
    page.end_line()
    lines, main = page.content()
    if not lines:
        return ""
    ratios = smoothed([len(text) / max(1, tags) for text, tags, _ in lines])
    mean = sum(ratios) / len(ratios)
    deviation = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    threshold = min(SENTENCE, mean - deviation / 2)
    # Where the page marks its article, other regions aren't asked.
    asked = main & {region for _, _, region in lines}
    content = {region for (_, _, region), r in zip(lines, ratios, strict=True) if r >= threshold and (not asked or region in asked)}
    content = content or asked
    return "\n".join(text for text, _, region in lines if region in content)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row."""

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py() or "") for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(
        pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")), extracted, f"page_id {kind}, url string, text string, n_chars long")
