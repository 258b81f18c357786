"""Main text of web pages by scores on the tree of elements.

Every block of text passes points for its length and commas to the elements around it. An
element's points are discounted by the share of its text that stands in links, and by marks: words of a
class or id that speak of menus, adverts, comments and the like. The best element, or the article around it,
and those next to it that also look like text are kept, without menus, forms and scripts and
without marked elements. A mark never takes out what holds the main text, and if nothing would be left, marks
don't count at all.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapseflow.llm import tokens
from lapseflow.llm.registry import query, table

PIECE = 1 << 19

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What they hold is text up to their own end tag.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rt rp s samp small span "
    "strike strong sub sup time tt u var wbr label output".split()
)
#: Never part of an article.
_NEVER = frozenset(
    "script style noscript template head title nav header footer aside form button select option textarea input "
    "iframe object embed applet svg canvas audio video dialog menu menuitem map noembed noframes xmp datalist math".split()
)
#: Words of a class, id or role that mark what is not the article.
_MARKS = frozenset(
    "nav navbar navigation menu menubar submenu sidebar aside side footer foot header masthead banner breadcrumb "
    "breadcrumbs ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion cookie "
    "cookies consent gdpr notice notification alert popup modal overlay dialog comment comments commentlist disqus "
    "respond reply replies share sharing social related recommended recommendations widget subscribe subscription newsletter "
    "signup login signin search pager pagination paging toolbar skip complementary contentinfo outbrain taboola "
    "toc hidden rail tags meta byline copyright legal disclaimer feedback form discussion discuss responses reviews "
    "adbox adslot adunit adwrap dfp banners menus subnav topnav offcanvas paywall".split()
)
#: Beginnings and ends of such words.
_MARKED_START = ("advert", "cookie", "breadcrumb", "sidebar", "newsletter", "sponsor", "footer", "navbar")
_MARKED_END = ("comments", "sidebar", "footer", "navbar", "menu", "masthead")
#: Marks that don't count on an element that is also named as main text.
_SOFT = frozenset("banner head header foot meta byline tags rail side hidden copyright legal form feedback toolbar".split())
#: Marks that are also ordinary words: on prose of some length they don't count.
_ORDINARY = frozenset("social reviews legal tags side meta rail".split())
_PROSE = 80
#: Parts of a class or id that say what an element has or lacks, not what it is.
_HAS = frozenset("has have with without no not non is show hide free enabled disabled".split())
#: What of a marked element's points counts.
DISCOUNT = 0.25
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of a class, id or itemprop of the main text itself.
_MAIN = frozenset("article articlebody main content post entry story body text".split())
_IN_HEAD = frozenset("title meta link script style base noscript template".split())
#: A start tag of the key closes an open element of the values.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"),
}
#: Where the search for an element to close ends.
_WALLS = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
    "option": ("select",), "tbody": ("table",), "tfoot": ("table",),
}
_WORD = re.compile(r"[a-z]+")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_COMMA = re.compile("[,،、，]")


class Page:
    """The elements of a page in order: tag, parent, whether it and all below go, and marks; and its pieces of text."""

    def __init__(self, source: str) -> None:
        self.tags = ["html"]
        self.parents = [-1]
        self.gone = [False]
        self.main = [False]
        #: Whether a word marks the element as something else: 1, only if it isn't prose; 2, in any case.
        self.marks = [0]
        #: (element, text); a break between blocks has no text.
        self.pieces: list[tuple[int, str | None]] = []
        self._stack = [0]
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            low = source.find("<", at)
            if low < 0:
                self._text(source[at:])
                return
            if low > at:
                self._text(source[at:low])
            if source.startswith("<!--", low):
                close = source.find("-->", low + 4)
                at = end if close < 0 else close + 3
            elif source.startswith(("<!", "<?"), low):
                close = source.find(">", low)
                at = end if close < 0 else close + 1
            elif found := _TAG.match(source, low) or _LOOSE_TAG.match(source, low):
                at = found.end()
                tag = found[2].lower()
                if found[1]:
                    self._end(tag)
                else:
                    self._start(tag, found[3])
                    if tag in _RAW:
                        close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                        at = close.end() if close else end
                        self._end(tag)
            elif low + 1 < end and source[low + 1] == "/":
                close = source.find(">", low)
                at = end if close < 0 else close + 1
            else:
                self._text("<")
                at = low + 1

    def _text(self, text: str) -> None:
        self.pieces.append((self._stack[-1], text))

    def _break(self) -> None:
        self.pieces.append((self._stack[-1], None))

    def _pop_to(self, names: tuple[str, ...], walls: tuple[str, ...]) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag in names:
                del self._stack[depth:]
                return
            if tag in walls:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "html":
            return
        if tag not in _INLINE and tag not in _VOID:
            self._pop_to(("p",), ("td", "th", "li", "button", "object", "table", "article", "section", "div"))
        if tag not in _IN_HEAD:
            self._pop_to(("head",), ("body",))
        if tag in _CLOSES:
            names = _CLOSES[tag]
            for _ in names:
                self._pop_to(names, _WALLS[tag])
        if tag not in _INLINE:
            self._break()
        if tag in _VOID:
            return
        words, main, hidden = set(), tag in ("article", "main"), False
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _UNSEEN.search(value):
                hidden = True
            elif name in ("class", "id", "role"):
                for token in value.split():
                    own = _WORD.findall(token)
                    if not (len(own) > 1 and _HAS.intersection(own)):
                        words.update(own)
            if name == "itemprop" and value == "articlebody" or name == "role" and value in ("main", "article"):
                main = True
        marks = {w for w in words if w in _MARKS or w.startswith(_MARKED_START) or w.endswith(_MARKED_END)}
        if words & _MAIN or tag == "article":
            marks -= _SOFT
        if tag in ("body", "html", "main"):
            marks = set()
        above = self._stack[-1]
        # An article's own heading stands in its header.
        around = self.parents[above]
        heading = tag in _HEADINGS and self.tags[above] == "header" and self._within_main(around) and not self.gone[around]
        self.tags.append(tag)
        self.parents.append(above)
        self.gone.append((self.gone[above] and not heading) or tag in _NEVER or hidden)
        self.main.append(main)
        self.marks.append(0 if not marks else 1 if marks <= _ORDINARY else 2)
        self._stack.append(len(self.tags) - 1)

    def _within_main(self, i: int) -> bool:
        while i >= 0 and not self.main[i]:
            i = self.parents[i]
        return i >= 0

    def _end(self, tag: str) -> None:
        if tag in _VOID:
            if tag == "br":
                self._break()
            return
        inline = tag in _INLINE
        if not inline:
            self._break()
        for depth in range(len(self._stack) - 1, 0, -1):
            other = self.tags[self._stack[depth]]
            if other == tag:
                del self._stack[depth:]
                return
            if inline and other not in _INLINE or other in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                return


def _marked(page: Page, size: list[float], linked: list[float]) -> list[bool]:
    """The elements that marks tell apart from the main text, and all below them.

    A marked element that holds an article of its own that isn't marked is the layout around it.
    """
    n = len(page.tags)
    holds = [False] * n
    for i in range(n - 1, 0, -1):
        holds[i] = holds[i] or (page.main[i] and not page.marks[i] and not page.gone[i] and size[i] > 0)
        # Not through a marked article, such as a comment.
        holds[page.parents[i]] = holds[page.parents[i]] or (holds[i] and not (page.marks[i] and page.main[i]))
    found = [False] * n
    for i in range(1, n):
        prose = size[i] >= _PROSE and linked[i] < 0.25 * size[i]
        own = page.marks[i] == 2 or page.marks[i] == 1 and not prose
        found[i] = found[page.parents[i]] or (own and not (holds[i] and not page.main[i]))
    return found


def _kept(page: Page, by_marks: bool = True) -> list[bool]:
    """Which elements belong to the main text, without looking at what is gone."""
    n = len(page.tags)
    size, linked, points = [0.0] * n, [0.0] * n, [0.0] * n
    text: dict[int, list[str]] = {}
    in_link = [False] * n
    block = list(range(n))
    for i in range(1, n):
        above = page.parents[i]
        in_link[i] = in_link[above] or page.tags[i] == "a"
        if page.tags[i] in _INLINE:
            block[i] = block[above]
    for i, words in page.pieces:
        if words is not None and not page.gone[i]:
            length = len(words.strip())
            size[i] += length
            linked[i] += length * in_link[i]
            text.setdefault(block[i], []).append(words)
    for i in range(n - 1, 0, -1):
        size[page.parents[i]] += size[i]
        linked[page.parents[i]] += linked[i]
    marked = _marked(page, size, linked) if by_marks else [False] * n
    for i, parts in text.items():
        joined = "".join(parts).strip()
        if not joined:
            continue
        value = (1 + len(_COMMA.findall(joined)) + len(joined) / 100) * (DISCOUNT if marked[i] else 1)
        # A block of its own tag passes its points on, a container with bare text keeps them.
        level = 1 if page.tags[i] in ("p", "pre", "blockquote", "li", "td", "dd", "figcaption") or page.tags[i] in _HEADINGS else 0
        at = page.parents[i] if level and i else i
        share = 1.0
        for k in range(5):
            # Marked text gives no points to what isn't marked.
            if at < 0 or marked[i] and not marked[at]:
                break
            points[at] += value * share
            at, share = page.parents[at], 0.5 if k == 0 else share * 2 / 3

    def density(i: int) -> float:
        return linked[i] / size[i] if size[i] else 0.0

    final = [points[i] * (1 - density(i)) if not page.gone[i] else 0.0 for i in range(n)]
    # Where elements are marked as main text, the best lies in one of these, however long the rest is.
    within = [False] * n
    for i in range(n):
        within[i] = page.main[i] and not page.gone[i] and not marked[i] or i > 0 and within[page.parents[i]]
    has_main = any(w and f > 0 for w, f in zip(within, final, strict=True))
    best = max((i for i in range(n) if within[i] or not has_main), key=lambda i: (final[i], -i))
    chosen = set()
    around = -1
    if final[best] > 0:
        around = best
        while around >= 0 and not (page.main[around] and not marked[around]):
            around = page.parents[around]
        top = around if around >= 0 else best
        chosen.add(top)
        if marked[top]:
            # Marks on the best element, or above it, don't count within it; those below do.
            below = [False] * n
            for i in range(top, n):
                below[i] = i == top or i > top and below[page.parents[i]]
                if below[i]:
                    marked[i] = i > top and (page.marks[i] == 2 or marked[page.parents[i]])
        for i in range(1, n):
            # Beside an element marked as main text only others so marked are text.
            if top and page.parents[i] == page.parents[top] and not page.gone[i] and not marked[i] and (around < 0 or page.main[i]):
                prose = page.tags[i] in ("p", "h1", "h2", "h3", "blockquote", "pre") and density(i) < 0.25
                if prose or final[i] >= 0.2 * final[best] and density(i) < 0.5:
                    chosen.add(i)
    links = [0] * n
    for i in range(n - 1, 0, -1):
        links[i] += page.tags[i] == "a"
        links[page.parents[i]] += links[i]
    kept = [0 in chosen] + [False] * (n - 1)
    for i in range(1, n):
        # Within an element marked as main text a list of links is part of it, such as its sources.
        of_links = around < 0 and page.tags[i] in ("ul", "ol", "dl", "table", "div", "section") and links[i] > 1 and density(i) > 0.5
        above = page.parents[i]
        if page.tags[above] == "header" and not page.gone[i]:
            above = page.parents[above]
        kept[i] = (i in chosen or kept[above]) and not page.gone[i] and not marked[i] and not of_links
    return kept


def main_text(source: str | None) -> str:
    """The main text of a page, its blocks joined by single spaces; empty if there is none."""
    if not source:
        return ""
    page = Page(source)
    for by_marks in (True, False):
        kept = _kept(page, by_marks)
        parts = [" " if words is None else words for i, words in page.pieces if words is None or kept[i]]
        if found := " ".join(html.unescape("".join(parts)).split()):
            return found
    return ""


def extracted(pages: DataFrame, name: str = "text") -> DataFrame:
    """``pages`` with the main text of column ``html`` as ``name``, in place of one of that name.

    Null and empty pages and pages without text have an empty one, an empty table gives an empty result. Each row is
    read for itself, so repeated rows and ids don't matter; a very long page is read whole. Of
    containers with equal points the first one is the best.
    """
    pages = pages.drop(name)
    at = pages.columns.index("html")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in tokens.slices(batch.column(at), PIECE):
                piece = batch.slice(low, high - low)
                found = [main_text(x) for x in piece.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(found, pa.string())], names=[*piece.schema.names, name])

    return pages.mapInArrow(extract, T.StructType([*pages.schema.fields, T.StructField(name, T.StringType())]))


@query("op5_html_text")
def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extracted(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
