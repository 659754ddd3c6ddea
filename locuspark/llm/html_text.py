"""HTML extraction by line-block distribution.

Markup is stripped into one line per block element. The text length of each line is
summed over a sliding window of lines; where the sum surges a region of main text begins,
where it dives to nothing the region ends, and the text between is kept. Window sums
decide on every page; markup only changes what a line weighs. Text of menus, headers,
footers, sidebars, notices, adverts, forms and comments weighs nothing, linked text
little, a line of an article or main element enough to surge by itself, and text beside
such an element the less the more of the page's text the element holds. A name that only
holds a word of such a part, as in ``search-results``, is a hint: the text weighs a tenth,
and stands where it outweighs all that is kept without it. On a page of nothing but links
its linked paragraphs stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.shared import column, text_slices

#: Lines of a window, and the window sum from which on text surges; half the page's largest sum is enough.
WINDOW, SURGE = 3, 86

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul head".split()
)
_SILENT = frozenset("script style noscript template head title svg math iframe object embed canvas audio video map".split())
_APART = frozenset("nav footer aside form menu dialog button select textarea input label option fieldset".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_IMPLIED = {t: (t,) for t in "p li dt dd tr td th option".split()} | {"optgroup": ("option", "optgroup")}  # open elements that a start tag closes
_IMPLIED |= {
    t: ("p",)
    for t in "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol pre section summary table ul".split()
}
_WALLS = ("table", "ul", "ol", "dl", "div", "article", "aside", "nav", "header", "footer", "main", "form", "blockquote", "figure", "section", "td", "th", "body", "select", "button")
_MAIN = frozenset("article main".split())
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|banner|sponsor(?:ed)?|promo|sidebar|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|"
    r"cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommend(?:ed|ations)?|comments?|replies|respond|"
    r"disqus|widget|toolbar|pagination|pager|search|copyright|skip-?link)(?:$|[\s_-])",
    re.I,
)
_WHETHER = re.compile(r"(?<!\S)(?:has|with|no|without)[_-]\S+")  # how a page is laid out, not what an element is
_TEASER = re.compile(r"(?:^|\s)(?:comments?|comment-body|reply|replies|ads?|adverts?|advertisements?|sponsored|promo|teaser|related|share|social)(?:$|\s)", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|main|body)[_-]?(?:content|body|text)?(?:$|\s)", re.I)
#: Words that add nothing to the name of a part: ``comment-list`` names one as ``comments`` does.
_PLAIN_NAME = re.compile(
    r"(?:(?:site|page|top|bottom|left|right|main|primary|secondary|global|user|post|article|entry|block|js|is|the|sub|inner|mobile|fixed)[_-])*"
    r"(?:ads?|adverts?|advertisements?|banner|sponsor(?:ed)?|promo|sidebar|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|cookies?|consent|notice|popup|modal|newsletter|"
    r"subscribe|signup|login|share|sharing|social|related|recommend(?:ed|ations)?|comments?|replies|respond|disqus|widget|toolbar|pagination|pager|search|copyright|skip-?link)"
    r"(?:[_-]+(?:box|bar|list|links?|area|section|wrapper|wrap|container|block|widgets?|menu|nav|form|buttons?|items?|inner|unit|slot|panel|group|row|thread|body|text|banner|notice|posts?|articles?|stories|icons?|tools?|\d+))*",
    re.I,
)
_RIGHTS = re.compile(r"^(?:©|\(c\) ?\d{4}|copyright\s*(?:©|\(c\)|\d{4}))|\ball rights reserved\b", re.I)
_UNFINISHED = re.compile(r"<[A-Za-z/!?]")
_CRUMBS = re.compile(r"[^.!?|·»>•]{1,30}(?: [|·»>•] [^.!?|·»>•]{1,30})+")


class Line(NamedTuple):
    """A block's text (empty where all of it is set apart), how much of it is linked, and where it stands; hinted if a name hints at another part."""

    text: str
    linked: float = 0.0
    main: bool = False
    item: bool = False
    hinted: bool = False


class _Lines(HTMLParser):
    """Block lines of a page; what is silent or set apart is left out piece by piece."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool, bool, bool]] = []  # tag, silent, apart, main, hinted
        self.at: dict[str, list[int]] = {}  # where in the stack each tag is open
        self.parts: list[str] = []
        self.linked = self.in_link = 0
        self.beside = False  # whether the block holds text that is set apart
        self.lines: list[Line] = []

    @property
    def top(self) -> tuple[str, bool, bool, bool, bool]:
        return self.stack[-1] if self.stack else ("", False, False, False, False)

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, min(1.0, self.linked / len(text)), self.top[3], bool(self.at.get("li")), self.top[4]))
        elif self.beside:
            self.lines.append(Line(""))
        self.parts, self.linked, self.beside = [], 0, False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.parts.append(" ")
        inline = tag not in _BLOCK and tag not in _APART
        if not inline:
            self.cut()
        if tag == "a":
            self.in_link += 1
        if tag in _VOID:
            return
        for t in _IMPLIED.get(tag, ()):
            self.close(t, implied=True)
        _, silent, apart, main, hinted = self.top
        if attrs or not inline or tag in _SILENT:
            a = dict(attrs)
            names = _WHETHER.sub("", f"{a.get('class') or ''} {a.get('id') or ''}")
            noise = tag not in ("html", "body", "main") and bool((_TEASER if inline or tag == "article" else _NOISE).search(names))
            if tag == "main":  # a wrapper's name does not set the main element apart
                apart = False
            plain = noise and any(_PLAIN_NAME.fullmatch(x) for x in names.split())
            hinted = (hinted or (noise and not plain)) and tag != "main"
            apart = apart or tag in _APART or plain or (a.get("role") or "").lower() in _ROLES or "hidden" in a or (a.get("aria-hidden") or "") == "true"
            apart = apart or (tag == "header" and not main)
            named = tag not in ("html", "body") and not inline and bool(_MAIN_NAMES.search(names))
            main = main or (not noise and (tag in _MAIN or named)) or a.get("role") == "main"
            silent = silent or tag in _SILENT
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, silent, apart, main, hinted))

    def close(self, tag: str, implied: bool = False) -> None:
        if not self.at.get(tag):
            return
        k = self.at[tag][-1]
        if any(self.at[w][-1] > k for w in (_WALLS if implied else ("body", "html")) if self.at.get(w)):
            return
        for t, *_ in self.stack[k:]:
            self.at[t].pop()
        del self.stack[k:]

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag in _SILENT:
            self.close(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag in _BLOCK or tag in _APART:
            self.cut()
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        self.close(tag)

    def handle_data(self, data: str) -> None:
        _, silent, apart, _, _ = self.top
        if silent:
            return
        if apart:
            self.beside = self.beside or not data.isspace()
            return
        self.parts.append(data)
        if self.in_link:
            self.linked += len(data)


def weights(lines: list[Line], hints: bool = False, links: bool = False) -> np.ndarray:
    """What each line weighs in the window sums; 0 for what is not main text.

    ``hints`` lets hinted lines weigh a tenth, ``links`` lets linked paragraphs weigh a fifth, instead of nothing.
    """
    size = np.array([len(x.text) for x in lines], float)
    main, hinted = np.array([x.main for x in lines], bool), np.array([x.hinted for x in lines], bool)
    share = size[main & ~hinted].sum() / max(size.sum(), 1.0)  # of the page's text, in main elements
    linked, item = np.array([x.linked > 0.5 for x in lines], bool), np.array([x.item for x in lines], bool)
    beside = np.zeros(len(lines), bool)
    beside[1:] |= linked[:-1]
    beside[:-1] |= linked[1:]
    menu = linked & (item | (size < 40)) if links else linked & (beside | item)
    plain = np.array([(bool(_RIGHTS.search(x.text)) if len(x.text) < 200 else False) or bool(_CRUMBS.fullmatch(x.text)) for x in lines], bool)
    outside = np.where(menu | plain, 0.0, size * (1 - np.array([x.linked for x in lines]) * 0.8) * max(1 - share, 0.02))
    out = np.where(main, np.where(size > 0, 2 * size + SURGE, 0), outside)
    return np.where(hinted, size * (0.1 if hints else 0.0), out)


def regions(weight: np.ndarray) -> np.ndarray:
    """Which lines are kept: those with weight between a surge of the window sums and the next dive to nothing."""
    n = len(weight)
    sums = np.convolve(np.concatenate([weight, np.zeros(WINDOW)]), np.ones(WINDOW), "valid")[:n]  # of WINDOW lines from each line on
    surge = min(SURGE, sums.max(initial=0) / 2)
    keep, at = np.zeros(n, bool), 0
    while at < n:
        if weight[at] > 0 and sums[at] >= surge:
            end = at
            while end < n and sums[end] > 0:
                end += 1
            keep[at:end] = weight[at:end] > 0
            at = end
        at += 1
    return keep


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks joined by one line feed; '' if it has none."""
    if not page:
        return ""
    reader = _Lines()
    reader.feed(page)
    if not _UNFINISHED.match(reader.rawdata):  # a tag or comment that the page's end cuts off is no text
        HTMLParser.close(reader)
    reader.cut()
    lines = reader.lines
    if not lines:
        return ""
    keep = regions(weights(lines))
    size = np.array([len(x.text) for x in lines])
    hinted = np.array([x.hinted for x in lines], bool) & np.array([x.linked <= 0.5 for x in lines], bool)
    if 0.1 * size[hinted].sum() > size[keep].sum():
        keep |= regions(weights(lines, hints=True)) & hinted
    if not keep.any():
        keep = regions(weights(lines, links=True))
    if not keep.any():  # lines of rights or paths alone
        keep = regions(np.array([0.0 if x.linked > 0.5 or x.hinted else len(x.text) for x in lines]))
    return "\n".join(lines[i].text for i in np.flatnonzero(keep))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per input row.

    Null, empty and markup-only pages give an empty text. Null ids and urls pass through,
    repeated rows repeat, extra columns are ignored, an empty table gives no rows. Pages
    are read whole; unclosed markup ends with the page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            text = [main_text(h) for h in column(b, "html")]
            n = pa.array([len(t) for t in text], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), n], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
