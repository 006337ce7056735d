"""The main text of web pages by text-to-tag ratio.

Events of the standard library's parser are read in order. Text between two tags that break lines is
a line; it knows how many tags it met and which parts of the page it lies in. Menus, headers,
footers, asides, forms, scripts, styles and what its class or id calls an advert, a notice, a sidebar
or comments are left out as wholes. A form or such a name may also be that of a wrapper: the articles
and main elements that fewest of these hold are kept if they have at least as much text as the page
outside of all of them, and without such a region as many levels of wrappers are kept as hold half of
the page's text. Comments are no wrappers. The text-to-tag ratios of the other lines are smoothed by a
Gaussian, and a threshold of one standard deviation, at most the mean, parts content from the rest; a
line of content reaches it by its own ratio as well.
Regions (an article or the main element, else the nearest division) with a line of content are kept
with all their lines, so a short paragraph stays with its neighbours; a header inside an article
belongs to the article.

NULL and empty pages have no text. Nothing is cut; repeated rows get the same result each.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.common import ship

ship(__name__)

# fixed values: elements by their part in the standard's content model
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
SILENT = frozenset("head script style noscript template iframe object svg math canvas audio video".split())
LEFT_OUT = frozenset("nav footer aside menu dialog button select textarea".split())
OUTSIDE_LEFT_OUT = frozenset("header fieldset".split())
REGIONS = frozenset("article main section div td body".split())
WHOLE = frozenset("article main".split())
CLOSED_BY = {"p": BREAKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
WORDS = (
    "ad ads adv advert advertisement adverts banner sponsor sponsored promo cookie cookies consent gdpr notice notices alert popup "
    "modal newsletter subscribe comment comments respond replies disqus sidebar side widget menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead topbar toolbar share sharing social related recommended login search"
)
# what may stand beside such a word where it names the whole element
BESIDE = (
    "area articles author bar block body bottom box button buttons container content form group header holder icons inner item "
    "items left link links list main media more new outer panel pane post posts primary right section signup site slot small "
    "stories story text thread title top unit wrap wrapper"
)
NAMES = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(WORDS.split())})(?:$|[\s_-])")
WHOLE_NAMES = re.compile(
    rf"(?:^|\s)(?:(?:{'|'.join(BESIDE.split())}|\d+)[_-])*(?:{'|'.join(WORDS.split())})"
    rf"(?:[_-](?:{'|'.join((WORDS + ' ' + BESIDE).split())}|\d+))*(?:$|\s)"
)
COMMENTS = re.compile(r"(?<!has-)(?<!with-)(?<!no-)\b(?:comments?(?:area|body|form|list|section|s)?|respond|replies|disqus)(?:\b|_)")
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
CLOSES = {tag: {held for held, by in CLOSED_BY.items() if tag in by} for tag in BREAKS}
KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2.0)
KERNEL /= KERNEL.sum()


class PageLines(HTMLParser):
    """Collects lines as (text pieces by level, tags, region); the level is the number of elements around that may be wrappers."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []  # tag, left out, region, level
        self.held: Counter[str] = Counter()  # open elements by tag
        self.whole: dict[int, int] = {}  # level of each whole region
        self.regions = 0
        self.lines: list[tuple[list[tuple[int, str]], int, int]] = []
        self.pieces: list[tuple[int, str]] = []
        self.tags = 0

    def _state(self) -> tuple[bool, int, int]:
        return self.open[-1][1:] if self.open else (False, 0, 0)

    def _break(self) -> None:
        if any(not text.isspace() for _, text in self.pieces):
            self.lines.append((self.pieces, self.tags, self._state()[1]))
        self.pieces, self.tags = [], 0

    def _push(self, tag: str, attrs) -> None:
        out, region, level = self._state()
        named = {k: (v or "").lower() for k, v in attrs}
        called = f"{named.get('class', '')} {named.get('id', '')}"
        inside = region in self.whole
        if tag in SILENT or tag in LEFT_OUT or (tag in OUTSIDE_LEFT_OUT and not inside):
            out = True
        elif tag not in ("html", "body") and tag not in WHOLE:
            # within an article a name counts only where all of it is one of boilerplate
            boilerplate = (WHOLE_NAMES if inside else NAMES).search(called)
            if named.get("role") in ROLES or (boilerplate and COMMENTS.search(called)):
                out = True
            elif tag == "form" or named.get("role") == "form" or boilerplate:
                level += 1
        elif tag in WHOLE and COMMENTS.search(called):
            out = True
        if "hidden" in named or named.get("aria-hidden") == "true":
            out = True
        if tag in REGIONS and region not in self.whole:
            self.regions += 1
            region = self.regions
            if tag in WHOLE:
                self.whole[region] = level
        self.open.append((tag, out, region, level))
        self.held[tag] += 1

    def _close_from(self, i: int) -> None:
        for tag, *_ in self.open[i:]:
            self.held[tag] -= 1
        del self.open[i:]

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BREAKS:
            self._break()
            if any(self.held[held] for held in CLOSES.get(tag, ())):
                for i in range(len(self.open) - 1, -1, -1):
                    held = self.open[i][0]
                    if held in CLOSES[tag]:
                        self._close_from(i)
                        break
                    if held in BREAKS:
                        break
        if tag in VOID:
            self.pieces.append((0, " "))
        else:
            self._push(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BREAKS:
            self._break()
        if self.held[tag]:  # a stray end tag does not look through all that is open
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    self._close_from(i)
                    break

    def handle_data(self, data):
        out, _, level = self._state()
        if not out:
            self.pieces.append((level, data))

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)  # as browsers do

    def close(self):
        super().close()
        self._break()


def unwrapped(lines: list[tuple[list[tuple[int, str]], int, int]], whole: dict[int, int]) -> list[tuple[str, int, int]]:
    """The lines with the text that lies in nothing left out, as (text, tags, region)."""

    def text(pieces, level):
        return " ".join("".join(t for at, t in pieces if at <= level).split())

    inside = [(whole[r], len(text(p, whole[r]))) for p, _, r in lines if r in whole]
    least = min((level for level, size in inside if size), default=0)
    base = 0
    if least:
        outside = sum(len(text(p, 0)) for p, _, _ in lines)
        if sum(size for level, size in inside if level == least) < outside:
            least = 0
    if not least and not any(size for level, size in inside if not level):
        levels = sorted({at for p, _, _ in lines for at, _ in p})
        held = [sum(len(text(p, level)) for p, _, _ in lines) for level in levels]
        base = next((level for level, size in zip(levels, held) if size * 2 >= held[-1]), 0)
    kept = [(text(p, least if whole.get(r) == least else base), tags, r) for p, tags, r in lines]
    return [line for line in kept if line[0]]


def content(lines: list[tuple[str, int, int]], whole: dict[int, int]) -> list[str]:
    """The lines of the regions that hold content."""
    if not lines:
        return []
    ratio = np.array([len(text) / max(tags, 1) for text, tags, _ in lines], float)
    smooth = np.convolve(np.pad(ratio, 2, mode="edge"), KERNEL, mode="valid")
    threshold = min(smooth.std(), smooth.mean())
    chosen = {region for (_, _, region), s, own in zip(lines, smooth, ratio) if min(s, own) >= threshold}
    if chosen & whole.keys():
        chosen &= whole.keys()
    return [text for text, _, region in lines if region in chosen]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = PageLines()
    page.feed(html)
    page.close()
    return "\n\n".join(content(unwrapped(page.lines, page.whole), page.whole))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`page_id`, `url`, `text`, `n_chars` of every page."""

    def extracted(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
