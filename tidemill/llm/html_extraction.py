"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page as events. Text between block boundaries is a line
with its number of tags. The ratios of text to tags are smoothed with a Gaussian along the page; lines over
the threshold, one standard deviation, are content and vote for the region they are in. The
regions that win are taken with all their lines, so that a short line of an article stays.
Menus, notices and the like are left out by their elements, roles and class names.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import read_table, text_of

SIGMA = 1.0
RADIUS = 3
#: A region of a page without article or main element is taken with this share of the best one's content,
#: and others for being beside or between those taken.
REGION_SHARE = 0.25
#: An element left out for a part of its name, or a form, is the page itself with this share of the text.
PAGE_SHARE = 0.75

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
#: Elements whose text is never the article's.
OUTSIDE = frozenset(
    "head title script style noscript template nav footer aside button select option textarea input label "
    "iframe object svg math canvas audio video map dialog menu".split()
)
#: An open element that the next one of the same kind closes.
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p".split())
REGIONS = frozenset("article main section div body html".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header "
    "masthead comment comments reply replies disqus respond share sharing social related recommended newsletter "
    "subscribe signup login popup modal overlay widget pagination pager toolbar skip".split()
)
#: Name parts that say what an element has, not what it is; and those of an article, whose header is its own.
STATES = frozenset("has with no without is".split())
OWN = frozenset("article post entry story".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
NAMES = re.compile(r"[^a-z0-9]+")


def hinted(names: str) -> str | None:
    """Whether class names and id hint at a menu or the like: by a "whole" name, by a "part" of one, or not."""
    found = None
    for name in names.split():
        parts = NAMES.split(name)
        hints = HINTS.intersection(parts)
        if not OWN.isdisjoint(parts):
            hints -= {"header"}
        if hints and parts[0] not in STATES:
            if len(parts) == 1:
                return "whole"
            found = "part"
    return found


class Page(HTMLParser):
    """Lines of a page: [text, tags, region]; the region is None outside the article.

    Elements left out for their names, forms, and articles are numbered; a line in one that is left
    out has region -1 - the innermost number. Those in ``taken`` are not left out.
    """

    def __init__(self, taken: frozenset = frozenset()):
        super().__init__(convert_charrefs=True)
        self.taken = taken
        self.named: list[str] = []  # why each numbered element is left out
        self.above: list[int | None] = []  # the number around a numbered element
        self.lines: list[tuple[str, int, int | None]] = []
        self.regions: list[str] = ["html"]
        self.parents: list[int] = [0]
        self.open: list[tuple[str, int | None]] = []  # container, its region
        self.parts: list[str] = []
        self.begun: int | None = 0  # region of the first part
        self.tags = 0

    def region(self) -> int | None:
        return self.open[-1][1] if self.open else 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.lines.append((text, self.tags, self.begun))
            self.tags = 0

    def outside(self, tag: str, attrs: list) -> bool | str:
        """Whether an element is left out; by its names only: "whole", "part" or "form"."""
        if tag in OUTSIDE:
            return True
        if tag in ("html", "body", "main"):
            return False
        known = {k: (v or "").lower() for k, v in attrs}
        if tag == "header":
            return not any(t == "article" for t, _ in self.open)
        if "hidden" in known or known.get("aria-hidden") == "true" or known.get("role") in ROLES:
            return True
        if HIDDEN.search(known.get("style", "")):
            return True
        if tag == "article" and not any(t == "article" for t, _ in self.open):
            return False
        return hinted(f"{known.get('class') or ''} {known.get('id') or ''}".lower()) or ("form" if tag == "form" else False)

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCKS
        if block:
            self.flush()
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.handle_data("\n")
            return
        outside = self.outside(tag, attrs)
        if not block and not outside:
            return
        if self.open and block and (self.open[-1][0] == "p" or self.open[-1][0] == tag and tag in CLOSED_BY_SAME):
            self.open.pop()
        here = self.region()
        number = None
        if isinstance(outside, str) or not outside and tag in ("article", "main"):
            number = len(self.named)
            self.named.append(outside or "article")
            self.above.append(-1 - here if here is not None and here < 0 else None)
        if here is None or outside is True:
            inner = None
        elif number is not None and number not in self.taken and (outside or here < 0):
            inner = -1 - number
        elif here < 0:
            inner = here
        elif tag in REGIONS and self.regions[here] != "article" and (self.regions[here] != "main" or tag == "article"):
            inner = len(self.regions)
            self.regions.append(tag)
            self.parents.append(here)
        else:
            inner = here
        self.open.append((tag, inner))

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if tag == "br":
            self.handle_data("\n")

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data):
        # text of an inline element that is left out, as of a button, belongs to no block
        here = self.region()
        if (here is None or here < 0) and self.open[-1][0] not in BLOCKS:
            return
        if not self.parts:
            self.begun = self.region()
        self.parts.append(data)

    def parse_marked_section(self, i, report=1):
        """What looks like <![...> is skipped as far as its end."""
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else -1


def smoothed(ratios: np.ndarray) -> np.ndarray:
    reach = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[RADIUS : RADIUS + len(ratios)]
    return np.convolve(ratios, kernel, "full")[RADIUS : RADIUS + len(ratios)] / weight


def misleading(page: Page) -> set[int]:
    """Numbers of elements left out that hold the page's article or, their names apart, nearly all its text."""
    chars, kept = [0] * len(page.named), 0
    for text, _, region in page.lines:
        if region is not None and region < 0:
            chars[-1 - region] += len(text)
        elif region is not None:
            kept += len(text)
    depth = [0] * len(chars)
    for n, above in enumerate(page.above):
        depth[n] = 0 if above is None else depth[above] + 1
    total = kept + sum(chars)
    for n in range(len(chars) - 1, -1, -1):  # what is inside has the larger number
        if page.above[n] is not None:
            chars[page.above[n]] += chars[n]
    found: set[int] = set()
    if not {page.regions[r] for _, _, r in page.lines if r is not None and r >= 0} & {"article", "main"}:
        articles = [n for n, why in enumerate(page.named) if why == "article" and chars[n]]
        least = min((depth[n] for n in articles), default=0)
        for article in articles:
            n = article if depth[article] == least else None
            while n is not None and n not in found:
                found.add(n)
                n = page.above[n]
    if not found:
        found = {n for n, why in enumerate(page.named) if why in ("part", "form") and chars[n] >= max(1, PAGE_SHARE * total)}
    return found - page.taken


def parsed(html: str) -> Page:
    """The page, without taking elements as left out that hold its article under a misleading name."""
    html, taken = without_open_end(html), frozenset()
    while True:
        page = Page(taken)
        page.feed(html)
        page.close()
        page.flush()
        more = misleading(page)
        if not more:
            page.lines = [(t, tags, r if r is not None and r >= 0 else None) for t, tags, r in page.lines]
            return page
        taken |= more


def with_siblings(page: Page, chosen: set[int], candidates: set[int]) -> set[int]:
    """The chosen regions with those between them, and beside them in one element of the page's body."""
    out = set(chosen)
    for parent in {page.parents[r] for r in chosen if r}:
        own = [r for r in chosen if r and page.parents[r] == parent]
        beside = page.regions[parent] not in ("html", "body")
        near = (r for r in candidates if r and page.parents[r] == parent)
        out.update(r for r in near if beside or min(own) < r < max(own))
    return out


def chosen_regions(page: Page) -> set[int]:
    """The regions that hold the article."""
    inside = [line for line in page.lines if line[2] is not None]
    if not inside:
        return set()
    ratios = smoothed(np.array([len(t) / max(1, tags) for t, tags, _ in page.lines]))
    content = ratios >= ratios.std()
    votes: dict[int, int] = {}
    chars: dict[int, int] = {}
    for (text, _, region), counts in zip(page.lines, content):
        if region is not None:
            chars[region] = chars.get(region, 0) + len(text)
            votes[region] = votes.get(region, 0) + (len(text) if counts else 0)
    for kind in ("article", "main"):
        of_kind = [r for r in chars if page.regions[r] == kind]
        if of_kind:
            voted = {r for r in of_kind if votes[r]}
            return with_siblings(page, voted or {max(of_kind, key=lambda r: chars[r])}, set(of_kind))
    tally = votes if any(votes.values()) else chars
    best = max(tally.values())
    return with_siblings(page, {r for r, v in tally.items() if v >= REGION_SHARE * best}, set(chars))


UNFINISHED = re.compile(r"<[a-zA-Z/!?]")


def without_open_end(html: str) -> str:
    """A comment or a tag that the page's end cuts off has no text; the parser would give it as text."""
    at = html.rfind("<!--")
    if at >= 0 and html.find("-->", at) < 0:
        html = html[:at]
    cut = UNFINISHED.search(html, html.rfind(">") + 1)
    return html[: cut.start()] if cut else html


def main_text(html: str) -> str:
    """The article's blocks, one per line; empty if there is none."""
    page = parsed(html)
    chosen = chosen_regions(page)
    return "\n".join(text for text, _, region in page.lines if region in chosen)


def extracted(html_col: str = "html") -> Column:
    """Main text of a page; of a null page empty."""

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return run(text_of(html_col))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars``, its code points.

    White space inside a block is one space, blocks are joined by a line feed. A null or empty page,
    or one without text outside menus and the like, has an empty text. Nulls in the other columns
    and repeated rows are kept as they are; other columns are ignored.
    """
    rows = pages.select(F.col(id_col), F.col(url_col), extracted(html_col).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


QUERIES = {"op6_html_extraction": op6_html_extraction}
ORACLE = {}
