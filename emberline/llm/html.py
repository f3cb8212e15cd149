"""Main text of web pages by smoothed text-to-tag ratios.

The standard library's parser streams events; block-level tags cut the page
into lines, each with its text, its number of tags and the region (nearest
sectioning element) it stands in.  Elements that by their tag are menus, forms
and the like yield no text, only tags; a menu that the page never closes ends
where an article or main element begins.  Elements whose class, id or role says
that they are no article are named regions, unless they are or hold an article
or main element.  Where an article or main element has text, named regions
outside and inside it are left out; elsewhere a named region must exceed the
best other region ten times.

Each line's ratio of text to tags is smoothed with a Gaussian over its
neighbours, so a short paragraph among long ones stays high and a long advert
among links low.  A threshold on the smoothed ratios - their standard
deviation - splits them into two clusters, and the regions whose peak reaches
it are the content, all their lines included.  A page without an article or main
element whose best ratio is below that of running text has no content.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Element names by role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split())
WHOLE = frozenset("article main".split())
REGIONS = frozenset("article aside body div footer form header main nav section table".split())
DROPPED = frozenset(
    "aside button dialog footer form frame frameset head iframe input menu nav noframes noscript object "
    "option script select style svg template textarea title".split())
# Words in class, id or role that hint at what is not the article.
LOWERED_NAMES = frozenset(
    "ad ads adv advert advertisement adverts advertising alert aside banner breadcrumb breadcrumbs comment "
    "comments consent contentinfo cookie cookies dialog disqus footer form gdpr masthead menu modal nav "
    "navbar navigation newsletter notice notices pagination paywall popup promo promoted promotion recommended "
    "related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget".split())
NAME_PART = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
MENUS = frozenset("aside footer form header menu nav".split())  # may hold an article only by never being closed
RADIUS = 2
LOWERED = 0.1  # of the smoothed ratio stays in an element with such a name
NAMED_FLOOR = 24.0  # characters to a tag, where all regions are named: what short notices stay under
SILENT = -1  # in place of the number of a dropped element that never holds text


class Lines(HTMLParser):
    """Collects (text, plain, tags, region, menu, whole) lines of one page: ``plain`` is the length
    without links, ``menu`` the number of the dropped element around the line, 0 if none, and
    ``whole`` that of the article or main element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int, int]] = []
        # tag, menu, region, article or main, regions of named elements around
        self.open: list[tuple[str, int, int, int, tuple[int, ...]]] = []
        self.lowered: dict[int, tuple[int, ...]] = {}  # of each region
        self.cleared: set[int] = set()  # named elements that hold an article or main
        self.closed: set[int] = set()  # menus with an end tag of their own
        self.within: dict[int, int] = {}  # the menu around each article or main
        self.text: list[str] = []
        self.in_link: list[bool] = []  # of each open element
        self.tags = self.regions = self.menus = self.wholes = self.linked = 0

    def state(self) -> tuple[int, int, int, tuple[int, ...]]:
        return self.open[-1][1:] if self.open else (0, 0, 0, ())

    def cut(self) -> None:
        """Ends a line; without text, its tags count for the line that follows."""
        text = " ".join("".join(self.text).split())
        if text:
            menu, region, whole, _ = self.state()
            self.lines.append((text, max(0, len(text) - self.linked), self.tags, region, menu, whole))
            if not menu:
                self.tags = 0
        self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        named = tag not in VOID and tag not in WHOLE and tag not in ("html", "body") and any(
            v and k in ("class", "id", "role") and not LOWERED_NAMES.isdisjoint(
                p.lower() for p in NAME_PART.split(v)) for k, v in attrs)
        if tag not in INLINE or named:
            self.cut()
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        menu, region, whole, lowered = self.state()
        if not menu and (tag in DROPPED or (tag == "header" and not whole)):
            self.menus += 1
            menu = self.menus if tag in MENUS else SILENT
        elif menu and tag in DROPPED and tag not in MENUS:
            menu = SILENT
        if named or (tag in REGIONS and not whole):
            self.regions += 1
            region = self.regions
            if named:
                lowered = (*lowered, region)
            self.lowered[region] = lowered
        if tag in WHOLE:
            if menu != SILENT:
                self.cleared.update(lowered)
            if not whole:
                self.wholes += 1
                whole = self.wholes
                self.within[whole] = menu
                if menu > 0:  # a region of its own, should the menu never be closed
                    self.regions += 1
                    region = self.regions
                    self.lowered[region] = lowered
        self.open.append((tag, menu, region, whole, lowered))
        self.in_link.append(tag == "a" or bool(self.in_link and self.in_link[-1]))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if tag not in INLINE or (at is not None and self.state()[3] != (self.open[at - 1][4] if at else ())):
            self.cut()
        self.tags += 1
        if at is not None:
            menu = self.open[at][1]
            if menu > 0 and (at == 0 or self.open[at - 1][1] != menu):
                self.closed.add(menu)
            del self.open[at:], self.in_link[at:]

    def handle_data(self, data):
        if self.state()[0] != SILENT:
            self.text.append(data)
            if self.in_link and self.in_link[-1]:
                self.linked += len(" ".join(data.split()))

    def kept(self) -> list[tuple[str, int, int, int, int]]:
        """(text, plain, tags, region, whole) of the lines that no menu holds."""
        return [(t, c, n, r, w) for t, c, n, r, m, w in self.lines
                if not m or (w and m == self.within[w] and m not in self.closed)]


def smooth(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing (the edge values continue beyond the ends)."""
    kernel = np.exp(-np.arange(-RADIUS, RADIUS + 1) ** 2 / (2 * (RADIUS / 2) ** 2))
    return np.convolve(np.pad(ratios, RADIUS, mode="edge"), kernel / kernel.sum(), "valid")


def main_text(html: str) -> str:
    """The main text of a page: its blocks, in page order, one to a line."""
    parser = Lines()
    parser.feed(re.sub(r"<[a-zA-Z/!?][^<>]*\Z", "", html))  # a tag cut off by the end of the page
    parser.close()
    parser.cut()
    lines = parser.kept()
    if not lines:
        return ""
    texts, plain, tags, regions, wholes = zip(*lines)
    level = smooth(np.array([c / max(1, n) for c, n in zip(plain, tags)]))
    named = {r for r, around in parser.lowered.items() if not parser.cleared.issuperset(around)}
    keep = content(level, regions, named, any(w and r not in named for r, w in zip(regions, wholes)))
    return "\n".join(t for t, r in zip(texts, regions) if r in keep)


def content(level: np.ndarray, regions: tuple[int, ...], named: set[int], article: bool) -> set[int]:
    """The regions to keep, by the smoothed ratios of their lines."""
    peaks: dict[int, float] = {}
    for r, x in zip(regions, level.tolist()):
        peaks[r] = max(x, peaks.get(r, 0.0))
    best = max((x for r, x in peaks.items() if r not in named), default=0.0)
    alone = named.issuperset(peaks)
    for r in named & peaks.keys():
        peaks[r] = 0.0 if article or (not alone and LOWERED * peaks[r] < best) else LOWERED * peaks[r]
    top = max(peaks.values())
    if alone and top < LOWERED * NAMED_FLOOR:
        return set()
    low = np.array([peaks[r] and x * (LOWERED if r in named else 1.0) for r, x in zip(regions, level.tolist())])
    threshold = min(float(low.std()), top)
    return {r for r, x in peaks.items() if x >= threshold and x > 0}


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` plus ``text`` (empty if a page has none) and ``n_chars``, its code points.

    NULL pages are empty; an empty table gives an empty result; pages of any
    length are read whole; repeated rows come back each.
    """
    small_batches(pages.sparkSession)

    @F.udf("string", useArrow=True)
    def run(page):
        return main_text(page)

    return pages.withColumn("text", run(F.coalesce(F.col(html), F.lit("")))).withColumn(
        "n_chars", F.char_length("text").cast("long"))
