"""Main text of HTML pages from parser events, text-to-tag ratios and a clustered threshold.

The standard library's parser streams events. Block elements cut the page into lines; each line has its text, its
number of tags and the region (nearest sectioning ancestor) that it stands in. The ratio of text outside links to tags
is smoothed along the page with a Gaussian, and a two-means clustering of the logarithms gives the threshold. Regions
whose text lies above it are the content, with all their lines, so that one-word paragraphs stay. Where a page has an
article or main element, regions outside it are not considered; inside it a region goes if it lies below the threshold
and is made of links or of other marked-up bits. Tables, and sections of an article or of a region that has begun, belong
to the region around them and are judged with it as a whole (in an article, links in them count as text, as references
are no menu); elsewhere a table's cell is a region of its own only if
it holds several lines, as in pages laid out by tables. Lines inside elements that are never content (menus, headers, footers, asides, forms, scripts, adverts,
notices, comments, by tag or by class, id or role) take part in the smoothing but are never selected.

Time is in proportion to the page: the open elements are also kept by name, so no tag makes a search of all of them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
REGION = frozenset("article main section div body td".split())
#: What an open paragraph, and an open element of CLOSES, cannot be closed through.
PARAGRAPH_STOPS = ("div", "section", "article", "main", "td", "th", "li", "blockquote", "body", "table")
LIST_STOPS = ("ul", "ol", "dl", "table")
NEVER = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea input iframe object svg canvas menu dialog "
    "audio video map".split()
)
#: An element with one of these words in its class, id or role is no content.
NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner banners sponsor sponsored promo promotion cookie cookies consent gdpr notice alert "
    "popup modal overlay sidebar aside widget menu navbar nav navigation breadcrumb breadcrumbs footer masthead comment comments commentlist "
    "disqus replies respond reader-comments related recommended share sharing social newsletter subscribe signup login search toolbar pagination "
    "pager complementary contentinfo".split()
)
#: Words that may stand beside those of NEVER_WORDS: `site-footer` is a footer, `share-price` is no sharing.
BESIDE = frozenset(
    "site page main top bottom left right inner outer wrap wrapper container box block section area list item items bar body content global "
    "primary secondary mobile desktop sticky fixed reader user post article articles posts links link buttons icons form text label row col "
    "column group media panel unit slot large small".split()
)
#: Elements whose start closes an open one of the same group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What may stand in a head; any other element, or text, ends it.
HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
SIGMA = 1.5


def _never(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether a class, id or role names what is no content: a word of NEVER_WORDS, alone or with words of BESIDE or digits."""
    for k, v in attrs:
        if k in ("class", "id", "role") and v:
            for name in v.lower().split():
                words = [w for w in re.split(r"[^a-z]+", name) if w]
                if any(w in NEVER_WORDS for w in words) and all(w in NEVER_WORDS or w in BESIDE for w in words):
                    return True
    return False


class _Lines(HTMLParser):
    """lines: [text parts, tags, characters in links, region, selectable, tags inside the line]."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, bool]] = []  # tag, never content, region, in an article
        self.places: dict[str, list[int]] = {}  # of the open elements in the stack, by tag
        self.lines: list[list] = []
        self.regions = [False]  # by number: whether inside an article or main element
        self.parents = [0]  # by number: the region around it
        self.cells: set[int] = set()  # regions that are cells of tables
        self.begun: set[int] = set()  # regions inside the body that have text of their own
        self.links = 0
        self.comments_end = True  # whether a comment's end may follow
        self._cut()

    def _state(self) -> tuple[bool, int, bool]:
        return self.stack[-1][1:] if self.stack else (False, 0, False)

    def _push(self, tag: str, never: bool, region: int, article: bool) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, never, region, article))

    def _pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self.places[self.stack.pop()[0]].pop()
        self._cut()

    def _last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of these tags; -1 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _cut(self) -> None:
        never, region, _ = self._state()
        if self.lines and not self.lines[-1][0]:
            self.lines[-1][3:5] = [region, not never]
            return
        self.lines.append([[], 1, 0, region, not never, 0])

    def parse_html_declaration(self, i: int) -> int:
        """As in browsers, `<![` is a comment up to the next `>`, or to the end of the page (which is fed whole)."""
        if not self.rawdata.startswith("<![", i):
            return super().parse_html_declaration(i)
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def parse_comment(self, i: int, report: bool = True) -> int:
        """A comment that is never closed ends at the next `>`, so that no text after it is lost."""
        end = self.rawdata.find("-->", i + 2) if self.comments_end else -1
        if end >= 0:
            return end + 3
        self.comments_end = False
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def _leave_head(self, tag: str) -> None:
        head = self._last(("head",))
        if head >= 0 and (tag == "body" or head == len(self.stack) - 1):
            self._pop_to(head)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HEAD:
            self._leave_head(tag)
        if tag == "br":
            self.handle_data(" ")
        if tag in BLOCK or tag in NEVER:
            if tag in BLOCK:
                if tag in CLOSES:
                    self._close_open(CLOSES[tag], LIST_STOPS)
                self._close_open(("p",), PARAGRAPH_STOPS)
            never, region, article = self._state()
            header = tag == "header" or any(k in ("class", "id", "role") and v and "header" in v.lower().split() for k, v in attrs)
            never = never or tag in NEVER or _never(attrs) or (header and not article)
            article = article or tag in ("article", "main")
            if self._opens_region(tag, region, article):
                self.regions.append(article)
                self.parents.append(region)
                region = len(self.regions) - 1
                if tag == "td":
                    self.cells.add(region)
            if tag not in VOID:
                self._push(tag, never, region, article)
            self._cut()
        elif tag not in VOID and _never(attrs):
            _, region, article = self._state()
            self._push(tag, True, region, article)
            self._cut()
        self.lines[-1][1] += 1
        self.lines[-1][5] += self._inside(tag)
        self.links += tag == "a"

    @staticmethod
    def _inside(tag: str) -> bool:
        return tag not in BLOCK and tag not in NEVER and tag not in VOID

    def _opens_region(self, tag: str, region: int, article: bool) -> bool:
        if tag not in REGION or (article and tag in ("section", "td")):
            return False
        return tag != "section" or region not in self.begun

    def _close_open(self, tags: Iterable[str], stop: Iterable[str]) -> None:
        place = self._last(tags)
        if place > self._last(stop):
            self._pop_to(place)

    def handle_endtag(self, tag: str) -> None:
        self.links = max(0, self.links - (tag == "a"))
        self.lines[-1][1] += 1
        self.lines[-1][5] += self._inside(tag)
        place = self._last((tag,))
        if place >= 0:
            self._pop_to(place)
        elif tag in BLOCK:
            self._cut()

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._leave_head("")
        line = self.lines[-1]
        if line[3] not in self.begun and data.strip() and self.places.get("body", [0])[-1:] != [len(self.stack) - 1]:
            self.begun.add(line[3])
        line[0].append(data)
        if self.links and not (self._state()[2] and self._last(("section", "table")) > self._last(("div", "article", "main"))):
            line[2] += len(data.strip())


def two_means(values: list[float]) -> float:
    """Middle of the two means of the values; below all of them where they are one cluster."""
    low, high = min(values), max(values)
    if high - low < 0.7:  # within a factor of two
        return low - 1
    for _ in range(50):
        cut = (low + high) / 2
        below, above = [v for v in values if v <= cut], [v for v in values if v > cut]
        new = (sum(below) / len(below) if below else low, sum(above) / len(above) if above else high)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _whole_tags(html: str) -> str:
    """The page without a tag that its end cuts off, which the parser would take for text."""
    end = html.rfind(">") + 1
    open_ = re.compile("<[a-zA-Z/!?]").search(html, end)
    return html[: open_.start()] if open_ else html


def main_text(html: str | None, sigma: float = SIGMA, threshold: Callable[[list[float]], float] = two_means) -> str:
    """The main text; blocks joined by an empty line. Null, empty and text-free pages give ''.

    The region with the most text above the threshold is always taken.
    """
    if not html:
        return ""
    parser = _Lines()
    parser.feed(_whole_tags(html))
    parser.close()
    lines = [(" ".join("".join(parts).split()), *rest) for parts, *rest in parser.lines]
    lines = [x for x in lines if x[0]]
    if not any(ok for _, _, _, _, ok, _ in lines):
        return ""
    ratios = [max(0, len(text) - linked) / tags for text, tags, linked, _, _, _ in lines]
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(5)]
    smooth = []
    for i in range(len(ratios)):
        near = [(ratios[j], kernel[abs(i - j)]) for j in range(max(0, i - 4), min(len(ratios), i + 5))]
        smooth.append(math.log1p(sum(r * w for r, w in near) / sum(w for _, w in near)))
    cut = threshold(smooth)
    held = Counter(region for _, _, _, region, ok, _ in lines if ok)
    # Cells of one line are judged with what is around them; a region's parent has the lesser number.
    whole = list(range(len(parser.regions)))
    for k in sorted(parser.cells):
        if held[k] < 2:
            whole[k] = whole[parser.parents[k]]
    mass: dict[int, list[float]] = {}
    for (text, _, linked, region, ok, inside), x in zip(lines, smooth, strict=True):
        if ok:
            m = mass.setdefault(whole[region], [0.0, 0.0, 0.0, 0.0, 0.0])
            for i, v in enumerate((len(text), len(text) * x, linked, inside, text.count(" ") + 1)):
                m[i] += v
    pool = {k for k in mass if parser.regions[k]} or set(mass)
    best = max(pool, key=lambda k: mass[k][1])

    def stays(k: int) -> bool:
        size, weighed, linked, inside, words = mass[k]
        above, links = weighed / size >= cut, linked > 0.5 * size
        if parser.regions[k]:
            return above or not (links or inside >= words)
        return above and not links

    chosen = {k for k in pool if stays(k)} | {best}
    return "\n\n".join(text for text, _, _, region, ok, _ in lines if ok and whole[region] in chosen)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """`pages` without the html column, with text and n_chars (code points); columns of these names are replaced."""
    kept = pages.drop("text", "n_chars")
    fields = [f for f in kept.schema if f.name != html]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [main_text(x) for x in pdf[html]]
            yield pdf.drop(columns=html).assign(text=text, n_chars=[len(x) for x in text])

    return kept.mapInPandas(run, f"{schema}, text string, n_chars long")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(C.table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")))
