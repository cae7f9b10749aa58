"""Main text of web pages.

The standard library's streaming parser turns a page into lines, one for each block
of text between block tags. A line has the ratio of its text outside links to the tags in it. The ratios
are smoothed along the page by a Gaussian, and the lines are split into two clusters by a threshold
between their means (two-means on the logarithm). Lines of the upper cluster tell where the content is:
the main container is the innermost article or main element that holds ``MOST`` of their text, or else the
innermost container that holds ``NEARLY_ALL`` of it.

All lines of the main container are the text, long and short ones, lists, tables and nested sections alike,
but for what is outside by structure: elements such as ``nav``, ``footer`` and ``form``, by role, and containers
whose class or id says so. Names of paragraphs and headings say nothing. Of a main container that is no
article, boxes made of links are left out too.

A null or empty page, and one without text, give the empty text. Character references
are decoded, white space within a block is one blank, blocks are joined by one. Equal page_ids are pages of
their own; other columns are not looked at.
"""

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from curfew.llm import steps
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMOOTHING = 1.0
#: Shares of the text of the upper cluster that a main container holds.
MOST, NEARLY_ALL = 0.5, 0.95

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is never shown as such.
UNSHOWN = frozenset("head iframe noembed noframes noscript object script style svg template textarea title".split())
#: Regions that are not the article, by tag, by role, and by a word of class or id.
OUTSIDE = frozenset("aside button dialog footer form header menu nav select".split())
OUTSIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter "
    "notice notices pager pagination popup promo promoted promotion related replies reply respond share sharing sidebar "
    "signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: They close an open paragraph.
ENDS_PARAGRAPH = BLOCKS - {"br", "html", "body", "caption", "option", "optgroup", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: Their end tags may be left out; the next such tag ends them, within the same list or select.
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup")}
#: Parts of a table, likewise: what a tag ends, within the same table.
CELLS = ("td", "th", "caption", "colgroup")
SECTIONS = ("thead", "tbody", "tfoot")
ENDED_IN_TABLE = {"td": CELLS, "th": CELLS, "tr": ("tr", *CELLS)} | dict.fromkeys(SECTIONS, (*SECTIONS, "tr", *CELLS))
#: An open one of these hides the list items around it; an address, div or p does not.
BOUNDS = BLOCKS - {"address", "div", "p"} | {"button", "object", "template"}
#: Whatever holds these words is not the article, even within one.
REMARKS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus promo promoted promotion related replies "
    "reply respond sponsor sponsored".split()
)
#: What they name lies elsewhere: a box that has a sidebar is no sidebar.
BESIDE = frozenset("has is no with without".split())
CONTAINERS = frozenset("article aside body details div fieldset footer form header main nav section table td ul ol".split())
#: Names of these say nothing about the layout.
PROSE = frozenset("a b blockquote caption cite code dd dt em figcaption h1 h2 h3 h4 h5 h6 i p pre q span strong".split())
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def named(attributes: list[tuple[str, str | None]]) -> set[str]:
    """Words of the classes and the id."""
    out: set[str] = set()
    for name, value in attributes:
        for part in (value or "").split() if name in ("class", "id") else ():
            words = WORD.findall(CAMEL.sub(" ", part).lower())
            out.update(() if words and words[0] in BESIDE else words)
    return out


def hidden(attributes: list[tuple[str, str | None]]) -> bool:
    for name, value in attributes:
        value = (value or "").strip().lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in OUTSIDE_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def outside(tag: str, attributes: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """Whether an element is not the article for good, and whether it is not by its place
    in the layout, which an article or main element within it overrules."""
    if not attributes or tag in ("html", "body"):
        return tag in OUTSIDE, False
    words = set() if tag in PROSE else named(attributes)
    for_good = tag in OUTSIDE or hidden(attributes) or bool(words & REMARKS)
    return for_good, tag not in ("article", "main") and bool(words & OUTSIDE_WORDS)


class Lines(HTMLParser):
    """Collects (region, text, tags, characters in links) for each block of text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[int, str, int, int]] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0
        self.unshown = self.outside = self.beside = 0
        self.open: list[tuple[str, int, int, int, int, int]] = []
        #: Where the open elements of each tag, the blocks and the bounds stand in ``open``.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.bounds: list[int] = []
        self.region = 0
        #: The container around each container, and whether it is an article.
        self.around, self.is_article = [0], [False]

    def updatepos(self, i, j):
        """Line numbers are not needed."""
        return j

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((self.region, text, self.tags, self.linked))
        self.parts, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag, attributes):
        if tag in BLOCKS:
            self.flush()
            if tag in ENDS_PARAGRAPH:
                self.close_paragraph()
            self.close_implied(tag)
        self.tags += 1
        if tag in VOID:
            return
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        if tag in BOUNDS:
            self.bounds.append(len(self.open))
        self.open.append((tag, self.region, self.unshown, self.outside, self.beside, self.links))
        self.unshown += tag in UNSHOWN
        for_good, by_place = outside(tag, attributes)
        self.outside += for_good
        self.beside = 0 if tag in ("article", "main") else self.beside + by_place
        self.links += tag == "a"
        if tag in CONTAINERS:
            self.around.append(self.region)
            self.is_article.append(tag in ("article", "main"))
            self.region = len(self.around) - 1

    def close_paragraph(self) -> None:
        """A block ends a paragraph that its container holds open."""
        if self.blocks and self.open[self.blocks[-1]][0] == "p":
            self.leave(self.blocks[-1])

    def close_implied(self, tag: str) -> None:
        """Ends what is open of a list, select or table and ends where ``tag`` begins."""
        for ended in ENDED_BY.get(tag, ()):
            if self.bounds and self.open[self.bounds[-1]][0] == ended:
                self.leave(self.bounds[-1])
        if tag in ENDED_IN_TABLE:
            table = self.last("table")
            ended = [k for k in map(self.last, ENDED_IN_TABLE[tag]) if k > table]
            if ended:
                self.leave(min(ended))

    def last(self, tag: str) -> int:
        """Where the innermost open element of a tag stands, or -1."""
        places = self.places.get(tag)
        return places[-1] if places else -1

    def leave(self, k: int) -> None:
        _, self.region, self.unshown, self.outside, self.beside, self.links = self.open[k]
        for tag, *_ in self.open[k:]:
            self.places[tag].pop()
        del self.open[k:]
        for places in (self.blocks, self.bounds):
            while places and places[-1] >= k:
                places.pop()

    def handle_startendtag(self, tag, attributes):
        self.handle_starttag(tag, attributes)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        at = self.last(tag)
        if at >= 0:
            self.leave(at)

    def handle_data(self, data):
        if self.unshown or self.outside or self.beside:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data)

    def close(self):
        super().close()
        self.flush()


def smoothed(values: np.ndarray, sigma: float = SMOOTHING) -> np.ndarray:
    """A Gaussian of ``sigma`` lines, with the ends repeated."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(values, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """Halfway between the means of two clusters; below all if they lie close."""
    low, high = values.min(), values.max()
    for _ in range(50):
        middle = (low + high) / 2
        upper = values > middle
        if not upper.any() or upper.all():
            break
        new = values[~upper].mean(), values[upper].mean()
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high - low > math.log(4) else -math.inf


def upper_lines(lines: list[tuple[int, str, int, int]]) -> np.ndarray:
    """Which lines are in the upper cluster of smoothed text-to-tag ratios."""
    unlinked = np.array([max(0, len(text) - linked) for _, text, _, linked in lines], float)
    tags = np.array([max(1, tags) for _, _, tags, _ in lines], float)
    ratio = np.log1p(smoothed(unlinked / tags))
    return ratio >= threshold(ratio)


def main_container(parser: Lines, mass: np.ndarray) -> int:
    """The container that holds the content, given the text of the upper cluster in each."""
    total = mass.copy()
    for k in range(len(total) - 1, 0, -1):  # a container comes before those within it
        total[parser.around[k]] += total[k]
    for least, wanted in ((MOST, True), (NEARLY_ALL, False)):
        fit = [k for k in range(len(total)) if total[k] > least * total[0] and (parser.is_article[k] or not wanted)]
        if fit and total[0]:
            return fit[-1]
    return 0


def main_text(html: str) -> str:
    """The lines of the main container, in page order."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    owner = np.array([region for region, *_ in lines])
    size = np.array([len(text) for _, text, _, _ in lines], float)
    linked = np.array([min(len(text), linked) for _, text, _, linked in lines], float)
    boxes = len(parser.around)
    mass = np.bincount(owner, (size - linked) * upper_lines(lines), boxes)
    main = main_container(parser, mass)
    inside = np.zeros(boxes, bool)
    inside[main] = True
    for k in range(main + 1, boxes):
        inside[k] = inside[parser.around[k]]
    if not parser.is_article[main]:
        inside &= np.bincount(owner, linked, boxes) * 2 <= np.bincount(owner, size, boxes)
    return " ".join(text for (_, text, _, _), k in zip(lines, owner, strict=True) if inside[k])


def texts(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(page) if page else "" for page in pages.to_pylist()], pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its number of code points for each row of ``pages``."""
    steps.ship(pages.sparkSession)
    text = F.arrow_udf(texts, "string").asNondeterministic()("html")
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
