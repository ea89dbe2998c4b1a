"""HTML extraction: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's parser reads a page in pieces and its events build
lines: a line ends wherever a block element starts or ends. A line's ratio is
its characters per tag, with what stands in links taken off. Ratios are
smoothed with a Gaussian over neighbouring lines, so a short line is lifted by
the prose around it, and two-means clustering of the smoothed ratios gives the
threshold between prose and the rest.

Structure is a feature, not the decision:

- elements that HTML itself defines as no prose (scripts, styles, menus,
  footers, asides, controls ...) give lines of ratio 0, and so do blocks named
  as readers' comments, however long they are beside the article, and links
  alone in a header outside of its headings (share bars);
- a block whose class, id or role hints at other boilerplate has its lines
  weighed by HINT, unless it encloses all prose of the page: then the hint is
  wrong and is dropped (a wrapper named after a sidebar, a page in one form);
- a region, the innermost element that holds MASS of the characters of the
  lines above the threshold, is where the article is. A page's <article> or
  <main> counts as an element like others, only that nothing outside of the
  marked ones is searched while they hold any prose.

Selected are the lines of the region above the threshold, and those that they
carry: lines in the region without a hint, when the region is an element of
its own inside the body, or lines that share their block with selected ones.

Defined results: a null or empty page, or one without content, gives an empty
text; ties of the innermost region go to the first in page order; repeated rows
each give a row; a very long page is parsed in pieces and kept whole; an empty
table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kit

PIECE = 1 << 16
#: Width of the smoothing in lines, weight of hinted lines, and what share of the prose a region holds.
SIGMA, HINT, MASS = 1.5, 0.1, 0.7
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav noscript ol option p pre section select summary table tbody td template tfoot th thead title tr ul".split()
)
#: Elements that are no prose by the definition of HTML.
DROP = frozenset("head nav footer aside script style noscript template iframe object svg canvas button select option textarea input label legend menu dialog audio video".split())
CONTENT = frozenset(("article", "main"))
#: Elements that lines stand in, but that are no place for an article of several lines.
SMALL = frozenset("html body p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption hgroup address tr ul ol dl".split())
#: Words of class names that hint at boilerplate, and words that may stand beside them.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead "
    "footer foot sidebar aside widget widgets cookie cookies consent notice notices alert popup modal newsletter subscribe share sharing social related recommended "
    "recommendations comment comments discussion discussions disclaimer disclaimers disqus reply replies respond login signup search form".split()
)
#: Those that name what readers write; an article is never inside.
READERS = frozenset("comment comments discussion discussions disqus reply replies respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BESIDE = frozenset("top bottom left right side site page main article post user reader readers box block bar area list section inner outer links posts articles stories text".split())
SPACES = re.compile(r"\s+")


def is_boilerplate(names: str, words: frozenset[str] = BOILERPLATE) -> bool:
    """Whether a class, id or role hints at boilerplate: one of the names is made of such words, one of `words` among them, and of words that may stand beside them."""
    tokens = [{w for w in re.split(r"[-_:]+", t) if w} for t in names.lower().split()]
    return any(t & words and t <= BOILERPLATE | BESIDE for t in tokens)


class Line:
    """A line: text, tags since the last one, characters in links, ids of the open blocks and of those that may be a region, innermost hint, whether it may be content."""

    __slots__ = ("around", "hint", "linked", "marked", "may", "path", "tags", "text")

    def __init__(self, text, tags, linked, path, around, hint, may, marked):
        self.text, self.tags, self.linked, self.path, self.around = text, tags, linked, path, around
        self.hint, self.may, self.marked = hint, may, marked


class Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: Open elements: tag, id, id of the innermost hinted one or None, in a dropped one, in a marked one.
        self.open: list[tuple[str, int, int | None, bool, bool]] = []
        self.lines: list[Line] = []
        self.text: list[str] = []
        self.tags = self.linked = self.links = self.elements = 0

    def cut(self) -> None:
        text = SPACES.sub(" ", "".join(self.text)).strip()
        if text:
            _, _, hint, dropped, marked = self.open[-1] if self.open else ("", 0, None, False, False)
            blocks = [(t, i) for t, i, *_ in self.open if t in BLOCK]
            around = tuple(i for t, i in blocks[:-1] if t not in SMALL)
            tags = {t for t, *_ in self.open}
            shared = "header" in tags and not tags & HEADINGS and self.linked >= len(text)
            self.lines.append(Line(text, self.tags, min(self.linked, len(text)), tuple(i for _, i in blocks), around, hint, not dropped and not shared, marked))
            self.tags = 0
        self.text, self.linked = [], 0

    def enter(self, tag: str, attrs) -> None:
        _, _, hint, dropped, marked = self.open[-1] if self.open else ("", 0, None, False, False)
        self.elements += 1
        names = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        named = names and tag not in CONTENT and tag not in ("html", "body")
        if tag == "form" or (named and is_boilerplate(names)):
            hint = self.elements
        dropped = dropped or tag in DROP or (tag == "header" and not marked) or bool(named and is_boilerplate(names, READERS))
        self.open.append((tag, self.elements, hint, dropped, marked or tag in CONTENT))
        self.links += tag == "a"

    def leave(self) -> None:
        self.links -= self.open.pop()[0] == "a"

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.cut()
            if self.open and tag in ("p", "li", "option", "tr", "td", "th", "dt", "dd"):
                self.close_like(tag)
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag not in VOID:
            self.enter(tag, attrs)

    def close_like(self, tag: str) -> None:
        """An unclosed sibling ends where the next one starts."""
        stop = {"p": ("div", "article", "section", "main", "body", "td", "li", "blockquote", "aside", "footer", "nav")}.get(tag, ("ul", "ol", "table", "select", "dl", "menu"))
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self.leave()
                return
            if self.open[i][0] in stop:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.leave()

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.cut()
        self.tags += 1
        if any(t == tag for t, *_ in self.open):
            while True:
                done = self.open[-1][0] == tag
                self.leave()
                if done:
                    break

    def handle_data(self, data):
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        self.text.append(data)
        if self.links:
            self.linked += len(data.strip())


def smooth(x: list[float], sigma: float = SIGMA) -> list[float]:
    r = math.ceil(3 * sigma)
    w = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-r, r + 1)]
    out = []
    for i in range(len(x)):
        lo, hi = max(0, i - r), min(len(x), i + r + 1)
        k = w[lo - i + r : hi - i + r]
        out.append(sum(a * b for a, b in zip(x[lo:hi], k, strict=True)) / sum(k))
    return out


def two_means(x: list[float]) -> float:
    """The threshold between a lower and an upper cluster: the middle of their means, iterated from the extremes."""
    cut = (min(x) + max(x)) / 2
    for _ in range(64):
        low, high = [v for v in x if v < cut], [v for v in x if v >= cut]
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2 if low and high else cut
        if new == cut:
            break
        cut = new
    return cut


def content(lines: list[Line], sigma: float = SIGMA, hint: float = HINT, mass: float = MASS) -> list[str]:
    """The texts of the content lines, in page order."""
    may = [x.may for x in lines]
    if any(x.may and x.marked and len(x.text) > x.linked for x in lines):
        may = [x.may and x.marked for x in lines]
    prose = [len(x.text) - x.linked if ok else 0 for x, ok in zip(lines, may, strict=True)]
    # A hint at what encloses all prose is wrong.
    held: dict[int, int] = {}
    for x, n in zip(lines, prose, strict=True):
        if x.hint is not None:
            for i in x.path:
                held[i] = held.get(i, 0) + n
    hinted = [x.hint is not None and held.get(x.hint, 0) < max(1, sum(prose)) for x in lines]
    ratio = [
        (hint if h else 1.0) * max(0, len(x.text) - 2 * x.linked) / max(1, x.tags) if ok else 0.0
        for x, ok, h in zip(lines, may, hinted, strict=True)
    ]
    if not any(ratio):
        # No prose at all: what is marked as the article is all there is.
        return [x.text for x, ok, h in zip(lines, may, hinted, strict=True) if ok and not h and x.marked]
    level = smooth(ratio, sigma)
    cut = two_means([v for v, ok in zip(level, may, strict=True) if ok])
    core = [ok and not h and v >= cut for v, ok, h in zip(level, may, hinted, strict=True)]
    if not any(core):
        core = [ok and v >= cut for v, ok in zip(level, may, strict=True)]
        hinted = [False] * len(lines)
    inside: dict[int, int] = {}
    for x, on in zip(lines, core, strict=True):
        for i in x.around if on else ():
            inside[i] = inside.get(i, 0) + len(x.text)
    total = sum(len(x.text) for x, on in zip(lines, core, strict=True) if on)
    # Elements are numbered in page order; of nested ones that hold enough, the innermost has the largest number.
    region = max((i for i, n in inside.items() if n >= mass * total), default=0)
    blocks = {x.path[-1] for x, on in zip(lines, core, strict=True) if on and x.path}
    return [
        x.text
        for x, ok, h, on in zip(lines, may, hinted, core, strict=True)
        if (not region or region in x.path) and (on or (ok and not h and (region or (x.path and x.path[-1] in blocks))))
    ]


def extract(html: str | None) -> str:
    """Main text of a page, a block a line."""
    if not html:
        return ""
    parser = Lines()
    for i in range(0, len(html), PIECE):
        parser.feed(html[i : i + PIECE])
    parser.close()
    parser.cut()
    return "\n".join(content(parser.lines))


def extract_pages(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """page_id, url, text, n_chars for every page."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [extract(h.as_py()) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
                )

    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return slim.mapInArrow(kit.lean(run), "page_id long, url string, text string, n_chars long")
