"""Main text of HTML pages by text-to-tag ratios."""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption"
                   " figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section"
                   " select summary table tbody td tfoot th thead title tr ul".split())
SKIPPED = frozenset("script style noscript template svg math iframe object canvas nav footer aside form menu button select"
                    " textarea dialog head title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class, id and role names: furniture anywhere; furniture but inside an article, where the text decides; and what may
# stand beside one of these in a name.
FURNITURE = frozenset("ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies consent"
                      " footer menu nav navbar navigation newsletter notice notices popup promo promos promotion sidebar sponsor sponsored sponsors".split())
DOUBTFUL = frozenset("banner header masthead related respond share sharing social subscribe toolbar".split())
BESIDE = frozenset("area bar block bottom box button buttons container content fixed form global inner item items left links list main"
                   " mobile outer page panel post posts reader row section site slot sticky thread top unit user right widget wrap wrapper"
                   .split())
REGIONS = ("article", "main")
HOLDERS = frozenset(("div", "section", "center", "td", *REGIONS))
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
LINKED = 0.5  # a block of an article that is named like furniture is none unless so much of it is links, or it is thinner than the rest
LINKS = 3  # a longer run of lines that are nothing but links parts two regions
ABOVE = 3  # a heading stands at most so many lines above its text


class Line(NamedTuple):
    text: str
    tags: int
    inside: bool  # within an article, outside all furniture
    linked: bool  # nothing but links
    heading: bool
    holder: int  # number of the innermost open element that may bound a region, 0 for none
    doubt: int  # number of the block of an article, named like furniture, that holds the line; 0 for none
    link_chars: int


def named_like(names: str, words: frozenset[str]) -> bool:
    """Is one whole name made of these words and of what may stand beside them? ``share-price`` and ``post-header`` are not."""
    for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", names).lower().split():
        parts = [part for part in re.split(r"[-_]+", name) if part and not part.isdigit()]
        # "post" speaks of several posts only behind the word, as in related-post.
        if parts and parts[0] != "post" and any(part in words for part in parts) and all(
                part in FURNITURE or part in DOUBTFUL or part in BESIDE for part in parts):
            return True
    return False


class Lines(HTMLParser):
    """Parser events to lines outside all furniture."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool]] = []  # tag, is it furniture
        self.tags_open: Counter[str] = Counter()
        self.holders = [0]  # numbers of the open elements that may bound a region, outermost first
        self.parents, self.ends = [0], [0]  # of each such element: the one around it, the last one within
        self.links = 0
        self.link_chars = 0
        self.doubts: list[int] = []  # depths of the open blocks of an article named like furniture
        self.doubt = 0
        self.plain = False  # has the line text outside links
        self.furniture = 0
        self.region = 0
        self.parts: list[str] = []
        self.tags = 0
        self.lines: list[Line] = []

    def cut(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                heading = any(tag in HEADINGS for tag, _ in self.open[-3:])
                doubt = self.doubt if self.doubts else 0
                self.lines.append(Line(text, self.tags, self.region > 0, not self.plain, heading, self.holders[-1], doubt, self.link_chars))
                self.tags = 0
            self.parts, self.plain, self.link_chars = [], False, 0

    def leave(self, upto: int) -> None:
        while len(self.open) > upto:
            tag, bad = self.open.pop()
            self.tags_open[tag] -= 1
            if tag in HOLDERS:
                self.ends[self.holders.pop()] = len(self.ends) - 1
            if self.doubts and len(self.open) == self.doubts[-1]:
                self.doubts.pop()
            self.links -= tag == "a"
            self.furniture -= bad
            self.region -= tag in REGIONS and not bad

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in BLOCKS:
            self.cut()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += not self.furniture
        if tag in VOID:
            return
        if tag == "body":  # whatever the head left open ends here
            self.leave(0)
        if tag in REGIONS and self.furniture and not self.region:
            # An article never stands in a menu or an advert: that was left open.
            self.leave(next(i for i, (_, bad) in enumerate(self.open) if bad))
        names = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        named = bool(names) and tag not in ("html", "body", *REGIONS)
        doubtful = named and named_like(names, DOUBTFUL)
        bad = tag in SKIPPED or (tag == "header" and not self.region) or (named and named_like(names, FURNITURE)) or (doubtful and not self.region)
        if doubtful and not bad and not self.furniture:
            self.cut()
            self.doubt += not self.doubts  # the outermost such block counts
            self.doubts.append(len(self.open))
        self.open.append((tag, bad))
        self.tags_open[tag] += 1
        if tag in HOLDERS:
            self.parents.append(self.holders[-1])
            self.holders.append(len(self.ends))
            self.ends.append(len(self.ends))
        self.links += tag == "a"
        self.furniture += bad
        self.region += tag in REGIONS and not bad

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.cut()
        self.tags += not self.furniture
        if not self.tags_open[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.leave(i)
                break
            if tag in ("p", "b", "i", "a", "span", "li") and self.open[i][0] in BLOCKS - {"p", "li"}:
                break

    def handle_data(self, data: str) -> None:
        if not self.furniture:
            self.parts.append(data)
            self.plain = self.plain or (not self.links and not data.isspace())
            self.link_chars += len(data.strip()) if self.links else 0

    def finish(self) -> list[Line]:
        if re.match("<[!?/a-zA-Z]", self.rawdata):  # a comment or tag that is never closed takes the rest of the page
            self.rawdata = ""
        self.close()
        self.cut()
        self.leave(0)
        return self.lines

    def smallest(self, low: int, high: int) -> int:
        """Number of the innermost element that holds those numbered ``low`` to ``high``; 0 for none."""
        while low and high > self.ends[low]:
            low = self.parents[low]
        return low

    def within(self, line: Line, holder: int) -> bool:
        return holder <= line.holder <= self.ends[holder] if holder else not line.holder


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(ratios, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def clusters(lines: list[Line], content: np.ndarray) -> list[np.ndarray]:
    """Content lines in order, parted where more than ``LINKS`` lines in a row are nothing but links."""
    run, parted = 0, []
    for line in lines:
        run = run + 1 if line.linked else 0
        parted.append(run == LINKS + 1)
    return np.split(content, np.flatnonzero(np.diff(np.cumsum(parted)[content])) + 1)


def widen(parser: Lines, cluster: np.ndarray) -> range:
    """All lines from a cluster's first to its last, and on to the bounds of the smallest element that holds them.

    Where that is the whole body, other elements and long runs of links are bounds. A
    heading just above belongs to it.
    """
    lines = parser.lines
    low, high = int(cluster[0]), int(cluster[-1]) + 1
    around = [lines[i].holder for i in cluster]
    held = parser.smallest(min(around), max(around))

    def reach(ahead) -> int:
        steps, run = 0, 0
        for taken, line in enumerate(ahead, 1):
            if not parser.within(line, held):
                break
            run = run + 1 if line.linked else 0
            if not held and run > LINKS:
                return taken - run
            steps = taken
        return steps

    low, high = low - reach(lines[i] for i in range(low - 1, -1, -1)), high + reach(lines[i] for i in range(high, len(lines)))
    for i in range(max(0, low - ABOVE), low):
        if lines[i].heading and not lines[i].linked:
            return range(i, high)
    return range(low, high)


def without_furniture(lines: list[Line]) -> list[Line]:
    """Lines less the blocks of an article that are named like furniture, if their text agrees.

    That is a block of which half the characters are links, or which has no heading and fewer characters per tag than half of
    what the article's other lines have. Without other lines all are kept.
    """
    doubted: dict[int, list[Line]] = {}
    for line in lines:
        if line.doubt:
            doubted.setdefault(line.doubt, []).append(line)
    others = [line for line in lines if line.inside and not line.doubt]
    if not doubted or not others:
        return lines

    def ratio(some: list[Line]) -> float:
        return sum(len(line.text) for line in some) / max(1, sum(line.tags for line in some))

    least, gone = ratio(others) / 2, set()
    for number, block in doubted.items():
        links = sum(line.link_chars for line in block) / sum(len(line.text) for line in block)
        if links >= LINKED or (ratio(block) < least and not any(line.heading for line in block)):
            gone.add(number)
    return [line for line in lines if line.doubt not in gone]


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The main text of one page: null, empty and textless pages give an empty one; very long pages are taken whole.

    Furniture is known by its tags and by whole names of class, id and role; inside an article
    most of these names only count where the text is like furniture too. Lines outside furniture get characters per tag. Smoothed ratios of half their
    deviation under the mean and more, and of a quarter of the mean, are content; links
    alone only if nothing else is. Content lines are clustered to regions, which are
    widened to the element that holds them; every line of a region is kept, short
    ones and links too. Articles are the regions, whole, if they have at
    least half of the content's characters; else they count as any other element.
    """
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    lines = parser.lines = without_furniture(parser.finish())
    if not lines:
        return ""
    ratios = smooth(np.array([len(line.text) / max(1, line.tags) for line in lines]), sigma)
    chosen = ratios >= min(ratios.max(), max(ratios.mean() - 0.5 * ratios.std(), 0.25 * ratios.mean()))
    content = np.flatnonzero(chosen)
    plain = [i for i in content if not lines[i].linked]
    content = np.array(plain) if plain else content
    marked = sum(len(lines[i].text) for i in content if lines[i].inside)
    if 2 * marked >= sum(len(lines[i].text) for i in content):
        return "\n".join(line.text for line in lines if line.inside)
    kept = set().union(*(widen(parser, c) for c in clusters(lines, content)))
    return "\n".join(lines[i].text for i in sorted(kept))


def extract(pages: DataFrame, sigma: float = 1.0) -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars`` (code points); such columns are replaced.

    A null page has an empty text; repeated rows come back once each, other columns as they are.
    """
    rest = [c for c in pages.columns if c not in ("html", "text", "n_chars")]

    @F.pandas_udf(T.StringType())
    def text_of(html):
        return html.map(lambda h: main_text(h, sigma), na_action=None)

    out = pages.select(*[F.col(f"`{c}`") for c in rest], text_of(F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op4_html(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
