"""Main text of web pages by text-to-tag ratios.

The standard library's parser reads a page once, as a stream of events. Block tags cut it into lines; a line has its text,
its number of tags and the element it stands in. What the markup itself says is no article (navigation, page headers
and footers, asides, forms, scripts, styles, hidden parts, articles within an article, which are its comments, and elements
whose role, id or class is one of the words below) makes a line count as without text. The lines' text-to-tag ratios are put on a
log scale, smoothed by a Gaussian, and split in two clusters at the threshold half way between the clusters' means. Lines of the upper
cluster vote with their length for the elements around them. The region is the articles with half of the best one's
votes or more; without an article the ``main`` elements likewise; without either the innermost element that
holds nine tenths of the votes. All its lines but those the markup excludes are the text, short ones as well.

Character references are decoded by the parser, white space within a block becomes one space, and blocks are joined by
an empty line. A line break tag is white space.

Defined results: null and empty pages, and pages without text, have an empty text; pages of any length are read whole; a page that
breaks off ends its elements; repeated rows are repeated; other columns pass through where asked for, unless a result column
has their name; an empty table gives no rows.
"""

import re
from collections.abc import Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.tokens import slices

# Elements of the markup language that end a line, that have no end tag, and that hold no article text.
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td
tfoot th thead title tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("""
script style template noscript head title nav aside footer search menu dialog button select option textarea label legend
input iframe object applet canvas svg math audio video datalist map
""".split())
NO_PARAGRAPH = BLOCKS - {"p"}
SCOPES = frozenset("article main body table".split())
SPLITTERS = frozenset("html body div section table tbody tr td center form fieldset".split())
# An end tag that may be left out: what a start tag ends if it is open, and the elements at which the search stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# Words of a class or an id, and roles, of what is no part of an article.
HINTS = frozenset("""
ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments disqus
respond reply replies cookie cookies consent gdpr notice notices notification notifications alert alerts masthead menu
menus nav navbar navigation newsletter subscribe subscription popup modal overlay promo promotion promoted sponsor
sponsored recommended recommendation recommendations related rss share sharing sidebar sidenav signup login social
toolbar widget widgets pagination pager footer
""".split())
PAGE_HINTS = HINTS | {"header", "topbar"}  # outside an article
ROLES = frozenset("""
navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status tablist
""".split())
NOT_SO = frozenset("no without has with hide is".split())  # "has-comments" is about an element's content
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
UNFINISHED = re.compile("<[A-Za-z/!?]")  # markup that the page's end cuts off
SIGMA, REACH = 1.0, 2
ENOUGH, MOST = 0.5, 0.9


def hinted(value: str, words: frozenset) -> bool:
    """Whether a class or id attribute names one of ``words``."""
    for name in value.split():
        parts = [part.lower() for part in WORD.findall(name)]
        if any(part in words and not (i and parts[i - 1] in NOT_SO) for i, part in enumerate(parts)):
            return True
    return False


class Lines(HTMLParser):
    """The lines of a page: ``texts``, ``tags`` and ``homes`` by line; ``parents``, ``names``, ``dropped`` by element.

    The text of an inline element that is left out is not read at all, so that the text around it stays one line.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts, self.tags, self.homes = [], [], []
        self.parents, self.names, self.dropped, self.silent, self.within = [-1], [""], [False], [False], [False]
        self.open = [0]
        self.pieces, self.count = [], 0

    def line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.texts.append(text)
            self.tags.append(self.count)
            self.homes.append(self.open[-1])
        self.pieces, self.count = [], 0

    def handle_data(self, data: str) -> None:
        if not self.silent[self.open[-1]]:
            self.pieces.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def unknown_decl(self, data: str) -> None:
        pass

    def excluded(self, tag: str, attributes: dict, in_article: bool) -> bool:
        if tag in ("html", "body", "main"):
            return False
        if tag in NO_TEXT or (tag == "article" and in_article) or (tag == "header" and not in_article):
            return True
        style = (attributes.get("style") or "").replace(" ", "").lower()
        if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style:
            return True
        if (attributes.get("role") or "").lower() in ROLES:
            return True
        words = HINTS if in_article else PAGE_HINTS
        return any(hinted(attributes.get(name) or "", words) for name in ("class", "id"))

    def pop(self, names: set, stops: frozenset | set = frozenset()) -> None:
        """End the innermost open element of ``names``, and what is open in it, unless one of ``stops`` is nearer."""
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.names[self.open[depth]]
            if name in names:
                del self.open[depth:]
                return
            if name in stops:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        block = tag in BLOCKS
        if block:
            if not self.silent[self.open[-1]]:
                self.line()
            self.pop({"p"}, NO_PARAGRAPH)
            if tag in ENDS:
                self.pop(*ENDS[tag])
        elif tag == "br":
            self.pieces.append(" ")
        self.count += 1
        if tag in VOID:
            return
        home = self.open[-1]
        in_article = self.within[home]
        out = self.excluded(tag, dict(attrs), in_article)
        if not block and not out:
            return
        self.parents.append(home)
        self.names.append(tag)
        self.dropped.append(self.dropped[home] or out)
        self.silent.append(self.silent[home] or not block)
        self.within.append(in_article or (tag == "article" and not out))
        self.open.append(len(self.parents) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS and not self.silent[self.open[-1]]:
            self.line()
        if tag in BLOCKS or self.silent[self.open[-1]]:
            self.pop({tag}, SCOPES - {tag})
        self.count += 1


def extract(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    if UNFINISHED.match(page.rawdata):
        page.rawdata = ""
    page.close()
    page.line()
    return selected(page)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    weights = np.exp(-np.square(np.arange(-REACH, REACH + 1)) / (2 * SIGMA**2))
    padded = np.pad(ratios, REACH, mode="edge")
    return np.convolve(padded, weights / weights.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """Half way between the means of two clusters of numbers."""
    at = (values.min() + values.max()) / 2
    while True:
        upper = values >= at
        if upper.all():
            return at
        new = (values[upper].mean() + values[~upper].mean()) / 2
        if abs(new - at) <= 1e-9 or not (values >= new).any() or not (values < new).any():
            return at
        at = new


def summed(parents: list[int], homes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """By element, the sum of ``sizes`` of the lines in it at any depth."""
    total = np.zeros(len(parents), np.int64)
    np.add.at(total, homes, sizes)
    for node in range(len(parents) - 1, 0, -1):
        total[parents[node]] += total[node]
    return total


def spread_down(parents: list[int], marks: np.ndarray) -> np.ndarray:
    """``marks`` of elements, taken over by all elements within."""
    for node in range(1, len(parents)):
        marks[node] |= marks[parents[node]]
    return marks


def selected(page: Lines) -> str:
    """The lines of the content region."""
    if not page.texts:
        return ""
    homes, sizes = np.array(page.homes), np.array([len(text) for text in page.texts])
    dropped = np.array(page.dropped)
    held = summed(page.parents, homes, np.where(dropped[homes], 0, sizes))
    bodies = spread_up(page, ("article", "main"))
    for node, name in enumerate(page.names):  # a form around the page's text is no form to fill in
        if name == "form" and not bodies[node] and held[node] < ENOUGH * held[0]:
            dropped[node] = True
    kept = ~spread_down(page.parents, dropped)[homes]
    if not kept.any():
        return ""
    values = smoothed(np.log1p(np.where(kept, sizes / np.maximum(1, page.tags), 0)))
    content = (values >= threshold(values)) & kept
    if not content.any():
        content = kept
    inside = np.zeros(len(page.parents), bool)
    inside[region(page, dropped, summed(page.parents, homes[content], sizes[content]))] = True
    return "\n\n".join(page.texts[i] for i in np.flatnonzero(spread_down(page.parents, inside)[homes] & kept))


def spread_up(page: Lines, names: Sequence[str]) -> np.ndarray:
    """Whether each element holds one of ``names`` that is not left out."""
    marks = np.array([name in names and not out for name, out in zip(page.names, page.dropped)])
    for node in range(len(marks) - 1, 0, -1):
        marks[page.parents[node]] |= marks[node]
    return marks


def region(page: Lines, dropped: np.ndarray, votes: np.ndarray) -> list[int]:
    """The elements that make up the content region."""
    for name in ("article", "main"):
        found = [i for i, n in enumerate(page.names) if n == name and not dropped[i] and votes[i] > 0]
        if found:
            best = max(votes[i] for i in found)
            return [i for i in found if votes[i] >= ENOUGH * best]
    inner, titled = {}, set()
    for child, (parent, name) in enumerate(zip(page.parents, page.names)):
        if name in SPLITTERS and votes[child] >= MOST * votes[0]:
            inner[parent] = child
        elif name == "h1" and page.names[parent] not in ("", "html", "body"):
            titled.add(parent)
    node = 0
    while node in inner and node not in titled:
        node = inner[node]
    return [node]


def page_text(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """``keep``, text, n_chars of each page."""
    made = ("text", "n_chars")
    keep = [c for c in keep if c.lower() not in made]
    chosen = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").alias("__html"))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("text", T.StringType())])

    def read(batches):
        for batch in batches:
            sources = batch.column(batch.num_columns - 1)
            for start, end in slices(sources, 1 << 24):
                part = batch.slice(start, end - start)
                texts = [extract(source.as_py()) for source in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string())], names=[*part.schema.names[:-1], "text"]
                )

    found = chosen.mapInArrow(read, schema)
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
