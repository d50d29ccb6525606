"""Main text of web pages by text-to-tag ratio.

The standard library's streaming parser turns a page into lines, one per block,
each with its text length and its number of tags. The ratios are smoothed with a
Gaussian along the page, and lines above the threshold between the two clusters
of ratios (two means on one axis) vote for the region they stand in. Elements
that never hold main text weigh nothing, and an ``article`` or ``main`` weighs
more than the page around it, also where a form or a block named for its layout
(``with-sidebar``) holds it. Where no article is left and such wrappers hold the most
text, they are taken for the page. A region that wins gives all of its lines, short
ones included, so a one-word paragraph of the article stays.

On a page without ``article`` and ``main`` the regions that win span the smallest
container around them, and one more level: its other parts (a heading in a ``div`` of
its own, a short last section) stay too, unless most of their text is links.

Inside an article divs and lists are judged by whole names (``share-links``, not
``related-work``), other blocks and ``ins`` by whole class names of adverts, notices and
comments, and sections by an id that names comments. Headings and inline elements are not
judged. ``noscript`` counts inside an article only.

Defined results: a null, empty or text-free page gives an empty text; repeated
rows get the same result each; an empty table gives an empty result. Character
references are decoded, white space inside a block becomes one space, and blocks
are joined by one line feed in page order. Very long pages are read whole, in time
linear in their length. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paystrata.llm.common import map_arrow

# Elements by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN = frozenset(
    "script style template head title iframe object svg canvas audio video map "
    "select datalist textarea button annotation annotation-xml".split()
)
OUTSIDE = frozenset("nav menu aside footer form dialog search".split())
MAIN = frozenset(("article", "main"))
REGIONS = frozenset(("article", "main", "section", "div", "td", "body"))
ROLES_OUTSIDE = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar toolbar".split()
)
WORDS_OUTSIDE = (
    r"ads?|advert\w*|adsense|promo\w*|sponsor\w*|banner|nav|navbar|navigation|menu|"
    r"breadcrumbs?|sidebar|side|widget|footer|header|masthead|cookies?|consent|notices?|gdpr|alert|"
    r"popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|"
    r"comments?|commentlist|disqus|replies|respond|pagination|pager|toolbar|skip"
)
NAMES_OUTSIDE = re.compile(rf"(?:^|[\s_-])(?:{WORDS_OUTSIDE})(?:$|[\s_-])", re.IGNORECASE)
# a name of such words and of words that say nothing, and of comments alone
_NEUTRAL = (
    r"\d[a-z0-9]*|area|articles?|bar|block|body|bottom|box|btns?|buttons?|cells?|col|column|container|"
    r"content|feed|form|global|group|holder|icons?|inline|inner|items?|left|links?|lists?|main|"
    r"module|page|panel|placeholder|posts?|primary|region|right|row|secondary|section|site|slot|"
    r"stor(?:y|ies)|text|top|unit|wrap|wrapper|zone"
)


def _whole_names(words: str) -> re.Pattern:
    part = rf"(?:{_NEUTRAL})[_-]+"
    return re.compile(
        rf"(?:^|\s)(?:{part})*(?:{words})(?:[_-]+(?:{words}|{_NEUTRAL}))*(?=$|\s)", re.IGNORECASE
    )


WHOLE_OUTSIDE = _whole_names(WORDS_OUTSIDE.replace(r"\w", "[a-z]"))
WHOLE_COMMENTS = _whole_names("comments?|commentlist|disqus|replies|respond")
# names that a paragraph, section or other block of an article may be dropped for
WHOLE_FOREIGN = _whole_names(
    "ads?|advert[a-z]*|adsense|adsbygoogle|promo[a-z]*|sponsor[a-z]*|cookies?|consent|notices?|gdpr|"
    "newsletter|subscribe|share|sharing|social|pagination|pager|breadcrumbs?|"
    "comments?|commentlist|disqus|replies|respond"
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p li dd dt td th pre blockquote caption figcaption".split())
# Why an element weighs nothing: it may be a wrapper, its whole name, its tag or role.
WRAPPER, NAME, KIND = 1, 2, 3
# Elements whose end tag may be missing, and the start tags that end them.
CLOSED_BY = {
    "p": BLOCKS - {"body", "html", "option"},
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
    "tr": frozenset(("tr",)),
    "option": frozenset(("option",)),
}
WHITE = re.compile(r"\s+")
SIGMA = 1.0
MAIN_WEIGHT = 4.0
PROSE_WORDS = 10


class State(NamedTuple):
    """What holds inside an open element."""

    weight: float = 1.0
    spare: float = 1.0  # the weight if wrappers are taken for the page
    region: int = 0
    hidden: int = 0  # NAME if an inline element's name hides it, else KIND
    cause: int = 0  # why the weight is zero
    within: str = ""  # main or article
    prose: bool = False
    link: bool = False


class Line(NamedTuple):
    """A block's text with what the page says of it."""

    text: str
    tags: int
    weight: float
    region: int
    spare: float
    linked: int  # characters of link text


class LineReader(HTMLParser):
    """Collects a page's lines, and the region that holds each region (``inside``)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, State]] = []
        self.names: Counter[str] = Counter()  # how often each element is open
        self.pieces: list[str] = []
        self.linked = 0
        self.tags = 0
        self.inside = [0]

    def _state(self) -> State:
        return self.open[-1][1] if self.open else State()

    def flush(self) -> None:
        text = WHITE.sub(" ", "".join(self.pieces)).strip()
        state = self._state()
        if text:
            self.lines.append(
                Line(text, self.tags, state.weight, state.region, state.spare, self.linked)
            )
            self.tags = 0
        self.pieces, self.linked = [], 0

    def _close(self, at: int) -> None:
        """Ends the open elements from place ``at`` on."""
        self.names.subtract(name for name, _ in self.open[at:])
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
        elif tag == "br":
            self.pieces.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        while self.open and tag in CLOSED_BY.get(self.open[-1][0], ()):
            self._close(len(self.open) - 1)
        if tag in BLOCKS:
            self._close_inline_paragraph(tag)
        parent = self._state()
        weight, spare, region, hidden, cause, within, prose, link = parent
        named = dict(attrs)
        if tag in HIDDEN or "hidden" in named or tag == "noscript" and not within:
            hidden = KIND
        why = self._outside(tag, named, parent)
        if why:
            weight = 0.0
            spare = spare if why == WRAPPER else 0.0
            cause = max(cause, why)
            if tag not in BLOCKS:
                hidden = max(hidden, NAME)
        elif kind := self._main(tag, named):
            if cause:
                if cause == KIND or (kind == "article" and self._names(tag, named, WHOLE_OUTSIDE)):
                    pass
                elif cause == WRAPPER or kind == "main":
                    weight, spare, cause = MAIN_WEIGHT, MAIN_WEIGHT, 0
                    hidden = 0 if hidden == NAME else hidden
                elif not within:
                    spare = MAIN_WEIGHT
            else:
                weight, spare = weight * MAIN_WEIGHT, spare * MAIN_WEIGHT
            within = "article" if "article" in (kind, within) else kind
        if tag in REGIONS and spare:
            # parts of an article belong to it
            if not (spare > 1 and region and parent.spare > 1):
                self.inside.append(region)
                region = len(self.inside) - 1
        prose = prose or tag in PROSE
        link = link or tag == "a"
        self.open.append((tag, State(weight, spare, region, hidden, cause, within, prose, link)))
        self.names[tag] += 1

    @staticmethod
    def _main(tag: str, named: dict[str, str | None]) -> str:
        role = named.get("role")
        return tag if tag in MAIN else role if role in MAIN else ""

    @staticmethod
    def _names(tag: str, named: dict[str, str | None], pattern: re.Pattern) -> bool:
        """Whether a class or id fits; a heading's id is an anchor, not a name."""
        keys = ("class",) if tag in HEADINGS else ("class", "id")
        return any(pattern.search(named.get(k) or "") for k in keys)

    def _outside(self, tag: str, named: dict[str, str | None], parent: State) -> int:
        if tag == "form" or named.get("role") == "form":
            return WRAPPER
        if tag in OUTSIDE or named.get("role") in ROLES_OUTSIDE:
            return KIND
        if tag == "header":
            return 0 if any(self.names[name] for name in MAIN) else KIND
        if tag in ("body", "html") or self._main(tag, named):
            return 0
        if parent.within:
            if tag in ("div", "ul", "ol"):
                return NAME if self._names(tag, named, WHOLE_OUTSIDE) else 0
            if tag == "section" and self._names(tag, named, WHOLE_COMMENTS):
                return NAME
            judged = tag == "ins" or tag in BLOCKS and tag not in HEADINGS
            return NAME if judged and WHOLE_FOREIGN.search(named.get("class") or "") else 0
        if not self._names(tag, named, NAMES_OUTSIDE):
            return 0
        if tag not in BLOCKS and parent.prose:
            return 0
        return NAME if self._names(tag, named, WHOLE_OUTSIDE) else WRAPPER

    def _close_inline_paragraph(self, tag: str) -> None:
        """A block inside unclosed inline elements of a paragraph ends the paragraph."""
        if not self.names["p"]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == "p":
                if tag in CLOSED_BY["p"]:
                    self._close(at)
                return
            if name in BLOCKS:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if not self.names[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        state = self._state()
        if not state.hidden:
            self.pieces.append(data)
            if state.link:
                self.linked += len(WHITE.sub(" ", data).strip())


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel is renormalised."""
    reach = min(len(ratios) - 1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weights


def threshold(values: np.ndarray) -> float:
    """Between the means of the low and the high cluster; below all if they agree."""
    low, high = float(values.min()), float(values.max())
    if high - low < 1e-9:
        return low
    for _ in range(50):
        middle = (low + high) / 2
        under = values <= middle
        fresh = float(values[under].mean()), float(values[~under].mean())
        if fresh == (low, high):
            break
        low, high = fresh
    return (low + high) / 2


def page_lines(html: str) -> tuple[list[Line], list[int]]:
    """The page's lines, and for each region the one that holds it."""
    reader = LineReader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.lines, reader.inside


def line_weights(lines: list[Line]) -> np.ndarray:
    """The lines' weights; with those of wrappers where they hold most of an unmarked page."""
    weights = np.array([line.weight for line in lines])
    if (weights > 1).any():
        return weights
    wrapped = [line.text for line in lines if not line.weight and line.spare]
    usable = sum(len(line.text) for line in lines if line.weight)
    if sum(map(len, wrapped)) > usable and any(len(t.split()) >= PROSE_WORDS for t in wrapped):
        return np.array([line.spare for line in lines])
    return weights


def around(winners: set[int], inside: list[int]) -> int:
    """The region that holds the smallest region around all winners (0 is the page).

    A region's number is greater than that of the region that holds it.
    """
    held = [int(region in winners) for region in range(len(inside))]
    for region in range(len(inside) - 1, -1, -1):
        if held[region] == len(winners):
            return inside[region]
        held[inside[region]] += held[region]
    return 0


def joined(lines: list[Line], usable: np.ndarray, winners: set[int], inside: list[int]) -> np.ndarray:
    """Which lines stand with the winning regions of an unmarked page."""
    text, linked = [0] * len(inside), [0] * len(inside)
    for line, counts in zip(lines, usable):
        if counts:
            text[line.region] += len(line.text)
            linked[line.region] += line.linked
    links = [2 * a > b for a, b in zip(linked, text)]
    # smoothing also lifts short blocks of links that stand beside long lines
    winners = {region for region in winners if not links[region]} or winners
    top = around(winners, inside)
    within = [False] * len(inside)
    for region, parent in enumerate(inside):  # a parent comes before its parts
        within[region] = region == top or region > 0 and within[parent]

    def stays(line: Line) -> bool:
        if line.region in winners:
            return True
        return within[line.region] and not links[line.region] and 2 * line.linked <= len(line.text)

    return usable & np.array([stays(line) for line in lines])


def main_text(html: str | None) -> str:
    """The page's main text, empty if it has none."""
    lines, inside = page_lines(html) if html else ([], [0])
    weights = line_weights(lines)
    if not (weights > 0).any():
        return ""
    regions = np.array([line.region for line in lines])
    sizes = np.array([len(line.text) for line in lines], dtype=float)
    tags = np.array([max(1, line.tags) for line in lines])
    usable = weights > 0
    # a region that the page marks as its article stands out by its marks, not by its length
    score = np.log1p(sizes / tags) * usable
    marked = usable & (weights > 1)
    value = smoothed(score)
    if marked.any():
        value = value + marked * (value.max() + 1.0)
    content = usable & (value >= threshold(value))
    winners = np.unique(regions[content])
    if marked.any():
        keep = usable & np.isin(regions, winners)
    else:
        keep = joined(lines, usable, set(winners.tolist()), inside)
    return "\n".join(line.text for line, kept in zip(lines, keep) if kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html.as_py()) for html in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(text) for text in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page. Nothing is shuffled."""
    source = pages.select("page_id", "url", "html")
    kinds = dict(source.dtypes)
    return map_arrow(
        source, _extract,
        f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint",
    )
