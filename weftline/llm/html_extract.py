"""Main text of web pages by text-to-tag ratios.

The events of the standard library's streaming parser are cut into lines, one per block element. A line's ratio is its
text length over the tags in it. The ratios are smoothed along the page with a Gaussian and clustered by a threshold. What a
page says about itself goes first: parts that are marked as menus, headers, footers, sidebars, notices, adverts, forms or
comments are dropped, by whole names in class, id or role.

* Where a page marks its article, the marked element with the most text is taken. Its lines are judged by region: a table, a
  list or a run of like siblings has one ratio, text and tags summed. A region goes when it lies in the lower cluster, links
  make up most of its letters, and it is at an end of the article or has no other text. All else of the article stays.
* Elsewhere link letters do not count as text, and the lines of the upper cluster are the content.

A page's text depends on that page alone: repeated rows give repeated results, an empty table an empty one, and null, empty
and text-free pages the empty text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SIGMA = 1.0
#: Two clusters are told apart when the mean of the lower one is under this part of the upper one's; inside a marked article,
#: where letters of links count, under a smaller part.
APART, APART_INSIDE = 0.25, 0.15

# Element names of HTML.
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary "
                   "table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video select button "
                   "textarea".split())
ASIDE = frozenset("nav footer aside form menu dialog".split())
MAIN = frozenset("article main".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta title script style noscript noframes template".split())
CLOSED_BY = {"p": BLOCKS - {"br", "body", "html", "option", "legend", "summary", "li", "dd", "dt", "td", "th", "tr"} | {"p"},
             "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
             "tr": {"tr"}, "option": {"option"}}
LISTS = frozenset("table ul ol dl".split())
#: Names in class, id or role that mark what is not the article, whatever else an element is called ...
SURELY_NOT = re.compile(
    r"ads?|adverts?|advert\w+|adsbygoogle|sidebars?|nav|navbar|navigation|menus?|breadcrumbs?|footers?|cookies?|comments?|disqus|"
    r"gdpr|contentinfo|complementary")
#: ... those that do unless another name of the element marks the article ...
NOT_MAIN = re.compile(
    r"sponsor\w*|promos?|promo\w+|banner|side|widgets?|header|masthead|topbar|toolbar|consent|notice|alert|popup|modal|overlay|"
    r"newsletters?|subscri\w+|signup|login|search|share|sharing|social|related|recommend\w+|respond|reply|replies|pagination|"
    r"pager|copyright|legal|disclaimer")
#: ... those that say nothing at the end of a longer name, those that say it before any other part ...
NOT_AT_END = frozenset("header side search legal alert cookie cookies".split())
BEFORE_ANY = re.compile(r"ads?|adverts?|advert\w+|sponsor\w*|disqus|gdpr|breadcrumbs?")
#: ... the parts that leave a name what its first part says, those that turn it round, and the names of an article.
HOLDERS = frozenset("area articles bar block body bottom box button buttons col column container content form group holder icons "
                    "inner item items left link links list main menu outer panel posts primary right row secondary section "
                    "slot stories thread top unit widget wrap wrapper".split())
TURNED = frozenset("has no with without not is hide show".split())
SITE = frozenset("global site top".split())
MAIN_WORDS = frozenset("article main content post entry story text body".split())
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPACE = re.compile(r"\s+")
WHITE = " \t\n\v\f\r"


def name_says(name: str) -> str:
    """What one class, id or role says: ``no`` (surely not the article), ``not``, ``main`` or nothing.

    A word counts as the whole name, at the end of a longer name (``post-sidebar``) or before parts that only hold it
    (``share-bar``); inside other names (``side-by-side``, ``social-history``) it says nothing.
    """
    parts = [x for x in re.split(r"[-_]+", HUMP.sub("-", name).lower()) if x]
    if not parts or TURNED.intersection(parts[:-1]):
        return ""
    words = [parts[0]] if len(parts) == 1 else [] if parts[-1] in NOT_AT_END else [parts[-1]]
    if len(parts) > 1 and (BEFORE_ANY.fullmatch(parts[0]) or all(x in HOLDERS or x.isdecimal() for x in parts[1:])):
        words.append(parts[0])
    if any(SURELY_NOT.fullmatch(w) for w in words):
        return "no"
    if any(NOT_MAIN.fullmatch(w) for w in words) or (parts[-1] == "header" and parts[0] in SITE):
        return "not"
    return "main" if parts[-1] in MAIN_WORDS else ""


class Line(NamedTuple):
    """Text of a block with its tags, letters inside links and outside them (``plain``, without white space), the marked element
    it is in (0: none), the article within that element, and the region: table, list or run of siblings."""

    text: str
    tags: int
    linked: int
    plain: int
    main: int
    article: int
    region: tuple[int, str]


class Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.open: Counter[str] = Counter()
        self.lines: list[Line] = []
        self.text: list[str] = []
        self.tags = self.linked = self.plain = 0
        self.dropped = self.links = self.main = 0
        self.serial = self.outer = self.inner = 0
        self.outer_tag = ""
        self.blocks: list[tuple[int, str]] = [(0, "")]
        self.lists: list[tuple[int, bool]] = []

    def region(self) -> tuple[int, str]:
        within = self.main > 0
        for serial, inside in self.lists:  # a list around the marked element is the page's layout
            if inside == within:
                return serial, "list"
        return self.blocks[max(0, len(self.blocks) - 2)][0], self.blocks[-1][1]

    def end_line(self) -> None:
        text = SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            inside = self.main > 0
            self.lines.append(Line(text, self.tags, min(self.linked, len(text)), self.plain, self.outer if inside else 0,
                                   self.inner if inside else 0, self.region()))
        self.text, self.tags, self.linked, self.plain = [], 0, 0, 0

    def kind(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        given = dict(attrs)
        names = " ".join(given.get(k) or "" for k in ("class", "id", "role")).split()
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none", given.get("style") or "", re.I)
        if tag in SILENT or tag in ASIDE or hidden:
            return "drop"
        if tag == "header":
            return "" if self.main else "drop"
        if self.main and tag not in MAIN:  # an article may have a header of its own
            names = [n for n in names if n.lower() != "header"]
        said = {name_says(n) for n in names} if tag not in ("body", "html") else set()
        if tag in MAIN:
            return "drop" if "no" in said else "main"
        if self.open["pre"] or self.open["code"]:  # names of highlighted code
            return "link" if tag == "a" else ""
        if "no" in said or ("not" in said and "main" not in said):
            return "drop"
        return "link" if tag == "a" else ""

    def count(self, kind: str, by: int) -> None:
        if kind == "drop":
            self.dropped += by
        elif kind in ("main", "inner"):
            self.main += by
            if kind == "inner" and by < 0:
                self.inner = 0
        elif kind == "link":
            self.links += by

    def close_last(self) -> None:
        tag, kind = self.stack[-1]
        if tag in BLOCKS:
            self.end_line()
            self.blocks.pop()
        if tag in LISTS:
            self.lists.pop()
        self.stack.pop()
        self.open[tag] -= 1
        self.count(kind, -1)

    def close_head(self) -> None:
        """Pages may omit the head's end tag: what cannot be in a head ends it."""
        while self.open["head"]:
            self.close_last()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open["head"] and tag not in IN_HEAD and not self.open["template"]:
            self.close_head()
        for at in range(len(self.stack) - 1, -1, -1) if tag in BLOCKS or tag == "option" else ():
            name = self.stack[at][0]
            if tag in CLOSED_BY.get(name, ()):
                while len(self.stack) > at:
                    self.close_last()
                break
            if name in BLOCKS:
                break
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag not in VOID:
            kind = self.kind(tag, attrs)
            self.serial += 1
            if kind == "main" and not self.main:
                self.outer, self.outer_tag = self.serial, tag
            elif kind == "main" and tag == "article" and self.outer_tag == "main" and not self.inner:
                self.inner, kind = self.serial, "inner"
            if tag in BLOCKS:
                self.blocks.append((self.serial, tag))
            if tag in LISTS:
                self.lists.append((self.serial, self.main > 0))
            self.stack.append((tag, kind))
            self.open[tag] += 1
            self.count(kind, 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1][0] == tag and tag not in BLOCKS:
            self.close_last()

    def handle_endtag(self, tag: str) -> None:
        if not self.open[tag]:
            return
        self.tags += 1
        while self.stack[-1][0] != tag:
            self.close_last()
        self.close_last()

    def handle_data(self, data: str) -> None:
        if self.open["head"] and self.stack[-1][0] == "head" and data.strip(WHITE):
            self.close_head()
        if not self.dropped:
            self.text.append(data)
            if self.links:
                self.linked += len(data.strip())
            else:
                self.plain += len(SPACE.sub("", data))

    def unknown_decl(self, data: str) -> None:
        """CDATA sections and the like are markup."""


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-np.arange(-reach, reach + 1)**2 / (2 * sigma * sigma))
    weights = np.convolve(np.ones(len(ratios)), kernel, "same") if len(ratios) > 2 * reach else None
    if weights is None:  # shorter than the kernel
        far = np.exp(-np.subtract.outer(np.arange(len(ratios)), np.arange(len(ratios)))**2 / (2 * sigma * sigma))
        return far @ ratios / far.sum(axis=1)
    return np.convolve(ratios, kernel, "same") / weights


def split(level: np.ndarray, apart: float = APART) -> float:
    """The bar between two clusters (2-means over the sorted levels); below all levels where they are no two clusters.

    What is one cluster must not be cut: the mean of the lower cluster has to be under ``apart`` times the upper one's.
    """
    x = np.sort(level)
    n = np.arange(1, len(x))
    sums = np.cumsum(x)
    low, high = sums[:-1] / n, (sums[-1] - sums[:-1]) / (len(x) - n)
    if not len(n):
        return float(x[0])
    at = int((n * (len(x) - n) * (high - low)**2).argmax())
    return float((low[at] + high[at]) / 2 if low[at] < apart * high[at] else x[0])


def grown(level: np.ndarray, ratios: np.ndarray, bar: float) -> np.ndarray:
    """Lines of the upper cluster, and those beside them that are above the bar by themselves."""
    take = level >= bar
    for order in (range(1, len(take)), range(len(take) - 2, -1, -1)):
        back = -1 if order.step > 0 else 1
        for i in order:
            take[i] |= take[i + back] and ratios[i] >= bar
    return take


def unmarked(lines: list[Line]) -> list[str]:
    """The lines of the content cluster of a page that does not mark its article."""
    lengths = np.array([len(x.text) for x in lines], float)
    tags = np.array([max(1, x.tags) for x in lines], float)
    plain = 1 - np.array([x.linked for x in lines], float) / lengths
    ratios = np.log1p(lengths / tags * plain)  # short paragraphs must not vanish beside very long ones
    level = smoothed(ratios)
    return [x.text for x, take in zip(lines, grown(level, ratios, split(level)), strict=True) if take]


def longest(lines: list[Line], of: str) -> int:
    """The element (field ``of``) that holds the most text, the first one of equals; 0 if none does."""
    sizes: Counter[int] = Counter()
    for line in lines:
        if getattr(line, of):
            sizes[getattr(line, of)] += len(line.text)
    return max(sizes, key=lambda serial: (sizes[serial], -serial), default=0)


def marked(lines: list[Line]) -> list[str]:
    """The lines of a marked article without its regions of bare links."""
    letters, linked, plain, tags = Counter(), Counter(), Counter(), Counter()
    for x in lines:
        letters[x.region] += len(x.text)
        linked[x.region] += x.linked
        plain[x.region] += x.plain
        tags[x.region] += max(1, x.tags)
    level = smoothed(np.array([np.log1p(letters[x.region] / tags[x.region]) for x in lines]))
    low = level < split(level, APART_INSIDE)
    cut = {r for r in letters if linked[r] > plain[r]}
    cut -= {x.region for x, under in zip(lines, low, strict=True) if not under}
    gone = {r for r in cut if not plain[r]}
    for order in (lines, lines[::-1]):  # others go only as far as they reach in from an end
        for x in order:
            if x.region not in cut:
                break
            gone.add(x.region)
    return [x.text for x in lines if x.region not in gone]


def chosen(lines: list[Line]) -> list[str]:
    """The lines that are content."""
    outer = longest(lines, "main")
    if not outer:
        return unmarked(lines)
    inside = [x for x in lines if x.main == outer]
    inner = longest(inside, "article")
    return marked([x for x in inside if x.article in (0, inner)])


def main_text(html: str | None) -> str:
    """The main text of a whole page; null, empty and text-free pages give the empty text."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    if not parser.lines:
        return ""
    return "\n".join(chosen(parser.lines))


def extract(html: Column) -> Column:
    """The main text of a page as a column; never null."""

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None).astype(object)

    texts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(texts, StringType())(html)
