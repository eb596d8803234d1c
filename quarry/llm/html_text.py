"""Main text of HTML pages: text-to-tag ratios, smoothed and clustered, over streamed parser events.

The standard library's parser is fed the whole page; its events are turned into lines (one per block
of text) with their text, the number of tags in them, how much of the text is links, and the region
they stand in (the innermost article or main element, else the innermost sectioning element or div).
Text in elements that are never content (scripts, navigation, asides, ...) makes no line. A class, id
or role that marks adverts, notices, menus, comments and the like only makes its element suspect: it
stays out unless it is around a main element or the page's articles, or around over half of the page's
text and then holds the headline too, merely has the word in its name, or has nine tenths of the text;
comments, and notices and forms without the headline, never come in by their size. A class that merely has such a word in it ("social-policy") also stays in by its ratios, those of the
page's ordinary text, or as the holder of the headline; so does a header in an article. The lines' text-to-tag ratios, bounded by twice their weighted median so that no single line
sets the scale, are smoothed by a Gaussian, and lines over a threshold (a share of the page's spread of
ratios) are the content cluster. A region with lines of the cluster is content as a whole, as short
paragraphs and headings belong to it; only lists of links in it (mostly linked lines under the
threshold) are not. Where a page has article or main elements, the regions are those with a good share
of the cluster's text, and a main's own lines go with the articles in it; elsewhere a region of a
single line counts as a part of the region around it.

Each page is a row of its own: no shuffle, and memory is bounded by the page.

Defined cases: a null or empty page gives an empty text; repeated rows are extracted each; broken
markup is read as far as it goes (an element left open ends with the page, a cut-off tag is dropped,
a cut-off reference stays as text); an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.shared import in_arrow

# Element names and the class, id and role words that mark what is never content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset("script style noscript template svg math head title nav aside footer button select textarea "
                   "iframe object canvas audio video dialog menu".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td "
                   "tfoot th thead title tr ul".split())
_REGION = frozenset("article main section div body td".split())
_ENDS_P = _BLOCK - {"body", "html", "head", "title"}
_MARKS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
                   "cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination "
                   "popup promo promoted promotion related reply respond share sharing sidebar signup skip social sponsor "
                   "sponsored subscribe toolbar widget".split())
_USERS = frozenset("comment comments disqus reply respond".split())
_HEADS = frozenset("banner header masthead".split())
# those that size alone never makes content: forms, notices, comments and what else is longer than many an article
_STERN = _USERS | frozenset("alert alertdialog consent cookie cookies dialog form gdpr modal newsletter notice popup search signup subscribe".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_WHOLE = ("body", "html", "article", "main")
_SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass
class Mark:
    """A suspect element; the counts take in all that is inside it."""
    parent: int  # the suspect element around it, or -1
    loose: bool  # the mark is only a part of a class or id
    users: bool  # comments and the like
    stern: bool  # comments, notices, forms
    head: bool  # a header in an article
    title: bool = False  # holds h1
    main: bool = False
    article: bool = False
    plain: int = 0  # characters outside links
    dense: float = 0.0  # of those, how many are in text as dense as the page's


@dataclass
class Line:
    text: str
    tags: int
    linked: int
    region: int
    article: int  # number of the article or main element it is in, or -1


@dataclass
class _Block:
    """A line before it is known which suspect elements stay out of it."""
    parts: list[tuple[int, bool, str]]  # suspect element (or -1), in a link, text
    tags: int
    region: int
    article: int

    def line(self, out: list[bool]) -> Line:
        parts = [(linked, x) for mark, linked, x in self.parts if mark < 0 or not out[mark]]
        text = " ".join("".join(x for _, x in parts).split())
        return Line(text, max(1, self.tags), sum(len(x) for linked, x in parts if linked), self.region, self.article)


class _Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[_Block] = []
        self.marks: list[Mark] = []
        self.open: list[tuple[str, bool, int, int, int]] = [("", False, 0, -1, -1)]  # tag, never, region, article, mark
        self.around: list[int] = [0]  # of each region, the one around it
        self.main_of: dict[int, int] = {}  # of an article, the main element it is in
        self.mains: set[int] = set()
        self.links = 0
        self._reset()

    def _reset(self) -> None:
        self.parts: list[tuple[int, bool, str]] = []
        self.tags = 0

    def _flush(self) -> None:
        text = any(x.strip() for _, _, x in self.parts)
        if text:
            _, _, region, article, _ = self.open[-1]
            self.blocks.append(_Block(self.parts, self.tags, region, article))
        tags = 0 if text else self.tags  # tags without text count for the next line
        self._reset()
        self.tags = tags

    def _is_never(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in _NEVER:
            return True
        if tag == "header" and self.open[-1][3] < 0:
            return True
        return tag not in _WHOLE and any(name == "hidden" for name, _ in attrs)

    def _suspect(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        """Whether the element is marked as what is not content; it is then the newest of `marks`."""
        if tag in _WHOLE:
            return False
        words: set[str] = set()
        loose = True
        for name, value in attrs:
            if name in ("class", "id") and value:
                for one in value.lower().split():
                    held = {x for x in _SPLIT.split(one) if x}
                    words |= held & _MARKS
                    loose &= not held or not held <= _MARKS
            elif name == "role" and value and value.lower().strip() in _ROLES:
                words.add(value.lower().strip())
                loose = False
        if tag == "form":
            words.add(tag)
            loose = False
        if words:
            _, _, _, article, mark = self.open[-1]
            self.marks.append(Mark(mark, loose, not _USERS.isdisjoint(words), not _STERN.isdisjoint(words), article >= 0 and words <= _HEADS))
        return bool(words)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCK:
            self._flush()
        self.tags += 1
        if tag == "br":
            self.parts.append((self.open[-1][4], self.links > 0, " "))
        if tag in _VOID:
            return
        if tag in _ENDS_P:
            self._close("p", "div", "article", "main", "section", "td")
        if tag == "li":
            self._close("li", "ul", "ol", "menu")
        _, never, region, article, mark = self.open[-1]
        if mark >= 0 and not never:
            self.marks[mark].title |= tag == "h1"
            self.marks[mark].main |= tag == "main"
            self.marks[mark].article |= tag == "article"
        if tag in _REGION:
            self.around.append(region)
            region = len(self.around) - 1
            if tag in ("article", "main") and (article < 0 or tag == "article"):
                if tag == "article" and article in self.mains:
                    self.main_of[region] = article
                elif tag == "main":
                    self.mains.add(region)
                article = region
        self.links += tag == "a"
        never = never or self._is_never(tag, attrs)
        if not never and self._suspect(tag, attrs):
            mark = len(self.marks) - 1
        self.open.append((tag, never, region, article, mark))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash of elements that are not void

    def _close(self, tag: str, *within: str) -> bool:
        """Close the innermost open element of that name, unless one of `within` is nearer."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.links -= sum(x[0] == "a" for x in self.open[i:])
                del self.open[i:]
                return True
            if self.open[i][0] in within:
                return False
        return False

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCK:
            self._flush()
        self.tags += 1
        # an inline end tag does not close blocks around it
        self._close(tag, *(() if tag in _BLOCK or tag in _NEVER else _BLOCK))

    def handle_data(self, data: str) -> None:
        if self.open[-1][1]:
            return
        self.parts.append((self.open[-1][4], self.links > 0, data))

    def close(self) -> None:
        super().close()
        self._flush()

    def lines(self) -> list[Line]:
        """The lines, without what is in suspect elements that are not content."""
        out = self._judged() if self.marks else []
        return [x for x in (b.line(out) for b in self.blocks) if x.text]

    def _judged(self) -> list[bool]:
        """Of each suspect element, whether it stays out."""
        marks = self.marks
        plain = [sum(len(x.strip()) for _, linked, x in b.parts if not linked) for b in self.blocks]
        ratio = np.array([n / max(1, b.tags) for n, b in zip(plain, self.blocks, strict=True)])
        dense = 0.5 * middle(ratio, np.sqrt(plain)) if len(ratio) else 0.0
        free = 0  # text of articles that are in no suspect element
        for b, r in zip(self.blocks, ratio.tolist(), strict=True):
            for mark, linked, x in b.parts:
                n = 0 if linked else len(x.strip())
                if mark >= 0:
                    marks[mark].plain += n
                    marks[mark].dense += n * (r >= dense)
                elif b.article >= 0:
                    free += n
        for m in reversed(marks):  # elements are numbered from outside in
            if m.parent >= 0:
                above = marks[m.parent]
                above.plain += m.plain
                above.dense += m.dense
                above.title |= m.title
                above.main |= m.main
                above.article |= m.article
        out: list[bool] = []
        for m in marks:
            if m.parent >= 0 and out[m.parent]:
                out.append(True)
                continue
            content = m.main or m.article and (not free or m.loose and not m.users)
            # over half of the page's text: a wrapper if it has the headline, if the mark is a part of its name only,
            # or if there is next to nothing outside
            content = content or 2 * m.plain > sum(plain) and not m.users and (m.title or not m.stern and (m.loose or 10 * m.plain > 9 * sum(plain)))
            content = content or not m.users and (m.loose or m.head) and m.title
            content = content or not m.stern and m.loose and 0 < m.plain < 2 * m.dense
            out.append(not content)
        return out


def smooth(ratio: np.ndarray, radius: int = 2, sigma: float = 1.0) -> np.ndarray:
    """The ratios convolved with a Gaussian; at the borders the kernel is what is left of it."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(ratio, kernel, "full")[radius:radius + len(ratio)] / np.convolve(np.ones(len(ratio)), kernel, "full")[radius:radius + len(ratio)]


def middle(values: np.ndarray, weights: np.ndarray) -> float:
    """The weighted median (the upper one); without any weight the largest value."""
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(weights[order])
    return float(values[order[min(np.searchsorted(upto, upto[-1] / 2, "right"), len(order) - 1)]])


def _joined(region: list[int], around: list[int]) -> np.ndarray:
    """The region of each line; one that has a single line (a paragraph in an element of its own) is
    taken for a part of the region around it, inner ones first."""
    held: list[list[int]] = [[] for _ in around]
    for i, r in enumerate(region):
        held[r].append(i)
    out = np.array(region)
    for r in range(len(around) - 1, 0, -1):  # regions are numbered from outside in
        if len(held[r]) == 1:
            held[around[r]] += held[r]
        else:
            out[held[r]] = r
    out[held[0]] = 0
    return out


def extract(html: str, share: float = 0.5) -> str:
    """The main text of a page: its blocks joined by newlines."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines()
    if not lines:
        return ""
    size = np.array([len(x.text) for x in lines], dtype=float)
    plain = size - np.array([min(x.linked, len(x.text)) for x in lines], dtype=float)
    ratio = plain / np.array([x.tags for x in lines], dtype=float)
    ratio = smooth(np.minimum(ratio, 2 * middle(ratio, np.sqrt(plain))))
    near = ratio >= share * ratio.std()
    text = plain >= 0.5 * size
    chosen = near & text
    if not chosen.any():
        chosen = plain == plain.max()
    article = np.array([x.article for x in lines])
    if (article >= 0).any():
        held: dict[int, float] = {}
        for a, n, c in zip(article.tolist(), size.tolist(), chosen.tolist(), strict=True):
            if a >= 0:
                held[a] = held.get(a, 0.0) + n * (1.0 if c else 0.01)
        most = max(held.values())  # several articles on a page: those with a good share of the largest's text
        good = {a for a, n in held.items() if n >= 0.3 * most}
        good |= {parser.main_of[a] for a in good if a in parser.main_of}
        region = article
    else:
        region = _joined([x.region for x in lines], parser.around)
        good = set(region[chosen].tolist())
    keep = np.isin(region, list(good)) & (near | text | chosen)
    return "\n".join(x.text for x, k in zip(lines, keep.tolist(), strict=True) if k)


def main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(*keep, text, n_chars) of each page."""
    given = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                text = [extract(h) if h else "" for h in part.column("html").to_pylist()]
                yield pa.record_batch([*part.columns[:-1], pa.array(text, pa.string())], [*part.schema.names[:-1], "text"])

    schema = T.StructType([*given.schema.fields[:-1], T.StructField("text", T.StringType())])
    return given.transform(in_arrow, run, schema).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "text", F.length("text").cast("long").alias("n_chars"))
