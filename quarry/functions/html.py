"""Field extraction from an ``html`` column as Spark expressions (H1-H8).

A page is cut into tags, comments and text by one regex; elements are intervals of these tokens, found
by the level of their tags with array functions, row by row and without a UDF. An attribute may stand anywhere in its tag, in double
quotes, single quotes or none. A class matches if it is one of the element's classes, or the whole
attribute (for a selector of several words). The text of an element is that of all its children up to
its own end tag. Character references are decoded.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's missing-value strings.
NO_DESCRIPTION = "No description found"
NO_IMAGE = "No image found"
NO_PRICE = "Not found"
NO_DISCOUNT = "No Discount"
FREE_TO_PLAY = "Free to Play"
NO_REVIEW = "not found"
# entries dropped from the split tag text
TAG_JUNK = ["", "\r\n", "+"]
# Elements without an end tag, and the named references that are decoded (the ampersand last).
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "\u00a9", "reg": "\u00ae", "trade": "\u2122",
         "middot": "\u00b7", "hellip": "\u2026", "ndash": "\u2013", "mdash": "\u2014", "lsquo": "\u2018", "rsquo": "\u2019",
         "ldquo": "\u201c", "rdquo": "\u201d", "euro": "\u20ac", "pound": "\u00a3", "amp": "&"}

TOKEN = r"""(?s)<!--.*?-->|</?[a-zA-Z](?:"[^"]*"|'[^']*'|[^'">]+)*+>|<[!?][^>]*>|[^<]+|<"""


def _q(s: str) -> str:
    """Escape regex metacharacters."""
    return re.sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", s)


def tokens(html: Column) -> Column:
    """ARRAY of the page's tags, comments and texts, in order."""
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def unescape(s: Column) -> Column:
    """Numeric references, then the named ones."""
    def char(ref: Column) -> Column:
        digits = F.substr(ref, F.lit(3), F.length(ref) - 3)
        number = F.when(F.lower(F.substr(digits, F.lit(1), F.lit(1))) == "x",
                        F.conv(F.substr(digits, F.lit(2)), 16, 10)).otherwise(digits).cast("long")
        return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")

    numeric = F.regexp_extract_all(s, F.lit(r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"), F.lit(0))
    out = F.when(F.contains(s, F.lit("&#")), F.aggregate(F.array_distinct(numeric), s, lambda a, r: F.replace(a, r, char(r)))).otherwise(s)
    named = out
    for name, value in NAMED.items():
        named = F.replace(named, F.lit(f"&{name};"), F.lit(value))
    return F.when(F.contains(out, F.lit("&")), named).otherwise(out)


def _attr(tag: Column, name: str) -> Column:
    """An attribute's decoded value; null when the tag has none of that name."""
    before = rf"(?is)\s{_q(name)}\s*=\s*"
    forms = [before + '"([^"]*)"', before + "'([^']*)'", before + "([^\\s\"'>]+)"]
    value = F.when(F.regexp_like(tag, F.lit(forms[0])), F.regexp_extract(tag, forms[0], 1))
    for form in forms[1:]:
        value = value.when(F.regexp_like(tag, F.lit(form)), F.regexp_extract(tag, form, 1))
    return unescape(value)


def _is_start(tag: Column, name: str | None) -> Column:
    return F.regexp_like(tag, F.lit(rf"^(?i)<{'[a-z]' if name is None else _q(name) + '(?=[^a-z0-9:-])'}"))


def _has_class(tag: Column, cls: str | None) -> Column:
    if cls is None:
        return F.lit(True)
    value = _attr(tag, "class")
    whole = (value == cls) | F.array_contains(F.split(F.trim(value), r"\s+"), cls)
    return F.contains(tag, F.lit(cls.split()[0])) & F.coalesce(whole, F.lit(False))


def _is_text(x: Column) -> Column:
    return ~F.startswith(x, F.lit("<")) | (x == "<")


def _named(x: Column, name: Column) -> tuple[Column, Column]:
    """Whether a token is a start tag, and an end tag, of the name."""
    low = F.lower(F.substr(x, F.lit(1), F.length(name) + 3))
    after = [">", " ", "\t", "\n", "\r", "/"]
    starts = F.startswith(low, F.concat(F.lit("<"), name)) & F.substr(low, F.length(name) + 2, F.lit(1)).isin(after) & ~F.endswith(x, F.lit("/>"))
    ends = F.startswith(low, F.concat(F.lit("</"), name)) & F.substr(low, F.length(name) + 3).isin(after)
    return starts, ends


def _intervals(t: Column, name: Column) -> Column:
    """The tags of one name: (n, pos, level), their places in order and how many elements of that name
    are open after each."""
    def is_tag(i: Column) -> Column:
        starts, ends = _named(F.get(t, i), name)
        return starts | ends | _is_start_of(F.get(t, i), name)

    def sign(i: Column) -> Column:
        starts, ends = _named(F.get(t, i), name)
        return F.when(starts, 1).when(ends, -1).otherwise(0)

    at = F.filter(F.sequence(F.lit(0), F.size(t) - 1), is_tag)
    none = F.struct(F.lit(0).alias("d"), F.array().cast("array<int>").alias("a"))
    level = F.aggregate(F.transform(at, sign), none, lambda s, x: F.struct((s["d"] + x).alias("d"), F.array_append(s["a"], s["d"] + x).alias("a")), lambda s: s["a"])
    return F.struct(name.alias("n"), at.alias("pos"), level.alias("level"))


def _is_start_of(x: Column, name: Column) -> Column:
    return F.lower(F.substr(x, F.lit(1), F.length(name) + 1)) == F.concat(F.lit("<"), name)


def _inner_text(t: Column, of: Column, i: Column, name: Column) -> Column:
    """Text of the element that starts at token i: the texts between it and the tag after which one
    element of its name less is open (or the page's end). ``of``: the intervals of its name."""
    r = F.array_position(of["pos"], i).cast("int")
    level = F.get(of["level"], r - 1)
    closing = F.array_position(F.slice(of["level"], r + 1, F.greatest(F.size(of["level"]) - r, F.lit(0))), level - 1).cast("int")
    end = F.when(closing > 0, F.get(of["pos"], r + closing - 1)).otherwise(F.size(t))
    text = F.array_join(F.filter(F.slice(t, i + 2, F.greatest(end - i - 1, F.lit(0))), _is_text), "")
    return F.when(name.isin(VOID), F.lit("")).otherwise(unescape(text))


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _elements(html: Column, cls: str | None, tag: str | None, attribute: str | None = None) -> Column:
    """ARRAY of the texts (or of an attribute) of every element with the class and tag name, in order.

    The tags of a name that has such elements are looked at once; an element's end is found among
    them by its level, and its text is a slice of the tokens."""
    def of(t: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: _is_start(F.get(t, i), tag) & _has_class(F.get(t, i), cls))
        if attribute is not None:
            return F.transform(at, lambda i: _attr(F.get(t, i), attribute))
        named = F.transform(at, lambda i: F.struct(i.alias("i"), F.lower(F.regexp_extract(F.get(t, i), "^<([a-zA-Z][a-zA-Z0-9:-]*)", 1)).alias("n")))
        return _bound(named, lambda found: _bound(
            F.transform(F.array_distinct(F.transform(found, lambda e: e["n"])), lambda n: _intervals(t, n)),
            lambda spans: F.transform(found, lambda e: _bound(
                F.get(F.filter(spans, lambda s: s["n"] == e["n"]), F.lit(0)), lambda s: _inner_text(t, s, e["i"], e["n"])))))

    return _bound(tokens(html), lambda t: F.when(F.size(t) > 0, of(t)).otherwise(F.array().cast("array<string>")))


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing white space of any kind (tabs, new lines)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def meta_content(html: Column, attr: str, value: str | None, take: str = "content",
                 default: str = NO_DESCRIPTION) -> Column:
    """H1: attribute ``take`` of the first meta tag whose ``attr`` is ``value`` (any, when None); an
    empty value stays empty; ``default`` when there is no such tag or attribute."""
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"""(?is)<meta\s(?:"[^"]*"|'[^']*'|[^'">]+)*+>"""), F.lit(0)),
                     lambda m: _attr(m, attr).isNotNull() if value is None else F.coalesce(_attr(m, attr) == value, F.lit(False)))
    return F.coalesce(F.get(F.transform(metas, lambda m: _attr(m, take)), F.lit(0)), F.lit(default))


def links_by_class(html: Column, cls: str | None) -> Column:
    """H2: ARRAY of the hrefs of all links (of the class, when given)."""
    return F.filter(_elements(html, cls, "a", "href"), lambda x: x.isNotNull())


def pick_link(links: Column, seed: Column, default: str = NO_IMAGE) -> Column:
    """H3: one link chosen by a deterministic seed; ``default`` when none."""
    return F.when(F.size(links) > 0,
                  F.element_at(links, (F.pmod(seed, F.size(links)) + 1).cast("int"))
                  ).otherwise(F.lit(default))


def text_by_class(html: Column, cls: str, default: str, strip: bool = True,
                  tag: str | None = None) -> Column:
    """H4 / H6: text of the first element with the class; stripped unless ``strip`` is False;
    ``default`` when there is none."""
    text = F.get(texts_by_class(html, cls, tag), F.lit(0))
    return F.coalesce(strip_ws(text) if strip else text, F.lit(default))


def discount_price(base: Column, disc: Column) -> Column:
    """H5: the discounted price, unless the base price is 'Free to Play'."""
    return F.when(base == F.lit(FREE_TO_PLAY), F.lit(NO_DISCOUNT)).otherwise(
        F.coalesce(disc, F.lit(NO_DISCOUNT)))


def texts_by_class(html: Column, cls: str | None, tag: str | None = None) -> Column:
    """H7: ARRAY of the texts of all elements with the class (or tag)."""
    return _elements(html, cls, tag)


def page_tags(html: Column, cls: str, tag: str | None = None) -> Column:
    """H8: stripped texts concatenated, split on TAB, junk entries dropped."""
    joined = F.array_join(F.transform(texts_by_class(html, cls, tag), strip_ws), "")
    parts = F.split(joined, "\t")
    return F.filter(parts, lambda p: ~p.isin(TAG_JUNK))
