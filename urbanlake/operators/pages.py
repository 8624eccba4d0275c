"""Page extraction: one vectorised helper on the standard HTML parser, driven by field rules.

A rule is (tag, attribute, value): the first node with that tag whose attribute has the value among its
words (attribute None: any node of the tag).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str | None, str | None]
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ENDED_BY_SELF = frozenset("li p td th tr dt dd option".split())


class _Node:
    __slots__ = ("tag", "attrs", "parts")

    def __init__(self, tag, attrs):
        self.tag, self.attrs, self.parts = tag, dict(attrs), []

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in ("script", "style"):
                stack.extend(reversed(n.parts))
        return " ".join("".join(out).split())

    def all(self, rule: Rule) -> Iterator[_Node]:
        tag, attr, value = rule
        stack = [self]
        while stack:
            n = stack.pop()
            if n is not self and n.tag == tag and (attr is None or value in (n.attrs.get(attr) or "").split()):
                yield n
            if n.parts:
                stack.extend([x for x in reversed(n.parts) if x.__class__ is _Node])


class _Nodes:
    """Builds nodes from tags and texts in their order."""

    def __init__(self):
        self.top = _Node("", ())
        self.open = [self.top]
        self.count = Counter()  # open elements by tag, so that a stray end tag costs nothing

    def handle_starttag(self, tag, attrs):
        if tag in _ENDED_BY_SELF and self.open[-1].tag == tag:
            self.open.pop()
            self.count[tag] -= 1
        node = _Node(tag, attrs)
        self.open[-1].parts.append(node)
        if tag not in _VOID:
            self.open.append(node)
            self.count[tag] += 1

    def handle_endtag(self, tag):
        while self.count[tag]:
            ended = self.open.pop().tag
            self.count[ended] -= 1
            if ended == tag:
                break

    def handle_data(self, data):
        self.open[-1].parts.append(data)


class _Tree(_Nodes, HTMLParser):
    def __init__(self):
        HTMLParser.__init__(self, convert_charrefs=True)
        _Nodes.__init__(self)


#: A tag in the plainest form, and its attributes; what else begins with "<" is left to the parser.
_ATTR = r'[ \t\n\r\f]+([a-zA-Z][a-zA-Z0-9-]*)(?:="([^"<>&\0]*)"|=([a-zA-Z0-9_.-]+))?'
_TAG = re.compile(rf"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:{re.sub(r'[(](?![?])', '(?:', _ATTR)})*)[ \t\n\r\f]*>")
_ATTRS = re.compile(_ATTR)
#: Elements whose content the parser reads in another way.
_RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp plaintext svg math".split())


@lru_cache(maxsize=4096)
def _attributes(text: str) -> tuple[tuple[str, str | None], ...]:
    return tuple((m[1].lower(), m[2] if m[2] is not None else m[3]) for m in _ATTRS.finditer(text))


def _plain(html: str) -> _Nodes | None:
    """The parsed page if all its markup is plain tags and character references, which are split without the parser; else None."""
    found = _TAG.split(html)
    if html.count("<") != len(found) // 4 or "\0" in html:
        return None
    tags = [x.lower() for x in found[2::4]]
    if not _RAW.isdisjoint(tags) or any(a and e for e, a in zip(found[1::4], found[3::4], strict=True)):
        return None
    p = _Nodes()
    for text, end, tag, attrs in zip(found[0::4], found[1::4], tags, found[3::4], strict=False):
        if text:
            p.handle_data(unescape(text) if "&" in text else text)
        if end:
            p.handle_endtag(tag)
        else:
            p.handle_starttag(tag, _attributes(attrs) if attrs else ())
    if found[-1]:
        p.handle_data(unescape(found[-1]) if "&" in found[-1] else found[-1])
    return p


def tree(html: str | None) -> _Node:
    """The nodes of a page; broken markup is read as far as it goes."""
    plain = _plain(html or "")
    if plain is not None:
        return plain.top
    p = _Tree()
    try:
        p.feed(html or "")
        p.close()
    except (AssertionError, ValueError):
        pass
    return p.top


def _rows(df: DataFrame, html: str, take: Callable, columns: str) -> DataFrame:
    """Apply ``take`` (node to list of tuples) to each page; the html column goes, the others stay."""
    kept = [f for f in df.schema.fields if f.name != html]
    names = [c.split()[0] for c in columns.split(", ")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), columns])

    def run(frames):
        for f in frames:
            found = [take(tree(h)) for h in f.pop(html)]
            out = f.loc[f.index.repeat([len(x) for x in found])].reset_index(drop=True)
            own = pd.DataFrame([r for x in found for r in x], columns=names)
            yield pd.concat([out, own], axis=1)

    return df.select(*(f.name for f in kept), html).mapInPandas(run, schema)


def page_fields(df: DataFrame, html: str, spec: Mapping[str, Rule]) -> DataFrame:
    """Named fields: the text of the first matching node, else ""."""
    def take(top):
        return [tuple(next((n.text() for n in top.all(r)), "") for r in spec.values())]

    return _rows(df, html, take, ", ".join(f"{k} string" for k in spec))


def page_links(df: DataFrame, html: str, url: str, container: Rule | None = None) -> DataFrame:
    """One row per link (``link``) under the containers, or of the whole page, joined to the page's url; the html column goes."""
    kept = [f for f in df.schema.fields if f.name != html]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "link string"])

    def found(page: str | None, base: str | None) -> list[str]:
        top = tree(page)
        anchors = (a for n in ((top,) if container is None else top.all(container)) for a in n.all(("a", None, None)))
        out = []
        for a in anchors:
            if a.attrs.get("href") is not None:
                try:
                    out.append(urljoin(base or "", a.attrs["href"].strip()))
                except ValueError:  # no url
                    pass
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            links = [found(p, u) for p, u in zip(f.pop(html), f[url], strict=True)]
            out = f.loc[f.index.repeat([len(x) for x in links])].reset_index(drop=True)
            yield out.astype({c: object for c in out if out[c].dtype == "string"}).assign(link=pd.Series([y for x in links for y in x], dtype=object))

    return df.select(*(f.name for f in kept), html).mapInPandas(run, schema)


def page_pairs(df: DataFrame, html: str, item: Rule, label: Rule, value: Rule) -> DataFrame:
    """``pairs``: map of cleaned labels to values of all items that have both; the first of a label stays."""
    def take(top):
        found: dict[str, str] = {}
        for n in top.all(item):
            a, b = next(n.all(label), None), next(n.all(value), None)
            if a is not None and b is not None:
                found.setdefault(a.text().rstrip(":："), b.text())
        return [(found,)]

    return _rows(df, html, take, "pairs map<string,string>")


def page_cards(df: DataFrame, html: str, card: Rule, spec: Mapping[str, Rule]) -> DataFrame:
    """One row per card that has all fields; others are skipped."""
    def take(top):
        out = []
        for n in top.all(card):
            nodes = [next(n.all(r), None) for r in spec.values()]
            if all(x is not None for x in nodes):
                out.append(tuple(x.text() for x in nodes))
        return out

    return _rows(df, html, take, ", ".join(f"{k} string" for k in spec))


def page_tables(df: DataFrame, html: str, skip: int = 1, width: int | None = None) -> DataFrame:
    """(row number, cells) of table rows after the header; with ``width`` only rows of so many cells."""
    def take(top):
        out = []
        for t in top.all(("table", None, None)):
            for i, r in enumerate(list(t.all(("tr", None, None)))[skip:]):
                cells = [c.text() for c in r.parts if isinstance(c, _Node) and c.tag in ("td", "th")]
                if width is None or len(cells) == width:
                    out.append((i, cells))
        return out

    return _rows(df, html, take, "row int, cells array<string>")


def page_fallback(df: DataFrame, html: str, main: Mapping[str, Rule], other: Mapping[str, Rule]) -> DataFrame:
    """Fields of the main layout, or all of the other layout's where the main one gives no first field; pages are parsed once."""
    def take(top):
        first, second = (tuple(next((n.text() for n in top.all(r)), "") for r in (spec[k] for k in main)) for spec in (main, other))
        return [first if first[0] else second]

    return _rows(df, html, take, ", ".join(f"{k} string" for k in main))


def embedded_ids(df: DataFrame, html: str, attr: str) -> DataFrame:
    """One row per number in an attribute, quoted or not."""
    return df.withColumn("hid", F.explode(F.regexp_extract_all(html, F.lit(rf'{attr}\s*=\s*["\']?(\d+)'), 1))).drop(html)
