"""HTML extraction with wrappers: union-free regular expressions inferred from the pages of a host.

A page's markup becomes a stream of items: block elements (element, class without digits, and the role that
their class, id or ARIA role names) that hold streams of their own, and text slots. Streams of one host are
aligned item by item: the alignment has as many common items as possible and, among these, as many of equal
text. Items that only one side has become optional groups; runs of equal neighbours (or neighbouring pairs)
longer than ``2 * EDGE + 1`` keep ``EDGE`` items at either end, and what lies between is one repeated group.
Aligned texts that differ make a slot, equal ones stay constant. Aligning is symmetric, so wrappers of parts
of a host are aligned like pages: tasks fold their pages, then parts of a host are folded per salt, then per
host, and no task holds a host's pages.

A page is read with its host's wrapper: its items are matched with the wrapper's, stream by stream, and its
main text is the text of the content items. Menus, headers, footers, sidebars, notices, adverts, forms, reader
comments and code never are. Slots, optional and repeated groups of blocks whose text is mostly outside links
are, except constants that all of several different pages repeat (a text keeps the hashes of up to three
different pages, so copies of one page count once). Article (or main) elements are blocks that keep their constants;
beside them only slots of several pages are content.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from html import unescape
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import small_batches, table, written

# Elements by what they are in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math mfrac mi mn mo mroot mrow msqrt msub msubsup msup mtext nobr q s samp semantics small span strike strong sub sup time tt u var wbr".split())
BOILERPLATE = frozenset("nav header footer aside form button dialog menu head".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th", "thead", "tbody"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "thead", "tbody")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}
# Parts of a class, id or role that name what is not the article.
ROLES = re.compile(r"(?:^|[\s_-])(nav(?:bar|igation)?|menus?|breadcrumbs?|header|masthead|footer|copyright|sidebar|side-?bar|aside|complementary|notices?|alert|cookies?|consent|gdpr|banner|ads?|advert(?:s|isement|ising)?|adbox|sponsor(?:ed|s)?|promo(?:tion)?s?|newsletter|subscribe|subscription|signup|login|search|form|comments?|commentlist|disqus|replies|reply|responses|related|recommend(?:ed|ations)?|share|sharing|social|popup|modal|overlay|toolbar|pagination|pager|contentinfo)(?=$|[\s_-])", re.I)
#: A quote opens a value only after an equals sign, and only where it is closed again.
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*')?)*+)>|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
EDGE, SEVERAL = 3, 3
sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000_000))  # markup nests as deeply as it likes; these calls stay off the C stack
TEXT = "#"


class Item:
    """A block (key = element, role and class; items inside) or a text; in wrappers with its occurrence."""

    __slots__ = ("key", "role", "items", "text", "links", "optional", "repeated", "size", "pages")

    def __init__(self, key, text=None, links=0):
        self.key, self.items, self.text, self.links = key, [], text, links
        self.role = key.split("|")[1] if "|" in key else ""
        self.optional = self.repeated = False
        self.size = len(text) if text else 0
        self.pages = ()  # of a text: hashes of different pages that have it, SEVERAL at most


def parse(html: str) -> Item:
    """The tree of blocks; inline elements fold into the texts around them. Never fails."""
    top = Item("page")
    stack: list[Item] = [top]
    words: list[str] = []
    linked = [0, 0]  # open links, characters in them

    def flush():
        text = " ".join(unescape("".join(words)).split())
        if text:
            stack[-1].items.append(Item(TEXT, text, min(linked[1], len(text))))
        words.clear()
        linked[1] = 0

    def close(upto: int):
        flush()
        del stack[upto:]
        linked[0] = 0

    def find(names, stop=()):
        for i in range(len(stack) - 1, 0, -1):
            tag = stack[i].key.partition("|")[0]
            if tag in names:
                return i
            if tag in stop:
                return 0
        return 0

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        piece = html[at : m.start() if m else n]
        if piece:
            words.append(piece)
            if linked[0]:
                linked[1] += len(piece.strip())
        if not m:
            break
        at = m.end()
        if m[5]:  # a tag whose quotes don't close ends at the next bracket, or is cut off by the page's end
            at = html.find(">", at) + 1
            if not at:
                break
            continue
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                words.append(m[0][9:].removesuffix("]]>"))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag == "br" or tag in VOID:
            words.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = end.end() if end else (n if tag in ("script", "style") else at)
            continue
        if tag in INLINE:
            if tag == "a":
                linked[0] = 0 if closing else 1
            continue
        if closing:
            i = find((tag,))
            if i:
                close(i)
            elif tag == "p":
                flush()
            continue
        if tag in CLOSES_P and (i := find(("p",), ("table", "td", "th", "div", "article", "section"))):
            close(i)
        if tag in SIBLINGS and (i := find(SIBLINGS[tag], SCOPES.get(tag, ("table",)))):
            while (j := find(SIBLINGS[tag], SCOPES.get(tag, ("table",)))) and j < i:
                i = j
            close(i)
        flush()
        named = kind = ""
        if m[3]:
            values = {k.lower(): (a or b or c or "") for k, a, b, c in _ATTRIBUTE.findall(m[3])}
            kind = " ".join(re.sub(r"[\d|]+", "", values.get("class", "").lower()).split())
            if "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style", "")):
                named = "hidden"
            elif tag not in ("body", "html"):
                names = " ".join(values.get(k, "") for k in ("class", "id", "role"))
                # Of an article a whole name tells its role, as others speak of its surroundings ("with-sidebar").
                role = next(filter(None, map(ROLES.fullmatch, names.split())), None) if tag in ("article", "main") else ROLES.search(names)
                named = role[1].lower() if role else ""
        block = Item(f"{tag}|{named}|{kind}" if named or kind else tag)
        stack[-1].items.append(block)
        if not m[3].endswith("/"):
            stack.append(block)
    flush()
    return top


def boilerplate(item: Item) -> bool:
    return bool(item.role) or item.key.partition("|")[0] in BOILERPLATE


def is_a(item: Item, tag: str) -> bool:
    return item.key.partition("|")[0] == tag


def mark(item: Item) -> str | None:
    """The text of an item that holds one text and nothing else."""
    return item.text if item.key == TEXT else item.items[0].text if len(item.items) == 1 and item.items[0].key == TEXT else None


def _merged(items: list[Item]) -> Item:
    out = items[0]
    for x in items[1:]:
        out = _merge(out, x)
    return out


def _repeats(items: list[Item]) -> list[Item]:
    """Long runs of equal neighbours, or of neighbouring pairs, keep their ends; between them is a repeated group."""
    out: list[Item] = []
    i, n = 0, len(items)
    while i < n:
        for step in (1, 2):
            j = i + step
            while j < n and items[j].key == items[j - step].key:
                j += 1
            j -= (j - i) % step
            if (j - i) // step > 2 * EDGE + 1 and (step == 1 or TEXT not in (items[i].key, items[i + 1].key)):
                first, last = i + EDGE * step, j - EDGE * step
                middle = [_merged(items[first + k : last : step]) for k in range(step)]
                for x in middle:
                    x.repeated = True
                out += [*items[i:first], *middle, *items[last:j]]
                i = j
                break
        else:
            out.append(items[i])
            i += 1
    return out


def _merge(a: Item, b: Item) -> Item:
    new = Item(a.key)
    new.optional, new.repeated = a.optional or b.optional, a.repeated or b.repeated
    new.size, new.links = a.size + b.size, a.links + b.links
    new.text = a.text if a.text == b.text else None
    new.pages = tuple(sorted({*a.pages, *b.pages})[:SEVERAL])
    new.items = align(a.items, b.items)
    return new


def gain(a: Item, b: Item) -> int:
    """What aligning two items is worth: 2, and 1 more for equal texts; 0 where they can't be aligned."""
    if a.key != b.key:
        return 0
    own = mark(a)
    return 3 if own is not None and own == mark(b) else 2


def align(a: list[Item], b: list[Item]) -> list[Item]:
    """One stream that both streams match: common items merged, all others optional."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = below[j] if below[j] >= row[j + 1] else row[j + 1]
            if (g := gain(a[i], b[j])) and below[j + 1] + g > row[j]:
                row[j] = below[j + 1] + g
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and (g := gain(a[i], b[j])) and best[i][j] == best[i + 1][j + 1] + g:
            out.append(_merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j >= m or i < n and best[i][j] == best[i + 1][j]:
            a[i].optional = True
            out.append(a[i])
            i += 1
        else:
            b[j].optional = True
            out.append(b[j])
            j += 1
    return _repeats(out)


def content_hash(page: Item, start: int = 0) -> int:
    """A hash of a page's texts outside boilerplate: copies of a page share it."""
    for x in page.items:
        if x.key == TEXT:
            start = crc32(x.text.encode("utf-8", "replace") + b"\n", start)
        elif not boilerplate(x):
            start = content_hash(x, start)
    return start


def text_hash(text: str) -> str:
    return f"{crc32(text.encode('utf-8', 'replace')):08x}"


def folded(page: Item, own: int | None = None) -> Item:
    """A page as a wrapper of itself; texts are kept as hashes."""
    own = content_hash(page) if own is None else own
    new = Item(page.key, None, page.links)
    new.size = page.size
    if page.text is not None:
        new.text = text_hash(page.text)
        new.pages = (own,)
    new.items = _repeats([folded(x, own) for x in page.items])
    return new


def pack(item: Item) -> str:
    """A tree as JSON: its items before what they hold, each with the number of items inside."""
    out, todo = [], [item]
    while todo:
        x = todo.pop()
        out.append([x.key, x.text, x.size, x.links, int(x.optional), int(x.repeated), len(x.items), x.pages])
        todo += x.items[::-1]
    return json.dumps(out, separators=(",", ":"))


def unpack(packed: str) -> Item:
    top = Item("")
    todo = [[top, 1]]
    for key, text, size, links, optional, repeated, inside, pages in json.loads(packed):
        item = Item(key)
        item.text, item.size, item.links, item.optional, item.repeated, item.pages = text, size, links, bool(optional), bool(repeated), tuple(pages)
        while not todo[-1][1]:
            todo.pop()
        todo[-1][0].items.append(item)
        todo[-1][1] -= 1
        todo.append([item, inside])
    return top.items[0]


def measured(item: Item) -> Item:
    """Sizes and linked characters of blocks become the sums of their texts'."""
    order, todo = [], [item]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += x.items
    for x in reversed(order):
        if x.key != TEXT:
            x.size, x.links = sum(y.size for y in x.items), sum(y.links for y in x.items)
    return item


def matched(items: list[Item], own: list[Item]) -> list[Item | None]:
    """The wrapper's item that each item of a page's stream matches, None for those that match none.

    As many common items as possible, and among these as many of equal text; a repeated item matches as often
    as it comes, a repeated pair in turns. Texts of ``own`` are hashes.
    """
    n, m = len(items), len(own)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    after = [max(0, j - 1) if j and x.repeated and own[j - 1].repeated else j if x.repeated else j + 1 for j, x in enumerate(own)]
    marks = [mark(x) for x in own]
    worth = []
    for x in items:
        text = mark(x)
        hashed = None if text is None else text_hash(text)
        worth.append([0 if y.key != x.key else 3 if hashed is not None and hashed == t else 2 for y, t in zip(own, marks, strict=True)])
    for i in range(n - 1, -1, -1):
        row, below, gains = best[i], best[i + 1], worth[i]
        for j in range(m - 1, -1, -1):
            row[j] = max(below[j], row[j + 1])
            if gains[j]:
                row[j] = max(row[j], below[after[j]] + gains[j])
    out: list[Item | None] = [None] * n
    i = j = 0
    while i < n and j < m:
        if worth[i][j] and best[i][j] == best[i + 1][after[j]] + worth[i][j]:
            out[i] = own[j]
            i, j = i + 1, after[j]
        elif best[i][j] == best[i][j + 1]:
            j += 1
        else:
            i += 1
    return out


def main_text(page: Item, wrapper: Item | None) -> str:
    """Texts of the content items, in page order, joined by empty lines.

    The page is matched with its host's wrapper, which decides: constants of several different pages go, groups that
    are mostly links go, and slots that several pages fill with texts of their own stay, also where they stand before
    or after an article. An article's constants stay, as near copies of an article share most of its text. What the
    wrapper has met on too few pages to tell is content in an article, or where the page has none.
    """
    found: list[tuple[str, bool, bool]] = []  # text, in an article, a slot of several pages

    def has_article_inside(item: Item) -> bool:
        todo = [item]
        while todo:
            for x in todo.pop().items:
                if not boilerplate(x):
                    if is_a(x, "article"):
                        return True
                    todo.append(x)
        return False

    def walk(item: Item, own: Item | None, article: bool):
        for x, model in zip(item.items, matched(item.items, own.items if own else []), strict=True):
            if x.key == TEXT:
                several = model is not None and len(model.pages) >= SEVERAL
                constant = several and model.text == text_hash(x.text) and not model.optional
                if (article or not constant) and 2 * x.links <= len(x.text):
                    found.append((x.text, article, several and model.text is None))
            elif not boilerplate(x):
                told = model or x
                named = is_a(x, "article") or not article and is_a(x, "main") and not has_article_inside(x)
                if 2 * told.links <= told.size:
                    walk(x, model, article or named)

    measured(page)
    walk(page, wrapper, False)
    articles = any(article for _, article, _ in found)
    return "\n\n".join(text for text, article, slot in found if article or slot or not articles)


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _fold_pages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Wrappers of the hosts of a task's pages; at most 500 are held at a time."""
    held: dict[str, tuple[Item, int]] = {}

    def rows():
        return pd.DataFrame([(h, pack(w), n) for h, (w, n) in held.items()], columns=["host", "wrapper", "n"])

    for frame in frames:
        for host, html in zip(frame["host"], frame["html"], strict=True):
            new = folded(parse(html))
            old = held.get(host)
            held[host] = (_merge(old[0], new), old[1] + 1) if old else (new, 1)
        if len(held) > 500:
            yield rows()
            held.clear()
    if held:
        yield rows()


def _fold_wrappers(frame: pd.DataFrame) -> pd.DataFrame:
    item = None
    for row in frame["wrapper"]:
        new = unpack(row)
        item = _merge(item, new) if item else new
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [pack(item)], "n": [int(frame["n"].sum())]})


_WRAPPER = "host string, wrapper string, n long"


def infer_wrappers(pages: DataFrame, salts: int = 32) -> DataFrame:
    """(host, wrapper, n) from (host, html) rows: the wrapper as JSON, and the number of pages it stands for."""
    parts = pages.filter("html is not null").mapInPandas(_fold_pages, _WRAPPER)
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
    parts = parts.groupBy("host", "salt").applyInPandas(_fold_wrappers, _WRAPPER)
    return written(parts.groupBy("host").applyInPandas(_fold_wrappers, _WRAPPER), "wrappers")


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, Item] = {}
    for frame in frames:
        out = []
        for html, host, wrapper in zip(frame["html"], frame.pop("host"), frame.pop("wrapper"), strict=True):
            if not html:
                out.append("")
                continue
            if wrapper is not None and host not in known:
                if len(known) > 500:
                    known.clear()
                known[host] = measured(unpack(wrapper))
            out.append(main_text(parse(html), known.get(host)))
        yield frame.drop(columns="html").assign(text=out)


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text): the main text of every page, empty where there is none.

    Null and empty html give an empty text; null and hostless urls share one wrapper; rows that repeat a
    page are rows again. Broken markup is read as far as it goes, markup of any depth and length is read whole.
    No rows give none. Other columns are ignored.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(F.col(url)).alias("host"))
    found = infer_wrappers(rows.select("host", "html"))
    kind = pages.schema[page_id].dataType.simpleString()
    return rows.join(found, "host", "left").select("page_id", "url", "html", "host", "wrapper").mapInPandas(_extract, f"page_id {kind}, url string, text string")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract_pages(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
