"""Main text of web pages, after removal of what a site repeats on its pages.

Each page is parsed once. Elements that are no article text whatever their content go first
(navigation, forms, scripts, adverts by class, reader comments and so on). What remains
are blocks of text, each with the hashes of the subtrees it lies in that could be a part of
the site's template: tag, attributes, text and the hashes of their children. A page
without such subtrees is done.

Spark counts on how many different pages of a host each hash occurs. Pages with the same
text count once, so copies of a page do not turn its article into a template. Blocks within
a subtree that occurs on at least ``LEAST_PAGES`` different pages of its host, however many
it has, are removed from the pages that hold them. Only hashes are shuffled, and for pages with such
subtrees their packed blocks.

What an element is called says little where it wraps the page. Neither ``html``, ``body`` nor ``main``
nor what holds the page's article goes, and nothing goes for a name, a role, a form or
being hidden that holds most of the text: there the controls of a form go, not its text.
Within an article, names count on containers only, doubtful ones (``related``) only where
most of the text is links; paragraphs, headings and other running text never count as
template: an article that quotes another keeps the quotation.

Character references are decoded, white space inside a block becomes one space, blocks
are joined by an empty line in page order. Null and empty pages give an empty text, pages
without a host in their address lose no template. Unclosed and misplaced tags are closed
as browsers do; broken markup never fails, and the time grows with the length of a page,
however deep its elements are nested. A page is parsed in one task, with memory in proportion to
its length. Rows stay as they are, repeated or not; other columns are left out.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rejoinder.llm.frames import saved

LEAST_PAGES = 5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title svg math object canvas video audio select".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = _HEADINGS | frozenset("p blockquote pre li ul ol dl dt dd table tbody thead tr td th figure figcaption".split())
#: Elements that end when the next of their kind begins, and what keeps them open.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_CLOSES_P = ({"p"}, {"button", "table", "td", "th"})
_NO_TEXT = frozenset("head nav header footer aside button dialog menu label".split())
#: Elements that hold no text unless they wrap the page.
_CONTROLS = frozenset("form fieldset".split())
_NO_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Parts of class names and ids that mark what is no article text.
_NO_NAME = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner cookie cookies consent notice notices gdpr "
    "popup modal newsletter subscribe subscription share sharing social comment comments disqus sidebar breadcrumb "
    "breadcrumbs menu nav navbar navigation footer masthead related recommended recommendations widget toolbar pagination "
    "pager replies respond".split()
)
#: Those that an article's own parts may bear.
_DOUBTFUL = frozenset("banner notice notices menu related recommended recommendations widget share sharing social promotion modal".split())
#: Those of what readers wrote, which may be longer than the article.
_READERS = frozenset("comment comments disqus replies respond".split())


class Element:
    __slots__ = ("tag", "attributes", "children", "mark", "size", "linked", "parent")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Element | None = None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Element | str] = []
        self.mark, self.size, self.linked = b"", 0, 0


class _Open:
    """The open elements, with the places of each tag among them, so that no search walks over the others."""

    def __init__(self, root: Element):
        self.stack, self.places = [root], {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.stack))
        self.stack.append(element)

    def last(self, tags: frozenset[str] | set[str]) -> int:
        """The place of the innermost open element of one of ``tags``, 0 for none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def close(self, place: int) -> None:
        """Closes the element at a place and all within it."""
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()


def parse(page: str) -> Element:
    """The tree of a page; text is kept with its references decoded."""
    root = Element("#page", {})
    opened, at = _Open(root), 0
    while True:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            opened.stack[-1].children.append(html.unescape(text))
        if not m:
            return root
        at = m.end()
        close, tag, inside = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if close:
            if place := opened.last({tag}):
                opened.close(place)
            continue
        attributes = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in _ATTRIBUTE.finditer(inside)} if inside else {}
        if tag in _VOID:
            opened.stack[-1].children.append(Element(tag, attributes, opened.stack[-1]))
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        ends, stops = _CLOSES.get(tag, _CLOSES_P if tag in _BLOCKS else (None, None))
        if ends:
            while (place := opened.last(ends)) > opened.last(stops):
                opened.close(place)
                if tag != "tr":
                    break
        element = Element(tag, attributes, opened.stack[-1])
        opened.stack[-1].children.append(element)
        opened.push(element)


def _walk(root: Element) -> Iterator[tuple[Element, bool, bool]]:
    """Elements before their children (``True``) and after them, and whether within an article."""
    todo: list[tuple[Element, bool, bool]] = [(root, True, False)]
    while todo:
        element, before, article = todo.pop()
        yield element, before, article
        if before:
            inside = article or element.tag in ("article", "main")
            todo.append((element, False, article))
            todo.extend((c, True, inside) for c in reversed(element.children) if isinstance(c, Element))


def _is_candidate(element: Element, article: bool) -> bool:
    """Whether an element could be a part of the site's template."""
    tag = element.tag
    return tag in _BLOCKS and tag not in ("html", "body", "article", "main") and not (article and tag in _PROSE)


def mark_subtrees(root: Element) -> list[bytes]:
    """Sets each element's hash; returns those of possible template parts with text."""
    found = []
    for element, before, article in _walk(root):
        if before:
            continue
        digest = hashlib.blake2b(repr((element.tag, sorted(element.attributes.items()))).encode("utf-8", "replace"), digest_size=8)
        text = False
        for child in element.children:
            if isinstance(child, Element):
                digest.update(b"\0" + child.mark)
                text = True
            elif words := " ".join(child.split()):
                digest.update(b"\1" + words.encode("utf-8", "replace"))
                text = True
        element.mark = digest.digest()
        if text and _is_candidate(element, article):
            found.append(element.mark)
    return found


def _measure(root: Element) -> None:
    """Sets how much text each element holds, and how much of it in links; what is never text counts for nothing."""
    for element, before, _ in _walk(root):
        if before:
            continue
        for child in element.children:
            if isinstance(child, str):
                element.size += len(child.strip())
            else:
                element.size += child.size
                element.linked += child.linked
        if element.tag in _NO_TEXT:
            element.size = element.linked = 0
        elif element.tag == "a":
            element.linked = element.size


def _main_part(root: Element) -> Element | None:
    """The article or main part that holds most text, one outside navigation and the like if there is any."""
    best, best_rank = None, (False, -1)
    todo = [(root, True)]
    while todo:
        element, free = todo.pop()
        free = free and element.tag not in _NO_TEXT
        if element.tag in ("article", "main"):
            rank = (free, element.size)
            if rank > best_rank:
                best, best_rank = element, rank
        todo.extend((c, free) for c in element.children if isinstance(c, Element))
    return best


def _names(element: Element) -> set[str]:
    text = f"{element.attributes.get('class', '')} {element.attributes.get('id', '')}"
    return {part.lower() for part in _NAME_PARTS.findall(text)} if len(text) > 1 else set()


def _is_hidden(a: dict[str, str]) -> bool:
    return "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "")


def _is_boilerplate(element: Element, whole: int, inside: bool) -> bool:
    """Whether an element that does not hold the page's article goes. ``whole``: how much text there is beside it and in it."""
    if element.tag in _NO_TEXT:
        return True
    if element.tag not in _CONTROLS and not element.attributes or element.tag in ("html", "body", "main"):
        return False
    names = _names(element) & _NO_NAME
    if inside:
        if element.tag in _PROSE:
            names = set()
        elif names <= _DOUBTFUL and 2 * element.linked <= element.size:
            names = set()
    if names & _READERS and 10 * element.size <= 9 * whole:
        return True
    if 2 * element.size > whole:
        return False
    return bool(names) or element.tag in _CONTROLS or _is_hidden(element.attributes) or element.attributes.get("role") in _NO_ROLE


def _kept(root: Element) -> None:
    """Removes what is no article text; of an article's header the headings stay."""
    _measure(root)
    main = _main_part(root)
    holding, at = set(), main
    while at is not None:
        holding.add(id(at))
        at = at.parent
    whole = main.size if main is not None else root.size
    todo = [(root, False)]
    while todo:
        element, article = todo.pop()
        inside = article or element.tag in ("article", "main")
        children = []
        for child in element.children:
            if isinstance(child, Element):
                if inside and child.tag == "header" and id(child) not in holding:
                    child.children = [e for e, before, _ in _walk(child) if before and e.tag in _HEADINGS]
                elif id(child) not in holding and _is_boilerplate(child, whole, inside):
                    continue
                todo.append((child, inside))
            children.append(child)
        element.children = children


def _outermost(root: Element, tag: str) -> list[Element]:
    found, todo = [], [root]
    while todo:
        element = todo.pop()
        if element.tag == tag:
            found.append(element)
        else:
            todo.extend(c for c in reversed(element.children) if isinstance(c, Element))
    return found


def _roots(root: Element) -> list[Element]:
    """The outermost articles, within the main part if there is one; that part itself where most of its text is
    outside of them; else the whole page."""
    mains = _outermost(root, "main")
    if not mains:
        return _outermost(root, "article") or [root]
    main = max(mains, key=lambda e: e.size)
    articles = _outermost(main, "article")
    return articles if 2 * sum(e.size for e in articles) > main.size else [main]


def blocks(root: Element, marks: frozenset[bytes] = frozenset()) -> list[tuple[str, tuple[bytes, ...]]]:
    """The text of each block, with those of ``marks`` that it lies in."""
    found: list[tuple[str, tuple[bytes, ...]]] = []
    open_text: list[str] = []
    within: list[bytes] = []

    def flush() -> None:
        if text := " ".join("".join(open_text).split()):
            found.append((text, tuple(within)))
        open_text.clear()

    for part in _roots(root):
        todo: list[Element | str | bool] = [part]
        while todo:
            item = todo.pop()
            if isinstance(item, bool):
                flush()
                if item:
                    within.pop()
            elif isinstance(item, str):
                open_text.append(item)
            elif item.tag == "br":
                open_text.append(" ")
            else:
                if item.tag in _BLOCKS or item is part:
                    flush()
                    marked = item.mark in marks and item.tag in _BLOCKS
                    if marked:
                        within.append(item.mark)
                    todo.append(marked)
                todo.extend(reversed(item.children))
    return found


def page_blocks(page: str | None) -> list[tuple[str, tuple[bytes, ...]]]:
    """The blocks of a page with the marks of the possible template parts they lie in."""
    root = parse(page or "")
    _kept(root)
    marks: frozenset[bytes] = frozenset()
    if any(before and _is_candidate(element, article) for element, before, article in _walk(root)):
        marks = frozenset(mark_subtrees(root))
    return blocks(root, marks)


def join_blocks(found: list[tuple[str, tuple[bytes, ...]]], templates: frozenset[bytes] = frozenset()) -> str:
    return "\n\n".join(text for text, marks in found if not templates.intersection(marks))


def main_text(page: str | None, templates: frozenset[bytes] = frozenset()) -> str:
    return join_blocks(page_blocks(page), templates)


def host_of(url: Column) -> Column:
    """The host of an address in lower case, null where it has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


_READ = "page_id long, url string, host string, key binary, page binary, marks array<binary>, text string, packed binary"
_READ_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("key", pa.binary()), ("page", pa.binary()),
        ("marks", pa.list_(pa.binary())), ("text", pa.string()), ("packed", pa.binary()),
    ]
)


def _digest(*parts: str) -> bytes:
    return hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=16).digest()


def _pack(found: list[tuple[str, tuple[bytes, ...]]]) -> bytes:
    return zlib.compress(json.dumps([(text, [m.hex() for m in marks]) for text, marks in found]).encode(), 6)


def _unpack(packed: bytes) -> list[tuple[str, tuple[bytes, ...]]]:
    return [(text, tuple(bytes.fromhex(m) for m in marks)) for text, marks in json.loads(zlib.decompress(packed))]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page with its text, or, where that depends on the host's other pages, with its packed blocks and their marks."""
    for batch in batches:
        rows = []
        for page_id, url, host, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "html"))):
            found = page_blocks(page)
            text = join_blocks(found)
            marks = sorted({m for _, marks in found for m in marks}) if host else []
            if marks:
                rows.append((page_id, url, host, _digest(host, page), _digest(text), marks, None, _pack(found)))
            else:
                rows.append((page_id, url, host, None, None, None, text, None))
        columns = zip(*rows) if rows else [[]] * len(_READ_SCHEMA)
        yield pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, _READ_SCHEMA)], schema=_READ_SCHEMA)


def site_templates(read: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``key, templates``: the marks of a page that are template of its host.

    Pages of a host that have the same text count once for a mark. Both sides of the join are written before
    it, so that AQE can split a mark that is on very many pages.
    """
    seen = read.filter("marks IS NOT NULL").select("host", "key", "page", F.explode("marks").alias("mark"))
    counts = seen.select("host", "mark", "page").distinct().groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n"))
    often = saved(counts.filter(F.col("n") >= least_pages).select("host", "mark"), "templates")
    return seen.select("host", "key", "mark").join(often, ["host", "mark"]).groupBy("key").agg(F.collect_set("mark").alias("templates"))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            join_blocks(_unpack(packed), frozenset(templates or ()))
            for packed, templates in zip(*(batch.column(c).to_pylist() for c in ("packed", "templates")))
        ]
        yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_text(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``page_id, url, html``."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")
    read = saved(own.mapInArrow(_read, _READ), "pages-read")
    done = read.filter("marks IS NULL").select("page_id", "url", "text")
    # Copies of a page share its key: written, so that AQE can split them.
    templates = saved(site_templates(read, least_pages), "page-templates")
    rest = read.filter("marks IS NOT NULL").select("page_id", "url", "key", "packed").join(templates, "key", "left")
    finished = rest.select("page_id", "url", "packed", "templates").mapInArrow(_finish, "page_id long, url string, text string")
    return done.unionByName(finished).withColumn("n_chars", F.length("text").cast("long"))
