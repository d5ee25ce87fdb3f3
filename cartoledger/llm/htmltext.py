"""Main text of web pages by site template removal.

Pages become element trees; the subtrees that can give text are hashed, inside
the article too, the hashes are counted per host in Spark, one count per
distinct text of a page, and subtrees that recur in many different texts of
their host are deleted. What the page holds outside its articles, and elements
that say by tag, role or a known class or id that they are no article text, go
too; the remaining blocks are the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoledger.llm.common import pieces

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noframes xmp svg math".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "caption legend optgroup option".split()
)
_ENDS_P = _BLOCK - frozenset("td th tr tbody thead tfoot caption body html legend option optgroup".split())
# Elements that an opening tag closes, up to the given boundary.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Parts of a list, a table or a form control.
_PARTS = frozenset("li dt dd tr td th tbody thead tfoot caption legend option optgroup summary figcaption".split())
_SCOPE = frozenset("table td th caption html body article section div main aside".split())

# What marks an element as no article text.
_DROP_TAGS = frozenset(
    "nav header footer aside form script style noscript template iframe noframes svg math button select input textarea "
    "dialog menu head title object embed canvas audio video map".split()
)
_DROP_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
# Whole names of a class or an id; other names that contain these words say nothing (``no-sidebar``, ``related-work``).
_DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense ad-container ad-slot ad-banner sponsor sponsored promo "
    "banner cookie cookies cookie-notice cookie-banner cookie-bar cookie-consent consent gdpr popup modal "
    "sidebar site-sidebar menu main-menu navbar nav main-nav site-nav navigation site-navigation breadcrumb breadcrumbs "
    "pagination pager comment comments comments-area comment-list commentlist respond replies disqus-thread "
    "share sharing share-buttons social social-share social-links newsletter newsletter-signup subscribe signup login "
    "related related-posts related-articles recommended trending widget widget-area "
    "site-header footer site-footer page-footer masthead topbar toolbar skip-link".split()
)


class Element:
    __slots__ = ("tag", "attributes", "children", "digest", "verdict")

    def __init__(self, tag: str, attributes: str) -> None:
        self.tag, self.attributes, self.children, self.digest, self.verdict = tag, attributes, [], 0, None


def parse(page: str) -> Element:
    """The element tree; unclosed and stray tags are repaired the way browsers mostly do."""
    root = Element("#root", "")
    stack = [root]
    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            stack[-1].children.append(page[at:])
            break
        if found.start() > at:
            stack[-1].children.append(page[at : found.start()])
        at = found.end()
        if found[1]:
            tag = found[1].lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in _SCOPE and tag not in _BLOCK:
                    break
            continue
        if not found[2]:
            continue
        tag = found[2].lower()
        if tag in _ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in _BLOCK:
                    break
        if tag in _IMPLIED:
            closes, bound = _IMPLIED[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in bound:
                    break
                if stack[i].tag in closes:
                    del stack[i:]
                    break
        element = Element(tag, found[3])
        stack[-1].children.append(element)
        if tag in _VOID or found[3].endswith("/") and tag in ("svg", "math"):
            continue
        if tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            element.children.append(page[at : close.start() if close else end])
            at = close.end() if close else end
            continue
        stack.append(element)
    return root


def _attributes(element: Element) -> dict[str, str]:
    if not element.attributes:
        return {}
    return {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(element.attributes)
    }


def _no_prose(element: Element, inside: bool = False) -> bool:
    """Whether tag, role, class or id say that an element is no article text; ``inside`` an article, headers are."""
    if element.verdict is None:
        element.verdict = element.tag in _DROP_TAGS and element.tag != "header" or _named_no_prose(element)
    return element.verdict or element.tag == "header" and not inside


def _named_no_prose(element: Element) -> bool:
    if not element.attributes or element.tag in ("html", "body"):
        return False
    own = _attributes(element)
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or own.get("role", "").lower() in _DROP_ROLES:
        return True
    style = own.get("style", "").replace(" ", "").lower()
    if "display:none" in style or "visibility:hidden" in style:
        return True
    names = f"{own.get('class', '')} {own.get('id', '')}".lower().replace("_", "-").split()
    return any(n in _DROP_NAMES for n in names)


def _walk(root: Element):
    """Elements with their parents first; no recursion, so depth costs nothing."""
    todo = [root]
    while todo:
        element = todo.pop()
        yield element
        todo.extend(c for c in element.children if isinstance(c, Element))


def _is_article(element: Element) -> bool:
    if element.tag in ("article", "main"):
        return True
    return "role" in element.attributes.lower() and _attributes(element).get("role", "").lower() == "main"


def _articles(root: Element) -> list[Element]:
    """The outermost ``article`` and ``main`` elements in page order; none in an element that is no article text.

    An article with more than half of the page's text is never in such an
    element: it and all that holds it are marked as article text.
    """
    order = list(_walk(root))
    wanted = [e for e in order if _is_article(e)]
    if not wanted:
        return []
    sizes: dict[int, int] = {}
    parents: dict[int, Element] = {}
    for element in reversed(order):  # children before parents
        n = 0
        for child in element.children:
            if isinstance(child, Element):
                n += sizes[id(child)]
                parents[id(child)] = element
            elif element.tag not in _RAW:
                n += len(child.strip())
        sizes[id(element)] = n
    held = set()
    for element in wanted:
        if 2 * sizes[id(element)] > sizes[id(root)]:
            above: Element | None = element
            while above is not None and id(above) not in held:
                above.verdict = False
                held.add(id(above))
                above = parents.get(id(above))
    found, todo = [], [root]
    while todo:
        element = todo.pop()
        if element is not root and id(element) not in held and _no_prose(element):
            continue
        if _is_article(element):
            found.append(element)
        else:
            todo.extend(c for c in reversed(element.children) if isinstance(c, Element))
    return found


def _digest(root: Element) -> None:
    """Hash of each subtree from its tag, attributes, text and the hashes below."""
    for element in reversed(list(_walk(root))):  # children before parents
        state = xxhash.xxh3_64(f"{element.tag}\x00{element.attributes.strip()}")
        for child in element.children:
            if isinstance(child, str):
                state.update(" ".join(child.split()))
            else:
                state.update(child.digest.to_bytes(8, "little"))
        element.digest = state.intdigest()


def _alone(parent: Element, at: int) -> bool:
    """Whether an inline child is all the text between two blocks of its parent, so no sentence loses words with it."""
    if parent.tag not in _BLOCK or parent.tag in _PARTS:
        return False
    for step in (-1, 1):
        i = at + step
        while 0 <= i < len(parent.children):
            c = parent.children[i]
            if isinstance(c, Element):
                if c.tag not in _BLOCK:
                    return False
                break
            if c.strip():
                return False
            i += step
    return True


def _counted(root: Element, articles: list[Element]) -> Iterator[Element]:
    """Elements that can give text and may be template.

    Inside an article only whole blocks: neither words of a sentence nor parts
    of a list or a table (these count as a whole) go for recurring.
    """
    todo = list(articles or [root])
    while todo:
        parent = todo.pop()
        for at, child in enumerate(parent.children):
            if isinstance(child, str) or _no_prose(child, bool(articles)):
                continue
            if not articles:
                whole = child.tag not in ("html", "body", "head")
            else:
                whole = child.tag not in _PARTS if child.tag in _BLOCK else _alone(parent, at)
            if whole:
                yield child
            todo.append(child)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def page_subtrees(page: str) -> set[int]:
    """Signed hashes of a page's subtrees that may be template and hold text."""
    return _content(page)[1]


def _content(page: str) -> tuple[int, set[int]]:
    """Signed hash of a page's text before any template is deleted, and its ``page_subtrees``."""
    root = parse(page)
    articles = _articles(root)
    _digest(root)
    found = {
        _signed(e.digest)
        for e in _counted(root, articles)
        if any(isinstance(c, Element) or c.strip() for c in e.children)
    }
    return _signed(xxhash.xxh3_64_intdigest(_text(root, articles, set()))), found


def extract(page: str, template: frozenset[int] | set[int]) -> str:
    """Text blocks of a page without its template subtrees."""
    root = parse(page)
    articles = _articles(root)
    gone: set[int] = set()
    if template:
        _digest(root)
        gone = {id(e) for e in _counted(root, articles) if _signed(e.digest) in template}
    return _text(root, articles, gone)


def _text(root: Element, articles: list[Element], gone: set[int]) -> str:
    """The text blocks of the articles, or of a page without any, without the elements whose ids are ``gone``."""
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            blocks.append(text)

    tops = articles or [root]
    starts = {id(e) for e in tops}
    todo: list = list(reversed(tops))
    while todo:
        node = todo.pop()
        if node is None:
            end()
        elif isinstance(node, str):
            run.append(node)
        elif id(node) in starts or not (id(node) in gone or _no_prose(node, bool(articles))):
            if node.tag in ("br", "wbr"):
                run.append(" " if node.tag == "br" else "")
            elif node.tag in _BLOCK or id(node) in starts:
                end()
                todo.append(None)
            todo.extend(reversed(node.children))
        elif node.tag in _BLOCK:
            end()
    end()
    return "\n\n".join(blocks)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def templates(pages: DataFrame, url_col: str, html_col: str, min_pages: int, min_share: float) -> DataFrame:
    """``(host, subtree)`` of the subtrees in at least ``min_pages`` and ``min_share`` of a host's different texts."""
    schema = pa.schema([("host", pa.string()), ("subtree", pa.int64()), ("content", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            hosts, found, contents = [], [], []
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                host = host_of(url)
                content, subtrees = _content(page.decode("utf-8", "replace"))
                own = [0, *subtrees]  # 0 counts the text itself
                hosts += [host] * len(own)
                found += own
                contents += [content] * len(own)
            columns = zip((hosts, found, contents), schema, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)

    counted = _columns(pages, None, url_col, html_col).mapInArrow(run, "host string, subtree long, content long")
    counted = counted.distinct().groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"))
    pages_of = counted.where("subtree = 0").select("host", F.col("n").alias("pages"))
    recurring = counted.where((F.col("subtree") != 0) & (F.col("n") >= min_pages))
    return recurring.join(pages_of, "host").where(F.col("n") >= F.col("pages") * min_share).select("host", "subtree")


def _columns(pages: DataFrame, id_col: str | None, url_col: str, html_col: str) -> DataFrame:
    own = [] if id_col is None else [pages[id_col].cast("long").alias("page_id")]
    return pages.select(
        *own, pages[url_col].alias("url"), F.coalesce(pages[html_col].cast("binary"), F.lit(b"")).alias("html")
    )


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = 5,
    min_share: float = 0.1,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages``.

    Blocks are joined by two line feeds, white space inside a block is one space,
    character references are decoded. A null or empty page has the empty text;
    a null or broken url belongs to the host without a name; pages of equal
    text count once, so copies of a page do not erase it; an empty table gives
    an empty result. Inside a page's article, blocks that recur in many
    different texts of the host are template like any others.

    Up to ``broadcast_rows`` templates (counted first) are sent to the
    executors; more are joined to the pages by host as sorted lists.
    """
    from cartoledger.llm.common import checkpointed

    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
    )
    found = checkpointed(templates(pages, url_col, html_col, min_pages, min_share))
    own = _columns(pages, id_col, url_col, html_col)
    by_host: dict[str, set[int]] = {}
    shared = found.count() <= broadcast_rows
    if shared:
        for row in found.collect():
            by_host.setdefault(row["host"], set()).add(row["subtree"])
    else:
        # Each page meets only the templates it holds: subtrees are joined by (host, subtree), never whole hosts.
        own = _with_own_templates(own, found)
    sent = pages.sparkSession.sparkContext.broadcast(by_host)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            urls = batch.column("url").to_pylist()
            pages_ = batch.column("html").to_pylist()
            if shared:
                known = [sent.value.get(host_of(u), set()) for u in urls]
            else:
                known = [set(x or ()) for x in batch.column("subtrees").to_pylist()]
            texts = [extract(p.decode("utf-8", "replace"), k) for p, k in zip(pages_, known, strict=True)]
            sizes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(urls, pa.string()), pa.array(texts, pa.string())]
                + [pa.array(sizes, pa.int64())],
                schema=schema,
            )

    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def _with_own_templates(own: DataFrame, found: DataFrame) -> DataFrame:
    """Pages with the list of their own subtrees that are templates, joined by subtree and then by page."""
    schema = pa.schema([("host", pa.string()), ("subtree", pa.int64()), ("page", pa.int64())])
    keyed = own.withColumn("page", F.xxhash64("page_id", "url", "html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            rows = [
                (host_of(r["url"]), s, r["page"])
                for r in batch.to_pylist()
                for s in page_subtrees(r["html"].decode("utf-8", "replace"))
            ]
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, schema.field(i).type) for i, c in enumerate(columns)], schema=schema
            )

    held = keyed.select("url", "html", "page").mapInArrow(run, "host string, subtree long, page long").distinct()
    lists = held.join(found, ["host", "subtree"]).groupBy("page").agg(F.collect_set("subtree").alias("subtrees"))
    return keyed.join(lists, "page", "left").select("page_id", "url", "html", "subtrees")
