"""Main text of web pages, without what a site repeats around it.

A page is parsed to a tree. The hash of an element's subtree stands for its tags and text; Spark
counts in how many pages of its host each occurs, and subtrees that recur in many of them are
deleted as the site's template. Rules on tags, classes and roles take out what no count can show,
as on hosts with few pages. What is left of the article is written block by block.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfunnel.llm.common import fresh, same, saved

#: Pages of a host, and share of its pages, that a subtree of the template is in at least.
TEMPLATE_PAGES, TEMPLATE_SHARE = 5, 0.3
#: Pages of a host that make a subtree a template's whatever their share: large hosts have many layouts.
TEMPLATE_ANYWAY = 500

_START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_SIGNS = re.compile("[>\"']")
#: Elements whose content is no text, whatever it holds.
_RAW = frozenset("script style noscript template textarea svg iframe object math".split())
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_NAME_PARTS = re.compile(r"[a-z]+|[0-9]+")
#: Elements without content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end a run of text.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An element of the key ends open ones of these kinds, up to the nearest of the ends.
_CLOSES = {
    **dict.fromkeys(_BLOCKS - {"body", "html"}, ({"p"}, {"table", "article", "section", "div", "td", "li"})),
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "option": ({"option"}, {"select"}),
}
#: Elements that never hold main text, and those that hold it inside an article only.
_NEVER = frozenset("head title nav footer aside form button select option input label dialog menu audio video canvas".split())
_IN_ARTICLE = frozenset(["header"])
#: Elements that mark the main text.
_ARTICLES = ("article", "main")
#: Parts of class names and ids of what isn't main text.
_NAMES = frozenset(
    "nav navbar navigation menu sidebar footer header masthead ad ads advert adverts advertisement sponsor sponsored promo "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup "
    "login share sharing social comment comments disqus respond replies related recommended recommendations breadcrumb "
    "breadcrumbs widget toolbar pagination pager skip search".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Elements whose subtrees are a text's own: repeated passages inside an article aren't a template.
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt b i em strong a span u s small sub sup code q cite mark font br".split())


class _Node:
    __slots__ = ("tag", "drop", "items", "article", "hash")

    def __init__(self, tag: str, drop: bool) -> None:
        self.tag, self.drop = tag, drop
        self.items: list[_Node | str] = []
        self.article = False
        self.hash = 0


def _unwanted(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _NEVER or (tag in _IN_ARTICLE and not in_article):
        return True
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return False
    if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attributes, re.I):
        return True
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id") and not _NAMES.isdisjoint(_NAME_PARTS.findall(value)):
            return not (in_article and tag in ("header", "h1", "h2"))
        if name == "role" and value in _ROLES or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


class _Ends:
    """Where tags end: at the first ``>`` outside quotes. All ends of a page are found in one pass."""

    def __init__(self, page: str) -> None:
        self.page, self.last = page, page.rfind(">")
        self.places = [m.start() for m in _SIGNS.finditer(page)]
        n = len(self.places)
        self.ends, following = [-1] * (n + 1), {}
        for k in reversed(range(n)):
            sign = page[self.places[k]]
            if sign == ">":
                self.ends[k] = self.places[k]
            elif sign in following:
                self.ends[k] = self.ends[following[sign] + 1]
            following[sign] = k

    def first(self, at: int) -> int:
        """The first ``>`` from ``at`` on, quoted or not; -1 if there is none."""
        return self.page.find(">", at) if at <= self.last else -1

    def after(self, at: int) -> int:
        """End of a tag whose name ends at ``at``; the first ``>`` if a quote is left open."""
        end = self.ends[bisect_left(self.places, at)]
        return end if end >= 0 else self.first(at)


def _tokens(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """``start, end, slash, name, attributes`` of tags, comments and the like; only tags have a name.

    Time is in proportion to the page, also where tags, quotes and comments are left open.
    """
    ends, at = _Ends(page), 0
    while found := _START.search(page, at):
        start, at = found.span()
        slash, name = found[1] or "", (found[2] or "").lower()
        if page.startswith("<!--", start):
            end = page.find("-->", at)
            end, name = (end + 3 if end >= 0 else len(page)), ""
        elif not name:
            if (end := ends.first(at)) < 0:
                continue
            end += 1
        elif name in _RAW and not slash:
            if (end := ends.first(at)) < 0:
                continue
            closed = _closing(name).search(page, end + 1)
            end, name = (closed.end() if closed else len(page)), ""
        else:
            if (end := ends.after(at)) < 0:
                continue
            end += 1
        yield start, end, slash, name, page[at : end - 1] if name else ""
        at = end


@cache
def _closing(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\s*>", re.I)


def parse(page: str) -> _Node:
    """Tree of a page; end tags that are missing, misplaced or cut off are made up for."""
    root = _Node("#root", False)
    stack, at = [root], 0
    open_tags: Counter[str] = Counter()

    def close(k: int) -> None:
        open_tags.subtract(n.tag for n in stack[k:])
        del stack[k:]

    for start, end, slash, tag, attributes in _tokens(page):
        if start > at:
            stack[-1].items.append(page[at:start])
        at = end
        if not tag:
            continue
        if slash:
            if open_tags[tag] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        kinds, until = _CLOSES.get(tag, ((), ()))
        if any(open_tags[kind] > 0 for kind in kinds):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in kinds:
                    close(k)
                elif stack[k].tag in until:
                    break
        node = _Node(tag, _unwanted(tag, attributes, open_tags["article"] > 0))
        stack[-1].items.append(node)
        if tag not in _VOID and not attributes.endswith("/"):
            stack.append(node)
            open_tags[tag] += 1
    if at < len(page):
        stack[-1].items.append(page[at:])
    return root


def _nodes(root: _Node) -> Iterator[_Node]:
    """The root and all below it, each before what it holds."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        waiting.extend(item for item in node.items if isinstance(item, _Node))


def _mark(root: _Node) -> None:
    """Fill in the hashes of subtrees, of their tags and text, and where articles are."""
    spelled: dict[int, str] = {}
    for node in reversed(list(_nodes(root))):
        parts = [node.tag]
        for item in node.items:
            if isinstance(item, str):
                words = item.split()
                if words:
                    parts.append(" ".join(words))
            else:
                parts.append(spelled.pop(id(item)))
                node.article |= item.article
        node.article |= node.tag in _ARTICLES
        node.hash = xxhash.xxh64_intdigest("\x00".join(parts)) - (1 << 63)
        spelled[id(node)] = f"{node.tag}\x01{node.hash}" if len(parts) > 1 else node.tag


def subtrees(page: str) -> set[int]:
    """Hashes of the subtrees that can be part of a template.

    Those are containers that neither hold an article nor lie in one: what copies of an article
    share is theirs and not the site's.
    """
    root = parse(page)
    _mark(root)
    found, waiting = set(), [item for item in root.items if isinstance(item, _Node)]
    while waiting:
        node = waiting.pop()
        if node.tag in _ARTICLES:
            continue
        if node.tag not in _TEXT and node.items and not node.article:
            found.add(node.hash)
        waiting.extend(item for item in node.items if isinstance(item, _Node))
    return found


def main_text(page: str | None, template: set[int] | None = None) -> str:
    """Blocks of the article, one a line, or of the whole body if no article is marked.

    A ``template`` is taken out of whole bodies only, and only if that leaves some text.
    """
    root = parse(page or "")
    blocks: list[str] = []

    def flush(run: list[str]) -> None:
        words = html.unescape("".join(run)).split()
        if words:
            blocks.append(" ".join(words))
        run.clear()

    def write(top: _Node, run: list[str]) -> None:
        waiting: list[_Node | str | None] = [top]  # nothing stands for the end of a block
        while waiting:
            node = waiting.pop()
            if node is None:
                flush(run)
            elif isinstance(node, str):
                run.append(node)
            elif not (node.drop or (template and node.hash in template)):
                if node.tag in _BLOCKS:
                    flush(run)
                    waiting.append(None)
                elif node.tag == "br":
                    run.append(" ")
                waiting.extend(reversed(node.items))

    def roots(node: _Node, tag: str) -> Iterator[_Node]:
        waiting = node.items[::-1]
        while waiting:
            item = waiting.pop()
            if isinstance(item, _Node) and not item.drop:
                if item.tag == tag:
                    yield item
                else:
                    waiting.extend(reversed(item.items))

    marked = [*roots(root, "article")] or [*roots(root, "main")]
    if template and not marked:
        _mark(root)
    else:
        template = None
    for top in marked or [root]:
        run: list[str] = []
        write(top, run)
        flush(run)
    if template and not blocks:
        return main_text(page)
    return "\n".join(blocks)


def host_of(url: str) -> Column:
    """Lower-case host of a URL column; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def template_subtrees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``row, hashes``: subtrees of each page that recur across its host; ``row`` hashes url and page.

    Pages without a host have no template. Copies of a page under one URL count once.
    """
    read = pages.select(
        host_of(url_col).alias("host"), F.xxhash64(url_col, html_col).alias("row"), F.col(html_col).alias("html")
    ).filter("html is not null and host <> ''")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(subtrees(p.as_py())) for p in batch.column("html")]
            columns = [batch.column("host"), batch.column("row"), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "row", "hashes"])

    parsed = saved(read.mapInArrow(hashes, "host string, row long, hashes array<long>"), "subtrees").distinct()
    each = parsed.select("host", "row", F.explode("hashes").alias("hash"))
    counts = each.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= TEMPLATE_PAGES)
    sizes = parsed.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    recurring = counts.join(sizes, "host").filter(
        F.col("n") >= F.least(TEMPLATE_SHARE * F.col("pages"), F.lit(TEMPLATE_ANYWAY))
    ).select("host", "hash")
    met = each.join(recurring, ["host", "hash"])
    return saved(met.groupBy("row").agg(F.collect_set("hash").alias("hashes")), "templates")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` without the html and with the main ``text``, empty if there is none.

    Character references are decoded, white space inside a block is one space, blocks are joined by
    line feeds in page order. A null page is empty. Repeated rows are kept. A column of ``pages``
    called like the result is replaced; an empty table gives an empty result.
    """
    if html_col != "text":
        pages = pages.drop("text")
    row, hashes, met = fresh(pages, "row"), fresh(pages, "hashes"), fresh(pages, "template_row")
    found = template_subtrees(pages, url_col, html_col).select(F.col("row").alias(met), F.col("hashes").alias(hashes))
    keyed = pages.withColumn(row, F.xxhash64(url_col, html_col))
    joined = keyed.join(found, same(keyed[row], found[met]), "left").drop(row, met)
    kept = [f for f in pages.schema.fields if f.name != html_col]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(html_col), batch.column(hashes))
            texts = [main_text(page.as_py(), set(bad.as_py() or ())) for page, bad in both]
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*(f.name for f in kept), "text"])

    return joined.mapInArrow(clean, T.StructType([*kept, T.StructField("text", T.StringType())]))
