"""Main text of web pages: site templates are removed by counting element subtrees.

Pass one hashes the element subtrees of every page; Spark counts, per host, the
pages that have each.  A subtree on at least ``SHARE`` of a host's pages (and
``MIN_PAGES``) belongs to the site's template.  Since an average page has few
subtrees, a host has at most ``1 / SHARE`` times that many template subtrees, so
the list that is joined to its pages is bounded.  Pass two deletes them, and what
is not part of an article by its element or class, and joins the blocks left.
Paragraphs, headings, list items and table cells are never counted by themselves: a
passage that many articles of a host share is text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import arrow_batches, by_bytes

#: A template subtree is on this share of its host's pages, and on so many pages, at least.
SHARE = 0.05
MIN_PAGES = 5

BATCH_BYTES = 4 << 20

# Fixed values of the HTML standard, and words by which page parts are commonly classed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
TEXT_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption tr".split())
CLOSES_P = BLOCK - frozenset("head html body li dd dt tr td th thead tbody tfoot caption option optgroup legend summary".split())
#: An opening tag that ends open elements of these kinds, up to the nearest one of the bounds.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, {"html"}),
}
#: Elements that are no template, however often they recur.
UNCOUNTED = TEXT_BLOCK | frozenset("html body head article main".split())
DROP_TAGS = frozenset(
    "head nav aside footer form menu dialog script style noscript template iframe svg canvas object embed button select textarea "
    "input label audio video map noembed noframes title".split())
#: Within an article only classes that are one of these words as a whole mark a part
#: that is no text; ids there are slugs of headings as a rule.
INNER_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation breadcrumb breadcrumbs "
    "sidebar cookie cookies gdpr popup modal newsletter subscribe social share sharing related recommended comments commentlist disqus "
    "toolbar pagination pager".split())
#: On a page without an article, classes and ids that are one of these as a whole, by itself or
#: with a word of place or shape before or behind it, mark such a part.
PAGE_WORDS = INNER_CLASSES | frozenset(
    "menu banner header footer masthead topbar notice notices consent overlay login signup widget respond".split())
_PLACE = "site|page|main|top|bottom|left|right|global|primary|secondary|mobile|user|web"
_SHAPE = "bar|box|wrapper|wrap|container|block|list|menu|area|links|link|inner|outer|content|form|top|bottom|left|right"
_WORD = f"(?:{'|'.join(sorted(PAGE_WORDS, key=len, reverse=True))})"
_PAGE_PART = re.compile(rf"(?:(?:{_PLACE})[-_]?)?{_WORD}(?:[-_]{_WORD})*(?:[-_]?(?:{_SHAPE}))?")
#: Elements of running text; within an article, only advertisements among them go by class.
RUNNING = TEXT_BLOCK | frozenset(["section"])
ADVERT_CLASSES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored share comments commentlist disqus".split())
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z))", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PART = re.compile(r"[a-z0-9]+")
_COMMENT_ID = re.compile(r"(?:div-)?(?:comment|reply)[-_]?\d+")


class Element:
    __slots__ = ("tag", "raw", "children", "hash", "_attrs")

    def __init__(self, tag: str, raw: str = ""):
        self.tag, self.raw, self.children, self.hash, self._attrs = tag, raw, [], 0, None

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            self._attrs = {}
            if self.raw:
                for k, v in _ATTR.findall(self.raw):
                    self._attrs.setdefault(k.lower(), unescape(v[1:-1] if v[:1] in "\"'" else v) if v else "")
        return self._attrs

    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").lower().split())

    def is_comment(self) -> bool:
        """Whether an article is a reader's comment: by words of its class, or a numbered id; other ids are slugs."""
        return (bool(COMMENT_WORDS & set(_PART.findall(self.attrs.get("class", "").lower())))
                or _COMMENT_ID.fullmatch(self.attrs.get("id", "").lower()) is not None)

    def page_part(self) -> bool:
        """Whether class or id name a part of a page that is no text."""
        return any(_PAGE_PART.fullmatch(w) for w in [*self.classes(), self.attrs.get("id", "").lower()])


def parse(html: str) -> Element:
    """The element tree of a page; broken markup is closed as browsers do in the common cases."""
    root = Element("#root")
    stack = [root]
    at, n = 0, len(html)

    def text(s: str) -> None:
        if s:
            stack[-1].children.append(s)

    def close(kinds, bounds) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in bounds:
                return
            if stack[i].tag in kinds:
                del stack[i:]
                return

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        m = _TAG.match(html, lt)
        if m is None:  # a lone "<" is text
            text(html[at:lt + 1])
            at = lt + 1
            continue
        text(html[at:lt])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                # An end tag of an inline element does not end a block around it.
                if stack[i].tag in BLOCK and tag not in BLOCK:
                    break
            continue
        if tag in CLOSES_P:
            close({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "table", "button", "body"})
        if tag in IMPLIED_END:
            close(*IMPLIED_END[tag])
        raw = m[3]
        element = Element(tag, raw.strip())
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            element.children.append(html[at:end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID and not raw.endswith("/"):
            stack.append(element)
    return root


def subtree_hashes(root: Element) -> set[int]:
    """Hash every element by tag, class, id, text and children; return those that are counted.

    Counted are block elements but those of running text (divisions, lists, asides).
    """
    counted: set[int] = set()
    # Depth first without recursion: pages may nest without bound.
    todo: list[tuple[Element, bool]] = [(root, False)]
    while todo:
        e, done = todo.pop()
        if not done:
            todo.append((e, True))
            if e.tag not in RAW:
                todo += [(c, False) for c in e.children if isinstance(c, Element)]
            continue
        a = e.attrs
        h = xxhash.xxh64(f"{e.tag}|{a.get('class', '')}|{a.get('id', '')}")
        for c in e.children:
            h.update(c.hash.to_bytes(8, "little") if isinstance(c, Element) else " ".join(c.split()))
            h.update(b"|")
        e.hash = h.intdigest()
        if e.tag in BLOCK and e.tag not in UNCOUNTED:
            counted.add(e.hash - (1 << 63))
    return counted


def _dropped(e: Element, inside: bool) -> bool:
    if e.tag in DROP_TAGS or e.tag == "header" and not inside:
        return True
    if not e.raw or e.tag in ("html", "body"):
        return False
    a = e.attrs
    if e.tag in ("article", "main"):
        return e.is_comment()
    named = e.classes() & (ADVERT_CLASSES if e.tag in RUNNING else INNER_CLASSES)
    return (bool(named) or not inside and e.page_part() or a.get("role", "").lower() in DROP_ROLES
            or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
            or "display:none" in a.get("style", "").replace(" ", "").lower())


def _main_parts(root: Element) -> list[Element]:
    """The outermost articles and main elements; without one the page.

    What stands in a menu, sidebar or footer is none: such an element, or one whose class as a
    whole says so, is not searched.  A main element holds its articles and what is around them.
    """
    found, todo = [], [root]
    while todo:
        e = todo.pop()
        if e.tag in ("article", "main") and not e.is_comment():
            found.append(e)
        elif e is root or e.tag not in RAW and not _dropped(e, True):
            todo += [c for c in reversed(e.children) if isinstance(c, Element)]
    return found or [root]


def main_text(html: str, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The text of a page without its template subtrees and its parts that are no article."""
    root = parse(html)
    subtree_hashes(root)
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        block = " ".join(unescape("".join(parts)).split())
        if block:
            blocks.append(block)
        parts.clear()

    for top in _main_parts(root):
        inside = top.tag != "#root"
        todo: list[object] = [top]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                parts.append(x)
            elif x.tag == "br":
                parts.append(" ")
            elif not _dropped(x, inside) and not (x is not top and _is_template(x, templates)):
                if x.tag in BLOCK:
                    flush()
                    todo.append(None)
                todo += reversed(x.children)
        flush()
    return " ".join(blocks)


def _is_template(e: Element, templates) -> bool:
    return e.hash - (1 << 63) in templates and e.tag not in UNCOUNTED


def host_of(url):
    """Lower-case host of a URL column; empty where there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))


def site_templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, templates): the hashes of the subtrees that recur across many pages of the host."""
    arrow_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            hosts, hashes = [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = subtree_hashes(parse(html or ""))
                hosts += [host] * len(found)
                hashes += found
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64())], names=["host", "hash"])

    host = host_of(F.col(url_col)).alias("host")
    seen = pages.select(host, F.col(html_col).alias("html")).mapInArrow(run, "host string, hash long")
    counts = seen.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    sizes = pages.groupBy(host).agg(F.count(F.lit(1)).alias("n_pages"))  # reads the URLs alone
    often = counts.where(F.col("n") >= MIN_PAGES).join(sizes, "host")
    return often.where(F.col("n") >= SHARE * F.col("n_pages")).groupBy("host").agg(F.collect_list("hash").alias("templates"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text (empty if none) and n_chars (code points).

    Null html counts as empty; pages without a host share the host ""; null ids,
    null urls and repeated rows stay; other columns are ignored; an empty table
    gives no rows.
    """
    from reportlake.session import stage

    arrow_batches(pages.sparkSession)
    templates = stage(site_templates(pages, url_col, html_col), "templates")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host_of(F.col(url_col)).alias("host"))
    rows = rows.join(templates, "host", "left").select("id", "url", "html", "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2, BATCH_BYTES):
            texts = [main_text(html or "", frozenset(t or ()))
                     for html, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)[id_col]
    return rows.mapInArrow(run, f"id {kind}, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
