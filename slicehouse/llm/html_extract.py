"""Main text of web pages with a site style tree.

All pages of a host are merged into one tree: a node is a path of elements with their classes, as it occurs in
pages. A node knows in how many pages it occurs and how its presentation (its sequence of children) and its content (the text
below it) vary over them, as entropies between 0 (the same everywhere) and 1 (different everywhere). The larger one is its
importance. A node in several pages with low importance belongs to the site and not to a page, and is cut off: anywhere in pages
without an article, and within the article in all others. Within articles each different article counts as one page, however
many pages of the host hold a copy of it.

Elements that say what they are (menus, footers, forms and the like, by element, role, class or id) go, too, and
elements that say they are the article bound what is taken.
"""

from __future__ import annotations

import functools
import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicehouse.llm.common import discard, persisted, quoted, read_table, small_batches

IMPORTANCE = 0.3
#: Different pages of a host that must have a branch before it is cut.
LEAST_PAGES = 3

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: The rest of a tag, in which quoted values may hold any sign. Nothing is given back, so a tag is read once.
_REST = re.compile(r"(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+")
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: So many times the page's length may be read in vain for the ends of tags; from then on a tag ends at the next ``>``, whatever is quoted.
_VAIN = 8
#: One attribute after the other, so that nothing is looked for within values.
_ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
SELF_NESTED = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
NOISE = frozenset(
    "head nav footer aside form script style noscript template iframe object svg canvas select button input textarea menu dialog audio video".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
#: Words of classes and ids that name what is not the article.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted promotion related reply replies respond share sharing sidebar sidebars skip social sponsor "
    "sponsored subscribe toolbar widget widgets".split()
)
#: Words that go with these in one name, as in ``ad-slot`` or ``comment-list``, and make no other thing of it.
PARTS = frozenset(
    "area article bar block body box button buttons container content controls entry form group header icons inner item items left link links list main "
    "module nav outer page panel post posts right section signup site slot top unit widget wrap wrapper zone".split()
)
#: Names of short previews of other pages, which count where there is an article without such a name.
TEASERS = frozenset("card cards excerpt preview teaser teasers tile tiles".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks the tree may cut within an article. Headings, items and cells are parts of what holds them: they go with it or stay.
CUT_WITHIN = BLOCK - HEADINGS - frozenset("body caption dd dt figcaption hr html li tbody td tfoot th thead tr".split())
#: Ids that name readers' remarks, whatever heading they have.
REMARKS = frozenset("comment comments commentlist disqus replies reply respond".split())
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "words", "classes", "ids", "role", "hidden", "open", "children", "path")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.words, self.role, self.hidden, self.children = tag, (), "", False, []
        self.classes, self.ids, self.open = (), (), False
        for name, *values in _ATTR.findall(attrs) if attrs and attrs != "/" else ():
            value, name = "".join(values).lower(), name.lower()
            if name == "role":
                self.role = value
            elif name == "hidden" or name == "aria-hidden":
                self.hidden = self.hidden or (name == "hidden" or value == "true")
            elif name == "class" or name == "id":
                self.words += tuple(_WORD.findall(value))
                if name == "class":
                    self.classes += tuple(value.split())
                else:
                    self.ids += tuple(value.split())
        self.path = 0

    def says_noise(self, in_article: bool, wraps: bool = False) -> bool:
        """``wraps`` tells that an article lies below: a name of several words then says what else the element has, not what it is."""
        if (self.tag in NOISE and not self.open) or self.hidden or self.role in NOISE_ROLES:
            return True
        if self.tag == "header" and not in_article:
            return True
        if self.tag in ("html", "body", "main"):
            return False
        if not in_article:
            return any(_names_noise(name) and not (wraps and len(_WORD.findall(name)) > 1) for name in self.classes + self.ids)
        # Ids of headings and sections are often made of their titles.
        if self.tag in HEADINGS:
            return False
        kinds = {child.tag for child in self.children if isinstance(child, Node)} if self.tag == "section" else set()
        titled = "p" in kinds and not HEADINGS.isdisjoint(kinds) and REMARKS.isdisjoint(self.ids)
        return any(map(_names_noise, self.classes)) or (not titled and any(_names_noise(name) for name in self.ids))


@functools.lru_cache(1 << 14)
def _names_noise(name: str) -> bool:
    """Whether a class or id is the name of something beside the article: a word of ``NOISE_WORDS``, alone or with words of ``PARTS``."""
    words = _WORD.findall(name)
    return not NOISE_WORDS.isdisjoint(words) and all(word in NOISE_WORDS or word in PARTS for word in words)


def tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of each tag; comments, declarations and what belongs to no tree have no name. Linear in the page."""
    at, last, vain = 0, page.rfind(">"), _VAIN * len(page)
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            yield start, (at := len(page) if end < 0 else end + 3), "", False, ""
            continue
        closing = page.startswith("/", at)
        name = _NAME.match(page, at + closing)
        if not name:
            if page[at : at + 1] in ("!", "?", "/"):
                end = page.find(">", at)
                yield start, (at := len(page) if end < 0 else end + 1), "", False, ""
            continue
        if start > last:
            return  # no tag ends any more
        end = _REST.match(page, name.end()).end()
        if page[end : end + 1] != ">":
            vain -= end - start
            if vain > 0:
                continue
            end = page.find(">", name.end())
        own, attributes, at = name.group().lower(), page[name.end() : end], end + 1
        if own in _RAW and not closing:
            ends = _closing(own).search(page, at)
            yield start, (at := ends.end() if ends else len(page)), "", False, ""
        else:
            yield start, at, own, closing, attributes


@functools.cache
def _closing(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\s*>", re.I)


class _Open:
    """The elements that are open, and where the last one of each name stands."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.stack))
        self.stack.append(node)

    def last(self, names) -> int:
        depth = 0
        for name in names:
            if (found := self.places.get(name)) and found[-1] > depth:
                depth = found[-1]
        return depth

    def close(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.places[node.tag].pop()
        del self.stack[depth:]


def parse(page: str | None) -> Node:
    """The tree of a page; texts are strings among the children. Any text is a page: what is left open ends with its parent."""
    root, text, at = Node(""), page or "", 0
    open_ = _Open(root)
    for start, end, tag, closing, attributes in tokens(text):
        if start > at:
            open_.stack[-1].children.append(html.unescape(text[at:start]))
        at = end
        if not tag:
            continue
        if closing:
            if depth := open_.last((tag,)):
                open_.close(depth)
            continue
        if tag in CLOSES_P:
            _close(open_, {"p"}, {"td", "th", "button", "caption", "object"})
        if tag in SELF_NESTED:
            same = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
            _close(open_, same, SELF_NESTED[tag])
        node = Node(tag, attributes)
        open_.stack[-1].children.append(node)
        # A slash does not end an element that makes a block.
        if tag not in VOID and (tag in BLOCK or not attributes.endswith("/")):
            open_.push(node)
    if at < len(text):
        open_.stack[-1].children.append(html.unescape(text[at:]))
    if any(node.tag == "form" for node in _elements(root)):
        _open_forms(root)
    return root


def _elements(root: Node) -> list[Node]:
    """All elements, parents first."""
    order = [root]
    for node in order:
        order.extend(child for child in node.children if isinstance(child, Node))
    return order


def _open_forms(root: Node) -> None:
    """Forms around an article, or around half of the page's text or more, count as plain elements."""
    order = _elements(root)
    for node in order:
        node.open = node.tag == "form"
    size: dict[int, int] = {}
    bounds: dict[int, bool] = {}
    for node in reversed(order):
        below = [child for child in node.children if isinstance(child, Node)]
        noise = node.says_noise(False)
        own = sum(len(child.strip()) for child in node.children if isinstance(child, str))
        size[id(node)] = 0 if noise else own + sum(size[id(child)] for child in below)
        bounds[id(node)] = not noise and (node.tag in ("article", "main") or "articlebody" in node.words or any(bounds[id(child)] for child in below))
    for node in order:
        if node.tag == "form":
            node.open = bounds[id(node)] or 0 < size[id(root)] <= 2 * size[id(node)]


def _close(open_: _Open, tags: set[str], stops: set[str]) -> None:
    depth = open_.last(tags)
    if depth and depth > open_.last(stops):
        open_.close(depth)


def set_paths(root: Node) -> list[Node]:
    """Number every element by its path from the root; all elements, parents first."""
    order, root.path = [root], 0
    for node in order:
        for child in node.children:
            if isinstance(child, Node):
                label = f"{node.path} {child.tag} {' '.join(child.words)}"
                child.path = xxhash.xxh3_64_intdigest(label.encode()) >> 1
                order.append(child)
    return order


def style_features(page: str | None) -> list[tuple[int, int, int, int, bool]]:
    """(path, presentation, content, subject, open to a cut) for each path of a page; elements with the same path count as one.

    Presentation and content are hashes. The subject is what counts as one page: for paths within articles a hash of the
    articles' own text, so that copies of them are told from texts that a site repeats; for all others 0, the page itself.
    """
    root = parse(page)
    order = set_paths(root)
    bodies = _articles(root, False)
    inner = {id(node) for body in bodies for node in _elements(body)}
    subject = _hash("\x1e".join(_own_text(body) for body in bodies)) | 1
    texts: dict[int, str] = {}
    found: dict[tuple[int, bool], tuple[int, int]] = {}
    fit: set[int] = set()
    for node in reversed(order):
        parts = [_SPACE.sub(" ", child) if isinstance(child, str) else texts[id(child)] for child in node.children]
        texts[id(node)] = str(xxhash.xxh3_64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass"))) if any(parts) else ""
        kinds = dict.fromkeys(f"{child.tag} {' '.join(child.words)}" for child in node.children if isinstance(child, Node))
        style = xxhash.xxh3_64_intdigest("\x1f".join(kinds).encode())
        content = xxhash.xxh3_64_intdigest(texts[id(node)].encode())
        key = node.path, id(node) in inner
        if texts[id(node)] and (node.tag in CUT_WITHIN if key[1] else not bodies):
            fit.add(node.path)
        old = found.get(key, (0, 0))
        found[key] = ((old[0] * 31 + style) & _63, (old[1] * 31 + content) & _63)
    return [(path, style, content, subject if within else 0, path in fit) for (path, within), (style, content) in found.items()]


def _own_text(body: Node) -> str:
    """The text of an article without elements that say they are none of it."""
    parts, work = [], [body]
    while work:
        item = work.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item is body or not item.says_noise(True):
            work.extend(reversed(item.children))
    return _SPACE.sub(" ", " ".join(parts))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


_63 = (1 << 63) - 1


def main_text(page: str | None, low: frozenset[int] = frozenset()) -> str:
    """The page's text without elements that say they are not the article and without branches of low importance."""
    root = parse(page)
    set_paths(root)
    bodies = _articles(root, False)
    within = bool(bodies)
    cut = _cut(bodies or [root], low, within) if low else set()
    blocks: list[list[str]] = [[]]
    for body in bodies or [root]:
        # Walk without recursion: pages may be nested deeply.
        work: list = [body]
        while work:
            item = work.pop()
            if item is None:
                blocks.append([])
            elif isinstance(item, str):
                blocks[-1].append(item)
            elif item.tag == "br":
                blocks[-1].append(" ")
            elif id(item) in cut:
                # What stands before and behind a block stays apart.
                blocks.extend([[]] if item.tag in BLOCK else [])
            elif item.says_noise(within):
                continue
            else:
                parts = list(reversed(item.children))
                work.extend([None, *parts, None] if item.tag in BLOCK or item is body else parts)
    lines = (_SPACE.sub(" ", "".join(parts)).strip() for parts in blocks)
    return "\n".join(line for line in lines if line)


def _cut(roots: list[Node], low: frozenset[int], within: bool) -> set[int]:
    """The elements below (and, of several, among) these to cut in page order: never html or body, nor what holds all the text that is left."""
    size: dict[int, int] = {}
    for node in reversed([node for root in roots for node in _elements(root)]):
        own = sum(len(child.strip()) for child in node.children if isinstance(child, str))
        below = sum(size[id(child)] for child in node.children if isinstance(child, Node))
        size[id(node)] = 0 if node.says_noise(within) else own + below
    left, cut, work = sum(size[id(root)] for root in roots), set(), list(reversed(roots))
    while work:
        node = work.pop()
        fit = node.tag in CUT_WITHIN if within else node.tag not in ("", "html", "body")
        if node.path in low and fit and 0 < size[id(node)] < left:
            left -= size[id(node)]
            cut.add(id(node))
        elif not node.says_noise(within):
            work.extend(child for child in reversed(node.children) if isinstance(child, Node))
    return cut


def _articles(root: Node, within: bool) -> list[Node]:
    """The outermost articles outside noise, or else the main elements; previews of other pages only if there is nothing else."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    wraps: dict[int, bool] = {}
    for node in reversed(_elements(root)):
        below = [child for child in node.children if isinstance(child, Node)]
        wraps[id(node)] = any(child.tag in ("article", "main") or wraps[id(child)] for child in below)
    work: list[tuple[Node, bool]] = [(root, False)]
    while work:
        node, in_main = work.pop()
        if node.tag == "article" or "articlebody" in node.words:
            found["article"].append(node)
            continue
        is_main = node.tag == "main" or node.role == "main"
        if is_main and not in_main:
            found["main"].append(node)
        for child in reversed(node.children):
            if isinstance(child, Node) and not child.says_noise(False, wraps[id(child)]):
                work.append((child, in_main or is_main))
    whole = [node for node in found["article"] if TEASERS.isdisjoint(word for name in node.classes for word in _WORD.findall(name))]
    return whole or found["article"] or found["main"]


def page_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def node_importance(pages: DataFrame) -> DataFrame:
    """The site style trees of pages (host, html): host, path, n_pages (with the path; copies of an article once within it), importance."""
    return _importance(page_paths(pages.select("host", F.monotonically_increasing_id().cast("string").alias("digest"), "html")))


def page_paths(pages: DataFrame) -> DataFrame:
    """``style_features`` of pages (host, digest, html) with their host and digest, from one reading of each page."""

    def features(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, 256):
            rows = [
                (host, digest, path, style, content, subject or _hash(digest) & ~1, open_)
                for host, digest, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
                for path, style, content, subject, open_ in style_features(page.as_py())
            ]
            if rows:
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["host", "digest", "path", "style", "content", "subject", "open"])

    kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.bool_()]
    form = "host string, digest string, path bigint, style bigint, content bigint, subject bigint, open boolean"
    return pages.select("host", "digest", "html").mapInArrow(features, form)


def _importance(paths: DataFrame) -> DataFrame:
    once = paths.select("host", "path", "style", "content", "subject").distinct()
    rows = once.select("host", "path", F.posexplode(F.array("style", "content")).alias("kind", "value"))
    counts = rows.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"))
    sums = counts.groupBy("host", "path", "kind").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("nlogn"))
    # Minus the sum of p log p, with logarithms to the base m.
    entropy = F.when(F.col("m") > 1, F.greatest(F.lit(0.0), 1 - F.col("nlogn") / (F.col("m") * F.log(F.col("m").cast("double"))))).otherwise(1.0)
    return sums.groupBy("host", "path").agg(F.max("m").alias("n_pages"), F.max(entropy).alias("importance"))


def _different(rows: DataFrame) -> DataFrame:
    """Each different html of a host once; only repeated ones are shuffled."""
    marked = rows.select("host", "html", _digest().alias("digest"))
    often = persisted(marked.groupBy("host", "digest").count().filter("count > 1").select("host", "digest"))
    once = marked.join(often, ["host", "digest"], "left_anti")
    repeated = marked.join(often, ["host", "digest"], "left_semi").dropDuplicates(["host", "digest"])
    return once.select("host", "html", "digest").union(repeated.select("host", "html", "digest"))


def _digest() -> Column:
    return F.sha2(F.coalesce("html", F.lit("")), 256)


def extract_text(
    pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html", least: float = IMPORTANCE
) -> DataFrame:
    """One row (page_id, url, text) per page: its blocks in page order, one per line, with white space made single.

    Equal pages of a host count once in the tree, and equal articles of a host once within articles. A node is cut if at least
    ``LEAST_PAGES`` different pages (within articles: articles) have it, however large the host is, and its importance is below
    ``least``. Null html is empty and gives an empty text; pages without a host form one site. Repeated pages are repeated in the result.
    """
    rows = pages.select(quoted(id).alias("page_id"), quoted(url).alias("url"), quoted(page).alias("html"), page_host(quoted(url)).alias("host"))
    # Written, so that pages are read once for the trees and for their lists.
    paths = persisted(page_paths(_different(rows)))
    low = _importance(paths).filter((F.col("importance") < least) & (F.col("n_pages") >= LEAST_PAGES)).select("host", "path")
    # Lists are made per page and only where the tree decides, so none grows with its host. Written, so that Spark knows the size and
    # sends small lists to the pages. A hot host's paths are split by adaptive execution, as ``low`` has one row for each.
    lists = persisted(paths.filter("open").join(low, ["host", "path"]).groupBy("host", "digest").agg(F.collect_list("path").alias("low")))
    discard(paths)

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, 256):
            texts = [main_text(value.as_py(), frozenset(low.as_py() or ())) for value, low in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    joined = rows.withColumn("digest", _digest()).join(lists, ["host", "digest"], "left").select("page_id", "url", "html", "low")
    return joined.mapInArrow(work, f"page_id {rows.dtypes[0][1]}, url {rows.dtypes[1][1]}, text string")


def op5_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(read_table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


QUERIES = {"op5_extract": op5_extract}
ORACLES: dict[str, str] = {}
