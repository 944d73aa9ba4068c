"""Main text of web pages by a site style tree.

The DOMs of a host are merged: elements with the same path of tags, classes,
ids and places are one node of the host's style tree.  A node has

* presentation importance: the entropy of its child layouts over the host's
  pages (a menu looks the same everywhere, an article never does).  Elements whose
  tag, role, class or id says what they are get a fixed value instead: 0 for
  menus, headers, footers, sidebars, notices, adverts, forms and comments, 1 for the
  page's article; what lies inside inherits it, and in a page with an article the rest has 0.
  A class, id or form does not hold over the article or main element inside it, nor over
  most of the page's text where that is its own on every page (see ``_ranks``);
* content importance: one minus the mean entropy of its text blocks over the
  pages that have the node (a block on every page scores 0, a unique one 1).

Inside the article, what the marks say is a prior only: an unmarked branch that stands on most of the host's pages
with this article and is of low importance there (a share strip, a "read more" box) goes, where the articles themselves differ
from page to page.  A branch on few of them, such as a passage that some articles quote, stays.

A branch whose weighted importance is low is removed from the page; what is left is
the main text.  If nothing were left, only the branches marked by tag, role,
class or id go.

Scale: pages are parsed once into a written table of blocks; the tree is two
map-side-combined aggregates over hashed (host, path) keys, exact copies of a page
counting once; its one row per node goes back to the pages by broadcast when
it is small, else by a join.  No host is collected.

Defined results: null html and pages without text give an empty text; a null or
unreadable url is a host of its own kind (""); repeated rows each give a row; an
empty table gives an empty result; extra columns are kept, but for one named like
the output, which the text replaces.  Very long pages are parsed in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warnindex.llm.common import arrow_rows, written
from warnindex.session import fits

BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
CONTAINER = BLOCK - frozenset("p pre li dd dt tr h1 h2 h3 h4 h5 h6 hr caption summary figcaption tbody thead tfoot html body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style noscript template svg math iframe object audio video canvas textarea select button option datalist head title map".split())
NOISE_TAGS = frozenset("nav footer aside form menu dialog search".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promos promotion banner nav navbar navigation "
    "menu menus menubar breadcrumb breadcrumbs sidebar sidebars rail footer foot cookie cookies consent gdpr notice notices popup modal overlay "
    "alert alerts newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments "
    "commentlist disqus reply replies respond widget widgets toolbar pagination pager copyright disclaimer paywall".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
# parts of names that say how a page is laid out, not what the element is: has-sidebar, nav-open
STATE_WORDS = frozenset("has with no without is open opened closed enabled disabled active collapsed expanded".split())
ARTICLE_NAMES = frozenset(
    "article articlebody article-body article-content article-text article-main main-article news-article entry-content "
    "post-content post-body post-text blog-post story-body story-content".split())
MAIN_NAMES = frozenset("main content main-content maincontent content-main content-body page-content page-body body-content post entry story".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"[0-9]+")
_CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*\Z")  # a page that ends inside a tag
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _weak(own: int, named: bool) -> int:
    """Rank of noise by name or form: ``own``, what the element is but for that, and whether
    a name says that it is noise (else it is a form or has names of state only)."""
    return -(1 + own + 3 * named)


@dataclass
class _Element:
    tag: str
    path: str
    node: int  # index of the nearest container's node, -1: none
    skip: bool
    kids: dict
    header: bool = False


class PageTree(HTMLParser):
    """Blocks of one page and the containers they lie in.

    ``nodes``: (path, parent node, rank) with rank 0 noise, 1 main, 2 article, None
    unmarked, below 0 noise by name or form only (see ``_weak``); ``layout``: child tags in order, runs of one tag as one.
    ``blocks``: (text, node)."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.nodes: list[tuple[str, int, int | None]] = []
        self.layout: list[list[str]] = []
        self.blocks: list[tuple[str, int]] = []
        self.stack = [_Element("", "", -1, False, {})]
        self.data: list[str] = []
        self.feed(_CUT_TAG.sub("", html or ""))
        self.close()
        self._flush()

    def _flush(self) -> None:
        if self.data:
            text = " ".join("".join(self.data).split())
            self.data = []
            if text:
                self.blocks.append((text, self.stack[-1].node))

    @staticmethod
    def _rank(tag: str, attrs: dict, inside: bool) -> int | None:
        if tag in ("html", "body"):
            return None
        role = (attrs.get("role") or "").lower()
        names = ((attrs.get("class") or "") + " " + (attrs.get("id") or "")).replace("_", "-").split()
        words = {w for n in names for w in _SPLIT.split(_CAMEL.sub("-", n).lower())}
        if tag in NOISE_TAGS - {"form"} or role in NOISE_ROLES - {"form"} or "hidden" in attrs or _HIDDEN.search(attrs.get("style") or ""):
            return 0
        if not inside and tag == "header":
            return 0
        plain = {n.lower() for n in names}
        own = None
        if tag == "article" or role == "article" or (attrs.get("itemprop") or "").lower() == "articlebody" or plain & ARTICLE_NAMES:
            own = 2
        elif tag == "main" or role == "main" or plain & MAIN_NAMES:
            own = 1
        noisy = NOISE_WORDS if inside else NOISE_WORDS | HEADER_WORDS
        if words & noisy:
            parts = [set(_SPLIT.split(_CAMEL.sub("-", n).lower())) for n in names]
            return _weak(own or 0, any(w & noisy and not w & STATE_WORDS for w in parts))
        return _weak(own or 0, False) if tag == "form" or role == "form" else own

    def _marked(self, node: int) -> int | None:
        while node >= 0:
            if self.nodes[node][2] is not None:
                return self.nodes[node][2]
            node = self.nodes[node][1]
        return None

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.data.append(" ")
        if tag in ("td", "th"):
            self.data.append(" ")
        if tag in BLOCK:
            self._flush()
            self._close({"p"}, set())
        if tag in CLOSES:
            self._close(CLOSES[tag], SCOPE[tag])
        if tag == "body":
            self._close({"head"}, set())
        if tag in VOID:
            return
        top = self.stack[-1]
        attrs = dict(attrs)
        inside = (self._marked(top.node) or 0) > 0
        rank = self._rank(tag, attrs, inside)
        skip = top.skip or tag in SKIP
        node, path = top.node, top.path
        if tag in CONTAINER or (rank is not None and tag in BLOCK):
            names = " ".join(sorted((attrs.get("class") or "").lower().split()) + ["#" + (attrs.get("id") or "").lower()])
            name = _DIGITS.sub("0", f"{tag}.{names}")
            place = top.kids.get(name, 0)
            top.kids[name] = place + 1
            path = f"{top.path}>{name}[{place}]"
            self.nodes.append((path, top.node, rank))
            self.layout.append([])
            node = len(self.nodes) - 1
        elif rank is not None and rank <= 0:
            skip = True  # a marked inline element: its text goes, the block around it stays
        if top.node >= 0 and tag in BLOCK and (not self.layout[top.node] or self.layout[top.node][-1] != tag):
            self.layout[top.node].append(tag)
        self.stack.append(_Element(tag, path, node, skip, {}))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, tags: set, scope: set) -> None:
        """Pop to the innermost open element of ``tags``, if none of ``scope`` or a container lies between."""
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t in tags:
                self._flush()
                del self.stack[i:]
                return
            if t in scope or (t in CONTAINER and t not in tags):
                return

    def handle_endtag(self, tag):
        if tag == "br":
            self.data.append(" ")
            return
        if tag in BLOCK:
            self._flush()
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t == tag:
                if any(e.tag in BLOCK for e in self.stack[i:]):
                    self._flush()
                del self.stack[i:]
                return
            if tag not in BLOCK and t in BLOCK:
                return  # a stray inline end tag closes no block

    def handle_data(self, data):
        if not self.stack[-1].skip:
            self.data.append(data)

    def unknown_decl(self, data):
        pass


@dataclass(frozen=True)
class SiteParams:
    threshold: float = 0.4
    marked_weight: float = 0.7  # of the presentation of marked branches
    free_weight: float = 0.3  # of that of unmarked ones
    min_pages: int = 3  # for unmarked branches to be judged
    wrapper_share: float = 0.8  # of the page's text in a branch that is no noise, whatever its name
    wrapper_content: float = 0.5  # and its content importance; also an article's, for branches in it to be judged
    strip_share: float = 0.5  # of the host's pages with the article, for an unmarked branch in it to be judged
    nodes_to_broadcast: int = 50_000


def _key(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}\n{path}".encode("utf-8", "surrogatepass")) - (1 << 63)


def _digest(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


_NODES = pa.list_(pa.struct([("key", pa.int64()), ("parent", pa.int32()), ("rank", pa.int32()), ("layout", pa.int64())]))
_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("hash", pa.int64()), ("node", pa.int32())]))
_TREE = {"page_key": "bigint", "digest": "bigint", "nodes": "array<struct<key:bigint,parent:int,rank:int,layout:bigint>>",
         "blocks": "array<struct<text:string,hash:bigint,node:int>>"}


def parse_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page`` (a struct of its columns but the html), page_key, and its parsed
    tree: digest of host and html, nodes, blocks."""
    rest = [c for c in pages.columns if c != html_col]
    held = pages.select(F.struct(F.lit(0).alias("_"), *rest).alias("page"), F.monotonically_increasing_id().alias("page_key"),
                        F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            digests, nodes, blocks = [], [], []
            for url, html in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                host, t = host_of(url), PageTree(html)
                digests.append(_digest(f"{host}\n{html or ''}"))
                nodes.append([{"key": _key(host, p), "parent": up, "rank": r, "layout": _digest(" ".join(lay))}
                              for (p, up, r), lay in zip(t.nodes, t.layout)])
                blocks.append([{"text": x, "hash": _digest(x), "node": n} for x, n in t.blocks])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(digests, pa.int64()), pa.array(nodes, _NODES), pa.array(blocks, _BLOCKS)], names=["page", *_TREE])

    schema = T.StructType([held.schema["page"], *T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in _TREE.items())).fields])
    return held.mapInArrow(go, schema)


def style_tree(trees: DataFrame) -> DataFrame:
    """One row per (host, path) key: pages, presentation and content importance."""
    looks = trees.select("digest", F.explode("nodes").alias("n")).select("digest", "n.key", "n.layout").distinct()
    looks = looks.groupBy("key", "layout").agg(F.count("*").alias("n"))
    # -sum(p * log_m(p)) with p = n / m, from two sums
    shape = looks.groupBy("key").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    shape = shape.select("key", "pages", F.when(F.col("pages") > 1, 1 - F.col("nlogn") / (F.col("pages") * F.log("pages"))).otherwise(1.0).alias("presentation"))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(digest, key, hash) of every block for every node it lies in, once a page."""
        for b in batches:
            out = set()
            for digest, nodes, blocks in zip(*(b.column(i).to_pylist() for i in range(3))):
                for x in blocks:
                    n = x["node"]
                    while n >= 0:
                        out.add((digest, nodes[n]["key"], x["hash"]))
                        n = nodes[n]["parent"]
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["digest", "key", "hash"])

    slim = trees.select("digest", "nodes", F.transform("blocks", lambda x: F.struct(x["hash"].alias("hash"), x["node"].alias("node"))).alias("blocks"))
    seen = slim.mapInArrow(held, "digest long, key long, hash long").distinct().groupBy("key", "hash").agg(F.count("*").alias("c"))
    # mean over block occurrences of 1 - log_m(c), c the pages that hold the block, from two sums
    sums = seen.groupBy("key").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
    content = F.when(F.col("pages") > 1, 1 - F.col("clogc") / (F.col("c") * F.log("pages"))).otherwise(1.0)
    return shape.join(sums, "key", "left").select("key", "pages", "presentation", F.coalesce(content, F.lit(0.0)).alias("content"))


def _ranks(nodes: list[dict], blocks: list[dict], stats: dict[int, tuple[int, float, float]], p: SiteParams) -> list[int | None]:
    """Ranks of the nodes, where noise by name or form around the page's text gives way to what
    the elements are else: around the longest article or main element in such noise, if it has no less
    text than all that is out of noise; on a page without one, around the longest text, if it is most of
    the page's and, over ``min_pages`` pages, each page's own (on fewer, not if a name says noise)."""
    ranks = [n["rank"] for n in nodes]
    if all(r is None or r >= 0 for r in ranks):
        return ranks
    weak, firm = [False] * len(nodes), [False] * len(nodes)  # inside of noise by name or form; inside of other noise
    for i, n in enumerate(nodes):
        up = n["parent"]
        weak[i] = ranks[i] is not None and ranks[i] < 0 or up >= 0 and weak[up]
        firm[i] = ranks[i] == 0 or up >= 0 and firm[up]
    text, clean = [0] * len(nodes), 0  # texts without those of noise inside
    for b in blocks:
        i = b["node"]
        if i >= 0:
            text[i] += len(b["text"])
        if i < 0 or not weak[i] and not firm[i]:
            clean += len(b["text"])
    for i in range(len(nodes) - 1, -1, -1):
        if nodes[i]["parent"] >= 0 and (ranks[i] is None or ranks[i] > 0):
            text[nodes[i]["parent"]] += text[i]
    own = [r if r is None or r >= 0 else (-r - 1) % 3 or None for r in ranks]
    named = [r is not None and r < -3 for r in ranks]

    def opened(i):
        around = [i]
        while nodes[around[-1]]["parent"] >= 0:
            around.append(nodes[around[-1]]["parent"])
        return [j for j in around if ranks[j] is not None and ranks[j] < 0]

    def most(i):
        pages, _, content = stats.get(nodes[i]["key"], (1, 1.0, 1.0))
        unlike = content >= p.wrapper_content if pages >= p.min_pages else not any(named[j] for j in opened(i))
        return unlike and text[i] >= p.wrapper_share * (clean + text[i])

    live = [i for i in range(len(nodes)) if text[i] and not firm[i]]
    found = [i for i in live if own[i]]
    if found:
        i = max((i for i in found if weak[i]), key=lambda i: (text[i], -i), default=None)
        wraps = opened(i) if i is not None and text[i] >= clean else ()
    else:
        by_size = sorted((i for i in live if ranks[i] is not None and ranks[i] < 0), key=lambda i: (named[i], -text[i]))
        wraps = next((opened(i) for i in by_size if most(i)), ())
    for j in wraps:
        ranks[j] = own[j]
    return [r if r is None else max(r, 0) for r in ranks]


def main_text(nodes: list[dict], blocks: list[dict], stats: dict[int, tuple[int, float, float]], p: SiteParams = SiteParams()) -> str:
    """The page's blocks outside of every branch of low importance, in page order."""
    textual = set()
    for b in blocks:
        n = b["node"]
        while n >= 0 and n not in textual:
            textual.add(n)
            n = nodes[n]["parent"]
    ranks = _ranks(nodes, blocks, stats, p)
    noise, best = [False] * len(nodes), 0
    for i, n in enumerate(nodes):
        noise[i] = ranks[i] == 0 or n["parent"] >= 0 and noise[n["parent"]]
        if not noise[i] and i in textual:
            best = max(best, ranks[i] or 0)
    inside, keep, around = [False] * len(nodes), [True] * len(nodes), set()
    root = [-1] * len(nodes)  # the article a node lies in
    for i, n in enumerate(nodes):
        if best and ranks[i] == best and not noise[i]:
            while i >= 0 and i not in around:
                around.add(i)
                i = nodes[i]["parent"]
    for i, n in enumerate(nodes):
        up = n["parent"]
        inside[i] = not noise[i] and (best > 0 and ranks[i] == best or up >= 0 and inside[up])
        if inside[i]:
            root[i] = root[up] if up >= 0 and inside[up] else i
        marked = 0.0 if noise[i] else 1.0 if inside[i] else 0.0 if best else None
        pages, look, text = stats.get(n["key"], (1, 1.0, 1.0))
        if inside[i] and ranks[i] is None:
            of, _, unlike = stats.get(nodes[root[i]]["key"], (1, 1.0, 1.0))
            if pages >= p.strip_share * of and unlike >= p.wrapper_content:
                marked = None  # the site tells what it is
        w = p.free_weight if marked is None else p.marked_weight
        score = w * (look if marked is None else marked) + (1 - w) * text
        low = score < p.threshold and (marked is not None or pages >= p.min_pages)
        # branches around the article stay; their own text is outside of it
        keep[i] = (not low or not noise[i] and i in around) and (up < 0 or keep[up])
    if best:
        own = [b["text"] for b in blocks if b["node"] >= 0 and inside[b["node"]] and keep[b["node"]]]
    else:
        own = [b["text"] for b in blocks if b["node"] < 0 or keep[b["node"]]]
    if not own:
        own = [b["text"] for b in blocks if b["node"] < 0 or not noise[b["node"]]]
    return "\n\n".join(own)


def extract(pages: DataFrame, p: SiteParams = SiteParams(), url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without the html column, with the main text as ``text_col``."""
    rest = [c for c in pages.columns if c != html_col]
    trees = written(parse_pages(pages, url_col, html_col), "html-trees", "zstd")
    stats = written(style_tree(trees), "html-style")
    shipped = None
    if fits(stats, p.nodes_to_broadcast):
        got = {r["key"]: (r["pages"], r["presentation"], r["content"]) for r in stats.collect()}
        shipped = pages.sparkSession.sparkContext.broadcast(got)
        rows = trees.select("page", "nodes", "blocks")
    else:
        used = trees.select("page_key", F.explode(F.array_distinct("nodes.key")).alias("key")).join(stats, "key")
        used = used.groupBy("page_key").agg(F.collect_list(F.struct("key", "pages", "presentation", "content")).alias("stats"))
        rows = trees.join(used, "page_key", "left").select("page", "nodes", "blocks", "stats")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            cols = [b.column(i).to_pylist() for i in range(1, b.num_columns)]
            if shipped is not None:
                text = [main_text(n, x, shipped.value, p) for n, x in zip(*cols)]
            else:
                text = [main_text(n, x, {r["key"]: (r["pages"], r["presentation"], r["content"]) for r in s or ()}, p) for n, x, s in zip(*cols)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["page", "text"])

    schema = T.StructType([rows.schema["page"], T.StructField("text", T.StringType())])
    out = rows.mapInArrow(go, schema)
    return out.select(*[F.col("page").getField(c).alias(c) for c in rest if c != text_col], F.col("text").alias(text_col))
