"""HTML main text by consensus host paths.

Each page scores its containers by the text that stands in them outside links. Names that page furniture often has only lower
the score: nothing is cut for its name before the votes. The best container's path, tags and classes with digits generalised, is the
page's vote. Spark counts the votes of each host, and every page is extracted again from the containers at its host's winning path, without
blocks inside them that are marked as furniture. A page that has none there, or no text in them, uses its own best container.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import Shared

# Parts of a host's pages where host paths are too many to go to all tasks.
SALTS = 256

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)                                    # comment
      | <(?P<raw>script|style)\b[^>]*+(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)
      | <(?P<skip>noscript|template|iframe|svg|textarea|select|title)\b[^>]*+>.*?</(?P=skip)\s*>
      | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)
      | <[a-zA-Z/!?][^>]*+(?:>|\Z)                            # a broken tag, declaration or instruction""",
    re.S | re.I | re.X,
)
_CLASS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_VALUE = re.compile(r"""=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)""")
_HIDDEN_NAME = re.compile(r"(?:^|\s)hidden(?=[\s/=]|$)", re.I)
_HIDDEN_VALUE = re.compile(r"""(?:^|\s)(?:style\s*=\s*(?:"[^"]*display\s*:\s*none|'[^']*display\s*:\s*none|display:none)|aria-hidden\s*=\s*["']?true)""", re.I)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_CONTAINERS = frozenset("article main section div td body".split())
_FURNITURE_TAGS = frozenset("nav header footer aside form button dialog menu head object video audio canvas title noscript template iframe svg textarea select".split())
# Names of what is never the article, and names that parts of an article can have as well.
_FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent "
    "newsletter comment comments reply replies disqus contentinfo".split()
)
_DOUBTFUL_WORDS = frozenset(
    "banner promo widget header masthead notice alert popup modal overlay subscribe signup share sharing social related recommended form login search complementary".split()
)
DOUBTFUL, FURNITURE = 1, 2
# What a block in such an element counts in the score of the containers around it.
_WEIGHTS = {0: 1.0, DOUBTFUL: 0.4, FURNITURE: 0.05}
# A table of host paths up to this size goes to all tasks, so that pages are not shuffled.
BROADCAST_BYTES = 16 << 20
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


@dataclass
class Node:
    parent: int
    tag: str
    path: str
    cut: bool
    mark: int = 0


@dataclass
class Page:
    """Elements of a page, and its text blocks in page order as ``(element, text, share of it in links)``."""

    nodes: list[Node] = field(default_factory=lambda: [Node(-1, "", "", False)])
    blocks: list[tuple[int, str, float]] = field(default_factory=list)

    def chain(self, at: int) -> Iterator[int]:
        while at >= 0:
            yield at
            at = self.nodes[at].parent


def _label(tag: str, attrs: str) -> tuple[str, int]:
    """The element's part of the path, and how far its names mark it as page furniture."""
    names = []
    classes = []
    for kind, *values in _CLASS.findall(attrs):
        value = "".join(values).split()
        names += value
        if kind.lower() == "class":
            classes += value
    words = {w for n in names for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", n).lower())}
    label = ".".join([tag, *sorted(re.sub(r"\d+", "#", c.lower()) for c in classes)])
    if tag in ("html", "body", "article", "main"):
        return label, 0
    return label, DOUBTFUL if words.isdisjoint(_FURNITURE_WORDS) and not words.isdisjoint(_DOUBTFUL_WORDS) else 0 if words.isdisjoint(_FURNITURE_WORDS) else FURNITURE


def _hidden(attrs: str) -> bool:
    """Whether the element is hidden by an attribute; a class or id with that name hides nothing."""
    return bool(_HIDDEN_VALUE.search(attrs) or _HIDDEN_NAME.search(_VALUE.sub("=", attrs)))


def parse(source: str) -> Page:
    """Elements and blocks of a page. Unclosed elements end with their parent; a paragraph ends where the next block begins."""
    page, open_at, parts, owner, linked = Page(), [0], [], 0, 0

    def flush() -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            page.blocks.append((owner, text, min(1.0, linked / len(text))))
        parts, linked = [], 0

    def text(lo: int, hi: int) -> None:
        nonlocal owner, linked
        if lo < hi:
            found = html.unescape(source[lo:hi])
            if not parts or not any(p.strip() for p in parts):
                owner = next(i for i in page.chain(open_at[-1]) if page.nodes[i].tag not in _INLINE)
            if any(page.nodes[i].tag == "a" for i in open_at):
                linked += len(found.strip())
            if not page.nodes[open_at[-1]].cut:
                parts.append(found)

    def close(tag: str, stop: frozenset[str] = frozenset()) -> None:
        for i in range(len(open_at) - 1, 0, -1):
            name = page.nodes[open_at[i]].tag
            if name == tag:
                del open_at[i:]
                return
            if name in stop:
                return

    at = 0
    for m in _TOKEN.finditer(source):
        text(at, m.start())
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m["raw"] or m["skip"]:
                parts.append(" ")
            continue
        if tag not in _INLINE:
            flush()
        elif tag == "br":
            parts.append(" ")
        if m["end"]:
            close(tag)
            continue
        if tag in _VOID:
            continue
        if tag in _CLOSES_P:
            close("p", frozenset(("td", "th", "li", "article", "section", "div", "table", "body")))
        elif tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
            close(tag, frozenset(("ul", "ol", "table", "dl", "select") if tag not in ("td", "th") else ("tr", "table")))
        parent = open_at[-1]
        label, mark = _label(tag, m["attrs"])
        cut = page.nodes[parent].cut or tag in _FURNITURE_TAGS or _hidden(m["attrs"])
        page.nodes.append(Node(parent, tag, f"{page.nodes[parent].path}>{label}", cut, mark))
        if not m["attrs"].rstrip().endswith("/"):
            open_at.append(len(page.nodes) - 1)
    text(at, len(source))
    flush()
    return page


def best_container(page: Page) -> tuple[str, float]:
    """Path and score of the best container; an empty path where the page has no text in one.

    A block gives its length outside links to the containers around it, less to those further out, and less if it stands in
    an element that is marked as furniture.
    """
    scores: dict[int, float] = {}
    for owner, text, linked in page.blocks:
        share = 1.0
        weight = len(text) * (1 - linked) * _WEIGHTS[max(page.nodes[i].mark for i in page.chain(owner))]
        for i in page.chain(owner):
            if page.nodes[i].tag in _CONTAINERS:
                scores[i] = scores.get(i, 0.0) + weight * share
                share *= 0.6
    for i in scores:
        scores[i] *= {"article": 1.5, "main": 1.3}.get(page.nodes[i].tag, 1.0)
    best = max(scores, key=lambda i: (scores[i], -i), default=0)
    return page.nodes[best].path, scores.get(best, 0.0)


def text_at(page: Page, path: str) -> str:
    """Blocks below the elements at a path, a line each, without the furniture among them.

    Below such an element, one marked as furniture goes, and one marked as doubtful goes unless most of the element's text stands
    in it. The element itself stays, whatever its name: votes have chosen it.
    """
    nodes = page.nodes
    root = [0] * len(nodes)  # the element at the path that holds a node; 0 for none
    for i, n in enumerate(nodes[1:], 1):
        root[i] = root[n.parent] or (i if path and n.path == path else 0)
    below = [0.0] * len(nodes)
    held = [(owner, text, len(text) * (1 - linked)) for owner, text, linked in page.blocks if root[owner]]
    for owner, _, weight in held:
        for i in page.chain(owner):
            below[i] += weight
            if i == root[owner]:
                break

    gone = [False] * len(nodes)
    for i, n in enumerate(nodes[1:], 1):
        if root[i] and root[i] != i:
            gone[i] = gone[n.parent] or n.mark == FURNITURE or (n.mark == DOUBTFUL and below[i] <= below[root[i]] / 2)
    return "\n".join(text for owner, text, _ in held if not gone[owner])


def extract(source: str | None, path: str | None) -> str:
    page = parse(source or "")
    found = text_at(page, path or "")
    if not found:
        found = text_at(page, best_container(page)[0])
    return found or "\n".join(text for _, text, _ in page.blocks)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best = [best_container(parse(s.as_py() or "")) for s in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.float64())], ["host", "path", "weight"])


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: the path with most votes of each host; then that with more text, then the first by name."""
    votes = pages.select("host", "html").mapInArrow(_vote, "host string, path string, weight double").where("path <> ''")
    # whole characters, so that the sum does not depend on its order
    votes = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("weight")).alias("weight"))
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), F.desc("weight"), "path"))
    return votes.withColumn("place", place).where("place = 1").select("host", "path")


def extract_main_text(spark: SparkSession, pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """All rows and columns of ``pages`` with ``text``: the main text, one line a block, without page furniture.

    A missing or empty page has an empty text. White space of any kind within a block is one space. A page without url counts
    to one host of all such pages. Repeated rows vote and are extracted each. Pages without any container keep what text
    they have outside furniture. A column of ``pages`` named ``text`` is replaced.
    """
    shared = Shared(spark)
    host, path = "__page_host", "__page_path"
    named = pages.withColumn(host, F.lower(F.coalesce(F.regexp_extract(F.col(url_column), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]+)", 1), F.lit(""))))
    votes = host_paths(named.select(F.col(host).alias("host"), F.col(html_column).alias("html")))
    paths = shared.cut(votes.select(F.col("host").alias(host), F.col("path").alias(path)), "paths")
    size = paths.agg(F.sum(F.octet_length(host) + F.octet_length(path) + 32)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = named.join(F.broadcast(paths), host, "left")
    else:
        # a host may hold a third of all pages: its path is there once for each of SALTS parts of them
        salt = "__page_salt"
        salted = paths.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = named.withColumn(salt, F.pmod(F.xxhash64(url_column, html_column), F.lit(SALTS))).join(salted, [host, salt], "left")
    main = _main_text()
    return joined.withColumn("text", main(F.col(html_column), F.col(path))).select(*[c for c in pages.columns if c != "text"], "text")


def _main_text() -> Callable:
    @F.arrow_udf("string")
    def main(source: pa.Array, path: pa.Array) -> pa.Array:
        return pa.array([extract(s, p) for s, p in zip(source.to_pylist(), path.to_pylist(), strict=True)], pa.string())

    return main
