"""Operator 5: main text of web pages by a site style tree.

1. Every page is parsed into block elements. An element's place in the tree is
   its path of tags and class names (containers also by their ordinal).
2. The trees of a host's pages are merged: per node, the number of pages that
   have it, the variants of its child sequence (presentation) and the texts
   found below it (content), each with the number of pages it is on.
3. Importance, between 0 and 1, with logarithms to the base of the node's pages:
   presentation is the entropy of the child sequences; content is one minus the
   mean entropy of its texts over the pages. They combine as
   ``(1 - decay^children) * presentation + decay^children * content``. Nodes seen
   on fewer than ``min_pages`` pages cannot be judged and count as important.
4. From each page the branches below the threshold go; an important node within
   such a branch stays, so the innermost judged node decides. Branches whose role is
   declared (menus, asides, forms, adverts, comments ... by tag, role, class or
   id; within an article only by tag, ARIA role and whole names that can be nothing
   else) have no importance on any host. What is left inside the article - or the
   main element, or the body, where there is none - is the text.

A page all of whose blocks are below the threshold shows no contrast (copies of
one page fill the host) and keeps them.

The statistics are aggregates over 64-bit node and text hashes, partially added
up before the shuffle, so a host that holds a third of all pages is no hot key.
The judged nodes go to the tasks as a broadcast while they number
``broadcast_nodes`` at most; beyond that they join the pages by host.

Defined results: null or empty html gives an empty text; pages without a host
are judged by declared roles alone; repeated rows give equal rows; null ids are
kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import checkpointed

# HTML's own vocabulary.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre"
    " search section select summary table tbody td template tfoot th thead tr ul button object canvas svg".split()
)
RAW_TAGS = frozenset("script style noscript textarea title iframe noembed noframes xmp head".split())
VOID_TAGS = frozenset("hr".split())
SPACE_TAGS = frozenset("br td th wbr img".split())
#: An open element of the value ends when one of the key starts.
IMPLIED_END = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
# What declares a branch not to be content.
ROLE_TAGS = frozenset("nav aside footer form dialog menu search select button object canvas svg template option".split())
ROLE_WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs"
    " comment comments commentlist complementary consent contentinfo cookie cookies copyright dialog disclaimer"
    " disqus footer form gdpr hidden login masthead menu modal nav navbar navigation newsletter notice notices"
    " overlay pager pagination popup promo promotion recommended related replies reply respond search share"
    " sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget".split()
)
ROLE_BEGINNINGS = ("adsby", "advert", "breadcrumb", "cookie", "newsletter", "sidebar", "sponsor")
ROLE_ENDINGS = ("banner", "comments", "footer", "menu", "nav", "navbar", "sidebar")
#: What can be nothing else even within an article: whole names, and ARIA roles.
INSIDE_NAMES = frozenset(
    "ad ads adsbygoogle advert adverts advertisement breadcrumb breadcrumbs comments commentlist navbar"
    " newsletter-signup share-buttons sidebar social-share sponsored".split()
)
INSIDE_ROLES = frozenset("banner complementary contentinfo dialog form menu navigation search".split())
ROOT_TAGS = frozenset({"html", "body", "article", "main"})
CONTAINERS = frozenset("div section table ul ol".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(frozen=True)
class TreeParams:
    threshold: float = 0.3
    decay: float = 0.9
    min_pages: int = 4
    broadcast_nodes: int = 2_000_000


@dataclass
class Element:
    tag: str
    path: int  # hash of the names from the top down to here
    dead: str  # why the branch is no content; empty: it may be
    root: int  # 0 body, 1 main, 2 article
    parent: Element | None = None
    children: list[str] = field(default_factory=list)
    ordinals: Counter = field(default_factory=Counter)


@dataclass
class Block:
    element: Element
    text: str
    root: int

    @property
    def paths(self) -> Iterator[int]:
        """Of the element and its ancestors, innermost first."""
        element = self.element
        while element.parent is not None:
            yield element.path
            element = element.parent


def _role(tag: str, attributes: dict[str, str], inside_article: bool) -> str:
    """Why the element is declared not to be content; empty if it is not."""
    if tag in ROOT_TAGS and not (tag == "article" and inside_article):
        return ""
    if tag == "article":
        return "comment"  # an article within an article
    if tag in ROLE_TAGS:
        return tag
    if tag == "header" and not inside_article:
        return tag
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return "hidden"
    if inside_article:
        # Body text may be called anything; what else is boilerplate shows in the tree.
        for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
            if name in INSIDE_NAMES:
                return name
        role = attributes.get("role", "").lower()
        return role if role in INSIDE_ROLES else ""
    names = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
    for word in map(str.lower, _WORDS.findall(names)):
        if word in ROLE_WORDS or word.startswith(ROLE_BEGINNINGS) or word.endswith(ROLE_ENDINGS):
            return word
        if word.endswith("header"):
            return word
    return ""


def parse(source: str | None) -> tuple[list[Block], dict[int, str]]:
    """The text blocks of a page in order, and per path the child sequence."""
    source = source or ""
    stack = [Element("", 0, "", 0)]
    blocks: list[Block] = []
    shapes: dict[int, list[str]] = {}
    run: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(run)).split())
        run.clear()
        top = stack[-1]
        if text and not top.dead:
            blocks.append(Block(top, text, top.root))

    def close(depth: int) -> None:
        flush()
        while len(stack) > depth:
            element = stack.pop()
            shapes.setdefault(element.path, []).append(" ".join(element.children))

    def open_(tag: str, rest: str) -> None:
        flush()
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        while stack[-1].tag in IMPLIED_END.get(tag, ()):
            close(len(stack) - 1)
        attributes = {}
        for name, value in _ATTRIBUTE.findall(rest):
            attributes.setdefault(name.lower(), entities.unescape(value.strip("\"'")))
        parent = stack[-1]
        name = ".".join([tag, *sorted(attributes.get("class", "").split())])
        parent.children.append(name)
        if tag in CONTAINERS:
            parent.ordinals[name] += 1
            name += f"[{parent.ordinals[name]}]"
        dead = parent.dead or _role(tag, attributes, parent.root == 2)
        if parent.dead == "form" and tag in ("article", "main"):
            dead = ""  # old sites wrap whole pages in a form
        article = tag == "article" or attributes.get("itemprop") == "articleBody"
        main = tag == "main" or attributes.get("role") == "main"
        path = xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass"), parent.path)
        stack.append(Element(tag, path, dead, 2 if article else max(parent.root, int(main)), parent))
        if tag in VOID_TAGS:
            close(len(stack) - 1)

    at = 0
    while at < len(source):
        found = _TAG.search(source, at)
        run.append(source[at : found.start() if found else len(source)])
        if not found:
            break
        at = found.end()
        ending, tag, rest = found[1] or found[4], (found[2] or found[5] or "").lower(), found[3] or found[6] or ""
        if not tag:
            continue
        if tag in SPACE_TAGS:
            run.append(" ")
        if tag in RAW_TAGS and not ending:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            if tag == "head" and not end:
                continue
            at = end.end() if end else len(source)
        elif tag not in BLOCK_TAGS or tag in ("td", "th"):
            continue
        elif not ending:
            open_(tag, rest)
        else:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if stack[depth].tag in ROOT_TAGS and tag not in ROOT_TAGS:
                    break
    close(1)
    return blocks, {path: "|".join(v) for path, v in shapes.items()}


def host_of(url: str | None) -> str:
    """Lower-case host name; empty where there is none."""
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return found[1].lower() if found else ""


def _node(host: str, path: int) -> int:
    return xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass"), path)


PAGE, SHAPE, TEXT = 0, 1, 2


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def observations(pages: DataFrame) -> DataFrame:
    """``node, host, kind, feature, pages, children``: what pages show of nodes,
    added up batch by batch."""
    schema = "node long, host string, kind int, feature long, pages long, children long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            children: Counter = Counter()
            for url, source in zip(batch.column("url"), batch.column("html")):
                host = host_of(url.as_py())
                if not host:
                    continue
                blocks, shapes = parse(source.as_py())
                own = set()
                for path, shape in shapes.items():
                    node = _node(host, path)
                    own |= {(node, host, PAGE, 0), (node, host, SHAPE, xxhash.xxh64_intdigest(shape.encode()))}
                    children[(node, host, PAGE, 0)] += len(shape.split())
                for block in blocks:
                    text = xxhash.xxh64_intdigest(block.text.encode("utf-8", "surrogatepass"))
                    own |= {(_node(host, path), host, TEXT, text) for path in block.paths}
                seen.update(own)
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [_signed([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([k[2] for k in keys], pa.int32()), _signed([k[3] for k in keys]),
                 pa.array([seen[k] for k in keys], pa.int64()), pa.array([children[k] for k in keys], pa.int64())],
                ["node", "host", "kind", "feature", "pages", "children"],
            )

    return pages.select("url", "html").mapInArrow(run, schema)


def importance(seen: DataFrame, params: TreeParams) -> DataFrame:
    """``node, host, m, presentation, content, importance`` of judged nodes."""
    features = seen.groupBy("node", "host", "kind", "feature").agg(F.sum("pages").alias("n"), F.sum("children").alias("children"))
    is_page, is_shape, is_text = (F.col("kind") == k for k in (PAGE, SHAPE, TEXT))
    n = F.col("n").cast("double")
    nodes = features.groupBy("node", "host").agg(
        F.sum(F.when(is_page, n)).alias("m"),
        F.sum(F.when(is_page, F.col("children"))).alias("children"),
        F.sum(F.when(is_shape, n)).alias("shapes"), F.sum(F.when(is_shape, n * F.log(n))).alias("shape_logs"),
        F.sum(F.when(is_text, n)).alias("texts"), F.sum(F.when(is_text, n * F.log(n))).alias("text_logs"),
    ).where(F.col("m") >= params.min_pages)
    base = F.log("m")
    # -sum p log p with p = n / m; a text on n pages has entropy log n.
    presentation = (F.log("shapes") - F.col("shape_logs") / F.col("shapes")) / base
    content = F.lit(1.0) - F.col("text_logs") / F.col("texts") / base
    weight = F.pow(F.lit(params.decay), F.col("children") / F.col("m"))
    return nodes.select(
        "node", "host", "m", F.coalesce(presentation, F.lit(0.0)).alias("presentation"), F.coalesce(content, F.lit(0.0)).alias("content"),
        weight.alias("weight"),
    ).withColumn("importance", (1 - F.col("weight")) * F.col("presentation") + F.col("weight") * F.col("content"))


def page_text(source: str | None, host: str, low: set[int] | frozenset[int], high: set[int] | frozenset[int] = frozenset()) -> str:
    """The text of one page without the branches in ``low``: of a block's element
    and its ancestors, the innermost that was judged (``low`` or ``high``) decides,
    so an important branch within a dull one stays."""
    blocks, _ = parse(source)
    if not blocks:
        return ""
    best = max(b.root for b in blocks)
    blocks = [b for b in blocks if b.root == best]
    if host and low:
        judged = (next((n in low for path in b.paths if (n := _node(host, path)) in low or n in high), False) for b in blocks)
        blocks = [b for b, noisy in zip(blocks, judged) if not noisy] or blocks
    return "\n".join(b.text for b in blocks)


def extract_main_text(pages: DataFrame, params: TreeParams = TreeParams()) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html")
    )
    judged = checkpointed(
        importance(observations(rows), params).select("node", "host", (F.col("importance") < params.threshold).alias("is_low"))
    )
    schema = "page_id long, url string, text string, n_chars long"

    def result(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    if judged.count() <= params.broadcast_nodes:
        found = judged.select("node", "is_low").toArrow()
        nodes, is_low = found.column("node").to_numpy().view(np.uint64), found.column("is_low").to_numpy()
        sets = pages.sparkSession.sparkContext.broadcast((frozenset(nodes[is_low].tolist()), frozenset(nodes[~is_low].tolist())))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield result(batch, [page_text(h.as_py(), host_of(u.as_py()), *sets.value) for u, h in zip(batch.column("url"), batch.column("html"))])

        return rows.mapInArrow(run, schema)

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield result(batch, [
                page_text(h.as_py(), host_of(u.as_py()), *({x % (1 << 64) for x in nodes.as_py() or ()} for nodes in (low, high)))
                for u, h, low, high in zip(*(batch.column(c) for c in ("url", "html", "low", "high")))
            ])

    host = F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    by_host = judged.groupBy("host").agg(
        F.collect_list(F.when(F.col("is_low"), F.col("node"))).alias("low"), F.collect_list(F.when(~F.col("is_low"), F.col("node"))).alias("high")
    )
    return rows.withColumn("host", host).join(by_host, "host", "left").mapInArrow(run_joined, schema)
