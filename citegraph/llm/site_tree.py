"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is a path of block elements with
their classes, as ``html/body/div.story/p``, and named by a 64-bit hash along it. Over the
different pages of the host, a node has the entropy of its presentations (the sequences of
child elements that a page has there) and, if it has own text, the entropy of its contents
(what a page says there; numbers inside a text do not count, so page numbers and dates make
nothing new). The importance of a node combines its presentations and the contents of its
whole branch: the more presentations it has, the more they decide. What looks and reads
alike on all pages is unimportant. A node is boilerplate if it and all nodes below it are
unimportant; its text is removed from each page.

Some branches say by their element, role or class that they are not main text
(navigation, advert, form, comments ...). Their importance is fixed at 0, since their
contents may well differ on every page, which entropy alone takes for main text. A class
or id counts as a whole, not by a word in it. Class and form alone do not mark a branch
that holds the only articles of a page, and words of ordinary use do not mark a branch
inside an article; there entropy decides.

Pages are read once into blocks, which are written; the tree is then combined aggregations
over narrow rows by node. A branch is summed over rows of a node and each node above
it, of which there are at most ``DEPTH``: what lies deeper belongs to the last one. Nodes of
boilerplate are broadcast as sorted numbers while they are counted to be few; else narrow
rows of pages and nodes are joined with them. Equal pages of a host count once in its tree,
so mirrored copies do not make their own text look like boilerplate.

Defined results: null and empty html have an empty text; a null url counts as a host of
its own, the empty one; a node seen on fewer than ``MIN_PAGES`` different pages is kept;
repeated rows are read alone; tables may be empty; extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegraph.llm.common import materialize
from citegraph.plans.materialize import BROADCAST_MAX_ROWS

MIN_IMPORTANCE = 0.3
MIN_PAGES = 4
#: Weight of contents falls as this power of the number of presentations.
GAMMA = 0.9
#: Levels of a tree.
DEPTH = 64

BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is never part of a page's own text, and no tags are read in it.
RAW_TAGS = "script|style|title|textarea|noscript|template|iframe|noframes|xmp"
NOISE_TAGS = frozenset(
    "head nav aside footer form menu button select datalist label fieldset dialog search svg math canvas object audio video map".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar rail footer cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription paywall comment comments disqus reply replies social share sharing related recommended "
    "recommendations widget login signin signup search pagination pager toolbar copyright legal skip".split()
)
#: Noise outside of articles only.
PLAIN_WORDS = frozenset("legal notice notices reply replies search share sharing skip social related recommended recommendations subscription".split())
#: Noise unless they head an article.
HEADING_TAG, HEADING_WORDS = "header", frozenset("header masthead banner".split())
MAIN_TAGS = frozenset(("article", "main"))
#: A start tag of the key closes an open element of the value, up to the nearest container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = frozenset("html body table ul ol dl div article main section nav aside footer header form td th blockquote".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW_TAGS})(?=[\s/>]).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z]+")
NUMBER = re.compile(r"[-_]?[0-9]+$")

DIGITS = re.compile(r"[0-9]+")

_BLOCK = [("node", pa.int64()), ("text", pa.string())]
_NODE = [("node", pa.int64()), ("above", pa.list_(pa.int64())), ("look", pa.int64()), ("says", pa.int64())]
_BLOCKS = "array<struct<node:bigint,text:string>>"
_NODES = "array<struct<node:bigint,above:array<bigint>,look:bigint,says:bigint>>"


def _signature(tag: str, attributes: str, in_main: bool) -> tuple[str, bool, bool]:
    """Element with its classes, whether it marks a branch that is not main text, and whether class or form alone do."""
    noise, weak = tag in NOISE_TAGS and tag != "form" or (tag == HEADING_TAG and not in_main), tag == "form"
    if not attributes.strip(" /"):
        return tag, noise, weak
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    named = f"{found.get('class', '')} {found.get('id', '')}".lower()
    classes = sorted(set(WORDS.findall(named)))
    if classes and tag not in ("html", "body", *MAIN_TAGS):
        words = {NUMBER.sub("", w) for w in named.split()}
        weak |= bool(words & (NOISE_WORDS - PLAIN_WORDS if in_main else NOISE_WORDS | HEADING_WORDS))
    noise |= found.get("role", "").lower() in NOISE_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    noise |= "display:none" in found.get("style", "").replace(" ", "").lower()
    return ".".join([tag, *classes]), noise, weak


def read_blocks(page: str | None) -> list[tuple[int, str]]:
    """Node and text of every block of a page outside the branches marked as noise, in page order."""
    return read_page(page)[0]


def read_page(page: str | None, host: str = "") -> tuple[list[tuple[int, str]], dict[int, tuple[tuple[int, ...], list[list[str]]]]]:
    """The blocks of a page, and by node the nodes from the root to it and the child elements of each of its elements."""
    if not page:
        return [], {}
    root = xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass"))
    blocks, nodes, spared = _read(page, frozenset(), root)
    return _read(page, spared, root)[:2] if spared else (blocks, nodes)


def _read(page: str, spared: frozenset[int], root: int):
    """Blocks and nodes of a page, and where the branches start that hold its only articles and are marked by class or form alone.

    The branches that start at ``spared`` are not marked by class or form.
    """
    nodes: dict[int, tuple[tuple[int, ...], list[list[str]]]] = {root: ((root,), [[]])}
    blocks: list[tuple[int, str]] = []
    holding: set[int] = set()
    free = False  # an article stands outside of marked branches
    # tag, nodes down to here, noise here, own mark: None, -1, or where it starts if by class or form alone
    stack: list[tuple[str, tuple[int, ...], bool, int | None]] = []
    pending: list[str] = []
    at = 0

    def flush() -> None:
        if pending:
            text = " ".join("".join(pending).split())
            if text:
                blocks.append((stack[-1][1][-1] if stack else root, text))
            pending.clear()

    def close(tags: set[str], scopes: frozenset) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                flush()
                del stack[i:]
                return
            if stack[i][0] in scopes:
                return

    for m in TOKEN.finditer(page):
        if m.start() > at and not (stack and stack[-1][2]):
            pending.append(html.unescape(page[at : m.start()]))
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            pending.append(" ")
        elif m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if any(t in BLOCK_TAGS for t, *_ in stack[i:]):
                        flush()
                    del stack[i:]
                    break
                if tag not in BLOCK_TAGS and stack[i][0] in BLOCK_TAGS:
                    break  # the end of an inline element does not close blocks
        else:
            if tag in BLOCK_TAGS:
                flush()
                close({"p"}, SCOPES)
                if tag in CLOSES:
                    close(CLOSES[tag], SCOPES - CLOSES[tag])
            if tag not in VOID_TAGS and not m["attributes"].endswith("/"):
                in_main = any(t in MAIN_TAGS for t, *_ in stack)
                signature, noise, weak = _signature(tag, m["attributes"], in_main)
                if tag in MAIN_TAGS:
                    marks = [x for *_, x in stack if x is not None]
                    free |= not marks
                    holding.update(marks if -1 not in marks else ())
                mark = -1 if noise else m.start() if weak else None
                noise |= weak and m.start() not in spared
                if noise and tag not in BLOCK_TAGS:
                    flush()
                noise |= bool(stack and stack[-1][2])
                above = stack[-1][1] if stack else (root,)
                if tag in BLOCK_TAGS and not noise and len(above) < DEPTH:
                    nodes[above[-1]][1][-1].append(signature)
                    above = (*above, xxhash.xxh64_intdigest(signature.encode("utf-8", "surrogatepass"), seed=above[-1]))
                    nodes.setdefault(above[-1], (above, []))[1].append([])
                stack.append((tag, above, noise, mark))
    if at < len(page) and not (stack and stack[-1][2]):
        pending.append(html.unescape(page[at:]))
    flush()
    return blocks, nodes, frozenset(() if free else holding)


def parse_pages(pages: DataFrame) -> DataFrame:
    """``row, page_id, url, host, blocks, nodes``: blocks in page order, and per node the nodes down to
    it, a digest of how it looks (its child elements) and of what it says (null without own text)."""
    kind = pa.struct([("blocks", pa.list_(pa.struct(_BLOCK))), ("nodes", pa.list_(pa.struct(_NODE)))])
    signed = lambda key: key - (1 << 63)
    digest = lambda parts: signed(xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")))
    # a text of nothing but numbers is what it says
    said = lambda text: DIGITS.sub("", text) if any(map(str.isalpha, text)) else text

    @F.arrow_udf(f"blocks {_BLOCKS}, nodes {_NODES}")
    def parse(column: pa.Array, hosts: pa.Array) -> pa.Array:
        rows = []
        for page, host in zip(column, hosts, strict=True):
            blocks, nodes = read_page(page.as_py(), host.as_py())
            says: dict[int, list[str]] = {}
            for node, text in blocks:
                says.setdefault(node, []).append(said(text))
            found = [
                {
                    "node": signed(node),
                    "above": [signed(a) for a in above],
                    "look": digest(["\1".join(children) for children in looks]),
                    "says": digest(says[node]) if node in says else None,
                }
                for node, (above, looks) in nodes.items()
            ]
            rows.append({"blocks": [{"node": signed(n), "text": t} for n, t in blocks], "nodes": found})
        return pa.array(rows, kind)

    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    read = pages.select("page_id", "url", "html", host.alias("host"))
    read = read.select("page_id", "url", "host", parse(F.col("html"), F.col("host")).alias("_page"))
    return read.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "host", "_page.blocks", "_page.nodes")


def node_importance(parsed: DataFrame) -> DataFrame:
    """``node, above, pages, importance`` of the nodes of all trees, over the different pages of each host."""
    different = parsed.groupBy("host", "nodes").agg(F.lit(1).alias("_one"))
    rows = different.select(F.inline("nodes"))

    def entropy(column: str) -> DataFrame:
        counts = rows.where(F.col(column).isNotNull()).groupBy("node", column).agg(F.count("*").alias("n"), F.any_value("above").alias("above"))
        sums = counts.groupBy("node").agg(
            F.any_value("above").alias("above"), F.sum("n").alias("pages"), F.count("*").alias("kinds"), F.sum(F.col("n") * F.log("n")).alias("s")
        )
        even = F.log("pages") - F.col("s") / F.col("pages")
        return sums.select("node", "above", "pages", "kinds", F.when(F.col("pages") > 1, even / F.log("pages")).otherwise(1.0).alias(column))

    says = entropy("says").select(F.explode("above").alias("node"), "pages", "says")
    inside = says.groupBy("node").agg((F.sum(F.col("pages") * F.col("says")) / F.sum("pages")).alias("inside"))
    weight = F.pow(F.lit(GAMMA), "kinds")
    importance = (1 - weight) * F.col("look") + weight * F.coalesce("inside", F.lit(0.0))
    return entropy("look").join(inside, "node", "left").select("node", "above", "pages", importance.alias("importance"))


def boilerplate(importance: DataFrame) -> DataFrame:
    """``node`` of what is unimportant and has only unimportant nodes below it."""
    low = (F.col("pages") >= MIN_PAGES) & (F.col("importance") < MIN_IMPORTANCE)
    branches = importance.select(F.explode("above").alias("node"), low.alias("low"))
    return branches.groupBy("node").agg(F.bool_and("low").alias("low")).where("low").select("node")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages`` (``page_id, url, html``)."""
    parsed = materialize(parse_pages(pages))
    removed = materialize(boilerplate(node_importance(parsed)))
    rows = parsed.drop("nodes")
    if removed.count() <= BROADCAST_MAX_ROWS:
        shared = pages.sparkSession.sparkContext.broadcast(np.sort(removed.toArrow().column("node").to_numpy()))

        @F.arrow_udf("array<boolean>")
        def stays(nodes: pa.Array) -> pa.Array:
            flat, known = nodes.flatten().to_numpy(), shared.value
            at = np.searchsorted(known, flat)
            gone = np.append(known, 0)[at] == flat if len(known) else np.zeros(len(flat), np.bool_)
            gone &= at < len(known)
            offsets = nodes.offsets.to_numpy()
            return pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), pa.array(~gone))

        rows = rows.withColumn("_stays", stays(F.col("blocks.node")))
        kept = F.filter("blocks", lambda b, i: F.get("_stays", i))
    else:
        gone = rows.select("row", F.explode(F.array_distinct("blocks.node")).alias("node")).join(removed, "node", "left_semi")
        rows = rows.join(gone.groupBy("row").agg(F.collect_set("node").alias("_gone")), "row", "left")
        kept = F.filter("blocks", lambda b: F.col("_gone").isNull() | ~F.array_contains("_gone", b["node"]))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), " ")
    return rows.select("page_id", "url", text.alias("text"))
