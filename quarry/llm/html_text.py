"""HTML main text by consensus host paths.

A page's containers are scored by the text they hold outside links.  Some are noise
by their tag or by a plain class word (menus, adverts, comments).  Others only may
be: their class word also occurs on parts of articles (related, social, share).
Each page judges those by their scores and votes for or against their generalised
paths (tags and classes, without digits), and for the path of the deepest container
that holds all of its text.  Spark adds the votes up per host, and every page is
extracted again: a container in doubt stays or goes with the majority of its host,
whatever the page's own score, and the text comes from the best path of the host
that holds all that is kept, or else from the page's own best container.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .url_rules import url_host

# fixed values: elements by role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NOISE = frozenset("nav aside footer form script style noscript template button select option textarea iframe svg "
                  "head title menu noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th "
                  "thead tr ul".split())
CONTAINER = frozenset("article body div main section td".split())
CLOSED_BY_BLOCK = frozenset({"p"})
CLOSED_BY_SELF = frozenset("li dt dd tr td th option".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
                        "menu submenu sidebar aside footer masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices "
                        "popup modal newsletter subscribe comments disqus login signup pagination pager header".split())
DOUBTFUL_WORDS = frozenset("alert comment copyright overlay recommended related reply replies respond search share sharing skip social "
                           "subscription toolbar widget".split())
KEEPS_HEADER = frozenset({"article", "main"})

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"(?<![\w-])display\s*:\s*none", re.I)
MOST = 0.5        # of the page's text; what holds more is no noise by a class word
PROSE = 120       # characters outside links from which a container in doubt scores as content,
LINK_SHARE = 1 / 3  # if no more than this share of its text is in links
DEPTH = 40        # steps of a path; what lies deeper has the path of the container at that depth
MIN_VOTES = 0.05  # of a host's pages that a winning main path needs
MAX_PATHS = 20    # so at most 1 / MIN_VOTES main paths win


def _value(match: re.Match | None) -> str:
    return "" if match is None else next((g for g in match.groups() if g is not None), "")


def _hidden(attributes: str) -> bool:
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), next((g for g in m.groups()[1:] if g is not None), "")
        if (name == "hidden" and not value.lower().startswith("until")) or (name == "aria-hidden" and value.lower() == "true") \
                or (name == "style" and _NO_DISPLAY.search(value)):
            return True
    return False


def _is_noise(tag: str, attributes: str, kept_header: bool) -> bool:
    """Noise by the tag or because it is hidden."""
    if tag in NOISE or (tag == "header" and not kept_header):
        return True
    return bool(attributes) and tag not in ("html", "body", "article", "main") and _hidden(attributes)


def _named(tag: str, attributes: str, kept_header: bool) -> int:
    """By a word of its class, id or role: 1 noise, 2 in doubt, 0 neither."""
    if not attributes or tag in ("html", "body", "article", "main"):
        return 0
    words = {w for m in _NAMED.finditer(attributes) for w in re.split(r"[^a-z]+", _value(m).lower())}
    if kept_header:
        words.discard("header")
    return 1 if not words.isdisjoint(NOISE_WORDS) else 2 if not words.isdisjoint(DOUBTFUL_WORDS) else 0


def _step(tag: str, attributes: str) -> str:
    """A path step: the tag and its sorted classes, digits dropped."""
    classes = sorted({re.sub(r"\d+", "", c) for c in _value(_CLASS.search(attributes)).lower().split()} - {""}) if attributes else []
    return ".".join([tag, *classes])


@dataclass
class Node:
    """An element: the pieces of text from ``start`` to ``end`` are inside it."""

    tag: str
    path: str
    depth: int                       # containers above it
    start: int
    end: int = -1
    named: int = 0                   # 1 noise, 2 in doubt by a class word
    voted: str = ""                  # the path that votes on it name
    sure: bool = False               # noise by its tag, or hidden
    above: int = -1                  # number of the next element above that a class word names
    children: list[Node] = field(default_factory=list)


class Page:
    """A page's text in pieces, its containers, and the elements that class words name.

    Read once, in time linear in the page, however deep or unclosed its elements:
    sizes are differences of running sums, and the nearest open element of a kind
    is kept, not looked for.  Unclosed elements end where their parent or a block
    that cannot lie inside them ends or starts."""

    def __init__(self, page: str | None):
        self.root = Node("", "", 0, 0)
        self.named: list[Node] = []
        self.texts: list[str] = []       # pieces of raw text outside sure noise
        self.linked: list[bool] = []
        self.owner: list[int] = []       # the innermost named element of each piece
        self.block: list[int] = []       # the block each piece belongs to
        self._read(page or "")
        sizes = [0 if link or text.isspace() else len(text) for text, link in zip(self.texts, self.linked, strict=True)]
        self.prose = [0, *accumulate(sizes)]
        self.links = [0, *accumulate(0 if text.isspace() or not link else len(text) for text, link in zip(self.texts, self.linked, strict=True))]

    def size(self, node: Node) -> int:
        """Characters outside links in an element."""
        return self.prose[node.end] - self.prose[node.start]

    def score(self, node: Node) -> bool:
        """Whether a container in doubt scores as content on this page."""
        prose, links = self.size(node), self.links[node.end] - self.links[node.start]
        return prose >= PROSE and links <= LINK_SHARE * (prose + links)

    def kept(self, verdicts: dict[str, bool]) -> list[bool]:
        """Per piece, whether no element that is noise by its class word holds it."""
        total, content = self.prose[-1], []
        for node in self.named:  # in page order, so what lies above is judged before
            own = self.size(node) > MOST * total or (node.named == 2 and verdicts.get(node.voted, self.score(node)))
            content.append(own and (node.above < 0 or content[node.above]))
        return [k < 0 or content[k] for k in self.owner]

    def _read(self, text: str) -> None:
        stack: list[Node] = [self.root]
        opened: dict[str, list[int]] = {}    # per tag: the depths of its open elements
        blocks: list[int] = []               # depths of open block elements
        containers: list[int] = []           # depths of open containers
        trees: list[Node] = [self.root]      # open containers that may hold text
        stops: list[int] = []                # depths of open lists and tables
        links, number = 0, 0

        def add(piece: str) -> None:
            if piece and not stack[-1].sure:
                self.texts.append(piece)
                self.linked.append(links > 0)
                self.owner.append(owners[-1])
                self.block.append(number)

        owners = [-1]  # per open element

        def close(depth: int) -> None:
            nonlocal links, number
            while len(stack) > depth:
                node = stack.pop()
                owners.pop()
                node.end = len(self.texts)
                opened[node.tag].pop()
                if node.tag in BLOCK:
                    number += 1
                    blocks.pop()
                if node.tag in CONTAINER:
                    containers.pop()
                if node.tag in ("ul", "ol", "table", "dl"):
                    stops.pop()
                if trees[-1] is node:
                    trees.pop()
                links -= node.tag == "a"

        def nearest(tag: str) -> int:
            return opened[tag][-1] if opened.get(tag) else 0

        for kind, tag, attributes, piece in tokens(text):
            if kind == "text":
                add(piece)
            elif kind == "end":
                depth = nearest(tag)
                # an inline end tag does not reach over a block that is open inside
                if depth and (tag in BLOCK or not blocks or blocks[-1] <= depth):
                    close(depth)
                elif tag == "p":
                    number += 1
                elif tag == "br":
                    add(" ")
            elif tag in VOID:
                if tag == "hr":
                    number += 1
                elif tag == "br":
                    add(" ")
            else:
                if tag in BLOCK:
                    depth = nearest("p")
                    if depth and (not containers or containers[-1] < depth):
                        close(depth)
                    if tag in CLOSED_BY_SELF:
                        depth = nearest(tag)
                        if depth and (not stops or stops[-1] < depth):
                            close(depth)
                    number += 1
                parent = stack[-1]
                kept_header = bool(opened.get("article") or opened.get("main"))
                deeper = tag in CONTAINER and parent.depth < DEPTH
                node = Node(tag, f"{parent.path}/{_step(tag, attributes)}" if deeper else parent.path, parent.depth + deeper, len(self.texts),
                            sure=parent.sure or _is_noise(tag, attributes, kept_header), above=owners[-1])
                if attributes.endswith("/") and tag not in BLOCK:
                    continue
                owner = owners[-1]
                if not node.sure:
                    node.named = _named(tag, attributes, kept_header)
                    if node.named:
                        node.voted = f"{parent.path}/{_step(tag, attributes)}"
                        owner = len(self.named)
                        self.named.append(node)
                stack.append(node)
                owners.append(owner)
                depth = len(stack) - 1
                opened.setdefault(tag, []).append(depth)
                if tag in BLOCK:
                    blocks.append(depth)
                if tag in CONTAINER:
                    containers.append(depth)
                    if not node.sure:
                        trees[-1].children.append(node)
                        trees.append(node)
                if tag in ("ul", "ol", "table", "dl"):
                    stops.append(depth)
                links += tag == "a"
        stack.append(Node("", "", 0, 0))  # the root is closed like any other
        owners.append(-1)
        opened[""] = [0, 0]
        close(0)
        self.root.end = len(self.texts)

    def lines(self, node: Node, kept: list[bool]) -> str:
        """The kept text of an element, a line a block."""
        out, held, now = [], [], -1

        def flush() -> None:
            joined = " ".join(html.unescape("".join(held)).split())
            if joined:
                out.append(joined)
            held.clear()

        for k in range(node.start, node.end):
            if self.block[k] != now:
                flush()
                now = self.block[k]
            if kept[k]:
                held.append(self.texts[k])
        flush()
        return "\n".join(out)


def tokens(text: str) -> Iterator[tuple[str, str, str, str]]:
    """``(kind, tag, attributes, text)`` of a page: kind is text, start or end.

    A quote that is never closed does not hide the end of its tag, and is looked
    for once."""
    at, n = 0, len(text)
    last = {q: text.rfind(q) for q in "\"'>"}
    while at < n:
        opening = text.find("<", at)
        if opening < 0 or opening > last[">"] and not text.startswith("<!--", opening):
            yield "text", "", "", text[at:]
            return
        if text.startswith("<!--", opening):
            if opening > at:
                yield "text", "", "", text[at:opening]
            end = text.find("-->", opening + 4)
            at = n if end < 0 else end + 3
            continue
        m = _TAG.match(text, opening)
        if m is None:
            if opening + 1 < n and text[opening + 1] in "!?":
                if opening > at:
                    yield "text", "", "", text[at:opening]
                at = text.find(">", opening) + 1
            else:
                yield "text", "", "", text[at:opening + 1]
                at = opening + 1
            continue
        if opening > at:
            yield "text", "", "", text[at:opening]
        start = place = m.end()
        if m[1]:
            end = text.find(">", place)
        else:
            while True:
                stop = _STOP.search(text, place)
                if stop is None or stop[0] == ">":
                    end = stop.start() if stop else text.find(">", start)
                    break
                if last[stop[0]] <= stop.start():  # never closed
                    end = text.find(">", start)
                    break
                place = text.find(stop[0], stop.end()) + 1
            if end < 0 or end < start:
                end = text.find(">", start)
        if end < 0:
            yield "text", "", "", text[opening:]
            return
        tag, attributes = m[2].lower(), text[start:end]
        at = end + 1
        if m[1]:
            yield "end", tag, "", ""
            continue
        yield "start", tag, attributes, ""
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            yield "text", "", "", text[at:close.start() if close else n]
            yield "end", tag, "", ""
            at = close.end() if close else n


def best_container(page: Page, kept: list[bool]) -> Node:
    """The deepest container on the way down outside which is only noise and link text."""
    sizes = [0, *accumulate(b - a if k else 0 for a, b, k in zip(page.prose, page.prose[1:], kept))]
    node = page.root
    while node.children:
        child = max(node.children, key=lambda c: sizes[c.end] - sizes[c.start])
        held = sizes[child.end] - sizes[child.start]
        if not held or held < sizes[node.end] - sizes[node.start]:
            break
        node = child
    return node


def main_text(page: str | None, paths: list[str] = (), verdicts: dict[str, bool] | None = None) -> str:
    """Text of the first of ``paths`` that leaves only noise and link text of the page
    out, else of its best container; ``verdicts`` say of paths in doubt whether they are content."""
    parsed = Page(page)
    kept = parsed.kept(verdicts or {})
    sizes = [0, *accumulate(b - a if k else 0 for a, b, k in zip(parsed.prose, parsed.prose[1:], kept))]
    if paths and sizes[-1]:
        by_path: dict[str, list[Node]] = {}
        todo = list(reversed(parsed.root.children))
        while todo:
            node = todo.pop()
            by_path.setdefault(node.path, []).append(node)
            todo.extend(reversed(node.children))
        for path in paths:
            found, end = [], -1
            for node in by_path.get(path, ()):  # in page order; those inside another are part of it
                if node.start >= end:
                    found.append(node)
                    end = node.end
            if sum(sizes[x.end] - sizes[x.start] for x in found) == sizes[-1] and found:
                return "\n".join(t for x in found if (t := parsed.lines(x, kept)))
    return parsed.lines(best_container(parsed, kept), kept)


VOTES = "host string, path string, content boolean, main boolean, size long"


def page_votes(page: str | None) -> Iterator[tuple[str, bool, bool, int]]:
    """``(path, content, main, size)``: a vote on every path in doubt, and one for the main path."""
    parsed = Page(page)
    for node in parsed.named:
        if node.named == 2:
            yield node.voted, parsed.score(node), False, parsed.size(node)
    best = best_container(parsed, parsed.kept({}))
    if best.path:
        yield best.path, True, True, parsed.size(best)


def host_paths(pages: DataFrame, host: Column, body: Column) -> DataFrame:
    """``(host, paths, verdicts)``: the main paths that win each host, most votes
    first, and of each path in doubt whether most of its votes are for content
    (a tie is noise)."""
    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(host, *v) for host, page in zip(batch["host"], batch["body"], strict=True) for v in page_votes(page)]
            yield pd.DataFrame(rows, columns=["host", "path", "content", "main", "size"])
    votes = pages.select(host.alias("host"), body.alias("body")).where("body is not null").mapInPandas(vote, VOTES)
    counts = written(votes.groupBy("host", "path", "main").agg(
        F.count(F.lit(1)).alias("votes"), F.sum(F.col("content").cast("long")).alias("content"), F.sum("size").alias("size")), "html-votes")
    main = counts.where("main")
    totals = main.groupBy("host").agg(F.sum("votes").alias("all"))
    won = main.join(totals, "host").where(F.col("votes") >= MIN_VOTES * F.col("all"))  # at most 1 / MIN_VOTES a host
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.col("size")).alias("s"), "path")))
    paths = won.groupBy("host").agg(F.transform(F.slice(ranked, 1, MAX_PATHS), lambda p: p["path"]).alias("paths"))
    verdicts = counts.where("not main").groupBy("host").agg(
        F.map_from_entries(F.collect_list(F.struct("path", (2 * F.col("content") > F.col("votes")).alias("is_content")))).alias("verdicts"))
    return written(paths.join(verdicts, "host", "full"), "html-paths")


def extract_main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """One row per input row: ``page_id``, ``url``, ``text``, ``n_chars`` (code points).

    The votes are small aggregates, written once; pages meet their host's paths
    in a join that Spark broadcasts or splits by the written size, so a host with a
    third of all pages is no single task.  A host's verdicts grow with its distinct
    paths in doubt, not with its pages.

    Edge cases: null or empty HTML gives an empty text; a page without tags is
    its own text; a null URL belongs to the empty host; elements nested or left
    open any number of times are read in linear time; repeated rows vote and
    are returned as often as they occur; an empty table gives an empty result;
    other columns are not read.
    """
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{body}`").alias("body"),
                        url_host(F.col(f"`{url}`")).alias("host"))
    winners = host_paths(rows, F.col("host"), F.col("body"))
    known = F.transform(F.map_entries("verdicts"), lambda e: F.struct(e["key"].alias("path"), e["value"].alias("is_content")))

    @F.pandas_udf("string")
    def extract(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for body, paths, verdicts in batches:
            yield pd.Series([main_text(b, [] if p is None else list(p), {} if v is None else {e["path"]: bool(e["is_content"]) for e in v})
                             for b, p, v in zip(body, paths, verdicts, strict=True)])

    return rows.join(winners.select("host", "paths", known.alias("verdicts")), "host", "left") \
        .select("page_id", "url", extract("body", "paths", "verdicts").alias("text")) \
        .withColumn("n_chars", F.length("text").cast("long"))
