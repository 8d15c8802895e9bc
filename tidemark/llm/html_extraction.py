"""The main text of web pages, by a minimum cut between content and boilerplate.

A page becomes its blocks of text in page order. A fixed linear classifier looks at the tags, class and id words above a
block, its links and its length; its two costs are the capacities from the block to the terminals *content* and
*boilerplate*. Neighbouring blocks, and blocks of one parent, are tied by edges that weaken with their distance in the
DOM tree. The maximum flow gives the cheapest labelling: a short paragraph in an article stays with its neighbours, a
chatty advert between them does not.

Blocks are what lies between block-level tags; ``<br>`` and other inline tags do not end a block (``<br>`` is white
space). Unclosed tags are closed by their parent or by the next tag that cannot stand inside them; a head also by text, and
other elements without shown text, if their own end tag is missing, by the next block-level tag. Text of head, script, style
and the like is never a block. Character references are decoded; white space becomes one space; blocks are joined
by an empty line. A null or empty page has the empty text. Each page is worked on by itself, so nothing is shuffled; reading a
page takes time in proportion to its length. Names such as *sidebar* count against an element unless they tell what it lacks or is
about (``no-sidebar``), or it is, or holds, an article or main part, or holds most of the page's paragraphs (reader comments never
pass for that). Repeated rows are extracted one by one, other columns are ignored, and an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# An attribute's value is quoted only right after its equals sign. A comment or tag without end goes on to the end of the page,
# so that no character is looked at twice.
_TAG = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)(?:>|\Z)""",
    re.S,
)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style head title noscript template iframe object svg math textarea select button canvas audio video".split())
RAW = frozenset("script style title textarea noscript iframe".split())
#: Code without end tag goes on to the end of the page. Of the others these lack theirs if they start again before it.
CODE = frozenset(["script", "style"])
SINGLE = frozenset(["title", "noscript", "iframe"])
#: What can stand in a head.
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var img br wbr input".split()
)
#: Tags that end an open tag of the same group below the nearest container.
CLOSES = {
    **dict.fromkeys(
        "p div ul ol dl table article section aside nav header footer main form pre blockquote figure h1 h2 h3 h4 h5 h6 hr "
        "address fieldset details body".split(),
        frozenset(["p"]),
    ),
    "li": frozenset(["li", "p"]),
    "dt": frozenset(["dt", "dd", "p"]),
    "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]),
    "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
}
CONTAINERS = frozenset("body article section aside nav header footer main form div table ul ol dl td th blockquote figure".split())
#: Tags that end an element without shown text whose own end tag is missing.
BLOCKS = (frozenset(CLOSES) | CONTAINERS) - {"option"}

# The classifier: weights of what stands above a block, and of the block itself.
GOOD_TAGS = {"article": 3.0, "main": 2.0}
BAD_TAGS = {"nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "header": -7.0, "menu": -9.0, "dialog": -9.0, "address": -3.0}
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice "
    "alert popup modal overlay menu nav navigation navbar breadcrumb breadcrumbs sidebar footer masthead comment comments "
    "reply replies disqus share sharing social related recommended widget newsletter subscribe subscription login signup "
    "pagination pager toolbar copyright legal disclaimer tags".split()
)
GOOD_WORDS = frozenset("article content entry post story main body text".split())
#: A class or id with one of these words in it tells what an element lacks, holds or is about, not what it is.
ABOUT = frozenset("no non not has have with without of for".split())
REPLIES = frozenset("comment comments reply replies disqus".split())
BAD_WORD, GOOD_WORD, LINKED = -9.0, 0.8, -4.0
#: An element with this part of the page's text, and this many paragraphs, is no boilerplate for its name alone.
MOST, PARAGRAPHS = 0.8, 3
BLOCK_TAGS = {"p": 1.0, "pre": 1.0, "blockquote": 1.0, "h1": 0.8, "h2": 0.8, "h3": 0.8, "li": 0.2}
#: The strength of an edge between neighbours of one parent, its part for each step apart in the tree, and of a parent's edge.
TIE, DECAY, SIBLING = 2.5, 0.5, 1.5
SCALE = 100
#: Steps in the tree after which an edge has no strength left.
FAR = 16


class Block(NamedTuple):
    text: str
    tag: str
    holder: int  # number of the nearest element that is not inline
    element: int  # number of the nearest element
    linked: float


class Tree:
    """The elements of a page by number, parents before children."""

    def __init__(self) -> None:
        self.tags = [""]
        self.up = [-1]  # the element above
        self.outer = [-1]  # of elements that are not inline: the next such one above
        self.depth = [0]
        self.good = [False]  # an article or main part is above, or it is one
        self.own = [0.0]
        self.named = [0]  # 1: its names are those of boilerplate, 2: of reader comments

    def add(self, tag: str, attributes: str, above: int, outer: int) -> int:
        self.tags.append(tag)
        self.up.append(above)
        self.outer.append(outer)
        self.depth.append(self.depth[outer] + 1)
        self.good.append(self.good[above] or tag in GOOD_TAGS)
        score, named = GOOD_TAGS.get(tag, 0.0), 0
        if tag != "header" or not self.good[above]:  # the head of an article holds its headline
            score += BAD_TAGS.get(tag, 0.0)
        if attributes:
            words: set[str] = set()
            for found in _NAMES.findall(attributes):
                for name in "".join(found).lower().split():
                    parts = _WORD.findall(name)
                    if ABOUT.isdisjoint(parts):
                        words.update(parts)
            if tag not in ("html", "body") and tag not in GOOD_TAGS and words & BAD_WORDS:
                named = 2 if words & REPLIES else 1
            score += GOOD_WORD * bool(words & GOOD_WORDS)
        self.own.append(score)
        self.named.append(named)
        return len(self.tags) - 1

    def scores(self, found: list[Block]) -> list[float]:
        """For each element, what it and all above say about a block."""
        n = len(self.tags)
        text, paragraphs, holds = [0] * n, [0] * n, [t in GOOD_TAGS for t in self.tags]
        for block in found:
            text[block.element] += len(block.text)
            paragraphs[block.element] += block.tag == "p"
        for i in range(n - 1, 0, -1):
            above = self.up[i]
            text[above] += text[i]
            paragraphs[above] += paragraphs[i]
            holds[above] = holds[above] or holds[i]
        out = [0.0] * n
        for i in range(1, n):
            most = self.named[i] == 1 and text[i] >= MOST * text[0] and paragraphs[i] >= PARAGRAPHS
            bad = self.named[i] and not holds[i] and not most
            out[i] = out[self.up[i]] + self.own[i] + (BAD_WORD if bad else 0.0)
        return out

    def distance(self, a: int, b: int) -> int:
        """Steps between two elements that are not inline, ``FAR`` at most."""
        steps = 0
        while a != b and steps < FAR:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a = self.outer[a]
            steps += 1
        return steps


def blocks(page: str) -> list[Block]:
    """The blocks of a page, in page order."""
    return parsed(page)[0]


def parsed(page: str) -> tuple[list[Block], Tree]:
    found, tree, unclosed = _parsed(page, frozenset())
    return _parsed(page, unclosed)[:2] if unclosed else (found, tree)


def _parsed(page: str, unclosed: frozenset[int]) -> tuple[list[Block], Tree, frozenset[int]]:
    """The blocks, where the elements of the numbers ``unclosed`` end at block-level tags, and the silent elements without end tag.

    Open elements are found by tag and kind through their places on the stack, so that no tag walks through it.
    """
    out: list[Block] = []
    tree = Tree()
    without: set[int] = set()
    endless: set[str] = set()  # tags that do not end any more
    stack = [0]
    places: dict[str, list[int]] = {}
    # Places of elements that are not inline, of containers, of silent elements, and of these the unclosed and the others.
    outer, containers, silent, soft, hard = [0], [0], [], [], [0]
    pieces: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            holder = stack[outer[-1]]
            out.append(Block(text, tree.tags[holder], holder, stack[-1], min(1.0, linked / len(text))))
        pieces.clear()
        linked = 0

    def pop(to: int, named: bool = False) -> None:
        """End the elements from a place on; ``named``: the one there by its own tag."""
        nonlocal links
        while len(stack) > to:
            number, place = stack.pop(), len(stack)
            tag = tree.tags[number]
            places[tag].pop()
            for kind in (outer, containers, silent, soft, hard):
                if kind and kind[-1] == place:
                    kind.pop()
            links -= tag == "a"
            if tag in SILENT and tag != "head" and not (named and place == to):
                without.add(number)

    at, end = 0, len(page)
    while at < end:
        found = _TAG.search(page, at)
        text = page[at : found.start() if found else end]
        if silent and tree.tags[stack[-1]] == "head" and text.strip():
            pop(len(stack) - 1)
        if text and not silent:
            pieces.append(text)
            if links:
                linked += len(text)
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found[1], (found[2] or "").lower(), found[3]
        if not tag:
            continue
        if page[at - 1] != ">":
            break
        if tag not in INLINE:
            flush()
        elif tag == "br":
            pieces.append(" ")
        if closing:
            place = (places.get(tag) or [0])[-1]
            if place and (tag not in INLINE or outer[-1] < place):
                pop(place, True)
            continue
        if silent and tag not in HEAD:
            if tree.tags[stack[hard[-1]]] == "head":
                pop(hard[-1])
        if soft and tag in BLOCKS:
            first = bisect_right(soft, hard[-1])
            if first < len(soft):
                pop(soft[first])
        ends = CLOSES.get(tag)
        if ends:
            place = max((places[t][-1] for t in ends if places.get(t)), default=0)
            if place and place >= containers[-1]:
                pop(place)
        if tag in VOID or attributes.endswith("/"):
            continue
        number = tree.add(tag, attributes, stack[-1], stack[outer[-1]])
        place = len(stack)
        stack.append(number)
        places.setdefault(tag, []).append(place)
        if tag not in INLINE:
            outer.append(place)
        if tag in CONTAINERS:
            containers.append(place)
        if tag in SILENT:
            silent.append(place)
            (soft if number in unclosed else hard).append(place)
        links += tag == "a"
        if tag in RAW:
            closed = None if tag in endless else re.compile(rf"<({'/?' if tag in SINGLE else '/'}){tag}\b", re.I).search(page, at)
            if closed is None:
                endless.add(tag)
            if closed and closed[1]:
                at = closed.start()
            elif tag in CODE:
                at = end
    flush()
    pop(1)
    return out, tree, frozenset(without)


def content_score(block: Block, above: float) -> float:
    """The classifier's odds for content; its sign is the label of the block alone. ``above``: the score of its element."""
    length = min(len(block.text), 400) / 200
    ends = 0.4 if block.text[-1] in ".!?…:;\"'»”" else -0.2
    return above + BLOCK_TAGS.get(block.tag, 0.0) + length + ends + LINKED * block.linked - 1.0


def minimum_cut(scores: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling of least cost: nodes on the source side of the maximum flow are content.

    A node with positive score hangs on the source, one with negative score on the sink, by its absolute value.
    """
    n = len(scores)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def edge(a: int, b: int, there: int, back: int) -> None:
        graph[a].append(len(to))
        graph[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i, score in enumerate(scores):
        if score > 0:
            edge(source, i, round(score * SCALE), 0)
        elif score < 0:
            edge(i, sink, round(-score * SCALE), 0)
    for a, b, tie in ties:
        edge(a, b, round(tie * SCALE), round(tie * SCALE))
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in graph[u]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                amount = min(room[e] for e in path)
                for e in path:
                    room[e] -= amount
                    room[e ^ 1] += amount
                path, u = [], source
                continue
            while tried[u] < len(graph[u]):
                e = graph[u][tried[u]]
                if room[e] and level[to[e]] == level[u] + 1:
                    break
                tried[u] += 1
            else:
                if u == source:
                    break
                e = path.pop()
                u = to[e ^ 1]
                tried[u] += 1
                continue
            path.append(e)
            u = to[e]


def main_text(page: str | None) -> str:
    found, tree = parsed(page or "")
    if not found:
        return ""
    ties = []
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        parent = tree.outer[block.holder]
        if i:
            ties.append((i - 1, i, TIE * DECAY ** max(0, tree.distance(found[i - 1].holder, block.holder) - 2)))
        if parent in last:
            ties.append((last[parent], i, SIBLING))
        last[parent] = i
    scores = tree.scores(found)
    keep = minimum_cut([content_score(b, scores[b.element]) for b in found], ties)
    return "\n\n".join(b.text for b, good in zip(found, keep, strict=True) if good)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, the main text and its number of code points, for every row."""
    chosen = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")
    )
    return chosen.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
