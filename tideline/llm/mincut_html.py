"""Main text of web pages: blocks are labelled content or boilerplate by a minimum cut.

A log-linear classifier of each block gives two costs, which are its capacities from the source and to the
sink. Blocks next to each other on the page, and more so next to each other in the DOM, are tied by edges that
cost something to cut. The maximum flow's cut is the labelling of least total cost.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import words

#: Costs in hundredths, so that flows are whole numbers.
SCALE = 100
#: What separating neighbours costs: of the page, and more with a common parent element.
ADJACENT, SIBLINGS = 0.6, 0.9

#: Weights of the classifier; positive speaks for content.
WEIGHTS = {
    "bias": -0.6,
    "article": 5.0,
    "boilerplate": -11.0,
    "named_content": 2.0,
    "named_boilerplate": -13.0,
    "hidden": -13.0,
    "link_share": -4.0,
    "log_words": 0.7,
    "sentence": 0.8,
    "heading": 0.6,
}

# Elements as HTML defines them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup"
    " time tt u var wbr br input picture source track param col embed area object canvas audio video math mfrac mi mn mo mover mrow"
    " mspace msqrt mstyle msub msubsup msup mtext munder semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSHOWN = frozenset("head title noscript template svg iframe textarea select datalist".split())
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hgroup hr main menu nav ol p pre section table ul".split()
)
ITEMS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
CONTENT_ELEMENTS = frozenset(("article", "main"))
BOILERPLATE_ELEMENTS = frozenset("nav header footer aside form menu dialog button fieldset".split())
CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article|articlebody|content|entry|main|post|story|text|body)(?:$|[\s_-])")
BOILERPLATE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|aside|banner|breadcrumbs?|comments?|commentlist|consent|contentinfo|cookies?|copyright|disclaimer"
    r"|discussion|disqus|footer|gdpr|header|legal|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|notification|pagination"
    r"|pager|popup|promo\w*|recommend\w*|related|replies|reply|respond|search|share|sharing|sidebar|signup|skip|social|sponsor\w*"
    r"|subscri\w*|tags|teaser|toolbar|widget|alert|complementary)(?:$|[\s_-])"
)
#: Parts of pages that have articles of their own, which are not the page's.
LISTING_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|aside|comments?|commentlist|discussion|disqus|footer|menu|modal|nav|navbar|navigation|popup|promo\w*"
    r"|recommend\w*|related|replies|reply|respond|sidebar|sponsor\w*|teaser|widget)(?:$|[\s_-])"
)
#: Names that say what a page has beside or lacks, not what an element is.
_LAYOUT_NAMES = re.compile(r"(?<![^\s_-])(?:has|with|without|no)[_-][\w-]*")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:script|style)\b.*?(?:</(?:script|style)\b[^>]*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(?P<broken>/?[a-zA-Z][^>]*)(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


@dataclass
class Element:
    name: str
    parent: Element | None
    article: bool = False
    boilerplate: bool = False
    named_content: bool = False
    named_boilerplate: bool = False
    listing: bool = False
    hidden: bool = False
    unshown: bool = False


@dataclass
class Block:
    text: str
    linked: int
    element: Element


def _opened(name: str, attrs: str, parent: Element) -> Element:
    """An element with what it and the elements around it say about its text."""
    named = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs)).lower() if attrs else ""
    # The header of an article is the article's own.
    boiler = name in BOILERPLATE_ELEMENTS and not (name == "header" and parent.article)
    names = _LAYOUT_NAMES.sub("", named) if name not in ("html", "body") else ""
    # The main element, and an article outside of listings, is not what the elements around it are called.
    own = name == "main" or name == "article" and not parent.listing
    return Element(
        name,
        parent,
        parent.article or name in CONTENT_ELEMENTS,
        parent.boilerplate or boiler,
        parent.named_content or bool(named and CONTENT_NAMES.search(named)),
        (parent.named_boilerplate and not own) or bool(names and BOILERPLATE_NAMES.search(names)),
        (parent.listing and not own) or bool(names and LISTING_NAMES.search(names)),
        # What an article hides at first is still its text.
        parent.hidden or bool(attrs and not parent.article and _HIDDEN.search(attrs)),
        parent.unshown or name in UNSHOWN,
    )


def blocks(page: str) -> list[Block]:
    """Runs of text between tags of block elements, white space made single, in page order."""
    out, parts, linked, in_link, hidden_inline = [], [], 0, 0, []
    at, here = 0, Element("", None)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, linked, here))
        parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not here.unshown and not hidden_inline:
            text = html.unescape(text)
            parts.append(text)
            linked += len(text) if in_link else 0

    for token in _TOKEN.finditer(page):
        say(page[at : token.start()])
        at, name = token.end(), (token["name"] or "").lower()
        if not name:
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if token["end"] else 1
            elif name in ("br", "img"):
                parts.append(" ")
            elif name == "span" and not here.unshown:
                # An inline element that is not shown hides its text; others do not matter.
                if token["end"]:
                    hidden_inline = hidden_inline[:-1]
                elif hidden_inline or (not here.article and _HIDDEN.search(token["attrs"])):
                    hidden_inline.append(name)
            continue
        flush()
        in_link, hidden_inline = 0, []
        if token["end"]:
            up = here
            while up.parent is not None and up.name != name:
                up = up.parent
            if up.parent is not None:
                here = up.parent
            continue
        if here.unshown and name == "body":
            while here.parent is not None and here.name != "html":
                here = here.parent
        if name in CLOSES_PARAGRAPH and here.name == "p":
            here = here.parent
        if name in ITEMS:
            up = here
            while up.parent is not None and up.name != name and up.name not in ITEMS[name]:
                up = up.parent
            if up.name == name:
                here = up.parent
        if name not in VOID and not token["attrs"].endswith("/"):
            here = _opened(name, token["attrs"], here)
    say(page[at:])
    flush()
    return out


def score(block: Block) -> float:
    """Log odds of content."""
    e, w, text = block.element, WEIGHTS, block.text
    total = w["bias"] + w["log_words"] * math.log1p(text.count(" ") + 1) + w["link_share"] * min(1.0, block.linked / len(text))
    total += w["sentence"] * (text[-1] in ".!?:;…。" or len(text) > 200) + w["heading"] * (e.name in ("h1", "h2", "h3"))
    total += w["named_boilerplate"] * e.named_boilerplate + w["hidden"] * e.hidden + w["boilerplate"] * e.boilerplate
    return total + w["article"] * e.article + w["named_content"] * e.named_content


def ties(found: list[Block]) -> list[tuple[int, int, int]]:
    """``(i, j, cost)`` of separating blocks: each and the next, and each and the next of its parent's children."""
    out, last = [], {}
    for j, block in enumerate(found):
        if j:
            out.append((j - 1, j, round(SCALE * ADJACENT)))
        parent = id(block.element.parent)
        if parent in last:
            out.append((last[parent], j, round(SCALE * SIBLINGS)))
        last[parent] = j
    return out


def minimum_cut(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each node is on the source side of a minimum cut, by maximum flow in layers.

    ``source[i]`` is lost if node ``i`` is on the sink side and ``sink[i]`` if it is on the source side; an edge's
    cost is lost if its ends are apart. A node that could be on either side is on the sink side.
    """
    n = len(source)
    # Flow through a single node needs no search.
    spare = [a - b for a, b in zip(source, sink)]
    s, t = n, n + 1
    to, room, at = [], [], [[] for _ in range(n + 2)]

    def edge(i: int, j: int, there: int, back: int) -> None:
        at[i].append(len(to))
        to.append(j)
        room.append(there)
        at[j].append(len(to))
        to.append(i)
        room.append(back)

    for i, x in enumerate(spare):
        if x:
            edge(*((s, i) if x > 0 else (i, t)), abs(x), 0)
    for i, j, cost in edges:
        edge(i, j, cost, cost)

    def layers() -> list[int]:
        depth, queue = [-1] * (n + 2), deque([s])
        depth[s] = 0
        while queue:
            i = queue.popleft()
            for e in at[i]:
                if room[e] and depth[to[e]] < 0:
                    depth[to[e]] = depth[i] + 1
                    queue.append(to[e])
        return depth

    while (depth := layers())[t] >= 0:
        following, path, i = [0] * (n + 2), [], s
        while True:
            if i == t:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if not room[e])
                i = to[path[cut] ^ 1]
                del path[cut:]
            while following[i] < len(at[i]):
                e = at[i][following[i]]
                if room[e] and depth[to[e]] == depth[i] + 1:
                    break
                following[i] += 1
            if following[i] < len(at[i]):
                path.append(e)
                i = to[e]
            elif path:
                depth[i] = -1
                i = to[path.pop() ^ 1]
                following[i] += 1
            else:
                break
    return [d >= 0 for d in depth[:n]]


def main_text(page: str | None) -> str:
    """Blocks labelled content, joined by a space; empty for a null page."""
    found = blocks(page or "")
    # log(1 + e^x) is the cost of the label that a score of x speaks against.
    odds = [max(-30.0, min(30.0, score(b))) for b in found]
    cost = lambda x: round(SCALE * math.log1p(math.exp(x)))
    content = minimum_cut([cost(x) for x in odds], [cost(-x) for x in odds], ties(found))
    return " ".join(b.text for b, keep in zip(found, content) if keep)


def _extracted(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(text_at).to_pylist()]
            columns = [*batch.columns[:text_at], *batch.columns[text_at + 1 :], pa.array(texts, pa.string())]
            names = [c for c in batch.schema.names if c != batch.schema.names[text_at]]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "text"])

    return run


def extract(df: DataFrame, html_col: str = "html") -> DataFrame:
    """``df`` with ``text`` in place of ``html_col``; the text is empty for null and empty pages.

    Pages are independent: rows that are repeated give equal results, an empty table an empty one. An input
    column ``text`` is replaced.
    """
    words.small_batches(df.sparkSession)
    names = [c for c in df.columns if c not in {html_col, "text"}]
    rows = df.select(*[f"`{c}`" for c in names], F.col(f"`{html_col}`").cast("string").alias("_mc_html"))
    schema = rows.drop("_mc_html").schema.add("text", "string")
    return rows.mapInArrow(_extracted(len(names)), schema)
