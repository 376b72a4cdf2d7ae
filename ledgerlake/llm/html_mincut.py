"""HTML main-text extraction by minimum-cut labelling.

A page becomes a list of text blocks in page order. A linear classifier turns
a block's place in the markup, its link share and its text into a cost of
calling it boilerplate or content; the costs are the capacities of its edges
to the two terminals. Smoothness edges join blocks that follow each other and
blocks that follow each other inside one element; they are heavier the more of
the path from the root the two share. The minimum cut labels all blocks of a
page at once, by max-flow.

Pages are independent: one Spark task labels its own rows, nothing moves.
Parsing takes work and memory in proportion to the page, as open elements are
found by their name; blocks whose own cost outweighs all their edges need no
flow, and the others are settled by blocking flows.

A class or id speaks against what an element holds as far as the element is a
part of the page: up to 40 % of the page's unlinked words it counts in full,
from 80 % on (a wrapper) not at all. The same holds for forms. Where the page
has an article or main element, only elements round one can be wrappers. Such
an element ends what names and forms round it say, and main also what other
markup round it says; hidden stays hidden.

Defined results: null and empty html give an empty text; markup that never
closes is closed at the end, only script and style then take the rest of the
page with them; formulas (math) and the fallback text of objects and canvases
are text where they stand, a formula's annotations are not; a cut-off tag is
dropped; repeated rows are
extracted alike; only id, url and html are read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, table

# Element and name lists of common page layouts.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea iframe svg annotation annotation-xml title select button".split())
BOILER_TAGS = frozenset("nav footer aside menu dialog head header".split())
FORM_TAGS = frozenset("form fieldset".split())
BODY_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag ends these elements if they are open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
SCOPES = frozenset("ul ol dl table div section article main body nav aside footer header form blockquote menu".split())
BOILER_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentary consent cookie cookies "
    "disclaimer disqus donate footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices pager "
    "pagination popup privacy promo promoted promotion recommended related replies reply reviews share sharing sidebar skip social "
    "sponsor sponsored subscribe subscription tags toc toolbar widget widgets".split()
)
BODY_NAMES = frozenset("article body content entry main post story text".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert".split())
#: What boilerplate costs a block, and the shares of the page between which a name's cost falls to nothing.
BOILER_COST = 9.0
PART, WRAPPER = 0.4, 0.8

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?/][^>]*>",
    re.S,
)
CUT_TAG = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)?\Z")
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME_PART = re.compile(r"[a-zA-Z]+")


class Element:
    """An element: what its own markup says, and after :func:`settle` how much
    it and its ancestors speak for content or boilerplate."""

    __slots__ = ("tag", "number", "depth", "parent", "holder", "link", "named", "region", "hidden", "content", "explicit",
                 "words", "holds", "hard", "soft", "cost", "boiler", "body")

    def __init__(self, tag, number, parent, attrs):
        self.tag, self.number, self.parent = tag, number, parent
        self.depth = parent.depth + 1 if parent else 0
        self.holder = self if tag in BLOCK_TAGS or parent is None else parent.holder
        self.link = tag == "a" or bool(parent and parent.link)
        names = self.region = self.hidden = False
        self.content = self.explicit = tag in BODY_TAGS
        if attrs and tag not in ("html", "body"):
            for m in ATTR.finditer(attrs):
                name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
                if name in ("class", "id"):
                    parts = set(NAME_PART.findall(value))
                    names = names or not parts.isdisjoint(BOILER_NAMES)
                    self.content = self.content or not parts.isdisjoint(BODY_NAMES)
                elif name == "role":
                    self.region = self.region or value in ROLES
                    names = names or value == "form"
                    self.explicit = self.explicit or value in ("main", "article")
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                    self.hidden = True
        self.content = self.content or self.explicit
        self.named = tag in FORM_TAGS or names and tag not in BODY_TAGS
        # An article of a comment list or of related pages is none that ends anything.
        self.explicit = self.explicit and not (names or self.region or self.hidden)
        self.words = self.holds = 0


def settle(elements: list[Element], blocks: list[Block]) -> None:
    """Costs of all elements; ``elements`` has parents before their children."""
    for block in blocks:
        block.element.words += (block.text.count(" ") + 1) * (1.0 - block.links)
    for e in reversed(elements):
        e.holds += e.explicit
        if e.parent is not None:
            e.parent.words += e.words
            e.parent.holds += e.holds
    page = elements[0]
    for e in elements:
        up = e.parent
        own = 0.0
        if e.named:
            share = e.words / page.words if page.words and (e.holds or not page.holds) else 0.0
            own = BOILER_COST * min(1.0, max(0.0, (WRAPPER - share) / (WRAPPER - PART)))
        region = e.region or e.tag in BOILER_TAGS and not (e.tag == "header" and up is not None and up.body)
        e.hidden = e.hidden or bool(up and up.hidden)
        e.hard = region or bool(up and up.hard and not (e.explicit and e.tag != "article"))
        e.soft = own if up is None or e.explicit else max(own, up.soft)
        e.cost = BOILER_COST if e.hidden or e.hard else e.soft
        e.boiler = e.cost > BOILER_COST / 2
        against = region or e.hidden or own > BOILER_COST / 2
        e.body = not against and (e.content or bool(up and up.body))


class Block:
    __slots__ = ("text", "element", "links", "heading")

    def __init__(self, text, element, links, heading):
        self.text, self.element, self.links, self.heading = text, element, links, heading


class OpenElements:
    """The open elements, with the places of each name and of all scopes, so no
    end tag searches the stack. The root stays."""

    def __init__(self, root: Element):
        self.stack, self.places, self.scopes = [root], {}, []

    def push(self, element: Element):
        self.places.setdefault(element.tag, []).append(len(self.stack))
        if element.tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.stack.append(element)

    def last(self, *tags: str) -> int:
        """The highest place of an open element of one of these names; 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def cut(self, place: int):
        """Close the element at ``place`` and all above it."""
        while len(self.stack) > place:
            gone = self.stack.pop()
            self.places[gone.tag].pop()
            if gone.tag in SCOPES:
                self.scopes.pop()

    def scope(self) -> int:
        return self.scopes[-1] if self.scopes else 0


def text_blocks(page: str) -> list[Block]:
    """The page's non-empty text blocks in order."""
    out: list[Block] = []
    root = Element("html", 0, None, "")
    opened, elements = OpenElements(root), [root]
    stack = opened.stack
    endless: set[str] = set()
    pieces: list[str] = []
    linked = 0
    heading = False

    def end_block():
        nonlocal linked, heading
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, stack[-1].holder, min(1.0, linked / len(text)), heading))
            pieces.clear()
        linked, heading = 0, False

    def add(text):
        nonlocal linked
        if text:
            pieces.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    at, size = 0, len(page)
    tags_end = page.rfind(">") + 1  # after it no tag is complete
    while at < size:
        m = TAG.search(page, at, tags_end) if at < tags_end else None
        if m is None and (comment := page.find("<!--", at)) >= 0:
            add(page[at:comment])
            break  # a comment that never closes
        if m is None:
            rest = page[at:]
            add(CUT_TAG.sub("", rest))
            break
        add(page[at : m.start()])
        at = m.end()
        closing, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break  # a comment that never closes
            continue  # a comment or a declaration
        tag = tag.lower()
        if closing:
            if tag in BLOCK_TAGS:
                end_block()
            place = opened.last(tag)
            # A stray end tag doesn't leave its container.
            if place and (tag in SCOPES or tag not in BLOCK_TAGS or place > opened.scope()):
                opened.cut(place)
            continue
        if tag in RAW_TAGS and not attrs.endswith("/"):
            if tag in BLOCK_TAGS:
                end_block()
            end = None if tag in endless else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif tag in ("script", "style"):
                at = size
            else:
                endless.add(tag)  # never closed: the tag alone is dropped
            continue
        if tag in BLOCK_TAGS:
            end_block()
            place = opened.last("p", *CLOSES.get(tag, ()))
            if place > opened.scope():
                opened.cut(place)
        if tag in VOID_TAGS:
            if tag in ("br", "wbr", "img", "hr"):
                pieces.append(" " if tag != "wbr" else "")
            continue
        if not attrs.endswith("/"):
            opened.push(Element(tag, len(elements), stack[-1], attrs))
            elements.append(stack[-1])
            heading = heading or tag in HEADINGS
    end_block()
    settle(elements, out)
    return out


def content_logit(block: Block) -> float:
    """Classifier: positive speaks for content, negative for boilerplate."""
    e, words = block.element, block.text.count(" ") + 1
    z = -0.8 + 0.55 * math.log1p(words) - 4.0 * block.links
    z += 4.0 if e.body else 0.0
    z -= e.cost
    z += 1.0 if block.heading and not e.boiler else 0.0
    z += 0.4 if block.text[-1] in ".!?\"”»…" else 0.0
    return z


def closeness(a: Element, b: Element) -> float:
    """Share of the deeper path that two elements have in common."""
    deepest = max(a.depth, b.depth, 1)
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a.depth / deepest


def smoothness(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Edges between neighbours in the page and neighbours inside one parent element."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        parent = block.element.parent or block.element
        for j in {i - 1, last.get(parent.number, -1)}:
            if j >= 0:
                near = closeness(blocks[j].element, block.element)
                # Markup that says opposite things is a border between regions.
                border = blocks[j].element.boiler != block.element.boiler or blocks[j].element.body != block.element.body
                edges[j, i] = (0.1 if border else 1.0) * (0.2 + 1.3 * near)
        last[parent.number] = i
    return edges


def min_cut(terminal: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Labels (True: source side) that minimise cut terminal and smoothness capacities.

    A node whose terminal capacity is at least the sum of its edges takes its
    own side in some minimum cut, so it is joined to that terminal first;
    max-flow by shortest augmenting paths decides the others.
    """
    n = len(terminal)
    scale = 1 << 16
    own = [round(t * scale) for t in terminal]
    capacity: list[dict[int, int]] = [{} for _ in range(n)]
    for (i, j), w in edges.items():
        c = round(w * scale)
        capacity[i][j] = capacity[i].get(j, 0) + c
        capacity[j][i] = capacity[j].get(i, 0) + c
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is None and abs(own[i]) >= sum(capacity[i].values()) and own[i] != 0:
            side[i] = own[i] > 0
            for j, c in capacity[i].items():
                own[j] += c if side[i] else -c
                del capacity[j][i]
                queue.append(j)
            capacity[i] = {}
    free = [i for i in range(n) if side[i] is None]
    if not free:
        return [bool(x) for x in side]
    return [bool(x) for x in max_flow_sides(free, own, capacity, side)]


def max_flow_sides(free: list[int], own: list[int], capacity: list[dict[int, int]], side: list[bool | None]) -> list[bool | None]:
    """``side`` with the free nodes: True for those that the source still reaches after a maximum flow, which
    goes phase by phase along all shortest paths (blocking flows), so long pages take few passes."""
    into = {i: max(own[i], 0) for i in free}  # what is left of the edges from the source
    out = {i: max(-own[i], 0) for i in free}  # and of those to the sink
    left = {i: dict(capacity[i]) for i in free}
    while True:
        level = {i: 0 for i in free if into[i]}
        queue, found = deque(level), False
        while queue:
            i = queue.popleft()
            found = found or out[i] > 0
            for j, c in left[i].items():
                if c and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not found:
            break
        ways, tried = {i: list(left[i]) for i in level}, dict.fromkeys(level, 0)
        for start in [i for i in level if level[i] == 0]:
            path = [start]
            while path and into[start]:
                i = path[-1]
                if out[i]:
                    push = min(into[start], out[i], *(left[x][y] for x, y in zip(path, path[1:])))
                    into[start] -= push
                    out[i] -= push
                    for x, y in zip(path, path[1:]):
                        left[x][y] -= push
                        left[y][x] += push
                    full = next((k for k, (x, y) in enumerate(zip(path, path[1:])) if not left[x][y]), None)
                    if full is not None:
                        del path[full + 1 :]
                    continue
                while tried[i] < len(ways[i]):
                    j = ways[i][tried[i]]
                    if left[i][j] and level.get(j) == level[i] + 1:
                        path.append(j)
                        break
                    tried[i] += 1
                else:
                    path.pop()
                    if path:
                        tried[path[-1]] += 1
    for i in free:
        side[i] = i in level
    return side


def main_text(page: str) -> str:
    """The main text of one page."""
    blocks = text_blocks(page)
    labels = min_cut([content_logit(b) for b in blocks], smoothness(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, labels) if keep)


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``."""

    def run(batch):
        texts = [main_text(h.as_py() or "") for h in batch.column("html")]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")
    )
    return rows.mapInArrow(arrow_rows(run, RESULT), "page_id bigint, url string, text string, n_chars bigint")


def op10(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))
