"""Main text of web pages by minimum-cut labelling of their blocks.

A page becomes a list of text blocks, each with its path of open elements. A linear classifier over
the path, the share of linked text, length and marks gives each block a cost of being called
boilerplate and a cost of being called content: the capacities from the source and to the sink, which
are bounded by ``LIMIT``. Neighbouring blocks are tied by smoothness edges, the stronger the nearer they
are in the tree, and so are blocks under one parent. The maximum flow separates the blocks at least total cost: a block
that the classifier is sure of keeps its label, and one it is not sure of goes with those around it.

A page is read once from its start to its end, however it is broken, and open elements are found by their
name, so time grows with the size of a page only.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts

#: Fixed values of HTML: elements that begin a block, hold raw text, have no end, or never hold page text.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option optgroup p pre search section select summary "
    "table tbody td textarea tfoot th thead title tr ul".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "script style title template noscript svg math canvas audio video object iframe noembed noframes select option optgroup "
    "datalist textarea button input map".split()
)
#: An opening tag of the first kind ends an open element of the second.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
#: Where the search for such an element ends.
SCOPES = frozenset("ul ol dl table body div article section main aside nav footer header form td th blockquote".split())

#: Elements and names of boilerplate. Weak names do not count within an article or beside a content name.
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset head".split())
BOILER_NAMES = re.compile(
    r"(?<![a-z])(?:ads?|advert|adverts|advertisements?|advertising|banners?|sponsor|sponsored|sponsors|promos?|promotions?|nav|navbar|"
    r"navigation|menus?|sidebars?|footers?|breadcrumbs?|pagination|pager|cookies?|consent|gdpr|notices?|popups?|modal|overlay|"
    r"comments?|commentlist|respond|replies|reply|disqus|discussion|social|shar(?:e|ing)|related|recommend(?:ed|ations?)?|newsletter|"
    r"subscribe|subscription|signup|login|search|toolbar|widgets?|copyright|disclaimer|skip|outbrain|taboola|"
    r"ad(?:box|slot|unit|space|wrap|wrapper|container)|cookie(?:bar|banner|notice)|(?:top|side|sub|main|site)(?:nav|menu|footer)|"
    r"(?:comment|reply)(?:form|box|section|area|thread))(?![a-z])"
)
WEAK_NAMES = re.compile(r"(?<![a-z])(?:headers?|masthead|side|rail|foot|legal|toc|tags|logo|brand|topbar|alerts?)(?![a-z])")
CONTENT_NAMES = re.compile(
    r"(?<![a-z])(?:article|articles|content|contents|entry|main|post|posts|story|text|body|prose|markdown|paragraph|lead|headline)(?![a-z])"
)
MODIFIER = re.compile(r"(?<![a-z])(?:has|with|without|no)-[\w-]+")
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

#: Names that are subjects as often as parts of a page. Within an article, and in one name with a content word, they are no
#: sign of boilerplate.
SUBJECTS = re.compile(
    r"(?<![a-z])(?:search|login|signup|shar(?:e|ing)|social|related|recommend(?:ed|ations?)?|discussion|notices?|subscription|copyright|disclaimer|"
    r"promotions?|promos?|banners?|sponsors?|consent|navigation|menus?)(?![a-z])"
)

#: Weights of the linear classifier; a score of UNSURE_NAME is added where a name says both.
BIAS, IN_ARTICLE, LINKED, LONG, SENTENCE, HEADING, BOILER, CONTENT_NAME, UNSURE_NAME = 0.5, 5.0, -3.0, 1.0, 0.8, 0.4, -12.0, 1.5, -1.0
#: At this weight an element is taken for boilerplate, whatever it holds.
LOST = -5.0
#: Largest capacity to a terminal. Edges between neighbours under one parent, under one grandparent, and further apart; and
#: between blocks under one grandparent. All edges of a block sum up to less than LIMIT.
LIMIT, SAME_PARENT, SAME_GRANDPARENT, APART, SIBLING = 4.0, 1.5, 1.0, 0.3, 0.4

_COMMENT_END = re.compile(r"--!?>")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""(?:^|[\s/])(id|class|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Element:
    """An open element, with what its ancestors and its own names weigh."""

    tag: str
    parent: Element | None
    weight: float = 0.0
    hidden: bool = False
    linked: bool = False
    article: bool = False
    number: int = 0
    holder: Element | None = None  # the nearest element that begins a block, itself or above


@dataclass
class Block:
    """A run of text between block borders."""

    parent: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _opened(tag: str, attributes: str, parent: Element, number: int) -> Element:
    weight, hidden = parent.weight, parent.hidden or tag in HIDDEN
    article = parent.article or tag in ("article", "main")
    if tag in BOILER_TAGS or tag == "header" and not article:
        weight += BOILER
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (values[0] or values[1] or values[2]).lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = True
            elif name == "style":
                hidden = hidden or "display:none" in value.replace(" ", "")
            elif name == "role":
                weight += BOILER if value in BOILER_ROLES else 0.0
                article = article or value in ("main", "article")
            elif name == "itemprop":
                article = article or value == "articlebody"
            elif tag not in ("body", "html"):
                value = MODIFIER.sub("", value)
                content = CONTENT_NAMES.search(value)
                if tag in ("article", "main"):
                    weight += BOILER if "comment" in value else 0.0
                elif BOILER_NAMES.search(value) or not article and not content and WEAK_NAMES.search(value):
                    weight += UNSURE_NAME if article and _unsure(value) else BOILER
                elif content:
                    weight += CONTENT_NAME
    article = article and weight > LOST
    made = Element(tag, parent, weight, hidden, parent.linked or tag == "a", article, number)
    made.holder = made if tag in BLOCKS else parent.holder
    return made


def _unsure(names: str) -> bool:
    """Whether each boilerplate word among the names is one of SUBJECTS, in a name that has a content word too."""
    for name in names.split():
        if BOILER_NAMES.search(name) and not (CONTENT_NAMES.search(name) and "comment" not in name and not BOILER_NAMES.search(SUBJECTS.sub("", name))):
            return False
    return True


class Tags:
    """Where the tags of a page end. A quoted value may hold the sign that ends a tag; once a quote is left open, quotes
    count no more."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = {quote: page.rfind(quote) for quote in "\"'"}
        self.quoted = True

    def end(self, at: int) -> int:
        """The place of the sign that ends the tag whose inside begins at ``at``; -1 if the page breaks off in it."""
        start = at
        while self.quoted:
            stop = _STOP.search(self.page, at)
            if stop is None:
                return -1
            if stop.group() == ">":
                return stop.start()
            if self.last[stop.group()] <= stop.start():
                self.quoted = False
            else:
                at = self.page.index(stop.group(), stop.end()) + 1
        return self.page.find(">", start)


def blocks_of(page: str) -> list[Block]:
    """The visible text blocks of a page, in order, white space made single blanks."""
    root = Element("", None)
    root.holder = root
    at, number, out = 0, 0, []
    stack = [root]
    opened: dict[str, list[int]] = {}  # places in the stack of the open elements of each name
    current: Block | None = None
    tags, size = Tags(page), len(page)

    def say(text: str) -> None:
        nonlocal current
        node = stack[-1]
        if node.hidden or not text:
            return
        text = html.unescape(text) if "&" in text else text
        if current is None:
            if text.isspace():
                return
            # marks inside the block (such as b) may carry names that count
            current = Block(node if node.weight != node.holder.weight else node.holder)
            out.append(current)
        current.parts.append(text)
        if node.linked:
            current.linked += len(text.strip())

    def close(tag: str, scope: frozenset = frozenset()) -> None:
        """Ends the innermost open element of a name, unless one of the scope is open within it."""
        places = opened.get(tag)
        if not places or any(opened.get(s) and opened[s][-1] > places[-1] for s in scope if s != tag):
            return
        down = places[-1]
        while len(stack) > down:
            opened[stack.pop().tag].pop()

    while at < size:
        sign = page.find("<", at)
        if sign < 0 or sign == size - 1:
            say(page[at:])
            break
        follows = page[sign + 1]
        if page.startswith("!--", sign + 1):
            say(page[at:sign])
            if page.startswith((">", "->"), sign + 4):
                at = page.index(">", sign + 4) + 1
                continue
            ended = _COMMENT_END.search(page, sign + 4)
            at = ended.end() if ended else size
            continue
        name = _NAME.match(page, sign + 1 + (follows == "/"))
        if name is None and follows not in "!?/":
            say(page[at : sign + 1])  # a sign that begins no tag is text
            at = sign + 1
            continue
        say(page[at:sign])
        inside = name.end() if name else sign + 2
        end = tags.end(inside) if name and follows != "/" else page.find(">", inside)
        if end < 0:
            break  # the page breaks off within a tag
        at = end + 1
        if name is None:
            continue
        tag = name.group().lower()
        if follows == "/":
            if tag in BLOCKS:
                current = None
            close(tag)
            continue
        attributes = page[inside:end]
        if tag in BLOCKS:
            current = None
        elif tag == "br" and current is not None:
            current.parts.append(" ")
        if tag in BLOCKS and tag != "p":
            close("p", frozenset(("button", "table", "td", "th")))
        elif tag == "p":
            close("p", SCOPES)
        for other in CLOSES.get(tag, ()):
            close(other, SCOPES - {other})
        if tag in EMPTY or attributes.endswith("/") and tag in ("svg", "path"):
            continue
        number += 1
        node = _opened(tag, attributes, stack[-1], number)
        opened.setdefault(tag, []).append(len(stack))
        stack.append(node)
        if tag in RAW:
            ended = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if tag not in HIDDEN:
                say(page[at : ended.start() if ended else size])
            close(tag)
            at = ended.end() if ended else size
            current = None if tag in BLOCKS else current
    kept = []
    for block in out:
        block.text = _SPACE.sub(" ", "".join(block.parts)).strip()
        if block.text:
            kept.append(block)
    return kept


def content_score(block: Block, has_article: bool) -> float:
    """Positive if the block looks like content: the log odds of a linear classifier."""
    node, text = block.parent, block.text
    words = text.count(" ") + 1
    score = BIAS + node.weight + LINKED * min(1.0, block.linked / max(len(text), 1))
    score += LONG * min(words, 40) / 20 + SENTENCE * (text[-1] in ".!?…:;\"'»”" or ". " in text)
    if has_article:
        score += IN_ARTICLE if node.article else -IN_ARTICLE
    elif words < 5:
        score -= 0.3
    if node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        score += HEADING
    return score


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source after a maximum flow (both ways along ``edges``).

    Level graphs and blocking flows; nodes that can be reached in the residual graph stay.
    """
    n = len(source)
    s, t = n, n + 1
    # what passes straight through a node is settled first
    through = [min(a, b) for a, b in zip(source, sink)]
    source = [a - c for a, c in zip(source, through)]
    sink = [b - c for b, c in zip(sink, through)]
    if not any(source) or not any(sink):
        return [x > 0 for x in source] if any(source) else [False] * n
    heads: list[int] = []
    room: list[float] = []
    around: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        around[a].append(len(heads))
        heads.append(b)
        room.append(there)
        around[b].append(len(heads))
        heads.append(a)
        room.append(back)

    for i in range(n):
        if source[i] > 0:
            edge(s, i, source[i], 0.0)
        elif sink[i] > 0:
            edge(i, t, sink[i], 0.0)
    for a, b, c in edges:
        edge(a, b, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in around[a]:
                if room[e] > tiny and level[heads[e]] < 0:
                    level[heads[e]] = level[a] + 1
                    queue.append(heads[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # go back to the first edge that is full
                full = next(i for i, e in enumerate(path) if room[e] <= tiny)
                a = heads[path[full] ^ 1]
                del path[full:]
            elif following[a] < len(around[a]):
                e = around[a][following[a]]
                if room[e] > tiny and level[heads[e]] == level[a] + 1:
                    path.append(e)
                    a = heads[e]
                else:
                    following[a] += 1
            elif path:
                a = heads[path.pop() ^ 1]
                following[a] += 1
            else:
                break


def capacities(blocks: list[Block]) -> list[float]:
    """Bounded scores: what it costs to call a block boilerplate, or, below zero, content."""
    has_article = any(b.parent.article for b in blocks)
    return [max(-LIMIT, min(content_score(b, has_article), LIMIT)) for b in blocks]


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and between a block and the one before it under the same grandparent."""
    edges, last_under = [], {}
    for i, block in enumerate(blocks):
        own, above = block.parent, block.parent.parent
        if i:
            other = blocks[i - 1].parent
            near = other.parent is above or other.parent is own or above is other
            weight = SAME_PARENT if own is other or own.tag == other.tag and other.parent is above else SAME_GRANDPARENT if near else APART
            edges.append((i - 1, i, weight))
        place = above.number if above else -1
        before = last_under.get(place)
        if before is not None and before != i - 1:
            edges.append((before, i, SIBLING))
        last_under[place] = i
    return edges


def labels(blocks: list[Block]) -> list[bool]:
    """True for the blocks that are content."""
    scores = capacities(blocks)
    return minimum_cut([max(x, 0.0) for x in scores], [max(-x, 0.0) for x in scores], smoothness(blocks))


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by a blank line."""
    if not page:
        return ""
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, kept in zip(blocks, labels(blocks)) if kept) if blocks else ""


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html", text: str = "text") -> DataFrame:
    """The ``keep`` columns of every page, and its main text.

    Null and empty pages, and pages without content, have empty text. Pages break off, leave
    elements open and repeat; each is handled alone and whole. Other columns are left out, so
    their names cannot clash. Narrow: nothing is shuffled.
    """

    def make():
        return lambda page: (main_text(page),)

    kept = [c for c in keep if c != text]
    return map_texts(pages, [html_col], kept, f"`{text}` string", {text: pa.string()}, make)
