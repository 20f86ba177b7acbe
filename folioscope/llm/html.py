r"""Main-text extraction by tree scoring.

A tolerant parser builds the tree (void elements, implied ends of p, li, td and the like, raw text of script and style).
Unwanted parts go first: by tag (nav, header, footer, aside, form, script, ...), by role, by being hidden, and by the words
of class and id. Such words count as parts of a name: what only says how something is laid out (``with-sidebar``,
``has-header``, ``menu-open``, ``header-image``) is no evidence. Adverts and notices go, unless a word like ``article`` or
``content`` stands beside; reader comments go, unless the page's ``main`` or ``article`` is in them; menus, sidebars and other
layout go, unless the elements of that name hold three quarters of all prose of the page, and so are its frame.

Each paragraph (25 characters or more of text between block borders) gives points, 1 + its commas + 1 per 100 characters up
to 3, to its parent, half of these to its grandparent, a quarter to the next, and so on; a container's score is its points
and a weight of its tag and class, times 1 - link density. The best container is kept with those siblings, text beside it
included, of which links make up less than a quarter, of any length, or that score at least a fifth of it; lists of links in
these, three or more that make up three quarters of the text, are menus and go. An ``article`` or
``main`` that holds the best container is kept whole; what stands beside it must be prose of some length or score as much.

Output: character references decoded, white space inside a block made one space, blocks joined by one newline. Every step is
linear in the page: open elements are looked up by name on the parser's stack, and points are passed up level by level.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from . import scan

SCHEMA = "page_id long, url string, text string, n_chars long"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe object svg math canvas textarea title xmp noembed noframes select button".split())
_TEXT_ONLY = frozenset("script style textarea title xmp noembed noframes iframe".split())
_DROP = _RAW | frozenset("nav header footer aside form head menu dialog fieldset audio video label option".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_CLOSES = {  # an opening tag ends these, up to the given containers
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
_P = ("p",)
_P_UNTIL = ("div", "article", "section", "td", "li", "blockquote", "body", "main", "table", "aside", "form", "button")
_PARAGRAPH = frozenset(("p", "pre", "td", "blockquote"))
_BLOCKS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul center".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_AD = re.compile(
    r"(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|notice\w*|cookie\w*|consent|gdpr|newsletter\w*|subscri\w*|signup|login|popup\w*|modal\w*"
    r"|overlay\w*|alert\w*|social\w*|share\w*|sharing|pagination|pager|skip\w*|hidden)"
)
_COMMENT = re.compile(r"(?:comment\w*|disqus\w*|replies|respond|reply)")
_LAYOUT = re.compile(
    r"(?:menu\w*|nav\w*|breadcrumb\w*|sidebar\w*|side|widget\w*|footer\w*|foot|header\w*|masthead|toolbar|related\w*|recommend\w*|copyright|legal|disclaimer|tags?)"
)
_STEMS = "menu nav breadcrumb side widget foot header masthead toolbar related recommend copyright legal disclaimer tag".split()
_MAIN = frozenset("article content entry hentry hfeed main page post story text blog body".split())
_STATE_FIRST = frozenset("with has have no not without is are hide show js can if enable enabled disable disabled page template layout theme".split())
_STATE_LAST = frozenset("open opened closed enabled disabled active inactive visible on off true false image img photo bg background layout template width free accepted dismissed allowed".split())
_AD_LEVEL, _COMMENT_LEVEL, _GONE_LEVEL = "ad", "comment", "gone"
_GOOD = re.compile(r"article|body|content|entry|hentry|main|page|post|story|text|blog", re.I)
_BAD_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())


class Node:
    __slots__ = ("tag", "name", "parent", "children", "points", "chars", "linked", "links", "suspect")

    def __init__(self, tag: str, name: str, parent: Node | None, suspect: str = "") -> None:
        self.tag, self.name, self.parent, self.suspect = tag, name, parent, suspect
        self.children: list[Node | str] = []
        self.points, self.chars, self.linked, self.links = 0.0, 0, 0, 0


def suspicion(name: str) -> str:
    """What class and id say: ``gone`` (an advert or notice), ``comment``, a word of layout, or nothing."""
    names = name.split()
    plain = any(n.lower() in _MAIN for n in names)
    found = ""
    for n in names:
        parts = [w.lower() for w in _WORD.findall(n)]
        if parts[:2] in (["sr", "only"], ["screen", "reader"]):
            return _GONE_LEVEL
        if len(parts) > 1 and (parts[0] in _STATE_FIRST or parts[-1] in _STATE_LAST):
            continue
        for w in parts:
            if _COMMENT.fullmatch(w):
                return _COMMENT_LEVEL
            if _AD.fullmatch(w):
                found = found or (_AD_LEVEL if plain else _GONE_LEVEL)
            elif not found and _LAYOUT.fullmatch(w):
                found = next(s for s in _STEMS if w.startswith(s))
    return found


_SUSPICION: dict[str, str] = {}


def _unwanted(tag: str, attributes: str) -> tuple[bool, str, str]:
    """Whether an element goes, its class and id, and what these make of it."""
    if tag in _DROP:
        return True, "", ""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False, "", ""
    a = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    name = f"{a.get('class', '')} {a.get('id', '')}".strip()
    if tag in ("body", "html", "main"):
        return False, name, ""
    if (found := _SUSPICION.get(name)) is None:
        found = suspicion(name)
        if len(_SUSPICION) < 10_000 and len(name) < 200:
            _SUSPICION[name] = found
    if tag == "article":
        return False, name, found if found == _COMMENT_LEVEL else ""
    gone = "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in _BAD_ROLE or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")))
    return gone or found == _GONE_LEVEL, name, found


class _Stack:
    """The open elements, with the places of each tag's, so that the nearest of a name is found without a walk."""

    def __init__(self, root: Node) -> None:
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of blocks, which end tags of inline elements don't cross
        self.skip = 0  # place of the unwanted element that we are inside of

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in _BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, size: int) -> None:
        while len(self.nodes) > size:
            node = self.nodes.pop()
            self.places[node.tag].pop()
            if node.tag in _BLOCKS:
                self.blocks.pop()
        if self.skip >= size:
            self.skip = 0

    def nearest(self, tags) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)


def parse(page: str) -> Node:
    """The tree of a page without the parts that are unwanted by themselves."""
    root = Node("html", "", None)
    stack = _Stack(root)
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            if not stack.skip:
                stack.nodes[-1].children.append(page[at:lt])
            at = lt
            continue
        m = _TOKEN.match(page, at)
        if not m or m.end() == at:
            if not stack.skip:
                stack.nodes[-1].children.append("<")
            at += 1
            continue
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA[") and not stack.skip:
                stack.nodes[-1].children.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        if m[1]:  # an end tag closes the nearest element of its name; without one it is ignored
            place = stack.nearest((tag,))
            if place and not (tag in _INLINE and stack.blocks and stack.blocks[-1] > place):
                stack.cut(place)
            continue
        if tag in ("html", "body"):
            continue
        if tag in _TEXT_ONLY:  # raw text up to its own end tag
            end = re.compile(f"</{re.escape(tag)}[\\s/>]|\\Z", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 if end and end.start() < n else n
            at = at or n
            continue
        ends, until = _CLOSES.get(tag, ((), ()))
        if tag in _BLOCKS:  # a block ends an open paragraph
            ends, until = _P, _P_UNTIL
        if ends and (place := stack.nearest(ends)) > stack.nearest(until):
            stack.cut(place)
        now = stack.nodes[-1]
        if tag in _VOID:
            if not stack.skip and tag in ("br", "hr"):
                now.children.append(Node(tag, "", now))
            continue
        gone, name, suspect = _unwanted(tag, m[3]) if not stack.skip else (False, "", "")
        if m[3].endswith("/") and tag not in _BLOCKS and tag not in _INLINE:
            if not stack.skip and not gone:
                now.children.append(Node(tag, name, now))
            continue
        child = Node(tag, name, now, suspect)
        if not stack.skip and not gone:
            now.children.append(child)
        elif not stack.skip:
            stack.skip = len(stack.nodes)
        stack.push(child)
    return root


def _ordered(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    return order


def _length(text: str) -> int:
    return len(_SPACE.sub(" ", text).strip())


def _prune(root: Node) -> None:
    """Takes out the suspects: see the module's text for which stay."""
    order = _ordered(root)
    if not any(x.suspect for x in order):
        return
    prose: dict[int, int] = {}  # characters outside links
    whole: dict[int, int] = {}  # those of the largest article or main inside
    for node in reversed(order):
        own = 0 if node.tag == "a" else sum(_length(c) for c in node.children if isinstance(c, str)) + sum(prose[id(c)] for c in node.children if isinstance(c, Node))
        prose[id(node)] = own
        inner = max((whole[id(c)] for c in node.children if isinstance(c, Node)), default=0)
        whole[id(node)] = max(inner, own) if node.tag in ("article", "main") and not node.suspect else inner
    total = prose[id(root)]
    of_name: dict[str, int] = {}
    within: dict[int, frozenset[str]] = {}
    for node in order:  # parents first: an element inside one of the same suspicion counts with it
        held = within[id(node.parent)] if node.parent is not None else frozenset()
        if node.suspect and node.suspect not in held:
            of_name[node.suspect] = of_name.get(node.suspect, 0) + prose[id(node)]
            held = held | {node.suspect}
        within[id(node)] = held
    stack = [root]
    while stack:
        node = stack.pop()
        kept: list[Node | str] = []
        for c in node.children:
            if isinstance(c, Node) and c.suspect:
                if c.suspect == _COMMENT_LEVEL:
                    stays = 2 * whole[id(c)] >= total > 0
                else:
                    stays = 4 * of_name[c.suspect] >= 3 * total > 0
                if not stays:
                    continue
            kept.append(c)
            if isinstance(c, Node):
                stack.append(c)
        node.children = kept


def _measure(root: Node) -> list[Node]:
    """Characters, linked characters and points of all elements, from the leaves up; returns the elements."""
    order = _ordered(root)
    flow: dict[int, tuple[int, int]] = {}  # characters and commas of the text between block borders
    for node in reversed(order):
        length = commas = 0
        for c in node.children:
            if isinstance(c, str):
                length += _length(c)
                commas += sum(c.count(x) for x in ",،、，")
            elif c.tag in _INLINE:
                length += flow[id(c)][0]
                commas += flow[id(c)][1]
        flow[id(node)] = length, commas
        node.chars += sum(_length(c) for c in node.children if isinstance(c, str))
        if node.tag == "a":
            node.linked, node.links = node.chars, 1
        mine = 0.0
        if length >= 25 and node.tag not in _INLINE:
            mine = 1 + commas + min(3, length // 100)
            if node.tag not in _PARAGRAPH:  # bare text of a container is a paragraph in it
                node.points += mine
                mine = 0.0
        if (up := node.parent) is not None:
            up.chars += node.chars
            up.linked += node.linked
            up.links += node.links
            # an inline element is no level of its own
            up.points += node.points if node.tag in _INLINE else mine + node.points / 2
    return order


def _score(node: Node) -> float:
    weight = {"article": 10, "main": 10, "div": 5, "section": 3, "blockquote": 3, "pre": 3, "td": 3, "form": -3, "ul": -3, "ol": -3, "dl": -3, "li": -3, "th": -5}.get(node.tag, 0)
    if node.name and _GOOD.search(node.name):
        weight += 5
    return (node.points + weight) * (1 - node.linked / max(1, node.chars)) if node.points else 0.0


def _is_menu(node: Node) -> bool:
    """A list or container of three or more links and little else."""
    return node.links >= 3 and 4 * node.linked >= 3 * node.chars and node.tag not in _INLINE and node.tag not in _PARAGRAPH


def _blocks(nodes: list[Node | str], menus: bool = True) -> list[str]:
    """The lines of the nodes; without ``menus``, those of lists of links are left out."""
    out: list[str] = []
    text: list[str] = []

    def flush() -> None:
        line = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
        if line:
            out.append(line)
        text.clear()

    for top in nodes:
        stack: list[tuple[Node | str, bool]] = [(top, False)]
        while stack:
            node, leaving = stack.pop()
            if isinstance(node, str):
                text.append(node)
            elif leaving:
                flush()
            elif node.tag in _INLINE:
                stack.extend((c, False) for c in reversed(node.children))
            elif not menus and _is_menu(node):
                flush()
            else:
                flush()
                stack.append((node, True))
                stack.extend((c, False) for c in reversed(node.children))
    flush()
    return out


def _runs(parent: Node) -> list[list[Node | str]]:
    """The children of an element: each block alone, text and inline elements that follow one another together."""
    out: list[list[Node | str]] = []
    inline = False
    for c in parent.children:
        if isinstance(c, str) or c.tag in _INLINE:
            if inline:
                out[-1].append(c)
            else:
                out.append([c])
            inline = True
        else:
            out.append([c])
            inline = False
    return out


def extract(page: str | None) -> str:
    """The main text of a page; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    _prune(root)
    order = _measure(root)
    scored = [(x, _score(x)) for x in order if x.tag not in _INLINE and x.points]
    if not scored:  # no paragraph: an article or main element if there is one, else all that is left
        whole = [x for x in order if x.tag in ("article", "main")][:1] or [root]
        return "\n".join(_blocks(whole))
    best, top = max(scored, key=lambda x: x[1])
    up: Node | None = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is not None:
        best = up
    siblings: list[Node | str]
    if best.parent is not None and best.tag in ("article", "main"):
        value = dict((id(x), s) for x, s in scored)
        siblings = []
        for s in best.parent.children:
            if s is best:
                siblings.append(s)
            elif isinstance(s, Node):
                density = s.linked / max(1, s.chars)
                alike = s.name == best.name != "" and s.tag == best.tag
                bonus = 0.2 * top if alike else 0
                prose = s.tag in ("p", "h1", "h2", "h3", "blockquote", "pre", "ul", "ol", "table") and density < 0.25 and (s.chars > 80 or s.tag[0] == "h")
                if value.get(id(s), 0) + bonus >= max(10, 0.2 * top) or prose and best.tag != "article":
                    siblings.append(s)
    else:
        value = dict((id(x), s) for x, s in scored)
        siblings = []
        for run in _runs(best.parent or best):
            chars = sum(s.chars if isinstance(s, Node) else len(_SPACE.sub(" ", s).strip()) for s in run)
            linked = sum(s.linked for s in run if isinstance(s, Node))
            first = run[0]
            alike = isinstance(first, Node) and first.name == best.name != "" and first.tag == best.tag
            scores = value.get(id(first), 0) + (0.2 * top if alike else 0) >= 0.2 * top
            if first is best or chars and (linked < 0.25 * chars or scores):
                siblings += run
            else:
                siblings.append(Node("br", "", best.parent))
    return "\n".join(_blocks(siblings, menus=up is not None))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null or empty html, and pages without text: empty text, 0. Pages are judged one by one: repeated rows give repeated
    results, and of containers that score alike the first wins. A null page_id or url stays null; extra columns are
    dropped; no page is cut. A narrow map: no shuffle.
    """
    rows = pages.selectExpr("cast(page_id as bigint) page_id", "cast(url as string) url", "cast(html as string) html")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [extract(x) for x in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return scan.map_arrow(rows, run, SCHEMA)
