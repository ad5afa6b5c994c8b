"""Main text of web pages by a minimum cut over their text blocks.

A page is cut into blocks of text at the tags of block elements. Every block is a node between a source
(content) and a sink (boilerplate). Its terminal capacities are the costs of a linear classifier over its
own words and links and the tags, classes and ids it stands in. Neighbouring blocks are joined by an edge,
as are blocks of one nearest container (through their neighbours in it): parting them costs something, more so if they are near in
the tree. The maximum flow gives the cheapest labelling; blocks on the source's side are the text.

Names such as "with-sidebar" or "has-comments" on a container around the page's article tell of what the
page has, not of all its text: see ``weigh``.

Where the cut leaves nothing of a page, it is made again with the costs of the blocks outside bad containers
raised by one amount, so that the best of them is content: a page of short plain lines keeps them.

Text of head, script, style, form controls and comments is never a block. Defined results: null, empty
and blank pages, and pages of markup alone, give an empty text. Unclosed and stray tags are taken as
browsers do: a closing tag ends what is open up to its match, or nothing; quotes count as such only where
a value begins; a last tag without its end is text if no ">" follows at all. Character references without
a semicolon are decoded where HTML knows them so. Whole pages are read, in time linear in their length, whatever
their markup. Null ids and repeated rows are rows like others, equal costs give equal labels on every run, an
empty table gives an empty result, and extra columns of any name are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import per_text

#: Fixed values of HTML: elements that break lines, that hold no elements, and whose text is not shown.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead "
    "tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template title textarea select option button iframe".split())
RAW = frozenset("script style textarea title iframe".split())
#: An opening tag of the first ends an open element of the second.
ENDS = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "td": "td th", "th": "td th", "tr": "tr td th", "option": "option"}

FRAME = frozenset(("html", "body", "main", "article"))

#: Classifier: log-odds for content of elements, and of words in class, id and role.
TAG_COST = {
    "article": 4.0, "main": 3.0, "nav": -7.0, "footer": -7.0, "aside": -7.0, "header": -3.0, "form": -7.0, "fieldset": -7.0, "menu": -7.0,
    "dialog": -7.0, "address": -2.0, "p": 0.7, "h1": 1.0, "h2": 0.7, "h3": 0.5, "blockquote": 0.7, "pre": 0.7, "table": 0.0, "li": -0.5,
    "td": -0.2, "figcaption": 0.3, "label": -3.0, "legend": -3.0,
}
GOOD = "article content post story entry main text body page-content prose"
BAD = (
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget ad ads advert advertisement adverts "
    "banner sponsor sponsored promo promotion cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login "
    "search form share sharing social related recommended comments comment reply replies disqus respond discussion reader pager pagination "
    "copyright legal toolbar skip hidden tags meta byline"
)
GOOD_COST, BAD_COST = 2.5, -7.0
CLASS_COST = {w: GOOD_COST for w in GOOD.split()} | {w: BAD_COST for w in BAD.split()}
ROLE_COST = {"navigation": -7.0, "banner": -4.0, "contentinfo": -7.0, "complementary": -7.0, "search": -7.0, "form": -7.0, "alert": -7.0, "main": 3.0, "article": 4.0}
#: Classifier: start, a word (up to WORDS), a sentence mark (up to MARKS), the share of linked characters.
START, WORD_COST, WORDS, MARK_COST, MARKS, LINK_COST = -0.6, 0.03, 40, 0.25, 4, -4.0
#: Capacity between neighbours in the page, and between neighbours of one container.
ADJACENT, SIBLING = 0.4, 0.8
#: Capacities below this are used up.
TINY = 1e-9
#: Cost of the best block of a page where the first cut left nothing.
RAISED = 1.0

# A value: quoted, or up to white space. All groups keep what they took, so no tag is read twice.
_VALUE = r"""=\s*+(?>"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|{_VALUE})*+)>", re.DOTALL
)
_ATTRIBUTES = re.compile(r"""([^\s>/=]++)(?:\s*+=\s*+(?>"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_SHOWN = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z]+")


def attributes_of(text: str) -> dict[str, str]:
    """Attributes by name, the first of a name, values decoded."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTES.findall(text):
        found.setdefault(name.lower(), unescape("".join(values)))
    return found


class Element:
    __slots__ = ("tag", "parent", "good", "bad", "named", "strong", "gone", "unseen", "hidden", "depth", "linked", "cost", "chars", "box")

    def __init__(self, tag: str, parent: Element | None, attributes: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        # The block element it stands in, or itself.
        self.box = self if parent is None or tag in BLOCKS else parent.box
        self.gone = bool(parent and parent.gone) or tag in HIDDEN
        self.unseen = bool(parent and parent.unseen)
        self.linked = tag == "a" or bool(parent and parent.linked)
        tag_cost = TAG_COST.get(tag, 0.0)
        # Own signs for content, against it by element and role, and against it by class and id.
        self.good, self.bad, self.named, self.strong = max(tag_cost, 0.0), min(tag_cost, 0.0), 0.0, tag in ("article", "main")
        known = attributes_of(attributes) if attributes else {}
        if known:
            style = dict((k.lower(), v.lower()) for k, v in _SHOWN.findall(known.get("style", "")))
            self.gone |= "hidden" in known and not known["hidden"].strip().lower().startswith("until")
            self.gone |= known.get("aria-hidden", "").strip().lower() == "true" or style.get("display") == "none"
            if "visibility" in style:
                self.unseen = style["visibility"] in ("hidden", "collapse")
            # Names on the page's frame tell of what it has somewhere, not of all its text.
            frame = tag in FRAME
            for word in _PARTS.split(known.get("role", "").lower()):
                sign = ROLE_COST.get(word, 0.0)
                self.strong |= word in ("article", "main")
                self.good, self.bad = max(self.good, sign), self.bad if frame else min(self.bad, sign)
            for name in ("class", "id"):
                for word in _PARTS.split(known.get(name, "").lower()):
                    sign = CLASS_COST.get(word, 0.0)
                    self.good, self.named = max(self.good, sign), self.named if frame and sign < 0 else min(self.named, sign)
                    if sign < 0:
                        self.strong = False
        self.hidden = self.gone or self.unseen
        self.chars = 0


class Block:
    __slots__ = ("text", "linked", "cost", "holder")

    def __init__(self, text: str, linked: int, holder: Element):
        self.text, self.linked, self.holder, self.cost = text, linked, holder, 0.0

    def weigh(self):
        words = self.text.count(" ") + 1
        marks = sum(map(self.text.count, ".!?…"))
        good, bad = self.holder.cost
        self.cost = START + good + bad + WORD_COST * min(words, WORDS) + MARK_COST * min(marks, MARKS) + LINK_COST * self.linked / len(self.text)


def inherit(elements: list[Element], frames: set[int] = frozenset()) -> None:
    """The strongest signs for and against, wherever above the block they stand; names of ``frames`` do not count against."""
    for e in elements:
        good, bad = e.parent.cost if e.parent else (0.0, 0.0)
        e.cost = max(good, e.good), min(bad, e.bad, 0.0 if id(e) in frames else e.named)


def weigh(elements: list[Element], found: list[Block]) -> None:
    """Costs of all blocks. ``elements``: all of the page, parents first.

    The page's main part is the article or main (else the element with a good name) with the most text,
    links aside, that has no bad name itself and stands in no nav, footer or the like. Where it has more text
    than all that stands in no bad container, the bad names of the containers around it do not count.
    """
    inherit(elements)
    if any(e.named for e in elements):
        clear = 0
        for block in found:
            n = len(block.text) - block.linked
            block.holder.chars += n
            clear += n if block.holder.cost[1] > BAD_COST else 0
        for e in reversed(elements):
            if e.parent:
                e.parent.chars += e.chars
        outside: dict[int, bool] = {}
        for e in elements:
            outside[id(e)] = e.bad <= BAD_COST or bool(e.parent and outside[id(e.parent)])
        able = [e for e in elements if e.chars and not e.named and not outside[id(e)]]
        able = [e for e in able if e.strong] or [e for e in able if e.good >= GOOD_COST and e.tag not in FRAME]
        # Of elements in each other with the same text, the innermost.
        best = max(able, key=lambda e: (e.chars, e.depth), default=None)
        if best and best.cost[1] <= BAD_COST and best.chars > clear:
            frames = set()
            while best.parent:
                best = best.parent
                frames.add(id(best))
            inherit(elements, frames)
    for block in found:
        block.weigh()


def blocks(html: str) -> list[Block]:
    """Blocks of shown text in page order: decoded, white space as one space, trimmed."""
    out: list[Block] = []
    top = here = Element("", None, "")
    elements = [top]
    parts: list[tuple[str, bool]] = []
    still_open: Counter[str] = Counter()

    def leave(element: Element) -> Element:
        """Ends what is open up to ``element``; what it stands in."""
        seek = here
        while seek is not element:
            still_open[seek.tag] -= 1
            seek = seek.parent
        still_open[element.tag] -= 1
        return element.parent

    def close():
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                linked = sum(len(" ".join(t.split())) for t, is_linked in parts if is_linked)
                out.append(Block(text, min(linked, len(text)), here.box))
            parts.clear()

    # Markup ends with the last ">": up to there every tag and comment has its end, or is none.
    at, size = 0, html.rfind(">") + 1
    while at < size:
        token = _TOKEN.search(html, at, size)
        start = token.start() if token else size
        if start > at and not here.hidden:
            parts.append((unescape(html[at:start]), here.linked))
        if not token:
            break
        at = token.end()
        if token[2] is None:
            if token[0].startswith("<!--") and not token[0].endswith(("-->", "--!>")):
                at = len(html)
            continue
        tag = token[2].lower()
        if tag in BLOCKS:
            close()
        if token[1]:
            if still_open[tag] > 0:
                seek = here
                while seek.tag != tag:
                    seek = seek.parent
                here = leave(seek)
            continue
        if tag in VOID:
            continue
        ended = ENDS.get(tag, "").split()
        if any(still_open[e] > 0 for e in ended):
            seek = here
            while seek.tag and seek.tag not in ended and (seek.tag not in BLOCKS or tag == "p"):
                if seek.tag in ("div", "article", "section", "body", "table", "ul", "ol", "td", "th", "li", "main", "nav", "footer", "header", "aside", "form"):
                    break
                seek = seek.parent
            if seek.tag in ended:
                here = leave(seek)
        if tag == "body":
            # A page's text begins here whatever was left open before.
            here = top
            still_open.clear()
        if not token[3].rstrip().endswith("/"):
            here = Element(tag, here, token[3])
            elements.append(here)
            still_open[tag] += 1
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
                at = end.start() if end else len(html)
    if not here.hidden and max(at, size) < len(html):
        parts.append((unescape(html[max(at, size) :].partition("<!--")[0]), here.linked))
    close()
    weigh(elements, out)
    return out


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source's side. A positive cost is capacity from the source, a negative one to the sink.

    Phases of shortest augmenting paths. What source and sink both give a node is settled before: its
    cost is the difference.
    """
    n = len(costs)
    left, room = [max(c, 0.0) for c in costs], [max(-c, 0.0) for c in costs]
    arcs: list[list[int]] = [[] for _ in range(n)]
    ends, flow = [], []
    for a, b, capacity in edges:
        arcs[a].append(len(ends))
        arcs[b].append(len(ends) + 1)
        ends += [b, a]
        flow += [capacity, capacity]
    while True:
        level, layer, depth, goal = [-1] * n, [i for i in range(n) if left[i] > TINY], 0, -1
        starts = layer
        for i in layer:
            level[i] = 0
        while layer:
            if any(room[i] > TINY for i in layer):
                goal = depth
                break
            depth, below = depth + 1, []
            for i in layer:
                for e in arcs[i]:
                    if flow[e] > TINY and level[ends[e]] < 0:
                        level[ends[e]] = depth
                        below.append(ends[e])
            layer = below
        if goal < 0:
            return [x >= 0 for x in level]
        tried = [0] * n
        for start in starts:
            while left[start] > TINY:
                path, i = [], start
                while not (level[i] == goal and room[i] > TINY):
                    while tried[i] < len(arcs[i]):
                        e = arcs[i][tried[i]]
                        if flow[e] > TINY and level[ends[e]] == level[i] + 1:
                            break
                        tried[i] += 1
                    if tried[i] < len(arcs[i]):
                        path.append(arcs[i][tried[i]])
                        i = ends[path[-1]]
                    elif path:
                        i = ends[path.pop() ^ 1]
                        tried[i] += 1
                    else:
                        i = -1
                        break
                if i < 0:
                    break
                most = min([left[start], room[i], *(flow[e] for e in path)])
                left[start] -= most
                room[i] -= most
                for e in path:
                    flow[e] -= most
                    flow[e ^ 1] += most


def page_edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges of neighbours in the page, and of neighbours in the container around their own element."""
    edges: list[tuple[int, int, float]] = []
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            a, b, steps = found[i - 1].holder, block.holder, 0
            while a is not b:
                if a.depth >= b.depth:
                    a = a.parent
                else:
                    b = b.parent
                steps += 1
            edges.append((i - 1, i, ADJACENT / (1 + steps)))
        box = id(block.holder.parent or block.holder)
        if box in last:
            edges.append((last[box], i, SIBLING))
        last[box] = i
    return edges


def labelled(html: str | None) -> list[tuple[str, bool]]:
    """Blocks of the page and whether each is content."""
    found = blocks(html or "")
    if not found:
        return []
    costs, edges = [b.cost for b in found], page_edges(found)
    sides = minimum_cut(costs, edges)
    plain = [b.holder.cost[1] > BAD_COST and 2 * b.linked < len(b.text) for b in found]
    if not any(sides) and any(plain):
        raised = RAISED - max(c for c, is_plain in zip(costs, plain, strict=True) if is_plain)
        sides = minimum_cut([c + raised if is_plain else c for c, is_plain in zip(costs, plain, strict=True)], edges)
    return list(zip([b.text for b in found], sides, strict=True))


def main_text(html: str | None) -> str:
    return " ".join(text for text, is_content in labelled(html) if is_content)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def one(html):
        text = main_text(html)
        return text, len(text)

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.col("html").alias("text"))
    schema = "page_id bigint, url string, text string, n_chars bigint"
    return rows.mapInArrow(per_text(one, ["page_id", "url"], ["text", "n_chars"]), schema)
