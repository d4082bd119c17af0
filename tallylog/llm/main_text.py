"""Main text of web pages by minimum cuts.

A page becomes a graph of its text blocks. Each block is tied to the source (content) or the sink (boilerplate) by
what a classifier of its marks, length and links would pay for the other label. Neighbouring blocks,
and blocks of one parent, are tied to each other, the closer in the document tree the stronger. A maximum flow finds the
cheapest cut, and the blocks on the source's side are the text. So a short line between paragraphs stays, and a
long sentence in a footer goes, although alone each would be taken for the other.

Pages are independent: each is cut in the task that reads it, and nothing is shuffled.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylog.llm.common import small_batches

_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_TOKEN = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas audio video noembed noframes xmp".split())
# Elements that a start tag of the key closes if one of them is open, up to the element that bounds the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Marks against. Strong ones name what no article lies in, unless a main element does; the others also name wrappers of whole
# pages (forms, shells of layouts), so they weigh by what they hold.
STRONG_TAGS = frozenset("nav footer aside menu dialog button select label legend".split())
WEAK_TAGS = frozenset("form fieldset search header".split())
FOR_TAGS = frozenset("article main".split())
STRONG = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner cookie cookies consent gdpr nav navbar navigation menu "
    "menubar breadcrumb breadcrumbs pagination pager footer foot copyright comment comments commentlist disqus reply replies "
    "respond hidden skip sitemap contentinfo".split()
)
WEAK = frozenset(
    "sponsor sponsored promo promoted promotion notice notices notification alert popup modal overlay legal header masthead topbar "
    "sidebar side rail widget widgets aside complementary discussion form login signup signin register search searchform subscribe "
    "subscription newsletter share sharing social related recommend recommended recommendations trending toolbar dialog".split()
)
FOR = frozenset("article content main post entry story text body maincontent articlebody".split())
# A name with one of these words, such as has-sidebar, is about the layout and not about what the element holds.
STATES = frozenset("has no not with without enabled disabled overflow".split())

# Capacities. A mark weighs as much as a paragraph; a tie between neighbours less than either.
MARK_FOR, MARK_AGAINST = 600, -900
LEAST_WITHIN, MOST_WITHIN = -500, 300
TIE = 240
# The share that an element holds is taken of this many characters more.
SMOOTHING = 200

_MAIN, _FOR, _NONE, _WEAK, _STRONG = 2, 1, 0, -1, -2


class Block(NamedTuple):
    text: str
    node: int  # number of the innermost open element
    link_chars: int
    heading: bool = False


class Tree(NamedTuple):
    """The elements of a page in the order of their start tags; number 0 is the page."""

    parent: list[int]
    depth: list[int]
    says: list[int]  # what an element's own marks say


def _mark(tag: str, attributes: str) -> int:
    """What an element says about its text."""
    if tag in ("html", "body"):
        return _NONE
    found = _MAIN if tag == "main" else _FOR if tag in FOR_TAGS else _STRONG if tag in STRONG_TAGS else _WEAK if tag in WEAK_TAGS else _NONE
    if not attributes:
        return found
    words: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop"):
            for one in value.strip("\"'").split():
                parts = _TOKEN.findall(_CAMEL.sub(" ", one).lower())
                if STATES.isdisjoint(parts):
                    words.update(parts)
        elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return _STRONG
    speaks_for = not words.isdisjoint(FOR)
    against = _STRONG if not words.isdisjoint(STRONG) else _WEAK if not words.isdisjoint(WEAK) else _NONE
    if against == _WEAK and (found == _MAIN or found == _FOR and speaks_for):
        return found
    if against and not (speaks_for and found == _NONE):
        return min(against, found)
    if speaks_for and not against and found == _NONE:
        return _FOR
    return found


def blocks(page: str) -> tuple[list[Block], Tree]:
    """The text blocks of a page in order, and its elements; markup may be broken or cut off anywhere.

    The work grows with the length of the page, however deep its elements lie in each other.
    """
    out: list[Block] = []
    tree = Tree([0], [0], [_NONE])
    stack: list[tuple[str, int]] = [("", 0)]  # tag, number
    places: dict[str, list[int]] = {}  # where on the stack the elements of a tag are
    texts: list[str] = []
    linked = headings = at = 0
    end = len(page)

    def last(tags: Iterable[str]) -> int:
        return max((places[tag][-1] for tag in tags if places.get(tag)), default=0)

    def flush() -> None:
        nonlocal linked
        if texts:
            text = _SPACE.sub(" ", "".join(texts)).strip()
            if text:
                out.append(Block(text, stack[-1][1], linked, headings > 0))
            texts.clear()
        linked = 0

    def close(index: int) -> None:
        nonlocal headings
        if any(tag in BLOCKS for tag, _ in stack[index:]):
            flush()
        while len(stack) > index:
            tag, _ = stack.pop()
            places[tag].pop()
            headings -= tag in HEADINGS

    while at < end:
        tag_at = page.find("<", at)
        if tag_at < 0:
            tag_at = end
        if tag_at > at:
            text = entities.unescape(page[at:tag_at])
            texts.append(text)
            if places.get("a"):
                linked += len(text.strip())
        if tag_at == end:
            break
        match = _NAME.match(page, tag_at)
        if match is None:
            if page.startswith("<!--", tag_at):
                done = page.find("-->", tag_at + 4)
                at = end if done < 0 else done + 3
            elif page.startswith(("<!", "<?", "</"), tag_at):
                done = page.find(">", tag_at)
                at = end if done < 0 else done + 1
            else:  # a lone sign, or a tag cut off right away
                texts.append("<" if tag_at + 1 < end else "")
                at = tag_at + 1
            continue
        tag = match[1].lower()
        done = _tag_end(page, match.end())
        if done < 0:  # cut off within a tag
            break
        at = done + 1
        if page[tag_at + 1] == "/":
            if places.get(tag):
                close(places[tag][-1])
            elif tag in BLOCKS:
                flush()
            continue
        if tag in EMPTY:
            if tag == "br":
                texts.append(" ")
            elif tag in BLOCKS:
                flush()
            continue
        attributes = page[match.end() : done]
        if tag in RAW:
            if not attributes.endswith("/"):
                at = _raw_end(page, tag, at)
            if tag in BLOCKS:
                flush()
            continue
        if tag in BLOCKS:
            paragraph = last(["p"])
            if paragraph > last(["td", "th", "button", "object", "caption"]):
                close(paragraph)
            if tag in CLOSES:
                closed, bounds = CLOSES[tag]
                open_one = last(closed)
                if open_one > last(bounds):
                    close(open_one)
            flush()
        tree.parent.append(stack[-1][1])
        tree.depth.append(len(stack))
        tree.says.append(_mark(tag, attributes))
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, len(tree.parent) - 1))
        headings += tag in HEADINGS
    flush()
    return out, tree


def marks(found: list[Block], tree: Tree) -> list[int]:
    """For every element what its marks, and those of what it lies in, are worth: positive for content.

    A strong mark against counts in full, unless a main element lies in it. A weak one says nothing about an element that holds
    half of the page's solid text and, for half of its own, an element marked as content. Where no text outside is marked as
    content it loses weight as the element holds more than half of it and the text without marks. The cheapest cut decides.
    """
    n = len(tree.parent)
    strong, weak, has_main = [False] * n, [False] * n, [False] * n
    for k in range(n - 1, 0, -1):
        if has_main[k] or tree.says[k] == _MAIN:
            has_main[tree.parent[k]] = True
    for k in range(1, n):
        strong[k] = strong[tree.parent[k]] and tree.says[k] != _MAIN or tree.says[k] == _STRONG and not has_main[k]
        weak[k] = weak[tree.parent[k]] or tree.says[k] == _WEAK
    solid, unmarked = [0] * n, 0  # characters of blocks that are content by themselves
    for block in found:
        if not strong[block.node] and alone(block) > 0:
            solid[block.node] += len(block.text)
            unmarked += 0 if weak[block.node] else len(block.text)
    most, marked = [0] * n, [0] * n  # the largest content element inside, and the text marked as content
    for k in range(n - 1, 0, -1):
        up, is_content = tree.parent[k], tree.says[k] > 0 and not strong[k]
        solid[up] += solid[k]
        most[up] = max(most[up], solid[k] if is_content else most[k])
        marked[up] += solid[k] if is_content else marked[k]
    costs = [0] * n
    for k in range(1, n):
        own = MARK_FOR if tree.says[k] > 0 else 0
        if tree.says[k] == _STRONG and strong[k]:
            own = MARK_AGAINST
        elif tree.says[k] == _WEAK:
            holds_article = 2 * solid[k] >= solid[0] and 2 * most[k] >= solid[k] > 0
            if not holds_article:
                own = MARK_AGAINST
                if marked[0] == marked[k]:
                    whole = solid[k] + unmarked + SMOOTHING
                    own = min(whole, 2 * (whole - solid[k])) * MARK_AGAINST // whole
        above = costs[tree.parent[k]]
        # What lies in boilerplate is boilerplate.
        costs[k] = min(above, own) if min(above, own) < 0 else own or above
    return costs


def _tag_end(page: str, at: int) -> int:
    """Where the sign that ends a tag is, outside of quoted values; -1 if the tag has no end."""
    first = page.find(">", at)
    if first < 0 or "=" not in page[at:first]:
        return first
    place = at
    while place < len(page):
        sign = page[place]
        if sign == ">":
            return place
        if sign in "\"'" and page[place - 1] == "=":
            closing = page.find(sign, place + 1)
            if closing < 0:
                return first
            place = closing
        place += 1
    return first


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where the content of an element whose content is no text ends, its end tag included."""
    match = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
    return match.end() if match else len(page)


def alone(block: Block) -> int:
    """What a block's length, links and ending say, whatever it lies in."""
    words = block.text.count(" ") + 1
    found = 40 * min(words, 25) - 200 - 900 * min(block.link_chars, len(block.text)) // len(block.text)
    if block.heading or block.text[-1] in ".!?:;…\"'”»":
        found += 150
    return found


def worth(block: Block, mark: int) -> int:
    """What the label boilerplate would cost for a block, or content, if negative."""
    if mark > 0:
        return mark + max(alone(block), LEAST_WITHIN)
    if mark < 0:
        return mark + min(alone(block), MOST_WITHIN)
    return alone(block)


def distance(tree: Tree, a: int, b: int) -> int:
    """Steps between two elements of a page."""
    steps = 0
    while a != b:
        if tree.depth[a] < tree.depth[b]:
            a, b = b, a
        a = tree.parent[a]
        steps += 1
    return steps


def ties(found: list[Block], tree: Tree) -> list[tuple[int, int, int]]:
    """Edges between neighbours, and between neighbours among the blocks of one parent."""
    edges = []
    last_of: dict[int, int] = {}
    for at, block in enumerate(found):
        parent = tree.parent[block.node]
        before = last_of.get(parent)
        for other in {at - 1, -1 if before is None else before} - {-1}:
            edges.append((other, at, TIE // (distance(tree, block.node, found[other].node) + 1)))
        last_of[parent] = at
    return edges


def minimum_cut(worths: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """For each node whether it is on the source's side of a minimum cut, by maximum flow in level graphs.

    Of several minimum cuts it is the one with the smallest side of the source.
    """
    n = len(worths)
    left = [max(w, 0) for w in worths]  # what the source still offers
    need = [max(-w, 0) for w in worths]  # what the sink still takes
    arcs: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[int] = []
    for a, b, capacity in edges:
        arcs[a].append(len(to))
        arcs[b].append(len(to) + 1)
        to += [b, a]
        room += [capacity, capacity]
    while True:
        level = [-1] * n
        queue = deque(k for k in range(n) if left[k])
        for k in queue:
            level[k] = 0
        reached = False
        while queue:
            k = queue.popleft()
            reached = reached or need[k] > 0
            for arc in arcs[k]:
                if room[arc] and level[to[arc]] < 0:
                    level[to[arc]] = level[k] + 1
                    queue.append(to[arc])
        if not reached:
            return [depth >= 0 for depth in level]
        following = [0] * n
        for start in range(n):
            path: list[int] = []
            k = start
            while left[start] and level[start] == 0:
                if need[k]:
                    flow = min([left[start], need[k], *(room[arc] for arc in path)])
                    left[start] -= flow
                    need[k] -= flow
                    for arc in path:
                        room[arc] -= flow
                        room[arc ^ 1] += flow
                    path.clear()
                    k = start
                    continue
                while following[k] < len(arcs[k]):
                    arc = arcs[k][following[k]]
                    if room[arc] and level[to[arc]] == level[k] + 1:
                        break
                    following[k] += 1
                else:
                    if not path:
                        break
                    k = to[path.pop() ^ 1]
                    following[k] += 1
                    continue
                path.append(arc)
                k = to[arc]


def extract(page: str | None) -> str:
    """The main text of a page: its content blocks, one a line."""
    if not page:
        return ""
    found, tree = blocks(page)
    costs = marks(found, tree)
    worths = [worth(block, costs[block.node]) for block in found]
    if min(worths, default=0) < 0:
        content = minimum_cut(worths, ties(found, tree))
        found = [block for block, kept in zip(found, content) if kept]
    return "\n".join(block.text for block in found)


@F.arrow_udf(T.StringType())
def _extracted(pages: pa.Array) -> pa.Array:
    return pa.array([extract(page.as_py()) for page in pages], pa.string())


def main_text(column: Column) -> Column:
    """The main text of html; empty for null."""
    return _extracted(column.cast("string"))


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Null and empty html, and pages without content, give an empty text. Repeated rows give the same
    text each; an empty table gives no rows; other columns play no part.
    """
    each = small_batches(pages).select(F.col(key).alias("page_id"), F.col(url).alias("url"), main_text(F.col(html)).alias("text"))
    return each.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
