"""Main text of web pages by minimum-cut labelling of their blocks."""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.text import per_text

# Elements by what HTML makes of them.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style title textarea noscript template iframe noframes noembed svg math object audio video canvas xmp".split())
LEAVES = frozenset("p li dd dt h1 h2 h3 h4 h5 h6 td th pre figcaption legend summary option".split())
#: Elements that a head may hold; any other start tag, and visible text, ends a head that is open.
IN_HEAD = frozenset("title meta link base basefont bgsound style script noscript template noframes head html".split())
#: What the start of an element closes: an open element of these, unless one of the limits is nearer.
CLOSES = {**{t: ({"p"}, frozenset()) for t in BLOCKS}, "li": ({"li", "p"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt", "p"}, {"dl"}), "dt": ({"dd", "dt", "p"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

# Classifier: evidence for content (above 0) or boilerplate (below 0), in log odds.
TAGS = {"article": 4.0, "main": 2.5, "nav": -7.0, "menu": -7.0, "footer": -7.0, "aside": -7.0, "form": -7.0, "fieldset": -7.0, "select": -7.0, "button": -7.0, "label": -4.0, "dialog": -7.0, "search": -7.0, "header": -3.0}
ROLES = {"main": 3.0, "article": 3.0, "navigation": -7.0, "banner": -5.0, "contentinfo": -7.0, "complementary": -7.0, "search": -7.0, "form": -7.0, "dialog": -7.0, "alert": -7.0, "alertdialog": -7.0, "menu": -7.0, "menubar": -7.0, "toolbar": -7.0, "note": -2.0}
GOOD_NAMES = frozenset("article content story entry post body main text".split())
BAD_NAMES = frozenset((
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall sidebar aside rail widget widgets menu nav navbar navigation "
    "breadcrumb breadcrumbs footer foot header masthead topbar toolbar comment comments commentlist disqus reply replies respond discussion reactions "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup signin login search form pagination pager copyright legal disclaimer skip"
).split())
HEADER_NAMES = {"header": -3.0, "text": 1.0, "body": 1.0}
GOOD_NAME, BAD_NAME, LIMIT = 2.0, -7.0, 8.0
#: Links weigh against a block, but less where its container is content by this much: an article has lists of links of its own.
LINKS, LINKS_INSIDE, INSIDE = -2.5, -0.4, 2.0
#: A form, or a wrapper around the page's heading, is no evidence if it holds this share of the page's words.
FORMS, WHOLE_FORM, WHOLE_WRAPPER = frozenset(("form", "fieldset", "label")), 0.5, 0.8

#: Smoothness between neighbouring blocks, more if they have one container, and to the previous block of the container.
ADJACENT, SAME_CONTAINER, CONTAINER = 0.4, 0.5, 0.5

TOKEN = re.compile(
    r"""<!--(?:>|->|(?P<comment>.*?)(?:--!?>|\Z))"""
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+|=)*+)>"""
    r"""|</?[a-zA-Z][^<>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.DOTALL,
)
ATTR = re.compile(r"""([^\s/>="']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Element:
    """An element: its own evidence, what it is in, and the words and headings below it."""

    tag: str
    own: float
    parent: int
    container: int
    link: bool
    hidden: bool
    article: bool
    leaf: str
    by_name: bool = False
    words: int = 0
    heading: bool = False
    total: float = 0.0


@dataclass
class Block:
    text: str
    score: float
    container: int
    owner: int = 0


def named(value: str) -> float:
    """Evidence from a class or id: the last word of each name counts, unless the name says "with" or "has" it."""
    total = 0.0
    for name in value.split():
        words = [w for w in re.split(r"[^a-z]+", CAMEL.sub("-", name).lower()) if w]
        if not words or {"with", "has", "no", "without", "hide", "show"} & set(words):
            continue
        if words[-1] in HEADER_NAMES:
            total += HEADER_NAMES[words[-1]]
        elif words[-1] in BAD_NAMES or words[0] in BAD_NAMES and words[-1] not in GOOD_NAMES:
            total += BAD_NAME
        elif words[-1] in GOOD_NAMES:
            total += GOOD_NAME
    return total


def element(tag: str, attrs: str, parent: Element, parent_at: int, number: int) -> Element:
    own, hidden, by_name = TAGS.get(tag, 0.0), parent.hidden, 0.0
    if tag == "header" and parent.article:
        own = 0.0  # an article's own heading
    if attrs and tag not in ("html", "body"):
        for m in ATTR.finditer(attrs):
            key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
            if key in ("class", "id"):
                by_name += named(value)
            elif key == "role":
                own += ROLES.get(value.strip().lower(), 0.0)
            elif key == "hidden" or key == "style" and HIDDEN.search(value) or key == "aria-hidden" and value.strip().lower() == "true":
                hidden = True
    block = tag in BLOCKS
    return Element(tag, own + by_name, parent_at, number if block and tag not in LEAVES else parent.container, parent.link or tag == "a", hidden,
                   parent.article or tag in ("article", "main"), tag if block else parent.leaf, by_name < 0)


def judged(elements: list[Element]) -> None:
    """Set every element's total evidence, from the outermost inwards.

    Good evidence adds up on the way in.  Bad evidence is not outweighed by
    what is around it or inside it: the worst of an element's surroundings holds.
    What holds most of the page is not told apart by it: a form around the
    page, or a wrapper with the page's heading in it, counts as nothing.
    """
    for e in reversed(elements[1:]):  # inner elements come after outer ones
        outer = elements[e.parent]
        outer.words += e.words
        outer.heading |= e.heading or e.tag in ("h1", "main") or e.tag == "article" and not e.by_name
    whole = elements[0].words
    for e in elements[1:]:
        outer, own = elements[e.parent].total, e.own
        if own < 0 and (e.tag in FORMS and e.words >= WHOLE_FORM * whole or e.heading and e.words >= WHOLE_WRAPPER * whole):
            own = 0.0
        if own < 0:
            e.total = max(-LIMIT, min(outer, own))
        else:
            e.total = outer if outer < 0 else min(LIMIT, outer + own)


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page, in page order, with their classifier scores.

    Character references are decoded and white space becomes single spaces.
    What browsers do not show (scripts, styles, titles, comments, hidden
    elements) is left out.  Markup may be cut off or badly nested; time grows
    with the length of the page, however deep it nests.
    """
    page = page or ""
    elements = [Element("", 0.0, 0, 0, False, False, False, "")]
    stack, out = [0], []
    open_at: dict[str, list[int]] = {}  # places in the stack of the open elements of each tag
    pieces: list[str] = []
    linked = shown = owner = 0

    def text(raw: str) -> None:
        nonlocal linked, shown, owner
        if raw and not raw.isspace():
            end_head()
        top = elements[stack[-1]]
        if raw and not top.hidden:
            s = html.unescape(raw) if "&" in raw else raw
            n = len(s.split())
            if n and not shown:
                owner = stack[-1]
            shown += n
            linked += n * top.link
            top.words += n
            pieces.append(s)

    def end_head() -> None:
        if open_at.get("head"):
            close({"head"}, frozenset())

    def end_block() -> None:
        nonlocal linked, shown
        words = "".join(pieces).split() if shown else ()
        if words:
            leaf = elements[stack[-1]].leaf
            score = (1.2 if shown >= 25 else 0.5 if shown >= 10 else -0.4 if shown < 5 else 0.0) + (0.5 if leaf in ("p", "blockquote", "pre") else -0.4 if leaf == "li" else 0.0)
            out.append((Block(" ".join(words), score, elements[owner].container, owner), linked / shown > 0.5))
        pieces.clear()
        linked = shown = 0

    def close(names: set[str], limits: frozenset[str] | set[str]) -> None:
        """Close the innermost open element of the names, and what is in it, unless one of the limits is nearer."""
        at = max((open_at[t][-1] for t in names if open_at.get(t)), default=0)
        if at and at > max((open_at[t][-1] for t in limits if open_at.get(t)), default=0):
            while len(stack) > at:
                open_at[elements[stack.pop()].tag].pop()

    at = 0
    while m := TOKEN.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        if m["tag"] is None:
            if m["comment"] is None and m[0][:2] not in ("<!", "<?") and not m[0].endswith(">"):
                break  # a tag cut off at the end
            continue
        tag = m["tag"].lower()
        if m["close"]:
            if tag in BLOCKS:
                end_block()
            close({tag}, frozenset())
            continue
        if tag not in IN_HEAD:
            end_head()
        if tag == "br":
            pieces.append(" ")
        if tag in VOID:
            if tag == "hr":
                end_block()
            continue
        if tag in SKIPPED:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = len(page) if end is None else end.start()
            pieces.append(" " * (tag not in ("svg", "math")))
            continue
        if tag in BLOCKS:
            end_block()
            close(*CLOSES[tag])
        elements.append(element(tag, m["attrs"], elements[stack[-1]], stack[-1], len(elements)))
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(len(elements) - 1)
    else:
        text(page[at:])
    end_block()
    judged(elements)
    for block, links in out:
        around = elements[block.owner].total
        block.score += around + links * (LINKS_INSIDE if around >= INSIDE else LINKS)
    return [block for block, _ in out]


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels (True: content) of least cost: |score| for a label against its sign, weight for an edge whose ends differ.

    A node whose score outweighs all its edges takes its sign's label in any
    minimum; such nodes are folded into their neighbours first.  The rest is
    cut by maximum flow from the content terminal to the other one (Dinic).
    Of several minima, the one with the fewest content nodes.
    """
    n = len(scores)
    unary, near = list(scores), [dict() for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0) + w
        near[b][a] = near[b].get(a, 0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        a = todo.popleft()
        if label[a] is None and (abs(unary[a]) > sum(near[a].values()) or not near[a]):
            label[a] = unary[a] > 0
            for b, w in near[a].items():
                del near[b][a]
                unary[b] += w if label[a] else -w
                todo.append(b)
            near[a] = {}
    rest = [a for a in range(n) if label[a] is None]
    if not rest:
        return [bool(x) for x in label]
    at = {a: i for i, a in enumerate(rest)}
    source, sink = len(rest), len(rest) + 1
    graph: list[list[list[int]]] = [[] for _ in range(len(rest) + 2)]  # [to, capacity, place of the reverse arc]

    def arc(a: int, b: int, there: int, back: int) -> None:
        graph[a].append([b, there, len(graph[b])])
        graph[b].append([a, back, len(graph[a]) - 1])

    for a in rest:
        if unary[a] > 0:
            arc(source, at[a], unary[a], 0)
        elif unary[a] < 0:
            arc(at[a], sink, -unary[a], 0)
        for b, w in near[a].items():
            if a < b:
                arc(at[a], at[b], w, w)
    while True:
        depth = [-1] * len(graph)
        depth[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for b, capacity, _ in graph[a]:
                if capacity and depth[b] < 0:
                    depth[b] = depth[a] + 1
                    queue.append(b)
        if depth[sink] < 0:
            for a in rest:
                label[a] = depth[at[a]] >= 0
            return [bool(x) for x in label]
        tried, path, a = [0] * len(graph), [], source
        while True:
            if a == sink:
                flow = min(e[1] for e in path)
                for e in path:
                    e[1] -= flow
                    graph[e[0]][e[2]][1] += flow
                full = next(i for i, e in enumerate(path) if not e[1])
                a = graph[path[full][0]][path[full][2]][0]
                del path[full:]
                continue
            while tried[a] < len(graph[a]):
                e = graph[a][tried[a]]
                if e[1] and depth[e[0]] == depth[a] + 1:
                    break
                tried[a] += 1
            if tried[a] < len(graph[a]):
                path.append(e)
                a = e[0]
            elif a == source:
                break
            else:
                depth[a] = -1
                a = graph[path[-1][0]][path[-1][2]][0]
                path.pop()


def labelled(found: list[Block]) -> list[bool]:
    """Whether each block is content."""
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, round(1000 * (ADJACENT + SAME_CONTAINER * (found[i - 1].container == b.container)))))
        if last.get(b.container, i - 1) < i - 1:
            edges.append((last[b.container], i, round(1000 * CONTAINER)))
        last[b.container] = i
    return minimum_cut([round(1000 * b.score) for b in found], edges)


def main_text(page: str | None) -> tuple[str, int, int]:
    """(main text, blocks, blocks kept) of a page; an empty text if nothing is content, or the page is null or empty."""
    found = blocks(page)
    kept = [b.text for b, content in zip(found, labelled(found), strict=True) if content]
    return " ".join(kept), len(found), len(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars, n_blocks, n_kept (long).

    Repeated rows are kept, an empty table gives an empty result, other columns are not read.
    """

    def start():
        def work(batch):
            return None, [list(c) for c in zip(*(main_text(p) for p in batch), strict=True)] if batch else [[], [], []]

        return work

    out = per_text(pages, [(id_col, "page_id"), (url_col, "url")], html_col, "text string, n_blocks long, n_kept long", start)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")
