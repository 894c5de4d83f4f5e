"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks, the runs of text between block elements. A small linear classifier gives
each block a cost of being called boilerplate or content, from the elements and names around it, the
share of link text, its length and its punctuation. These costs are the capacities to the two
terminals of a flow network. Neighbours in page order and neighbours within one container are joined
by smoothness edges, stronger the closer they are in the tree. The minimum cut is the labelling of
least total cost; the blocks on the content side, in page order, are the text.

A block whose own cost outweighs all its edges is on its side in every minimum cut, so such blocks
are settled first; the maximum flow runs over what is left. Where the cut leaves no block at all, it
is made once more without the bias against content, so that a short article has a text.

Defined results: a null or empty page has an empty text; markup that never ends runs to the end of
the page; unknown elements are inline; rows and extra columns are kept one by one, a null id or
address stays null, only a column named text is replaced; a quote opens a value only after an equals
sign; an empty table gives an empty result. Nothing is cut off: every character of a
block called content is in the text, with white space folded.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, and names that sites give to parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template noscript iframe object svg textarea title select canvas audio video annotation annotation-xml".split())
FORMULA = frozenset("mi mn mo ms mtext".split())  # parts of a formula, kept apart by blanks
BLOCK = frozenset("address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form"
                  " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody"
                  " tfoot thead tr ul caption".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote tr td th figcaption".split())
HEADINGS = frozenset("h1 h2 h3".split())
PROSE = HEADINGS | frozenset("h4 h5 h6 p li dt dd blockquote".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
APART = frozenset("nav footer aside form menu dialog button fieldset".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentary cookie cookies copyright"
    " consent disclaimer discuss discussion disqus donate footer form gdpr header login masthead menu metadata modal nav navbar navigation newsletter notice"
    " notices notification outbrain overlay pager pagination pagetop paywall popup print promo promotion recommend recommended recommendations"
    " related reply replies respond responses search share sharing shoutbox sidebar signin signup skip social sponsor sponsored subscribe"
    " subscription tags taboola toolbar topbar tooltip trending widget widgets alert complementary contentinfo".split())
CONTENT_NAMES = frozenset("article articlebody body content entry hentry main page post story text".split())
#: Content names that are given to articles and not to whole sites.
ARTICLE_NAMES = frozenset("article articlebody entry hentry post story".split())
#: Names that a paragraph or section inside an article may have as an address, for what it is about.
TOPICS = BOILERPLATE_NAMES - frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments commentary disqus masthead nav navbar newsletter outbrain"
    " pagination paywall popup promo recommended recommendations related replies respond responses sharing shoutbox sidebar sponsored subscribe taboola"
    " toolbar topbar trending widget widgets".split())
#: Words beside a boilerplate name that say where or in what form it stands, and nothing of its own.
PLACING = frozenset(
    "area articles article bar block body bottom box btn button buttons card center col column container content entry group head icon icons inline inner"
    " item items left link links list main media module news outer page panel post posts right row section site slot story text title top unit wrap wrapper".split())
#: has-sidebar, content-with-sidebar, comments-open: what a part has or allows, not what it is.
HAVING, ALLOWED = frozenset("has with no without".split()), frozenset("enabled disabled open closed free".split())

#: Weights of the classifier: positive is content.
WEIGHTS = {"bias": -1.0, "article": 4.0, "apart": -8.0, "header": -8.0, "boilerplate_name": -8.0, "content_name": 2.0, "hidden": -8.0,
           "links": -5.0, "article_links": -0.5, "length": 0.75, "sentence": 0.5,
           "heading": 0.5}
#: Smoothness: next to each other in one container, next to each other otherwise, next in one container with others between.
NEAR, TURN, BESIDE = 1.0, 0.3, 0.5

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=[ \t\n\f\r]*(?:\"[^\"]*\"|'[^']*')|=)*+)(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
SPLIT = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPACES = re.compile(r"[ \t\n\f\r]+")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Element:
    """An open element; `block` and `container` are the innermost block and the innermost one that holds others."""

    __slots__ = ("tag", "score", "in_link", "in_article", "block", "container")

    def __init__(self, tag, score, in_link, in_article, parent=None):
        self.tag, self.score, self.in_link, self.in_article = tag, score, in_link, in_article
        self.block = self if tag in BLOCK or parent is None else parent.block
        self.container = self if parent is None or tag in BLOCK and tag not in LEAF else parent.container


def _parts(name: str) -> set[str]:
    """The parts of one class, id or role that say what the element is."""
    parts = [x for x in SPLIT.split(CAMEL.sub(" ", name).lower()) if x]
    if len(parts) > 1 and parts[-1] in ALLOWED:
        return set()
    return set(parts[: next((i for i, x in enumerate(parts) if x in HAVING), len(parts))])


def _judged(names: list[str], tag: str, inside: bool) -> tuple[str | None, bool]:
    """The weight that an element's names give it, and whether they say that it is an article.

    Every name is judged by itself. One that is partly a boilerplate name yields to one beside it, or
    to an element, that is wholly of content names; a header of an article is no boilerplate. Inside an
    article a name counts only if all of it is boilerplate or says where it stands: form-of-government
    is a subject.
    """
    whole, boilerplate, some, article = tag in ("article", "main"), [], False, False
    for name in names:
        parts = _parts(name)
        if inside or parts & ARTICLE_NAMES:
            parts.discard("header")
        if parts & BOILERPLATE_NAMES and (not inside or parts <= BOILERPLATE_NAMES | PLACING):
            boilerplate.append(parts)
        elif parts & CONTENT_NAMES:
            some = True
            if parts <= CONTENT_NAMES:
                whole, article = True, article or bool(parts & ARTICLE_NAMES)
    if any(not whole or parts <= BOILERPLATE_NAMES for parts in boilerplate):
        return "boilerplate_name", False
    return "content_name" if some else None, article


def _opened(tag: str, attributes: str, parent: Element) -> Element:
    """The element with its score: what it and the elements around it say about the text inside."""
    score, inside, spared = parent.score, parent.in_article, False
    if tag in ("article", "main"):
        score, inside = WEIGHTS["article"], True  # whatever was left open before it
    elif tag in APART:
        score += WEIGHTS["apart"]
    if attributes and "=" in attributes or "hidden" in attributes:
        names: list[str] = []
        for key, value in NAMED.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "style":
                score += WEIGHTS["hidden"] * bool(HIDING.search(value.lower()))
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                score += WEIGHTS["hidden"]
            elif key == "role" and value.lower() in ("main", "article"):
                score, inside = max(score, 0) + WEIGHTS["article"], True
            elif key == "id" and inside and _parts(value) & BOILERPLATE_NAMES <= TOPICS:
                continue  # an anchor: what the part is about
            elif key in ("class", "id", "role"):
                names.extend(SPACES.split(value))
        if tag not in ("body", "html"):
            weight, article = _judged(names, tag, inside)
            score += WEIGHTS.get(weight, 0.0)
            inside = inside or article
            spared = any(_parts(name) & ARTICLE_NAMES for name in names)
    if tag == "header" and not inside and not spared:
        score += WEIGHTS["header"]
    return Element(tag, score, parent.in_link or tag == "a", inside, parent)


def blocks(page: str) -> list[tuple[str, float, int]]:
    """(text, score, container) of every block with text, in page order."""
    root = Element("", 0.0, False, False)
    stack, out, parts = [root], [], []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                container, leaf = stack[-1].container, stack[-1].block
                links = WEIGHTS["article_links" if leaf.in_article and leaf.tag in PROSE else "links"]
                score = WEIGHTS["bias"] + stack[-1].score + links * min(1.0, linked / len(text))
                words = text.count(" ") + 1
                score += WEIGHTS["length"] * ((words // 8 + 1).bit_length() - 1)
                score += WEIGHTS["sentence"] * (text[-1] in ".!?…。！？:;\"”»")
                score += WEIGHTS["heading"] * (stack[-1].tag in HEADINGS)
                out.append((text, score, id(container)))
                held.append(container)
            parts.clear()
        linked = 0

    held: list[Element] = []  # keeps containers alive, so that their ids stay apart

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if stack[-1].in_link:
                linked += len(text.strip())

    places: dict[str, list[int]] = {}  # where in the stack the open elements of a name are

    def close(tags: tuple, until: frozenset) -> None:
        """Close the innermost of these elements, unless one of `until` lies inside it; no walk through the stack."""
        at = max((places[t][-1] for t in tags if places.get(t)), default=0)
        if at and at > max((places[t][-1] for t in until if places.get(t)), default=0):
            for e in stack[at:]:
                places[e.tag].pop()
            del stack[at:]

    while (found := TAG.search(page, at)) is not None:
        add(page[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if tag in BLOCK:
                flush()
            if tag in ("td", "th") or tag in FORMULA:
                parts.append(" ")
            close((tag,), frozenset())
            continue
        if tag in SKIPPED:
            # only elements of other languages than HTML end in their own tag
            if tag not in ("svg", "annotation", "annotation-xml") or not page[found.start() : at].endswith("/>"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag != "option":
                close(("p",), frozenset(("article", "div", "section", "body", "button", "table", "td")))
        elif tag in ("br", "td", "th") or tag in FORMULA:
            parts.append(" ")
        if tag in CLOSES:
            close(CLOSES[tag], frozenset(("ul", "ol", "dl", "table", "select", "menu")))
        if tag not in VOID:
            places.setdefault(tag, []).append(len(stack))
            stack.append(_opened(tag, found[3], stack[-1]))
    add(page[at:])
    flush()
    return out


def smoothness(containers: list[int]) -> list[tuple[int, int, float]]:
    """Edges between blocks: page order, and order within a container."""
    edges, last = [], {}
    for i, c in enumerate(containers):
        if i:
            edges.append((i - 1, i, NEAR if containers[i - 1] == c else TURN))
        if c in last and last[c] < i - 1:
            edges.append((last[c], i, BESIDE))
        last[c] = i
    return edges


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the blocks on the content side of a minimum cut.

    A block's score is the capacity to the content terminal when positive, to the other when
    negative. Of several minimum cuts, the one with the fewest content blocks.
    """
    n, near = len(scores), [[] for _ in scores]
    for i, j, w in edges:
        near[i].append((j, w))
        near[j].append((i, w))
    side: list[bool | None] = [None] * n
    pull = list(scores)  # own score and the edges to settled blocks
    open_weight = [sum(w for _, w in x) for x in near]
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is None and abs(pull[i]) > open_weight[i]:
            side[i] = pull[i] > 0
            for j, w in near[i]:
                if side[j] is None:
                    pull[j] += w if side[i] else -w
                    open_weight[j] -= w
                    todo.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        content = _flow_side({i: pull[i] for i in rest}, [(i, j, w) for i, j, w in edges if side[i] is None and side[j] is None])
        for i in rest:
            side[i] = i in content
    return side


def _flow_side(pull: dict[int, float], edges: list[tuple[int, int, float]], tiny: float = 1e-9) -> set[int]:
    """Blocks that the source still reaches after a maximum flow (shortest augmenting paths, level by level)."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: {} for i in (*pull, source, sink)}
    for i, j, w in edges:
        room[i][j] = room[i].get(j, 0.0) + w
        room[j][i] = room[j].get(i, 0.0) + w
    for i, p in pull.items():
        if p > 0:
            room[source][i], room[i][source] = p, 0.0
        elif p < 0:
            room[i][sink], room[sink][i] = -p, 0.0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for v, r in room[u].items():
                if r > tiny and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return {u for u in level if u >= 0}
        ways = {u: iter(list(room[u])) for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                least = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= least
                    room[b][a] = room[b].get(a, 0.0) + least
                cut = next(k for k, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= tiny)
                del path[cut + 1 :]
                continue
            for v in ways[u]:
                if level.get(v) == level[u] + 1 and room[u][v] > tiny:
                    path.append(v)
                    break
            else:
                path.pop()


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    found = blocks(page)
    scores, edges = [score for _, score, _ in found], smoothness([c for *_, c in found])
    content = minimum_cut(scores, edges)
    if not any(content):  # a page of short lines without names: what nothing speaks against
        content = minimum_cut([score - WEIGHTS["bias"] + 0.25 for score in scores], edges)
    return "\n\n".join(text for (text, *_), keep in zip(found, content) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """pages (with a column html) with the column text added; a column of that name is replaced."""

    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        return column.map(main_text)

    return pages.withColumn("text", texts("html"))


def op4_html_text(spark, sf_dir: str) -> DataFrame:
    from tripgauge.llm.common import table

    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
