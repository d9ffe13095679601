"""Main text of HTML pages by minimum-cut labelling.

A page is cut into tags once and read into text blocks (text between block-level tags, with
the open elements above it). A linear classifier over the block's elements,
class words, length, ending and share of linked text gives the cost of each label; the
costs are the capacities from the source (content) and to the sink (the rest).
Neighbours in page order, and a block and the next one in the same element, are
joined by edges whose capacity falls with their distance in the DOM. Maximum
flow separates content from the rest at least cost: so a heading, a word of a list or
a line of three words, which the classifier alone would take for a label of a menu, stays
with the paragraphs around it.

What HTML itself names (nav, aside, footer, form, menu, dialog, a header outside the article), and all beneath an element whose class, id
or role names chrome, has a capacity to the sink that no length outweighs, whatever articles or bodies lie in it. If a page would have no
content so, forms and weaker names (a whole page in a form, an article in a "legal" box) are left to the classifier; if
still none, the costs are shifted until the best block is content. Only a page whose every text is in named chrome has none.

The classifier's weights are fitted by logistic regression, and the edges' capacity by the
number of wrong labels, on labelled pages made from a rule (layouts.py), once a process.

Blocks are joined in page order by one newline, white space inside a block is
one space, character references are decoded. Scripts, styles, templates,
controls, drawings, comments and hidden elements never become blocks.

Defined results: null and empty pages, and pages without text, give "" and 0.
Repeated rows give equal rows, an empty table no rows; other columns are ignored. A tag or comment that never
ends takes the rest of the page, as in browsers; a control, drawing or other left out element without an end tag ends with
its parent (also where the parent's end tag is left out), a self-closed one at once. Work is linear in
the page's size but for the flow, however deep elements are nested and whatever is left open.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vellumry.llm import layouts

# HTML elements by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe".split())
SKIPPED = set("noscript template svg object select button canvas audio video datalist".split())
FOREIGN = {"svg"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img math mi mn mo ms mtext mrow msup msub mfrac msqrt semantics annotation".split())
CLOSES_P = set("address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Start tags that end a drawing or formula in which they stand, and elements within one that hold HTML.
BREAKS_OUT = CLOSES_P | set("b big body br center code dd dt em embed head i img li listing meta nobr ruby s small span strong strike sub sup tt u var".split())
HOLDS_HTML = set("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
#: Start tags that end an open element by themselves, beside CLOSES_P for p.
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr"}, "tbody": {"tr"}, "option": {"option"}}
LEFT_OUT = set("nav footer aside form menu dialog fieldset legend".split())
#: Elements of these that some pages put around everything.
WEAK_ELEMENTS = {"form", "fieldset"}
# Words of class, id and role attributes. A name is chrome if it is one of these words, or if its first or
# last part is one of STRONG: "post-comments" is, "side-by-side" and "legal-form" aren't.
STRONG = set(
    "ad ads advert adverts advertisement sponsor sponsored promo banner sidebar navbar navigation nav menu breadcrumb breadcrumbs footer masthead topbar cookie cookies "
    "consent newsletter related recommended recommendations comment comments commentlist disqus respond outbrain taboola social pager pagination".split()
)
CHROME = STRONG | set(
    "adv advertising promotion side widget foot header notice notices alert gdpr popup modal overlay subscribe subscription signup login share sharing trending reply "
    "replies discussion form search toolbar skip copyright legal disclaimer contentinfo complementary dialog tags paywall feedback rating author-bio hidden recommend".split()
)
#: Words of chrome that also name the layout of an element around the text ("has-sidebar").
LAYOUT = set("sidebar side menu nav navbar header footer foot topbar toolbar".split())
BODY = set("article articlebody content entry main maincontent post posts story text body prose page-content".split())

MOST_WORDS = 40
#: Share of an edge's capacity that is left between blocks of differing regions (one of them an advert, say).
ACROSS = 0.1

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_PARTS = re.compile(r"[^a-z0-9]+")


class Tag:
    """A tag of a page: from start to end of its markup, or of a raw-text element's whole markup."""

    __slots__ = ("start", "end", "name", "rest", "closing", "jump")

    def __init__(self, start: int, end: int, name: str, rest: str, closing: bool):
        self.start, self.end, self.name, self.rest, self.closing = start, end, name, rest, closing
        self.jump: int | None = None  # of left out elements with an end: the tag that goes on behind them


def tags(page: str) -> tuple[list[Tag], int]:
    """(tags of a page in order, comments and raw texts left out; where its last text ends). One walk from front to back."""
    out: list[Tag] = []
    drawings, pos, n = 0, 0, len(page)
    while True:
        start = page.find("<", pos)
        if start < 0 or start + 1 == n:
            return out, n
        sign = page[start + 1]
        closing = sign == "/"
        m = _NAME.match(page, start + 1 + closing)
        if m is None:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                end = -1 if end < 0 else end + 3
            elif sign in "!?/":
                end = page.find(">", start)
                end = -1 if end < 0 else end + 1
            else:
                pos = start + 1
                continue
            if end < 0:
                return out, start
            out.append(Tag(start, end, "", "", False))
            pos = end
            continue
        name, stop = m[0].lower(), _REST.match(page, m.end()).end()
        if stop == n:
            return out, start
        rest, end = page[m.end() : stop], stop + 1
        if name in FOREIGN:
            drawings = max(0, drawings - 1) if closing else drawings + (not _closed(rest))
        if not closing and name in RAW and not (drawings and _closed(rest)):
            end = _raw_end(page, name, end)
        out.append(Tag(start, end, name, rest, closing))
        pos = end


def find_ends(found: list[Tag]) -> None:
    """Set jump of left out elements that end by their own end tag (behind it) or, drawings, by a tag that breaks out (at it)."""
    open_: list[tuple[str, int]] = []
    many: Counter = Counter()

    def pop() -> tuple[str, int]:
        x = open_.pop()
        many[x[0]] -= 1
        if drawings and drawings[-1] == len(open_):
            drawings.pop()
        elif holders and holders[-1] == len(open_):
            holders.pop()
        return x

    drawings: list[int] = []  # places of open drawings, and of elements in them that hold HTML
    holders: list[int] = []
    for k, t in enumerate(found):
        if not t.name or t.name in RAW and not t.closing:
            continue
        if t.closing:
            while many[t.name]:
                name, at = pop()
                if name == t.name:
                    if name in SKIPPED:
                        found[at].jump = k + 1
                    break
            continue
        if drawings and t.name in BREAKS_OUT and (not holders or holders[-1] < drawings[-1]):
            to = drawings[-1]
            while len(open_) > to:
                name, at = pop()
            found[at].jump = k
        if t.name in VOID or _closed(t.rest):
            continue
        if t.name in FOREIGN:
            drawings.append(len(open_))
        elif drawings and t.name in HOLDS_HTML:
            holders.append(len(open_))
        open_.append((t.name, k))
        many[t.name] += 1


class Node:
    """A block-level element: the one above it, and how deep it lies."""

    __slots__ = ("above", "depth")

    def __init__(self, above: "Node | None"):
        self.above, self.depth = above, 0 if above is None else above.depth + 1


def distance(a: Node, b: Node) -> int:
    """Elements between two nodes of a page. Of neighbours in page order all distances together are at most the page's tags."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.above
        else:
            b = b.above
        n += 1
    return n


class Block:
    __slots__ = ("text", "node", "linked", "state", "tag")

    def __init__(self, text: str, node: Node, linked: int, state: dict, tag: str):
        self.text, self.node, self.linked, self.state, self.tag = text, node, linked, state, tag


def _chrome_words(tag: str, names: list[str]) -> tuple[set[str], set[str]]:
    """(chrome that class, id and role names are, chrome that they have as first or last part).

    An article's or main element's own name must be a strong word, alone or with numbers: "comment-17" is, "comment-theory" isn't.
    """
    whole, part = set(), set()
    for name in names:
        parts = [p for p in _PARTS.split(name) if p]
        if tag in ("article", "main"):
            words = {p for p in parts if not p.isdigit()}
            whole |= words & STRONG if len(words) == 1 else set()
        elif name in CHROME:
            whole.add(name)
        elif parts:
            part |= {parts[0], parts[-1]} & STRONG
    return whole, part


#: How surely an element and all beneath it is no content: not named, by a weaker name, by HTML or a strong name.
FREE, WEAK, SURE = 0, 1, 2


def _state(above: dict, tag: str, rest: str) -> dict:
    """What an element adds to what holds inside it."""
    names: list[str] = []
    hidden = above["hidden"]
    if rest and ("=" in rest or "hidden" in rest):
        for m in _ATTR.finditer(rest):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
            if name in ("class", "id", "role"):
                names += value.lower().split()
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", value, re.I)):
                hidden = True
    level, chrome, body = above["level"], above["chrome"], above["body"]
    if tag in LEFT_OUT:
        level = max(level, WEAK if tag in WEAK_ELEMENTS else SURE)
    elif tag == "header" and not body:
        level = SURE
    if tag not in INLINE and tag not in ("html", "body"):
        whole, part = _chrome_words(tag, names)
        if whole & STRONG:
            level = SURE
        elif whole or part - LAYOUT:
            level = max(level, WEAK)
        elif part:
            chrome, body = True, False
        elif level == FREE and (tag in ("article", "main") or {p for x in names for p in (x, *_PARTS.split(x))} & BODY):
            chrome, body = False, True
    return {"level": level, "chrome": chrome, "body": body, "hidden": hidden}


_NONE = {"level": FREE, "chrome": False, "body": False, "hidden": False}


@lru_cache(64)
def _end_tag(tag: str) -> re.Pattern:
    return re.compile("</" + tag + r"(?![^\s/>])[^>]*>?", re.I)


def _raw_end(page: str, tag: str, pos: int) -> int:
    """Where the text of a raw-text element ends, after its end tag."""
    m = _end_tag(tag).search(page, pos)
    return m.end() if m else len(page)


def _closed(rest: str) -> bool:
    """Whether a start tag closes itself; a slash at the end of an unquoted value doesn't."""
    rest = rest.rstrip()
    if not rest.endswith("/"):
        return False
    last = max(rest.rfind(c) for c in " \t\n\r\f\"'") + 1
    return "=" not in rest[last:] and not rest[:last].rstrip().endswith("=")


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in page order."""
    found, end = tags(page)
    find_ends(found)
    out: list[Block] = []
    root = Node(None)
    stack: list[tuple[str, dict, Node]] = []  # open elements; an inline one has the node of the block around it
    places: dict[str, list[int]] = {}  # of each tag, where it stands in the stack
    around: list[tuple[int, str, dict]] = [(-1, "", _NONE)]  # the blocks of the stack
    walls: list[int] = [-1]  # blocks that an end tag of an inline element doesn't reach across
    parts: list[str] = []
    linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not (stack and stack[-1][1]["hidden"]):
            parts.append(raw)
            if places.get("a"):
                linked += len(raw)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, tag, state = around[-1]
                out.append(Block(text, stack[-1][2] if stack else root, linked, state, tag))
            parts.clear()
        linked = 0

    def top(*names: str) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=-1)

    def close(k: int) -> None:
        while len(stack) > k:
            places[stack.pop()[0]].pop()
            if around[-1][0] == len(stack):
                around.pop()
            if walls[-1] == len(stack):
                walls.pop()

    k = pos = 0
    while k < len(found):
        t = found[k]
        add(page[pos : t.start])
        pos, k = t.end, k + 1
        tag = t.name
        if not tag:
            continue
        if t.closing:
            if tag not in INLINE:
                flush()
            at = top(tag)
            if at >= 0 and (tag not in INLINE or at > walls[-1]):
                close(at)
            continue
        if tag in RAW or tag == "br":
            add(" ")
            continue
        if tag in SKIPPED:
            add(" ")
            if _closed(t.rest):
                continue
            if t.jump is not None:
                k = t.jump
                pos = found[k - 1].end if found[k - 1].closing and found[k - 1].name == tag else found[k].start
                continue
            # it has no end of its own: it hides what follows until an element around it ends
            if tag in ("button", "select") and (at := top(tag)) > walls[-1]:
                close(at)
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, {**(stack[-1][1] if stack else _NONE), "hidden": True}, stack[-1][2] if stack else root))
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES_P and (at := top("p")) >= 0 and at == walls[-1]:
                close(at)
            if (same := SAME.get(tag)) and (at := top(*same)) > top("ul", "ol", "dl", "table", "div", "article", "section", *([] if "tr" in same else ["tr"])):
                close(at)
        if tag in VOID or _closed(t.rest):
            continue
        above = stack[-1][1] if stack else _NONE
        node, state = stack[-1][2] if stack else root, _state(above, tag, t.rest)
        if tag not in INLINE:
            node = Node(node)
            around.append((len(stack), tag, state))
            walls.append(len(stack))
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, state, node))
    add(page[pos:end])
    flush()
    return out


#: What the classifier reads of a block, in the order of its weights.
FEATURES = ("bias", "chrome", "chrome_words", "body", "outside", "p", "heading", "li", "td", "words", "linked", "linked_words", "sentence")
#: Capacity that no cut pays for.
SEALED = 1e6


def features(found: list[Block]) -> np.ndarray:
    has_body = any(b.state["body"] and b.state["level"] == FREE for b in found)
    out = np.zeros((len(found), len(FEATURES)))
    for i, b in enumerate(found):
        s, n = b.state, min(b.text.count(" ") + 1, MOST_WORDS) / MOST_WORDS
        linked = min(1.0, b.linked / len(b.text))
        chrome = s["chrome"] or s["level"] > FREE
        out[i] = (
            1, chrome, chrome * n, s["body"], has_body and not s["body"], b.tag in ("p", "pre", "blockquote", "figcaption"),
            b.tag in ("h1", "h2", "h3", "h4"), b.tag == "li", b.tag in ("td", "th"), n, linked, linked * n, b.text[-1] in ".!?:;\"”»…",
        )
    return out


class Labeller:
    """Weights of the classifier (log odds of content) and the capacity of an edge between neighbours in one element."""

    def __init__(self, weights: np.ndarray, smooth: float):
        self.weights, self.smooth = weights, smooth

    def costs(self, found: list[Block]) -> np.ndarray:
        return features(found) @ self.weights

    def labels(self, found: list[Block]) -> list[bool]:
        level = np.array([b.state["level"] for b in found])
        cost, links = self.costs(found), edges(found, self.smooth)
        for free in (FREE, WEAK):
            kept = min_cut(np.where(level > free, -SEALED, cost).tolist(), links)
            if any(kept) or free == FREE and not (level == WEAK).any():
                break
        if not any(kept) and (level < SURE).any():
            least = FREE if (level == FREE).any() else WEAK
            best = int(np.argmax(np.where(level > least, -np.inf, cost)))
            kept = min_cut(np.where(level > least, -SEALED, cost - cost[best] + 1e-3).tolist(), links)
            kept[best] = True
        return kept


#: Made pages that weights and capacity are fitted on, capacities tried, and how weights are kept small.
MADE, TRIED, SHRINK = 500, (0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0), 1e-3


@lru_cache(1)
def labeller() -> Labeller:
    """Fitted on made pages: half for the weights (logistic regression, Newton's steps, on blocks that no name decides), half for the capacity with the fewest wrong labels (the smaller of equal ones)."""
    made = [b for b in map(blocks, layouts.pages(MADE, seed=20)) if b]
    truth = [np.array([b.text[0] == layouts.CONTENT for b in found]) for found in made]
    half = len(made) // 2
    x, y = np.concatenate([features(b) for b in made[:half]]), np.concatenate(truth[:half]).astype(float)
    free = np.array([b.state["level"] == FREE for found in made[:half] for b in found])
    x, y = x[free], y[free]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + SHRINK * len(y) * np.eye(len(w))
        w += np.linalg.solve(curve, x.T @ (y - p) - SHRINK * len(y) * w)
    wrong = {s: sum(int((np.array(Labeller(w, s).labels(b)) != t).sum()) for b, t in zip(made[half:], truth[half:])) for s in TRIED}
    return Labeller(w, min(TRIED, key=wrong.get))


def edges(found: list[Block], smooth: float) -> list[tuple[int, int, float]]:
    """Smoothness edges: page order, and the next block of the same element."""
    out: list[tuple[int, int, float]] = []
    last: dict[Node, int] = {}

    def strength(i: int, j: int) -> float:
        return smooth if found[i].state == found[j].state else smooth * ACROSS

    for i, b in enumerate(found):
        around = b.node.above or b.node
        if i:
            out.append((i - 1, i, strength(i - 1, i) * (2 / max(2, distance(found[i - 1].node, b.node))) ** 2))
        k = last.get(around)
        if k is not None and k < i - 1:
            out.append((k, i, strength(k, i) / 2))
        last[around] = i
    return out


def min_cut(gain: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least cost: -gain of a content block if negative, gain of another if positive, links cut.

    Flow that needs one node only is pushed at once: a node whose own capacity
    exceeds all its edges keeps its label in a least cut, and its edges join
    its neighbours' capacities. Dinic's algorithm takes what is left.
    """
    n = len(gain)
    gain = list(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in links:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(gain[i]) > sum(near[i].values()) or label[i] is None and not near[i]:
            label[i] = gain[i] > 0
            for j, c in near[i].items():
                gain[j] += c if label[i] else -c
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        at = {i: k for k, i in enumerate(rest)}
        s, t = len(rest), len(rest) + 1
        graph: list[list[int]] = [[] for _ in range(t + 1)]
        to: list[int] = []
        room: list[float] = []

        def edge(a: int, b: int, c: float, back: float) -> None:
            graph[a].append(len(to)), to.append(b), room.append(c)
            graph[b].append(len(to)), to.append(a), room.append(back)

        for i in rest:
            edge(s, at[i], gain[i], 0.0) if gain[i] > 0 else edge(at[i], t, -gain[i], 0.0)
            for j, c in near[i].items():
                if i < j:
                    edge(at[i], at[j], c, c)
        while True:
            level = [-1] * (t + 1)
            level[s] = 0
            queue = deque([s])
            while queue:
                u = queue.popleft()
                for e in graph[u]:
                    if room[e] > 1e-9 and level[to[e]] < 0:
                        level[to[e]] = level[u] + 1
                        queue.append(to[e])
            if level[t] < 0:
                break
            nxt = [0] * (t + 1)
            path: list[int] = []
            u = s
            while True:
                if u == t:
                    push = min(room[e] for e in path)
                    cut = 0
                    for k, e in enumerate(path):
                        room[e] -= push
                        room[e ^ 1] += push
                    cut = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                    del path[cut:]
                    u = to[path[-1]] if path else s
                    continue
                while nxt[u] < len(graph[u]):
                    e = graph[u][nxt[u]]
                    if room[e] > 1e-9 and level[to[e]] == level[u] + 1:
                        break
                    nxt[u] += 1
                if nxt[u] < len(graph[u]):
                    path.append(graph[u][nxt[u]])
                    u = to[path[-1]]
                elif path:
                    e = path.pop()
                    u = to[e ^ 1]
                    nxt[u] += 1
                else:
                    break
        for i in rest:
            label[i] = level[at[i]] >= 0
    return [bool(x) for x in label]


def extract(page: str | None, by: Labeller | None = None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, k in zip(found, (by or labeller()).labels(found)) if k)


def _extract(by: Labeller):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x.as_py(), by) for x in b.column(2)]
            n = [len(x) for x in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(n, pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html, ...) -> (page_id, url, text, n_chars)."""
    return pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(_extract(labeller()), "page_id long, url string, text string, n_chars long")
