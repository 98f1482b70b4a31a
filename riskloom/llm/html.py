"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded down the tree.

Every element has one of three roles: frame (may hold content, its own text is none), content, boilerplate. Boosted
trees give the log-probabilities of the roles from features of the node: density of text, links and tags of its
subtree, tokens of tag, class, id and role attributes, depth, place among siblings, and the same tokens of its
ancestors. Decoding chooses the likeliest roles of the whole page that don't contradict each other: a frame may hold
any role, content may hold content and boilerplate, boilerplate holds only boilerplate.

The trees are fitted on a sample of at most ``SAMPLE_PAGES`` pages whose markup tells the roles itself (pages with an
article or main element or the role main), each also in copies that lack this markup (``COPIES``), so that the trees know
content by more than the tags that gave the labels; the sample only fits the trees, every page is read whole. Without
such pages, and on a page without this markup in which the trees find no text, a node is content unless its tokens say
otherwise.

Null or empty pages give an empty text; markup without elements is one text; repeated rows give repeated results; an
empty table gives an empty result. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_map, pieces

SAMPLE_PAGES = 400
FRAME, CONTENT, BOILERPLATE = range(3)
#: Fixed markup vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var".split()
)
HEAD = frozenset("head script style textarea title noscript iframe template svg".split())
CONTENT_TAGS = frozenset(("article", "main"))
BOILER_TOKENS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs button comment comments consent cookie cookies"
    " dialog disqus footer form input login menu menubar modal nav navbar navigation newsletter notice notices pagination"
    " popup promo promoted related reply replies search select share sharing sidebar signup social sponsor sponsored"
    " subscribe toolbar topbar widget aside complementary contentinfo alert".split()
)
#: Share of a page's text above which an element is not written off by its name.
MOST_TEXT = 0.6
#: What an opening tag closes, up to the tags that bound the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
#: A quote means something only where a value begins; elsewhere it is a character like any other.
TAG = re.compile(r"""<(?:!--|(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)|[^>=]++|=)*+)>|[!?][^>]*>)""")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TOKEN = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")
#: Mark of a link in the text of a node.
LINK = 0


@dataclass(slots=True)
class Node:
    tag: str
    tokens: frozenset
    parent: int
    depth: int
    child: int  # place among the children of its parent
    children: int = 0
    parts: list = field(default_factory=list)  # (place in the page, text; None is a gap, LINK a link)


def _tokens(tag: str, attributes: str) -> frozenset:
    found = {f"tag:{tag}"}
    for m in ATTR.finditer(attributes):
        words = TOKEN.findall((m[2] or m[3] or m[4] or "").lower())
        found.update(words)
        if m[1].lower() == "role":
            found.update(f"role:{w}" for w in words)
    return frozenset(found)


def _inline_open(nodes: list[Node], stack: list[int], tag: str) -> int:
    """Place on the stack of an open inline element with that tag, or 0."""
    for k in range(len(stack) - 1, 0, -1):
        if nodes[stack[k]].tag == tag:
            return k
        if nodes[stack[k]].tag not in INLINE:
            break
    return 0


def parse(html: str) -> list[Node]:
    """Elements in page order; node 0 is the page itself. Inline elements are part of the block that holds them."""
    nodes = [Node("", frozenset(), -1, 0, 0)]
    stack, place, at, size = [0], 0, 0, len(html)
    lowered = ""

    def text(piece: str) -> None:
        nonlocal place
        if piece:
            place += 1
            nodes[stack[-1]].parts.append((place, unescape(piece) if "&" in piece else piece))

    def gap() -> None:
        nonlocal place
        place += 1
        nodes[stack[-1]].parts.append((place, None))

    while at < size:
        begin = html.find("<", at)
        if begin < 0:
            text(html[at:])
            break
        m = TAG.match(html, begin) or LOOSE.match(html, begin)
        if not m:
            text(html[at : begin + 1])
            at = begin + 1
            continue
        text(html[at:begin])
        at = m.end()
        if m[0] == "<!--":
            end = html.find("-->", begin + 2)
            at = size if end < 0 else end + 3
            continue
        if m.lastindex is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in VOID:
                if tag == "br":
                    gap()
                continue
            if tag in INLINE:
                if k := _inline_open(nodes, stack, tag):
                    del stack[k:]
                continue
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    del stack[k:]
                    break
            gap()
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                gap()
            continue
        tokens = _tokens(tag, m[3])
        if tag in INLINE and not tokens & BOILER_TOKENS and not _inline_open(nodes, stack, tag):
            if tag == "a":
                nodes[stack[-1]].parts.append((place, LINK))
            continue
        if tag not in INLINE:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == "p":
                    del stack[k:]
                    break
                if nodes[stack[k]].tag in ("td", "th", "button", "table"):
                    break
        if tag in CLOSES:
            closed, bounds = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag in bounds:
                    break
                if nodes[stack[k]].tag in closed:
                    del stack[k:]
                    break
        top = nodes[stack[-1]]
        if tag not in INLINE:
            gap()
        nodes.append(Node(tag, tokens, stack[-1], top.depth + 1, top.children))
        top.children += 1
        if tag in RAW:
            lowered = lowered or html.lower()
            end = lowered.find(f"</{tag}", at) if len(lowered) == size else html.find(f"</{tag}", at)
            close = html.find(">", end) if end >= 0 else -1
            body = html[at : end if end >= 0 else size]
            place += 1
            nodes[-1].parts.append((place, body))
            at = size if close < 0 else close + 1
            continue
        if not m[3].endswith("/") or tag in ("p", "div", "article", "section", "main", "span"):
            stack.append(len(nodes) - 1)
    return nodes


def tells(node: Node) -> bool:
    """Whether the markup itself says that the node is content."""
    return node.tag in CONTENT_TAGS or "role:main" in node.tokens


GROUPS = {  # content: what ``tells`` says
    "p": {"p", "blockquote", "pre"}, "heading": {"h1", "h2", "h3", "h4", "h5", "h6"}, "list": {"ul", "ol", "li", "dl", "dt", "dd"},
    "content": set(), "table": {"table", "tr", "td", "th", "tbody", "thead"}, "box": {"div", "section"},
    "outer": {"", "html", "body"}, "head": HEAD, "header": {"header"},
}


def named_boilerplate(nodes: list[Node]) -> list[bool]:
    """Which elements a tag or token names as boilerplate.

    A name does not write off the page itself: not html and body, not an element that is content by its markup or holds
    one that is, and not one with most of the text of the page.
    """
    size, holds = [0] * len(nodes), [tells(node) for node in nodes]
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        if node.tag not in HEAD:
            size[i] += sum(len(part) for _, part in node.parts if part)
            if i:
                size[node.parent] += size[i]
                holds[node.parent] |= holds[i]
    return [
        bool(node.tag in BOILER_TOKENS or node.tokens & BOILER_TOKENS)
        and node.tag not in ("html", "body") and not holds[i] and size[i] <= MOST_TEXT * size[0]
        for i, node in enumerate(nodes)
    ]


def features(nodes: list[Node]) -> np.ndarray:
    """Rows of numbers, one for each node."""
    n = len(nodes)
    own, links, tags, texts = np.zeros(n), np.zeros(n), np.ones(n), np.zeros(n)
    kind = np.zeros((n, len(GROUPS)))
    boiler = np.array(named_boilerplate(nodes), float)
    for i, node in enumerate(nodes):
        for _, part in node.parts:
            if part is LINK:
                links[i] += 1
            elif part:
                own[i] += len(part)
                texts[i] += 1
        kind[i] = [node.tag in g for g in GROUPS.values()]
        kind[i, 3] = tells(node)
    total, all_links, paragraphs = own.copy(), links.copy(), kind[:, 0].copy()
    parent = np.array([node.parent for node in nodes])
    for i in range(n - 1, 0, -1):
        for a in (total, all_links, tags, paragraphs):
            a[parent[i]] += a[i]
    above_boiler, above_content, above_head = boiler.copy(), kind[:, 3].copy(), kind[:, 7].copy()
    for i in range(1, n):
        above_boiler[i] += above_boiler[parent[i]]
        above_content[i] += above_content[parent[i]]
        above_head[i] += above_head[parent[i]]
    up = np.maximum(parent, 0)
    siblings = np.array([node.children for node in nodes])[up]
    child = np.array([node.child for node in nodes])
    return np.column_stack([
        np.log1p(own), np.log1p(total), np.log1p(links), all_links / (tags + all_links), total / (tags + all_links),
        np.log1p(tags), np.log1p(paragraphs), [node.depth for node in nodes], child, child / np.maximum(siblings, 1), siblings,
        [node.children for node in nodes], np.arange(n) / n, total / max(total[0], 1), boiler, above_boiler, above_content,
        above_head, kind, kind[up], all_links[up] / (tags[up] + all_links[up]), np.full(n, kind[:, 3].any()),
    ])


def weak_roles(nodes: list[Node]) -> np.ndarray | None:
    """Roles that the markup itself tells, or None."""
    holds = [False] * len(nodes)
    for i, node in enumerate(nodes):
        if tells(node):
            k = node.parent
            while k >= 0 and not holds[k]:
                holds[k] = True
                k = nodes[k].parent
    if not holds[0]:
        return None
    roles, named = np.zeros(len(nodes), np.int64), named_boilerplate(nodes)
    for i, node in enumerate(nodes):
        above = roles[node.parent] if i else FRAME
        if above == BOILERPLATE or node.tag in HEAD or named[i]:
            roles[i] = BOILERPLATE
        elif above == CONTENT or tells(node):
            roles[i] = CONTENT
        elif not holds[i]:
            roles[i] = BOILERPLATE
    return roles


#: Copies of a page without the markup that tells its roles: elements in place of the outermost content element, whether
#: boilerplate stays, and whether it keeps its tags and tokens.
COPIES = ((("div",), True, True), (("table", "tr", "td"), True, True), (("div",), True, False), ((), True, True), ((), False, True))


def unmarked(nodes: list[Node], roles: np.ndarray, instead: tuple, others: bool, named: bool) -> tuple[list[Node], np.ndarray]:
    """One copy of a page with the roles of its nodes; an element that takes over the text of a content element is content."""
    out, kept = [Node("", frozenset(), -1, 0, 0, parts=nodes[0].parts)], [roles[0]]
    place = {0: 0}

    def add(tag: str, tokens: frozenset, parent: int, role: int, parts: list) -> int:
        above = out[parent]
        out.append(Node(tag, tokens, parent, above.depth + 1, above.children, parts=parts))
        kept.append(role)
        above.children += 1
        return len(out) - 1

    for i, node in enumerate(nodes[1:], 1):
        at = place.get(node.parent)
        if at is None or not others and roles[i] == BOILERPLATE and node.tag not in HEAD:
            continue
        tag, tokens = node.tag, node.tokens
        if tells(node):
            if roles[i] == CONTENT and roles[node.parent] == FRAME:
                for k, box in enumerate(instead, 1):
                    last = k == len(instead)
                    at = add(box, frozenset(), at, CONTENT if last else FRAME, node.parts if last else [])
                if not instead:
                    out[at].parts = out[at].parts + node.parts
                    if any(part and part.strip() for _, part in node.parts):
                        kept[at] = CONTENT
                place[i] = at
                continue
            tag, tokens = "div", tokens - {"role:main"}
        if not named and roles[i] == BOILERPLATE and tag not in HEAD:
            tag, tokens = "div" if tag in BOILER_TOKENS else tag, frozenset()
        place[i] = add(tag, tokens, at, roles[i], node.parts)
    return out, np.array(kept)


@dataclass
class Trees:
    """Boosted regression trees, one sequence per role; node k of a tree has children 2k+1 and 2k+2."""

    start: np.ndarray
    column: np.ndarray  # rounds x roles x inner nodes
    limit: np.ndarray
    value: np.ndarray  # rounds x roles x leaves
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.start, (len(x), 1))
        rows = np.arange(len(x))
        for r in range(len(self.column)):
            for c in range(3):
                at = np.zeros(len(x), np.int64)
                for _ in range(self.depth):
                    at = 2 * at + 1 + (x[rows, self.column[r, c, at]] > self.limit[r, c, at])
                out[:, c] += self.value[r, c, at - (2**self.depth - 1)]
        return out - np.log(np.exp(out - out.max(1, keepdims=True)).sum(1, keepdims=True)) - out.max(1, keepdims=True)


def boost(x: np.ndarray, roles: np.ndarray, rounds: int = 20, depth: int = 4, rate: float = 0.3, bins: int = 32) -> Trees:
    """Second-order gradient boosting of the softmax loss on binned features."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    want = np.eye(3)[roles]
    start = np.log(want.mean(0) + 1e-3)
    scores = np.tile(start, (n, 1))
    inner = 2**depth - 1
    column, limit = np.zeros((rounds, 3, inner), np.int64), np.full((rounds, 3, inner), np.inf)
    value = np.zeros((rounds, 3, inner + 1))
    for r in range(rounds):
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        for c in range(3):
            g, h = p[:, c] - want[:, c], p[:, c] * (1 - p[:, c]) + 1e-6
            at = np.zeros(n, np.int64)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                best = np.zeros(count)
                split = np.full(count, -1)
                column_of = np.zeros(count, np.int64)
                for j in range(width):
                    if not len(edges[j]):
                        continue
                    cell = (at - first) * bins + binned[:, j]
                    gs = np.bincount(cell, weights=g, minlength=count * bins).reshape(count, bins).cumsum(1)
                    hs = np.bincount(cell, weights=h, minlength=count * bins).reshape(count, bins).cumsum(1)
                    gain = gs**2 / (hs + 1) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + 1) - gs[:, -1:] ** 2 / (hs[:, -1:] + 1)
                    gain = gain[:, : len(edges[j])]
                    top = gain.argmax(1)
                    better = gain[np.arange(count), top] > best + 1e-9
                    best[better] = gain[better, top[better]]
                    split[better], column_of[better] = top[better], j
                for k in np.flatnonzero(split >= 0):
                    column[r, c, first + k], limit[r, c, first + k] = column_of[k], edges[column_of[k]][split[k]]
                at = 2 * at + 1 + (x[np.arange(n), column[r, c, at]] > limit[r, c, at])
            leaf = at - inner
            gs, hs = (np.bincount(leaf, weights=w, minlength=inner + 1) for w in (g, h))
            value[r, c] = -rate * gs / (hs + 1)
            scores[:, c] += value[r, c, leaf]
    return Trees(start, column, limit, value, depth)


def decode(nodes: list[Node], logs: np.ndarray) -> np.ndarray:
    """Likeliest roles without contradictions between ancestors and descendants."""
    best = logs.copy()
    for i in range(len(nodes) - 1, 0, -1):
        parent, b = nodes[i].parent, best[i]
        best[parent, BOILERPLATE] += b[BOILERPLATE]
        best[parent, CONTENT] += max(b[CONTENT], b[BOILERPLATE])
        best[parent, FRAME] += b.max()
    roles = np.zeros(len(nodes), np.int64)
    allowed = {FRAME: [FRAME, CONTENT, BOILERPLATE], CONTENT: [CONTENT, BOILERPLATE], BOILERPLATE: [BOILERPLATE]}
    for i, node in enumerate(nodes):
        choice = allowed[roles[node.parent] if i else FRAME]
        roles[i] = max(choice, key=lambda r: best[i, r])
    return roles


def text_of(nodes: list[Node], roles: np.ndarray) -> str:
    """Own text of the content nodes by place in the page; blocks are trimmed and joined by one space, also within a frame."""
    parts = [
        p for node, role in zip(nodes, roles) if role != BOILERPLATE for p in node.parts
        if p[1] is None or role == CONTENT and p[1] is not LINK
    ]
    parts.sort(key=lambda p: p[0])
    return SPACES.sub(" ", "".join(" " if part is None else part for _, part in parts)).strip()


def rule_logs(nodes: list[Node]) -> np.ndarray:
    """Log-probabilities where no trees could be fitted: content unless a name, or one above, says boilerplate."""
    out = np.tile(np.log([0.2, 0.7, 0.1]), (len(nodes), 1))
    named = named_boilerplate(nodes)
    for i, node in enumerate(nodes):
        named[i] = named[i] or node.tag in HEAD or i > 0 and named[node.parent]
        if named[i]:
            out[i] = np.log([0.01, 0.01, 0.98])
    return out


def extract(pages: list[str], trees: Trees | None) -> list[str]:
    parsed = [parse(p) for p in pages]
    if trees is None:
        logs = [rule_logs(nodes) for nodes in parsed]
    else:
        cuts = np.cumsum([len(nodes) for nodes in parsed])[:-1]
        logs = np.split(trees.scores(np.concatenate([features(nodes) for nodes in parsed])), cuts)
    out = []
    for nodes, log in zip(parsed, logs):
        if len(nodes) == 1:
            out.append(text_of(nodes, np.array([CONTENT])))
        else:
            text = text_of(nodes, decode(nodes, log))
            if not text and not any(map(tells, nodes)):
                text = text_of(nodes, decode(nodes, rule_logs(nodes)))
            out.append(text)
    return out


def fit(pages: list[str]) -> Trees | None:
    xs, ys = [], []
    for page in pages:
        nodes = parse(page)
        if (roles := weak_roles(nodes)) is not None:
            for some, told in [(nodes, roles), *(unmarked(nodes, roles, *copy) for copy in COPIES)]:
                xs.append(features(some))
                ys.append(told)
    return boost(np.concatenate(xs), np.concatenate(ys)) if xs else None


def _drawn(rows: DataFrame, n: int) -> list[str]:
    """SAMPLE_PAGES different pages (all, if fewer) by a hash of id and page, the same in whatever order the rows are."""
    share = min(1.0, 1.5 * SAMPLE_PAGES / max(n, 1))
    some = rows.withColumn("h", F.xxhash64("page_id", "html")).where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    drawn = some.select("h", "html").distinct().orderBy("h", "html").limit(SAMPLE_PAGES)
    return [r.html or "" for r in drawn.collect()]


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    trees = rows.sparkSession.sparkContext.broadcast(fit(_drawn(rows, pages.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, pages_ in pieces(batches, 2):
            texts = extract(pages_, trees.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"],
            )

    return arrow_map(rows, run, "page_id long, url string, text string, n_chars long")
