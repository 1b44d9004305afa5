"""Main-text extraction by a tree-structured graphical model over the DOM.

Every block element is a node with a hidden label, main text or not. Its features (kind of tag with the words of its class, id and
role; length of its text with its share of links and sentence end; a copyright notice) depend on its label, and its label on its parent's
(one table for sections and elements with a telling name, one for plain ones inside
them, one for the rest). All tables are counted from labelled pages.
Sum-product messages pass from the leaves to the root and back, exactly, and give each node's marginal; the text of
nodes whose marginal for main text is over one half is kept.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in page order
by one newline. Scripts, styles, the head, drawings, embedded media and the contents of form controls are never text.

Defined results: a null, empty or textless page gives an empty text; broken markup is read as browsers do in the common
cases (implied ends, stray ends, unclosed elements). A head without an end tag ends at the first thing that can't stand in one; a
script or style without one runs to the end of the page, and any other silent element without one ends at the next block; repeated rows are extracted row by row; a null page_id is carried along; extra
columns are ignored; an empty table gives an empty result. Work and memory grow with the length of a page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.llm.common import small_batches, table
from quernel.llm.html_pages import labelled_pages

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^<>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)([^>]*)>|<[!?/][^>]*>|</?[a-zA-Z][^>]*\Z", re.S
)
#: Elements of HTML by what they mean for text.
#: RAW elements hold no markup; MUTED ones do, but none of their text counts; only HEAD_TAGS stand in a head; FOREIGN ones end at a block.
RAW = frozenset("script style iframe textarea title".split())
MUTED = frozenset("head template noscript select svg math object video audio canvas button".split())
HEAD_TAGS = frozenset("head base link meta title script style noscript template".split())
FOREIGN = frozenset("svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SECTIONS = frozenset("nav header footer aside form article main section dialog".split())
BLOCKS = SECTIONS | frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address fieldset legend details summary center label hgroup search menu hr".split()
)
#: Elements that an opening tag ends, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
P_ENDERS = BLOCKS - {"html", "body", "label", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
P_SCOPE = frozenset({"td", "th", "table", "caption", "html", "object"})
KINDS = {k: i for i, k in enumerate(["other", "nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "title", "heading", "list", "item", "table", "quote", "figure", "label", "root"])}
KIND_OF = {
    **{k: KINDS[k] for k in ("nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "label")}, "h1": KINDS["title"], **{f"h{i}": KINDS["heading"] for i in range(2, 7)},
    **dict.fromkeys(("ul", "ol", "dl", "menu"), KINDS["list"]), **dict.fromkeys(("li", "dt", "dd"), KINDS["item"]), **dict.fromkeys(("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"), KINDS["table"]),
    **dict.fromkeys(("blockquote", "pre"), KINDS["quote"]), **dict.fromkeys(("figure", "figcaption"), KINDS["figure"]), **dict.fromkeys(("html", "body"), KINDS["root"]), "dialog": KINDS["aside"], "search": KINDS["form"],
}
#: Words in class, id and role that tell what an element is; the first list that has one decides.
CUES = [
    re.compile(r"(?:^| )hidden(?:$| )"),
    re.compile(r"comment|repl(?:y|ies)|disqus|discussion|guestbook"),
    re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|adbox|promo\w*|sponsor\w*|cookies?|notice|consent|gdpr|alert|popup|modal|newsletter|subscribe|banner)(?:[^a-z]|$)"),
    re.compile(r"nav|menu|breadcrumb|sidebar|(?:^|[^a-z])side(?:[^a-z]|$)|foot|header|masthead|topbar|widget|share|social|related|recommend|pagination|pager|login|search|signup|toolbar|copyright|legal|tags|secondary|hidden|contentinfo|complementary"),
    re.compile(r"article|content|entry|story|(?:^|[^a-z])post|(?:^|[^a-z])main|(?:^|[^a-z])text"),
]
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
#: Weight of the backoff, in nodes.
BACKOFF = 20
LEGAL = re.compile(r"\s*(?:©|&copy;|copyright\b|\(c\) ?\d)", re.I)
LABEL = re.compile(r'\s*data-label="(\d)"')


@lru_cache(20_000)
def _cue(attrs: str) -> int:
    """0: nothing telling, else 1 + the number of the first list in CUES that has a word."""
    names = []
    for name, value in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            names.append("hidden")
        elif name in ("class", "id", "role"):
            names.append(value)
    text = " ".join(names)
    return next((i + 1 for i, p in enumerate(CUES) if text and p.search(text)), 0)


class Page:
    """Nodes in page order (parents first) and the runs of text between block boundaries."""

    __slots__ = ("parent", "kind", "cue", "own", "linked", "dot", "legal", "label", "runs")

    def __init__(self, html: str, labels: bool = False):
        self.parent, self.kind, self.cue, self.own, self.linked, self.dot, self.legal, self.label = [-1], [KINDS["root"]], [0], [0], [0], [0], [0], [-1]
        self.runs: list[list[tuple[int, str]]] = [[]]
        stack: list[tuple[str, int]] = [("", 0)]
        node, links, muted, loose, at, size = 0, 0, 0, 0, 0, len(html)
        run = self.runs[0]
        search = TOKEN.search
        last_end: dict[str, int] = {}

        def cut(i: int) -> None:
            """End the element at stack[i] and all inside it."""
            nonlocal node, links, muted, loose
            if links:
                links -= sum(t == "a" for t, _ in stack[i:])
            if muted:
                muted -= sum(t.rstrip("?") in MUTED or t.endswith("?") for t, _ in stack[i:])
                loose -= sum(t.endswith("?") for t, _ in stack[i:]) if loose else 0
            del stack[i:]
            node = stack[-1][1]

        def closed(tag: str) -> bool:
            """Whether an end tag of the kind is still to come."""
            if tag not in last_end:
                last_end[tag] = max((m.start() for m in re.finditer(rf"</{tag}[\s/>]", html, re.I)), default=-1)
            return last_end[tag] >= at

        while at < size:
            m = search(html, at)
            if m is None:
                raw, at = html[at:], size
            else:
                raw, at = html[at : m.start()], m.end()
            if raw and not raw.isspace():
                if muted and stack[-1][0] == "head":
                    cut(len(stack) - 1)
                if not muted:
                    run.append((node, raw))
                    n = len(raw)
                    self.own[node] += n
                    if links:
                        self.linked[node] += n
                    self.dot[node] = 1 if raw.rstrip()[-1:] in ".!?…" else 0
                    if n < 300 and LEGAL.match(raw):
                        self.legal[node] = 1
            elif raw:
                run.append((node, " "))
            if m is None:
                break
            closing, tag, attrs = m[1], m[2], m[3]
            if tag is None:
                closing, tag, attrs = m[4], m[5], m[6]
                if tag is None:
                    continue
            tag = tag.lower()
            block = tag in BLOCKS
            if block:
                if run:
                    run = []
                    self.runs.append(run)
            elif tag == "br":
                run.append((node, " "))
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        cut(i)
                        break
                    if block is False and stack[i][0] in BLOCKS and tag not in MUTED:
                        break  # a stray inline end doesn't leave its block
                continue
            if muted and tag not in HEAD_TAGS:
                i = next((i for i, (t, _) in enumerate(stack) if t == "head"), 0)
                if i:
                    cut(i)
            if muted and block:
                i = next((i for i, (t, _) in enumerate(stack) if t in FOREIGN or t.endswith("?")), 0)
                if i and (stack[i][0].endswith("?") or not any(t == "foreignobject" for t, _ in stack[i:])):
                    cut(i)
            if tag in RAW and not attrs.endswith("/"):
                if closed(tag):
                    at = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at).end()
                    continue
                if tag in ("script", "style"):
                    break
            elif tag in VOID:
                continue
            if tag in MUTED or tag in RAW:
                if attrs.endswith("/"):
                    continue
                if tag == "button" and muted:  # a button ends the one before it
                    i = next((i for i, (t, _) in enumerate(stack) if t == "button"), 0)
                    if i:
                        cut(i)
                muted += 1
                if tag == "head" or (tag in MUTED and closed(tag)):
                    stack.append((tag, node))
                else:
                    loose += 1
                    stack.append((tag + "?", node))
                continue
            if block:
                if tag in P_ENDERS:
                    i = self._ended(stack, {"p"}, P_SCOPE)
                    if i:
                        cut(i)
                if tag in ENDS:
                    i = self._ended(stack, *ENDS[tag])
                    if i:
                        cut(i)
            cue = _cue(attrs) if attrs else 0
            if block or 0 < cue < len(CUES):
                self.parent.append(node)
                self.kind.append(KIND_OF.get(tag, 0))
                self.cue.append(cue)
                self.own.append(0)
                self.linked.append(0)
                self.dot.append(0)
                self.legal.append(0)
                found = LABEL.search(attrs) if labels else None
                self.label.append(int(found[1]) if found else -1)
                node = len(self.parent) - 1
            elif tag == "a":
                links += 1
            stack.append((tag, node))

    @staticmethod
    def _ended(stack, ended, scope) -> int:
        """Where the outermost of `ended` above the nearest of `scope` stands, else 0."""
        lowest = 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in ended:
                lowest = i
                if len(ended) == 1:
                    break
            elif stack[i][0] in scope or (ended == {"p"} and stack[i][0] in BLOCKS):
                break
        return lowest

    def features(self) -> list[tuple[int, int, int]]:
        """(kind and cue; kind, length, links and sentence end; legal notice) of every node."""
        out = []
        for k, c, n, linked, dot, legal in zip(self.kind, self.cue, self.own, self.linked, self.dot, self.legal, strict=True):
            size = 0 if n == 0 else 1 if n < 25 else 2 if n < 80 else 3 if n < 200 else 4
            dense = 0 if n == 0 else 1 if linked * 2 > n else 2 if linked * 5 > n else 3 + dot
            out.append((k * (len(CUES) + 1) + c, k * 25 + size * 5 + dense, legal))
        return out

    def _tells(self, i: int) -> bool:
        return self.cue[i] != 0 or self.kind[i] in _TELLING

    def bond(self, i: int) -> int:
        """Which table binds a node to its parent: 0 for sections and telling names, 2 for plain nodes right inside one, 1 for the rest."""
        return 0 if self._tells(i) else 2 if self._tells(self.parent[i]) else 1

    def text(self, keep) -> str:
        blocks = []
        for run in self.runs:
            raw = "".join(x for i, x in run if keep[i])
            words = (unescape(raw) if "&" in raw else raw).split()
            if words:
                blocks.append(" ".join(words))
        return "\n".join(blocks)


_TELLING = frozenset(KINDS[k] for k in ("nav", "header", "footer", "aside", "form", "article", "main", "section"))


class TreeModel:
    """Tables counted from labelled pages (add-one smoothing) and exact inference on a page's tree."""

    def __init__(self, pages: list[str]):
        sizes = (len(KINDS) * (len(CUES) + 1), len(KINDS) * 25, 2)
        seen = [[[0.5] * n for n in sizes] for _ in range(2)]
        pair = [[[1.0, 1.0], [1.0, 1.0]] for _ in range(3)]
        root = [1.0, 1.0]
        for html in pages:
            page = Page(html, labels=True)
            n = len(page.parent)
            weight = [[0.0, 0.0] for _ in range(n)]
            for i in range(n):
                if page.label[i] >= 0:
                    weight[i][page.label[i]] += max(1, page.own[i])
            for i in range(n - 1, 0, -1):
                for x in range(2):
                    weight[page.parent[i]][x] += weight[i][x]
            labels = [int(w[1] > w[0]) for w in weight]
            for i, f in enumerate(page.features()):
                for t, v in zip(seen[labels[i]], f, strict=True):
                    t[v] += 1
                if i:
                    pair[page.bond(i)][labels[page.parent[i]]][labels[i]] += 1
                else:
                    root[labels[0]] += 1
        self.root = [x / sum(root) for x in root]
        self.pair = [[[x / sum(row) for x in row] for row in t] for t in pair]
        cues = len(CUES) + 1
        for by in seen:  # combinations seldom seen lean on kind and cue apart
            t = by[0]
            total = sum(t)
            kinds = [sum(t[k * cues : (k + 1) * cues]) / total for k in range(len(KINDS))]
            names = [sum(t[c::cues]) / total for c in range(cues)]
            by[0] = [x - 0.49 + BACKOFF * kinds[i // cues] * names[i % cues] for i, x in enumerate(t)]
        share = lambda t, width: [x / s for at in range(0, len(t), width) for s in (sum(t[at : at + width]),) for x in t[at : at + width]]
        # P(kind, cue | label), P(length, links, end | kind, label), P(legal | label)
        self.tables = [[share(t, width) for t, width in zip(by, (len(by[0]), 25, 2), strict=True)] for by in seen]
        self.known: dict[tuple[int, int, int], tuple[float, float]] = {}

    def evidence(self, f: tuple[int, int, int]) -> tuple[float, float]:
        got = self.known.get(f)
        if got is None:
            p = [1.0, 1.0]
            for x in range(2):
                for t, v in zip(self.tables[x], f, strict=True):
                    p[x] *= t[v]
            got = self.known[f] = (p[0] / (p[0] + p[1]), p[1] / (p[0] + p[1]))
        return got

    def marginals(self, page: Page) -> list[float]:
        """P(main text) of every node: one pass of messages up, one down."""
        n, parent = len(page.parent), page.parent
        zero, one = [0.0] * n, [0.0] * n
        for i, f in enumerate(page.features()):
            zero[i], one[i] = self.evidence(f)
        up = [(1.0, 1.0)] * n
        bonds = [self.pair[page.bond(i)] for i in range(n)]
        for i in range(n - 1, 0, -1):
            a, b = zero[i], one[i]
            (t00, t01), (t10, t11) = bonds[i]
            m0, m1 = t00 * a + t01 * b, t10 * a + t11 * b
            s = m0 + m1
            up[i] = m0, m1 = m0 / s, m1 / s
            p = parent[i]
            a, b = zero[p] * m0, one[p] * m1
            s = a + b
            if s < 1e-300:
                a, b, s = 0.5, 0.5, 1.0
            zero[p], one[p] = a / s, b / s
        a, b = zero[0] * self.root[0], one[0] * self.root[1]
        out = [b / (a + b)] * n
        for i in range(1, n):
            m0, m1 = up[i]
            q = out[parent[i]]
            d0, d1 = (1 - q) / m0, q / m1
            (t00, t01), (t10, t11) = bonds[i]
            a = zero[i] * (d0 * t00 + d1 * t10)
            b = one[i] * (d0 * t01 + d1 * t11)
            out[i] = b / (a + b)
        return out

    def extract(self, html: str | None) -> str:
        if not html:
            return ""
        page = Page(html)
        return page.text([m > 0.5 for m in self.marginals(page)])


@lru_cache(1)
def default_model() -> TreeModel:
    return TreeModel(labelled_pages())


def main_texts(pages: DataFrame, labelled: list[str] | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row; labelled: training pages whose text blocks carry data-label (default: this package's)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = default_model() if labelled is None else TreeModel(labelled)
        for b in batches:
            texts = [model.extract(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    small_batches(pages.sparkSession)
    kind = dict(pages.dtypes)
    return pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")).mapInArrow(run, f"page_id {kind[key]}, url {kind[url]}, text string, n_chars bigint")


def query(spark, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
