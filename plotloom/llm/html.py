"""Main text of pages by a tree-structured model over DOM nodes.

Each block element is a variable that is content or not. Its own potential comes from its tag, its names (class, id, role) and
the amounts of text and links in it; a potential between parent and child comes from the kind of child. Messages go up from the
leaves and down from the root once each, which gives exact marginals on a tree. Weights are fitted to labelled pages by the
gradient of their likelihood, whose expectations are those same marginals. Blocks of nodes above one half are kept.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.llm.common import as_rows
from plotloom.llm.pages import LABELLED, OFF, ON

_RAW = "script|style|textarea|title"
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(" + _RAW + r""")\b(?>"[^"]*"|'[^']*'|[^'">])*+>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>"[^"]*"|'[^']*'|[^'">])*+)>"""
                   r"|<[a-zA-Z/!?][^>]*(?:>|\Z)|([^<]+|<)", re.S | re.I)
ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br input".split())
#: A start tag of a key ends an open element of its values that has no other block inside the nearest enclosing container.
ENDS = {t: {"p"} for t in "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()}
ENDS |= {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
STOPS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
#: Elements whose text is left out.
DARK = set("noscript template iframe svg math select button object canvas audio video head".split())
#: What may stand in a head; anything else begins the body.
IN_HEAD = set("base basefont bgsound link meta noscript template script style title".split())
_OFF, _ON = ({*names, *(n + "s" for n in names)} for names in (OFF, ON))
#: Elements that hold no main text where a page names none as such.
BOXES = set("nav header footer aside form menu dialog".split())
TEXT = set("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd td th figcaption".split())


class Page:
    """Block elements in page order (parents before children) and the blocks of text between their borders."""

    def __init__(self, html: str):
        self.parent, self.tag, self.names, self.label = [-1], ["#root"], [frozenset()], [None]
        self.own, self.linked, self.blocks = [0], [0], []
        self._read(html)

    def _read(self, html: str) -> None:
        stack, links, part = [("#root", 0)], 0, []
        # where on the stack an element begins whose text is left out, and whether it lacks its end tag and so ends at the next block
        dark, loose, ends = 0, False, {}
        held = Counter()        # open elements by name, so that an end tag without a start tag costs nothing

        def closed(name: str, at: int) -> bool:
            """Whether the start tag at ``at`` has an end tag; each end tag goes with the last start tag that has none yet."""
            if name not in ends:
                ends[name], begun = set(), []
                for m in re.finditer(f"<(/?){name}(?=[\\s/>])", html, re.I):
                    if not m[1]:
                        begun.append(m.start())
                    elif begun:
                        ends[name].add(begun.pop())
            return at in ends[name]

        def flush() -> None:
            if part:
                text = " ".join(unescape("".join(part)).split())
                if text:
                    self.blocks.append((stack[-1][1], text))
                    self.own[stack[-1][1]] += len(text)
                part.clear()

        def close(upto: int) -> None:
            nonlocal links, dark
            seen = stack[upto:dark or None]
            if any(t not in INLINE for t, _ in seen):
                flush()
            links -= sum(t == "a" for t, _ in seen)
            held.subtract(t for t, _ in stack[upto:])
            del stack[upto:]
            if len(stack) <= dark:
                dark = 0

        for m in TOKEN.finditer(html):
            if (text := m[5]) is not None:
                if dark and stack[-1][0] == "head" and not text.isspace():
                    close(dark)
                if dark:
                    continue
                part.append(text)
                if links:
                    self.linked[stack[-1][1]] += len(text)
                continue
            tag = (m[3] or "").lower()
            if not tag:
                continue
            if m[2]:
                for at in range(len(stack) - 1, 0, -1) if held[tag] else ():
                    if stack[at][0] == tag:
                        close(at)
                        break
                continue
            if dark and (tag not in IN_HEAD if stack[dark][0] == "head" and len(stack) == dark + 1 else tag == "body" or loose and tag in ENDS):
                close(dark)
            if dark or tag in DARK:
                if tag not in VOID and not (tag in ("svg", "math") and m[4].endswith("/")):
                    if not dark:
                        dark, loose = len(stack), tag != "head" and not closed(tag, m.start())
                    stack.append((tag, stack[-1][1]))
                    held[tag] += 1
                continue
            if tag == "br":
                part.append(" ")
                continue
            if tag in INLINE:
                if tag not in VOID and not m[4].endswith("/"):
                    stack.append((tag, stack[-1][1]))
                    held[tag] += 1
                    links += tag == "a"
                continue
            for at in range(len(stack) - 1, 0, -1) if any(held[t] for t in ENDS.get(tag, ())) else ():
                if stack[at][0] in ENDS.get(tag, ()):
                    close(at)
                    if not any(held[t] for t in ENDS[tag]):
                        break
                elif stack[at][0] not in INLINE and (stack[at][0] in STOPS.get(tag, ()) or tag not in STOPS):
                    break
            flush()
            if tag in VOID:
                continue
            attrs = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in ATTR.finditer(m[4])} if m[4] else {}
            self.parent.append(stack[-1][1])
            self.tag.append(tag)
            self.names.append(frozenset(re.findall("[a-z]+", " ".join(attrs.get(k, "") for k in ("class", "id", "role")).lower())) if attrs else frozenset())
            self.label.append(attrs.get("data-y"))
            self.own.append(0)
            self.linked.append(0)
            stack.append((tag, len(self.tag) - 1))
            held[tag] += 1
        flush()

    def boxes(self) -> list[bool]:
        """Which nodes lie in an element that is by its name no content, or whose text is mostly links."""
        n = len(self.tag)
        size, linked = self.own[:], self.linked[:]
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
            linked[self.parent[i]] += linked[i]
        out = [False] * n
        for i in range(1, n):
            out[i] = out[self.parent[i]] or self.tag[i] in BOXES or not self.names[i].isdisjoint(_OFF) or 2 * linked[i] > size[i]
        return out

    def features(self) -> list[list[str]]:
        """Names of the features that hold at each node."""
        n = len(self.tag)
        size, linked = self.own[:], self.linked[:]
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
            linked[self.parent[i]] += linked[i]
        out = []
        for i in range(n):
            share = linked[i] / size[i] if size[i] else 0
            out.append(["one", "tag " + self.tag[i], "size %d" % min(4, int(math.log(size[i] + 1, 6))), "links %d" % min(3, int(4 * share)),
                        *["named off"] * (not self.names[i].isdisjoint(_OFF)), *["named on"] * (not self.names[i].isdisjoint(_ON)),
                        *("name " + x for x in sorted(self.names[i] - _OFF - _ON))])
        return out

    def kinds(self) -> list[int]:
        return [int(t in TEXT) for t in self.tag]


def marginals(parent: list[int], odds: list[float], kinds: list[int], pairs: list[list[list[float]]]) -> tuple[list[float], list[list[float]]]:
    """P(content) of each node, and P(parent, child) of each node with its parent as [00, 01, 10, 11].

    ``odds`` are the nodes' own log-potentials of content; ``pairs[kind][parent][child]`` those between parent and child.
    """
    n = len(parent)
    psi = [[[math.exp(x) for x in row] for row in p] for p in pairs]
    up = [[1.0, math.exp(max(-30.0, min(30.0, o)))] for o in odds]
    sent = [[1.0, 1.0]] * n
    for i in range(n - 1, 0, -1):
        (a, b), p, to = up[i], psi[kinds[i]], up[parent[i]]
        s = a + b
        m0, m1 = (p[0][0] * a + p[0][1] * b) / s, (p[1][0] * a + p[1][1] * b) / s
        sent[i] = [m0, m1]
        t0, t1 = to[0] * m0, to[1] * m1
        up[parent[i]] = [t0 / (t0 + t1), t1 / (t0 + t1)]
    belief, both = [0.0] * n, [[0.0] * 4] * n
    full: list = [None] * n
    full[0] = up[0]
    belief[0] = up[0][1] / sum(up[0])
    for i in range(1, n):
        f, p, u = full[parent[i]], psi[kinds[i]], up[i]
        c0, c1 = f[0] / sent[i][0], f[1] / sent[i][1]
        j = [c0 * p[0][0] * u[0], c0 * p[0][1] * u[1], c1 * p[1][0] * u[0], c1 * p[1][1] * u[1]]
        s = sum(j)
        both[i] = [x / s for x in j]
        belief[i] = both[i][1] + both[i][3]
        full[i] = [both[i][0] + both[i][2], belief[i]]
    return belief, both


def _labels(page: Page) -> list[int]:
    y = [0] * len(page.tag)
    for i in range(1, len(y)):
        y[i] = y[page.parent[i]] if page.label[i] is None else int(page.label[i])
    return y


@lru_cache(maxsize=1)
def trained(rounds: int = 250, rate: float = 0.6, ridge: float = 0.0003) -> tuple[dict[str, float], list[list[list[float]]]]:
    """Weights of features and of parent-child pairs that fit the labelled pages."""
    pages = [(p, p.features(), p.kinds(), _labels(p)) for p in map(Page, LABELLED)]
    names = sorted({f for _, fs, *_ in pages for x in fs for f in x})
    place = {f: i for i, f in enumerate(names)}
    at = [[[place[f] for f in x] for x in fs] for _, fs, *_ in pages]
    w, e, sw, se = np.zeros(len(names)), np.zeros((2, 2, 2)), np.full(len(names), 1e-6), np.full((2, 2, 2), 1e-6)
    for _ in range(rounds):
        gw, ge = -ridge * w * len(pages), -ridge * e * len(pages)
        for (page, _, kinds, y), own in zip(pages, at, strict=True):
            belief, both = marginals(page.parent, [float(w[x].sum()) for x in own], kinds, e.tolist())
            for i, x in enumerate(own):
                gw[x] += y[i] - belief[i]
                if i:
                    ge[kinds[i]].ravel()[:] -= both[i]
                    ge[kinds[i], y[page.parent[i]], y[i]] += 1
        sw, se = sw + gw * gw, se + ge * ge
        w, e = w + rate * gw / np.sqrt(sw), e + rate * ge / np.sqrt(se)
    return dict(zip(names, w.tolist(), strict=True)), e.tolist()


def main_text(html: str | None, weights: dict[str, float], pairs: list) -> str:
    """Kept blocks joined by two line ends; '' for null and for pages without content.

    Where no block is likelier content than not, as on pages that are paragraphs and nothing else, those outside of menus, notices
    and the like are kept.
    """
    if not html:
        return ""
    page = Page(html)
    belief, _ = marginals(page.parent, [sum(weights.get(f, 0.0) for f in x) for x in page.features()], page.kinds(), pairs)
    kept = [text for node, text in page.blocks if belief[node] > 0.5]
    if not kept:
        boxed = page.boxes()
        kept = [text for node, text in page.blocks if not boxed[node]]
    return "\n\n".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html, anything else).

    Scripts, styles, forms' fields and comments of the markup are never text; character references are decoded; white space
    within a block, line breaks included, is one space. Null and empty pages have an empty text. Every page is worked on by itself.
    """
    weights, pairs = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                texts = [main_text(h, weights, pairs) for h in b.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])
    rows = as_rows(pages).select(F.col("row.page_id").cast("long").alias("page_id"), F.col("row.url").alias("url"), F.col("row.html").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
