"""HTML main-text extraction by minimum-cut labelling (operator 3).

A page is read once into text blocks with what their markup says. Each block
gets two classifier costs, of being called content and of being called
boilerplate; these are its terminal capacities. Neighbouring blocks, and
blocks near in the tree, are joined by smoothness edges. The minimum cut
between the two terminals is the labelling of least total cost, found by
max-flow; blocks on the content side are the main text.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
#: One attribute after the other, its value with it, so that no name is found inside a value or another name.
ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?|[\s=\"'/]+")
SPACE = re.compile(r"[\s ]+")

#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template svg iframe object canvas select option textarea button head title audio video map datalist".split())
#: Elements read as raw text up to their end tag.
RAW = frozenset("script style textarea title noscript iframe".split())
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Elements that a new block of the first kind closes when still open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure".split())
#: Weights for the log-odds of content, per element around a block.
AROUND = {"article": 3.0, "main": 2.5, "nav": -7.0, "footer": -7.0, "aside": -6.0, "form": -7.0, "header": -2.5, "menu": -6.0, "dialog": -6.0, "address": -2.0, "figcaption": 0.0}
#: Class and id words that speak against content, and those of reader comments.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice gdpr popup modal overlay newsletter subscribe signup login "
    "sidebar widget widgets related recommended share sharing social toolbar nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager "
    "footer foot masthead topbar copyright legal disclaimer skip search tags taboola outbrain hidden header".split()
)
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: Words that only say what shape the element has: a name is about what stands before them.
SHAPES = frozenset(
    "area bar block body box button card cell column container content element form group holder inner item items label left link links list main menu module number "
    "page panel post posts right row section site slot strip text title top unit widget wrap wrapper zone".split()
)
IS_CONTENT = frozenset("article articlebody content entry post story main body text".split())
PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
ROLES = {"navigation": -7.0, "banner": -4.0, "contentinfo": -7.0, "complementary": -6.0, "search": -7.0, "form": -7.0, "dialog": -6.0, "alert": -5.0, "main": 2.5, "article": 3.0}
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: How far names around an ``article`` or ``main`` may count against it.
NAMED_AROUND = -2.0
#: Smoothness capacities: next block, and the same parent element.
NEXT_EDGE, PARENT_EDGE = 0.6, 0.8


def name_kind(token: str) -> str:
    """What one class or id says: ``comments``, ``boilerplate``, ``content`` or nothing.

    A name is taken apart at hyphens, underscores and capitals. It is judged by
    its last word, or by what is left when words of mere shape and numbers go:
    ``site-footer`` and ``comments-area`` are boilerplate, ``legal-analysis`` is not.
    """
    parts = [x.lower() for x in PARTS.split(token) if x]
    told = [x for x in parts if x not in SHAPES and not x.isdigit()]
    if told and all(x in COMMENTS or x in ("div", "reader", "user", "thread") for x in told) and any(x in COMMENTS for x in told):
        return "comments"
    if told and (all(x in BOILERPLATE for x in told) or parts[-1] in BOILERPLATE and len(told) <= 2):
        return "boilerplate"
    if parts and all(x in IS_CONTENT or x in SHAPES for x in parts) and any(x in IS_CONTENT for x in parts):
        return "content"
    return ""


def element_weight(name: str, attrs: str) -> tuple[float, float, bool]:
    """(log-odds by what the element is, by how it is named, whether it is hidden).

    A name counts less than what an element is: ``article`` and ``main`` are not
    boilerplate because of a class word, unless they are reader comments.
    """
    kind, named = AROUND.get(name, 0.0), 0.0
    if not attrs:
        return kind, named, False
    hidden, said = False, set()
    for m in ATTR.finditer(attrs):
        if m[1] is None:
            continue
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id"):
            if name not in ("html", "body"):
                said.update(map(name_kind, value.split()))
        elif key == "role":
            kind += ROLES.get(value.lower(), 0.0)
        elif key == "itemprop" and value.lower() == "articlebody":
            kind += 3.0
        elif key == "hidden":
            hidden = True
        elif key == "style" and HIDING.search(value):
            hidden = True
    if "comments" in said:
        kind -= 5.5 + max(kind, 0.0)
    elif "boilerplate" in said and name not in ("article", "main"):
        named -= 5.5
    elif "content" in said and "boilerplate" not in said:
        named += 1.5
    return kind, named, hidden


class Block:
    __slots__ = ("heading", "in_list", "link_chars", "parent", "path", "text", "weight")

    def __init__(self, text, link_chars, weight, heading, in_list, parent, path):
        self.text, self.link_chars, self.weight = text, link_chars, weight
        self.heading, self.in_list, self.parent, self.path = heading, in_list, parent, path


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order; markup that never closes is taken as it comes."""
    out: list[Block] = []
    # an open element: (name, serial, log-odds by kind and by name with all above, silent, index of the block element it is in)
    stack: list[tuple[str, int, float, float, bool, int]] = [("", 0, 0.0, 0.0, False, 0)]
    where: dict[str, list[int]] = {}  # open elements by name, so that nothing walks the stack
    pieces: list[str] = []
    state = {"links": 0, "serial": 0}

    def last(*names: str) -> int:
        return max((where[n][-1] for n in names if where.get(n)), default=0)

    def flush() -> None:
        if pieces:
            text = SPACE.sub(" ", html_lib.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                top = stack[-1]
                at = top[5]
                out.append(Block(text, state["links"], top[2] + top[3], any(where.get(h) for h in HEADINGS), bool(where.get("li")), stack[max(0, at - 1)][1], stack[at][1]))
        state["links"] = 0

    def close_to(i: int) -> None:
        if stack[-1][5] >= i:  # a block element is among them
            flush()
        for e in stack[i:]:
            where[e[0]].pop()
        del stack[i:]

    def say(text: str) -> None:
        if text and not stack[-1][4]:
            pieces.append(text)
            if where.get("a"):
                state["links"] += len(text.strip())

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            rest = page[at:]
            cut = re.search(r"<[/a-zA-Z!?][^<>]*\Z", rest)  # a tag cut off by the end of the page
            say(rest[: cut.start()] if cut else rest)
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            i = last(name)
            if name == "p" and not i:
                flush()
            elif i and (name not in INLINE or i > stack[-1][5]):  # an inline end tag stays inside its block
                close_to(i)
            continue
        if name in ENDS_P:
            i = last("p")
            if i > last("td", "th", "button", "object"):
                close_to(i)
        if name in CLOSES:
            i = last(*CLOSES[name])
            if i > last("ul", "ol", "dl", "table"):
                close_to(i)
        if name not in INLINE:
            flush()
        if name in ("br", "hr"):
            say(" ")
        if name in VOID or m[3].endswith("/") and name in ("svg", "iframe"):
            continue
        if name in RAW:
            end = RAW_END[name].search(page, at)
            at = end.end() if end else size
            continue
        kind, named, hidden = element_weight(name, m[3])
        top = stack[-1]
        around = max(top[3], NAMED_AROUND) if name in ("article", "main") else top[3]
        state["serial"] += 1
        where.setdefault(name, []).append(len(stack))
        stack.append((name, state["serial"], top[2] + kind, around + named, top[4] or hidden or name in SILENT, top[5] if name in INLINE else len(stack)))
    flush()
    return out


def log_odds(b: Block) -> float:
    """Classifier: how much more likely a block is content than boilerplate."""
    n = len(b.text)
    words = b.text.count(" ") + 1
    z = b.weight - 0.6
    z += 1.2 * min(words, 40) / 20
    z -= 3.5 * min(1.0, b.link_chars / max(n, 1))
    if b.text[-1] in ".!?:\"”»…":
        z += 0.7
    if b.heading:
        z += 0.8
    if b.in_list and words < 6:
        z -= 0.7
    if re.match(r"(?:©|\(c\)\s|copyright\b|all rights reserved)", b.text, re.I) and b.weight < 2:
        z -= 4.0
    return z


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for nodes on the source (content) side of a minimum cut.

    A positive log-odds is a capacity from the source, a negative one to
    the sink, an edge a capacity both ways. Shortest augmenting paths by
    levels; a node that no residual path reaches from the source, ties
    included, is boilerplate.
    """
    n = len(odds)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    adj: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, c: float, back: float) -> None:
        adj[a].append(len(to))
        to.append(b)
        cap.append(c)
        adj[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, z in enumerate(odds):
        if z > 0:
            link(s, i, z, 0.0)
        elif z < 0:
            link(i, t, -z, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = [s]
        for a in queue:
            for e in adj[a]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        while True:  # one augmenting path at a time, without recursion
            path: list[int] = []
            a = s
            while a != t:
                while nxt[a] < len(adj[a]):
                    e = adj[a][nxt[a]]
                    if cap[e] > 1e-9 and level[to[e]] == level[a] + 1:
                        break
                    nxt[a] += 1
                if nxt[a] < len(adj[a]):
                    path.append(adj[a][nxt[a]])
                    a = to[path[-1]]
                elif a == s:
                    break
                else:
                    a = to[path.pop() ^ 1]
                    nxt[a] += 1
            if a != t:
                break
            flow = min(cap[e] for e in path)
            for e in path:
                cap[e] -= flow
                cap[e ^ 1] += flow


def main_text(page: str | None) -> str:
    """Main text of one page: content blocks in order, two newlines between; empty if there is none."""
    found = blocks(page or "")
    if not found:
        return ""
    odds = [log_odds(b) for b in found]
    if all(z > 0 for z in odds):
        chosen = [True] * len(found)
    elif all(z <= 0 for z in odds):
        return ""
    else:
        edges = []
        last: dict[int, int] = {}
        for i, b in enumerate(found):
            if i:
                edges.append((i - 1, i, NEXT_EDGE if b.path != found[i - 1].path else 2 * NEXT_EDGE))
            if b.parent in last:
                edges.append((last[b.parent], i, PARENT_EDGE))
            last[b.parent] = i
        chosen = minimum_cut(odds, edges)
    return "\n\n".join(b.text for b, keep in zip(found, chosen, strict=True) if keep)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Adds ``out``, the main text of every whole page, to ``pages``; null html gives an empty text.

    Every row gives one row; other columns stay as they are, but for an older
    one named ``out``. An empty table gives no rows. Pages are independent, so a lost task only repeats its own.
    """
    names = [c for c in pages.columns if c != out]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            texts = [main_text(x) for x in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != out)
    return pages.select(*[F.col(f"`{c}`") for c in names], F.col(html).alias("_html_")).mapInArrow(run, f"{schema}, `{out}` string")
