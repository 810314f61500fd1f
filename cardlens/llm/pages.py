"""Main text of web pages by wrapper induction over pages of one host.

Each page becomes a small tree of its elements.  For every layout of a host one page is
the pivot, and every page of that layout is aligned with it by simple tree matching.  Sums over all
pages tell, for each node of the pivot, in how many pages it was found, in how many
with the same text, and how much text varied there.  Constant nodes are template; the
slot where most text varies holds the content.  A page is then aligned with its host's
pivot once more; the text of the node in that slot, and of what the page itself declares
as its content, without the template, is its main text.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.workspace import snapshot

# HTML's own classes of elements and the words that label boilerplate (fixed values)
TEXTUAL = set("h1 h2 h3 h4 h5 h6 p".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set("a abbr b bdi bdo cite code data dfn em font i ins del kbd label mark q s samp small span strike strong sub sup time tt u var".split())
DROPPED = set("script style head title template noscript iframe object embed svg canvas form button select option textarea input nav footer aside menu dialog".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = set("table ul ol dl select body html article section div main".split())
LABELS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs footer sidebar widget related "
    "recommended share sharing social cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond "
    "replies form search pagination pager toolbar skip banner masthead".split()
)
# one of these words is enough, unless one of the others stands with it
ALONE = set("ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored cookie cookies consent gdpr comment comments disqus newsletter".split())
NEGATED = set("no non not with without has have free hide hidden disable disabled".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S
)
SIMPLE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SHARED = 0.95
# pivots and wrappers that a worker keeps at hand
PIVOTS = 128
LEAST_PAGES = 4
EXACT_CELLS = 2500  # child lists up to this size are aligned exactly; longer ones by anchors and runs
ALIGNED_DEPTH = 150  # template is induced down to this depth; an element there is one block with all that is below it


@dataclass
class Node:
    tag: str
    labels: frozenset = frozenset()
    role: str = ""
    children: list = field(default_factory=list)  # nodes and texts in order
    mark: int = -1  # place in the pivot
    text: str = ""  # of a leaf that is aligned: its length and digest
    names: frozenset = frozenset()  # whole class and id values
    kept: bool = False  # neither labels nor being a form make it boilerplate

    @property
    def key(self) -> tuple:
        return (self.tag, self.labels)

    def elements(self) -> list["Node"]:
        return [c for c in self.children if isinstance(c, Node)]


def described(tag: str, attributes: str) -> Node:
    """An element with its labels and role."""
    given = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    # an id of a heading or paragraph is the target of a link, commonly made from its text
    named = f"{given.get('class', '')} {'' if tag in TEXTUAL else given.get('id', '')}".lower()
    words = frozenset(w for w in re.split(r"[^a-z]+", named) if w)
    return Node(tag, words, given.get("role", "").lower(), names=frozenset(named.split()))


def parse(source: str) -> Node:
    """A tree of the page; unclosed and stray tags are taken as browsers commonly do."""
    root = Node("#root")
    stack, at, low = [root], 0, source.lower()
    open_: dict[str, int] = {}  # of each tag, how many are in the stack

    def leave(depth: int) -> None:
        for n in stack[depth:]:
            open_[n.tag] -= 1
        del stack[depth:]

    while at < len(source):
        begin = source.find("<", at)
        if begin < 0:
            stack[-1].children.append(source[at:])
            break
        if begin > at:
            stack[-1].children.append(source[at:begin])
        found = TOKEN.match(source, begin) or SIMPLE_TAG.match(source, begin)
        if not found:
            stack[-1].children.append("<")
            at = begin + 1
            continue
        at = found.end()
        if not found.re.groups or found[2] is None:
            continue
        tag, closing = found[2].lower(), bool(found[1])
        if closing:
            for depth in range(len(stack) - 1, 0, -1) if open_.get(tag) else ():
                if stack[depth].tag == tag:
                    leave(depth)
                    break
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break
            continue
        if tag in CLOSES_P and open_.get("p"):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    leave(depth)
                    break
                if stack[depth].tag not in INLINE:
                    break
        if tag in CLOSES_SELF:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in CLOSES_SELF[tag]:
                    leave(depth)
                    break
                if stack[depth].tag in STOPS:
                    break
        node = described(tag, found[3]) if found[3] else Node(tag)
        stack[-1].children.append(node)
        if tag in RAW:
            end = low.find("</" + tag, at)
            end = len(source) if end < 0 else end
            node.children.append(source[at:end])
            close = source.find(">", end)
            at = len(source) if close < 0 else close + 1
        elif tag not in VOID and not (found[3] or "").endswith("/"):
            stack.append(node)
            open_[tag] = open_.get(tag, 0) + 1
    return root


@lru_cache(1 << 14)
def names_boilerplate(value: str) -> bool:
    """Whether a class or id value, as a whole, is a label of boilerplate, or has a word that nothing but boilerplate has.

    ``comments-area`` and ``google-ad`` are; ``with-sidebar`` and ``related-work`` may be the content, ``ad-free`` is.
    """
    words = [w for w in re.split("[^a-z]+", value) if w]
    return bool(words) and (value in LABELS or LABELS.issuperset(words) or not ALONE.isdisjoint(words) and NEGATED.isdisjoint(words))


def labelled(node: Node) -> bool:
    """A form, or one of its class and id values names boilerplate."""
    if node.tag == "form" or node.role == "form":
        return True
    if not node.names:
        return False
    if node.tag == "article":
        return bool(node.names & {"comment", "related", "ad", "sponsored"})
    return node.tag not in ("html", "body", "main") and any(map(names_boilerplate, node.names))


def boilerplate(node: Node, inside: bool, labels: bool = True) -> bool:
    """Named as such by its tag, role or labels; a heading part inside the content is no page header."""
    if node.tag != "form" and (node.tag in DROPPED or node.role in ROLES - {"form"}) or (node.tag == "header" and not inside):
        return True
    return labels and bool(node.names or node.role or node.tag == "form") and not node.kept and labelled(node)


def text_of(node: Node, constant: frozenset = frozenset(), inside: bool = True) -> str:
    """The node's text: references decoded, white space to single blanks, blocks joined by one blank."""
    parts: list[str] = []
    ahead = node.children[::-1]  # the next one last
    while ahead:
        child = ahead.pop()
        if isinstance(child, str):
            parts.append(html.unescape(child))
        elif not boilerplate(child, inside) and child.mark not in constant:
            if child.tag not in INLINE:
                parts.append(" ")
                ahead.append(" ")
            ahead += child.children[::-1]
    return " ".join("".join(parts).split())


def anchored(xs: list[Node], ys: list[Node]) -> list[tuple[int, int]]:
    """Pairs of leaves of equal key and text that are the only ones of their kind on both sides, in order."""
    def single(nodes: list[Node]) -> dict[tuple, int]:
        seen: dict[tuple, int] = {}
        for i, n in enumerate(nodes):
            if n.text:
                mark = (n.key, n.text)
                seen[mark] = -1 if mark in seen else i
        return {m: i for m, i in seen.items() if i >= 0}

    left, right = single(xs), single(ys)
    both = [(i, right[m]) for m, i in left.items() if m in right]
    # longest rising chain of places on the right
    ends: list[int] = []
    last: list[int] = []
    before = [-1] * len(both)
    for k, (_, j) in enumerate(both):
        at = bisect_left(ends, j)
        before[k] = last[at - 1] if at else -1
        ends[at : at + 1] = [j]
        last[at : at + 1] = [k]
    chain, k = [], last[-1] if last else -1
    while k >= 0:
        chain.append(both[k])
        k = before[k]
    return chain[::-1]


def runs_of(nodes: list[Node]) -> list[tuple[tuple, int, int]]:
    """Runs of equal keys: key, start, end."""
    made, start = [], 0
    for i in range(1, len(nodes) + 1):
        if i == len(nodes) or nodes[i].key != nodes[start].key:
            made.append((nodes[start].key, start, i))
            start = i
    return made


def long_pairs(xs: list[Node], ys: list[Node]) -> list[tuple[int, int]]:
    """An alignment of two long lists without a table of all their pairs.

    Equal ends first, then leaves of one text, and between those runs of equal keys.
    """
    same = lambda x, y: x.key == y.key and x.text == y.text
    low, high_x, high_y = 0, len(xs), len(ys)
    while low < min(high_x, high_y) and same(xs[low], ys[low]):
        low += 1
    while min(high_x, high_y) > low and same(xs[high_x - 1], ys[high_y - 1]):
        high_x, high_y = high_x - 1, high_y - 1
    pairs = [(i, i) for i in range(low)]
    stops = [(low + i, low + j) for i, j in anchored(xs[low:high_x], ys[low:high_y])] + [(high_x, high_y)]
    from_x = from_y = low
    for to_x, to_y in stops:
        left, right = runs_of(xs[from_x:to_x]), runs_of(ys[from_y:to_y])
        for a, b, size in SequenceMatcher(None, [r[0] for r in left], [r[0] for r in right], False).get_matching_blocks():
            for (_, i, end_i), (_, j, end_j) in zip(left[a : a + size], right[b : b + size]):
                # the last ones of a run face each other, as in the exact alignment
                n = min(end_i - i, end_j - j)
                pairs += [(from_x + end_i - n + k, from_y + end_j - n + k) for k in range(n)]
        if to_x < high_x:
            pairs.append((to_x, to_y))
        from_x, from_y = to_x + 1, to_y + 1
    return pairs + [(high_x + k, high_y + k) for k in range(len(xs) - high_x)]


def match(a: Node, b: Node, pairs: list[tuple[Node, Node]] | None = None) -> int:
    """Simple tree matching: the largest number of pairs of equal nodes, in order and under equal parents.

    Fills ``pairs`` with the pairs of one such matching.  Of equally large ones, leaves of equal text decide.
    Lists with more than EXACT_CELLS pairs of children are aligned as a whole by ``long_pairs``.
    """
    memo: dict[tuple[int, int], tuple[int, int]] = {}
    tables: dict[tuple[int, int], list] = {}  # by the first children

    def size(x: Node, y: Node) -> tuple[int, int]:
        if x.key != y.key:
            return 0, 0
        known = memo.get((id(x), id(y)))
        if known is None:
            xs, ys = x.elements(), y.elements()
            more, alike = 0, int(bool(x.text) and x.text == y.text)
            if xs and ys:
                if len(xs) * len(ys) > EXACT_CELLS:
                    found = [size(xs[i], ys[j]) for i, j in long_pairs(xs, ys)]
                    more, alike = sum(f[0] for f in found), alike + sum(f[1] for f in found)
                else:
                    below = table(xs, ys)[-1][-1]
                    more, alike = below[0], alike + below[1]
            known = memo[id(x), id(y)] = 1 + more, alike
        return known

    def table(xs: list[Node], ys: list[Node]) -> list[list[tuple[int, int]]]:
        known = tables.get((id(xs[0]), id(ys[0])))
        if known is not None:
            return known
        rows = [[(0, 0)] * (len(ys) + 1)]
        others = [(y, y.key, not y.children, y.text) for y in ys]
        for x in xs:
            last, left = rows[-1], (0, 0)
            row, key, leaf, text = [left], x.key, not x.children, x.text
            for j, (y, other, other_leaf, other_text) in enumerate(others):
                best = last[j + 1]
                if left > best:
                    best = left
                if key == other:
                    more, alike = (1, 1 if text and text == other_text else 0) if leaf or other_leaf else size(x, y)
                    before = last[j]
                    both = (before[0] + more, before[1] + alike)
                    if both > best:
                        best = both
                row.append(best)
                left = best
            rows.append(row)
        tables[id(xs[0]), id(ys[0])] = rows
        return rows

    def trace(x: Node, y: Node) -> None:
        pairs.append((x, y))
        xs, ys = x.elements(), y.elements()
        if not xs or not ys:
            return
        if len(xs) * len(ys) > EXACT_CELLS:
            for i, j in long_pairs(xs, ys):
                trace(xs[i], ys[j])
            return
        rows = table(xs, ys)
        i, j = len(rows) - 1, len(rows[0]) - 1
        while i and j:
            more, before = size(xs[i - 1], ys[j - 1]), rows[i - 1][j - 1]
            if more[0] and rows[i][j] == (before[0] + more[0], before[1] + more[1]):
                trace(xs[i - 1], ys[j - 1])
                i, j = i - 1, j - 1
            elif rows[i][j] == rows[i - 1][j]:
                i -= 1
            else:
                j -= 1

    total = size(a, b)[0]
    if pairs is not None and total:
        trace(a, b)
    return total


def signed(text: str) -> str:
    """Length and digest of a leaf's whole text."""
    return f"{len(text)}:{xxhash.xxh3_128_hexdigest(text)}" if text else ""


def blocks_of(node: Node, depth: int) -> list[Node]:
    """The children that are aligned; in-line elements, scripts and breaks are no blocks of their own."""
    return [c for c in node.elements() if c.tag not in INLINE and c.tag not in RAW and c.tag not in VOID] if depth < ALIGNED_DEPTH else []


def skeleton(node: Node, depth: int = 1) -> list:
    """The tree for the pivot: tag, labels, digest of the text, children; in-line elements are part of the text."""
    blocks = [skeleton(c, depth + 1) for c in blocks_of(node, depth)]
    return [node.tag, sorted(node.labels), signed(text_of(node)) if not blocks else "", blocks, sorted(node.names)]


def revived(spec: list, numbered: list[Node]) -> Node:
    node = Node(spec[0], frozenset(spec[1]), names=frozenset(spec[4]), text=spec[2])
    node.mark = len(numbered)
    numbered.append(node)
    node.children = [revived(c, numbered) for c in spec[3]]
    return node


def trimmed(node: Node, depth: int = 1) -> Node:
    """The same tree as in the pivot, pointing at the page's own nodes."""
    copy = Node(node.tag, node.labels)
    copy.children = [trimmed(c, depth + 1) for c in blocks_of(node, depth)]
    copy.text = "" if copy.children else signed(text_of(node))
    copy.role = node  # the page's node
    return copy


def align(pivot: Node, page: Node) -> list[tuple[Node, Node, bool]]:
    """Pairs of pivot's and page's nodes, and whether they are leaves of one text."""
    pairs: list[tuple[Node, Node]] = []
    match(pivot, trimmed(page), pairs)
    return [(p, own.role, not p.children and not own.children and own.text == p.text) for p, own in pairs]


def lengths(node: Node, known: dict[int, int]) -> int:
    """Characters of text below every node, left out what tags and roles drop; fills ``known`` by the nodes' identity."""
    for n in reversed([node, *_all(node)]):
        total = 0
        for child in n.children:
            if isinstance(child, str):
                total += len(child.strip())
            elif not boilerplate(child, True, labels=False):
                total += known[id(child)]
        known[id(n)] = total
    return known[id(node)]


def spare(root: Node) -> list[Node]:
    """Keep the labelled nodes that hold all the declared content which the page has; gives its landmarks."""
    declared = landmarks(root)
    if declared:
        return declared

    seen, holding = [(root, None)], set()
    for n, _ in seen:  # parents before children
        seen += [(c, n) for c in n.elements() if not boilerplate(c, False, labels=False)]
    for n, above in reversed(seen[1:]):
        below = id(n) in holding
        if below and n.tag != "article" and labelled(n):
            n.kept = True
        if below or landmark(n) and not (n.tag == "article" and labelled(n)):
            holding.add(id(above))
    return landmarks(root) if holding else []


def spare_most(root: Node) -> None:
    """Keep the labelled nodes that hold more than half of the page's text."""
    known: dict[int, int] = {}
    lengths(root, known)
    for n in _all(root):
        if 2 * known[id(n)] > known[id(root)] and labelled(n):
            n.kept = True


@lru_cache(PIVOTS)
def pivot_of(pivot_json: str) -> tuple[Node, list[Node]]:
    """The pivot and its nodes by place; read by all pages of its host in a task, and changed by none."""
    numbered: list[Node] = []
    return revived(json.loads(pivot_json), numbered), numbered


class Wrapper:
    """What a host's pages have in common, ready for use."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.pivot = revived(spec["pivot"], [])
        self.constant, self.kept, self.slot = frozenset(spec["constant"]), frozenset(spec["kept"]), spec["slot"]


wrapper_from = lru_cache(PIVOTS)(Wrapper)


def observed(pivot_json: str, source: str) -> list[tuple[int, int, int, int]]:
    """Per aligned node of the pivot: its place, 1 if the text is the same, and the length of text here."""
    (pivot, _), page = pivot_of(pivot_json), parse(source)
    known: dict[int, int] = {}
    lengths(page, known)
    return [(p.mark, int(same), known[id(own)]) for p, own, same in align(pivot, page)]


def landmark(n: Node) -> str:
    return "article" if n.tag == "article" or "articlebody" in n.labels else "main" if n.tag == "main" or n.role == "main" else ""


def landmarks(root: Node) -> list[Node]:
    """Elements that declare themselves the main content, outermost and in page order, boilerplate left out."""
    found: list[Node] = []
    ahead = root.elements()[::-1]
    while ahead:
        n = ahead.pop()
        if boilerplate(n, False):
            continue
        if landmark(n):
            found.append(n)
        else:
            ahead += n.elements()[::-1]
    return found


def parts_of(root: Node, slot: Node | None, declared: list[Node]) -> list[Node]:
    """Where the content is, outermost nodes in page order: the host's slot and what the page declares.

    Declared parts widen a slot inside them and stand beside one elsewhere; they narrow a slot around them
    if they hold most of its text.
    """
    if slot is None:
        return declared
    inner = [n for n in declared if n is slot or _holds(slot, n)]
    if not inner and any(_holds(n, slot) for n in declared):
        return declared
    known: dict[int, int] = {}
    if inner and 2 * sum(lengths(n, known) for n in inner) >= lengths(slot, known):
        return declared
    chosen = [slot, *(n for n in declared if not any(n is i for i in inner))]
    return [n for n in _all(root) if any(n is c for c in chosen)]


def extract(source: str, wrapper: str | None) -> str:
    """Main text of one page: the content without the host's template, else the page without boilerplate."""
    root = parse(source)
    declared = spare(root)
    constant: frozenset[int] = frozenset()
    slot = None
    if wrapper:
        host = wrapper_from(wrapper)
        constant = host.constant
        for p, own, _ in align(host.pivot, root):
            own.mark = p.mark
            own.kept = own.kept or p.mark in host.kept
            if p.mark == host.slot:
                slot = own
    if not declared and slot is None:
        spare_most(root)
    parts = parts_of(root, slot, declared)
    text = " ".join(filter(None, (text_of(n, constant) for n in parts)))
    if not text and declared:  # declared content that all pages share
        text = " ".join(filter(None, map(text_of, declared)))
    if text:
        return text
    bodies = [n for n in _all(root) if n.tag == "body"]
    return text_of(bodies[0] if bodies else root, constant, inside=False)


def _all(node: Node) -> Iterator[Node]:
    """The elements below a node, in page order."""
    ahead = node.elements()[::-1]
    while ahead:
        n = ahead.pop()
        yield n
        ahead += n.elements()[::-1]


def _holds(outer: Node, inner: Node) -> bool:
    return any(n is inner for n in _all(outer))


def wrapper_of(pivot_json: str, stats: list[tuple[int, int, int, int]]) -> str:
    """The host's wrapper: which nodes are template, and the slot of the content.

    The slot is the deepest node that holds most of the text that varies.
    """
    numbered: list[Node] = []
    revived(json.loads(pivot_json), numbered)
    pages, same, length = ({m: row[i] for m, *row in stats} for i in range(3))
    most = max(pages.values(), default=0)
    constant = [m for m in pages if not numbered[m].children and pages[m] >= LEAST_PAGES and same[m] >= SHARED * pages[m]]
    slot, kept = 0, []
    if most >= LEAST_PAGES:
        fixed, net = set(constant), {}

        def varying(n: Node) -> int:
            below = [(c, varying(c)) for c in n.elements()]
            net[n.mark] = 0 if n.mark in fixed else max(0, length.get(n.mark, 0) - sum(length.get(c.mark, 0) - v for c, v in below if not boilerplate(c, True, labels=False)))
            return net[n.mark]

        whole = varying(numbered[0])
        for n in numbered:
            if labelled(n) and 2 * net[n.mark] > whole:
                n.kept = True
                kept.append(n.mark)

        def content(n: Node) -> int:
            below = [(c, content(c)) for c in n.elements()]
            net[n.mark] -= sum(before[c.mark] - (0 if boilerplate(c, True) else v) for c, v in below if not boilerplate(c, True, labels=False))
            return net[n.mark]

        before = dict(net)
        content(numbered[0])
        node = numbered[0]
        while True:
            inner = [c for c in node.elements() if not boilerplate(c, False) and pages.get(c.mark, 0) >= 0.5 * most]
            inner = [c for c in inner if net[c.mark] >= 0.7 * net[node.mark] and c.children]
            if not inner:
                break
            node = max(inner, key=lambda c: net[c.mark])
        slot = node.mark
    return json.dumps({"pivot": json.loads(pivot_json), "constant": constant if most >= LEAST_PAGES else [], "kept": kept, "slot": slot if slot else -1})


def layout_of(page: Column) -> Column:
    """Signature of a page's layout: which containers it has, by tag, letters of the class, and ids of one plain word."""
    tags = F.regexp_extract_all(page, F.lit(r"(?i)<(?:div|section|main|article|table|form|header|footer|nav|aside)(?:\s[^<>]*)?>"), F.lit(0))

    def plain(tag: Column) -> Column:
        kind = F.regexp_extract(tag, r"(?i)^<([a-z]+)", 1)
        names = F.regexp_extract(tag, r"""(?i)\sclass\s*=\s*("[^"]*"|'[^']*'|[^\s>]*)""", 1)
        own = F.regexp_extract(tag, r"""(?i)^<(?:div|main|table|form)\s(?:[^>]*\s)?id\s*=\s*["']?([A-Za-z]+)["'\s>]""", 1)
        return F.concat_ws("|", F.lower(kind), F.regexp_replace(F.lower(names), "[^a-z ]", ""), F.lower(own))

    return F.xxhash64(F.array_join(F.array_sort(F.array_distinct(F.transform(F.array_distinct(tags), plain))), ">"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: ``page_id, url, text, n_chars``.

    Pages without a host (null or odd address) form one host of their own.  A null or empty page has an empty text.
    Every layout of a host has its own template.  Identical pages count once when it is induced; hosts with fewer than
    LEAST_PAGES different pages have no template, and their pages are read by their own landmarks.  Rows repeated with one id are all kept;
    an empty table gives an empty result; other columns are not looked at.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    source = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), source.alias("html"), host.alias("host"), layout_of(source).alias("layout"))

    def skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [json.dumps(skeleton(parse(s)), ensure_ascii=False) for s in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("part"), pa.array(made, pa.string())], ["host", "part", "pivot"])

    # copies of a page would make its content look like template: of equal pages the least id counts
    once = snapshot(rows.filter("html <> ''").groupBy("host", "layout", F.xxhash64("html").alias("h")).agg(F.min("page_id").alias("page_id")))
    layouts = once.groupBy("host", "layout").agg(F.count("*").alias("n"), F.min(F.struct("page_id", "h")).alias("_f"))
    largest = layouts.groupBy("host").agg(F.max(F.struct("n", "layout"))["layout"].alias("largest"))
    # layouts of too few pages are read with the wrapper of the host's largest
    part = F.when(F.col("n") >= LEAST_PAGES, F.col("layout")).otherwise(F.col("largest"))
    parts = snapshot(layouts.join(largest, "host").select("host", "layout", part.alias("part"), "_f.*"))
    first = parts.filter("layout = part").select("host", "part", "page_id", "h")
    chosen = rows.join(first, ["host", "page_id"]).filter(F.xxhash64("html") == F.col("h")).select("host", "part", "html")
    pivots = snapshot(chosen.mapInArrow(skeletons, "host string, part bigint, pivot string").groupBy("host", "part").agg(F.min("pivot").alias("pivot")))

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sums = zip(batch.column("host").to_pylist(), batch.column("part").to_pylist()), {}
            for key, pivot, source in zip(keys, batch.column("pivot").to_pylist(), batch.column("html").to_pylist()):
                for mark, same, length in observed(pivot, source):
                    total = sums.setdefault((*key, mark), [0, 0, 0])
                    total[0] += 1
                    total[1] += same
                    total[2] += length
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int64()), pa.array([k[2] for k in sums], pa.int32()), *[pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(3)]],
                ["host", "part", "mark", "pages", "same", "length"],
            )

    counted = once.join(parts.select("host", "layout", "part"), ["host", "layout"]).select("host", "page_id", "part").distinct()
    distinct_pages = rows.join(counted, ["host", "page_id"]).select("host", "part", "html")
    seen = distinct_pages.join(pivots, ["host", "part"]).mapInArrow(observe, "host string, part bigint, mark int, pages bigint, same bigint, length bigint")
    sums = seen.groupBy("host", "part", "mark").agg(*[F.sum(c).alias(c) for c in ("pages", "same", "length")])
    stats = sums.groupBy("host", "part").agg(F.sort_array(F.collect_list(F.struct("mark", "pages", "same", "length"))).alias("stats"))

    def induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [wrapper_of(p, [tuple(r.values()) for r in s]) for p, s in zip(batch.column("pivot").to_pylist(), batch.column("stats").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("part"), pa.array(made, pa.string())], ["host", "part", "wrapper"])

    wrappers = snapshot(stats.join(pivots, ["host", "part"]).select("host", "part", "pivot", "stats").mapInArrow(induce, "host string, part bigint, wrapper string"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(s, w) for s, w in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    placed = rows.join(parts.select("host", "layout", "part"), ["host", "layout"], "left")
    joined = placed.join(wrappers, ["host", "part"], "left").select("page_id", "url", "html", "wrapper")
    return joined.mapInArrow(read, f"page_id {kind}, url string, text string, n_chars bigint")
