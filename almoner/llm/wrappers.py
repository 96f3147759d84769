"""Main text of web pages by wrapper induction.

Some pages of every layout of a host are aligned by simple tree matching to
one tree. All pages are aligned with it and counted: nodes that say the same on
nearly all pages that have them are the host's template; nodes that vary are slots. A page is aligned with its host's wrapper: template text goes, and
of the slots those outside the article or in parts that are named as menus,
adverts, comments and the like.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Callable, Iterator, Set
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almoner.llm.tables import keep

#: Different pages of a layout that propose the nodes of its host's wrapper; a host of fewer than LEAST_PAGES has none.
PAGES, LEAST_PAGES = 8, 3
#: A node is template if it says the same on this share of the pages that have it.
CONSTANT = 0.8
#: If so much of an unmarked page is constant, the pages are copies of each other, and nothing of it is template.
COPIES = 0.5
#: Pairs of children for which a table is made in plain Python; whose steps are remembered at once, two bits each (a larger table is gone
#: through again in PARTS); and pairs of different trees among them that are matched at once (beyond, those of one child after the other).
SMALL_TABLE, LARGE_TABLE, LARGE_KINDS, PARTS = 1 << 10, 1 << 29, 1 << 18, 16
#: Matches that are remembered of the children of one node, numbers of their scores, and such nodes one in another that are so matched.
MOST_MATCHES, MOST_SCORES, MOST_INSIDE = 1 << 17, 1 << 23, 50
#: Places of nodes for which a task holds pages before it hands them on.
MOST_PLACES = 1 << 17
#: Trees and matches that are remembered of a wrapper.
REMEMBERED = 1 << 13

# fixed values: how HTML is read
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "svg", "math", "template")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends these open elements, up to the element that holds them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
ASIDE = frozenset(
    "nav aside footer form head script style noscript template iframe svg math object canvas audio video button select input textarea dialog menu noframes noembed xmp title search".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
ASIDE_NAMES = frozenset(
    "nav navbar navigation menu menus header masthead topbar footer foot sidebar side aside rail ad ads advert adverts advertisement advertising adslot sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login form search comment comments commentlist reply replies respond "
    "discussion disqus share sharing social related recommended recommendations breadcrumb breadcrumbs pagination pager widget toolbar skip copyright legal hidden".split()
)
#: What may follow such a word in a name that still means the part itself.
PART_WORDS = frozenset(
    "left right top bottom inner outer wrap wrapper container holder area box block blocks bar list lists item items link links button buttons slot unit group panel row col column primary secondary "
    "main desktop mobile sticky fixed posts articles stories section form text message field title icon icons".split()
)
#: Names that begin so tell what a page has or lacks, or in which state it is.
STATES = frozenset("no not non has have with without is hide hides show shows".split())
#: On a section inside an article these words may be its subject.
SUBJECTS = frozenset("discussion legal copyright form notice notices notification alert related recommended search social header side".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.DOTALL
)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parts: list = field(default_factory=list)  # texts and nodes in page order
    said: str | None = None  # once it was asked for

    @property
    def children(self) -> list[Node]:
        return [p for p in self.parts if type(p) is Node]

    def own(self) -> str:
        """Text of the node itself, without its children's. Not asked for before the page is read."""
        if self.said is None:
            self.said = " ".join(" ".join([p for p in self.parts if type(p) is str]).split()) if self.parts else ""
        return self.said


def _read_attrs(raw: str) -> dict[str, str]:
    return {a[0].lower(): entities.unescape(a[1] or a[2] or a[3]) for a in _ATTR.findall(raw)}


@lru_cache(1 << 14)
def _known_attrs(raw: str) -> dict[str, str]:
    """Short ones are often the same; nobody changes a node's attributes."""
    return _read_attrs(raw)


def _open_one(stack: list[Node], tag: str) -> int:
    """The place of the innermost open element with this tag, 0 if there is none."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            return i
    return 0


def parse(html: str) -> Node:
    """A tree for any text: tags that are never closed, never opened or out of order included."""
    root = Node("#")
    stack, at = [root], 0

    def text(s: str) -> None:
        if s:
            stack[-1].parts.append(entities.unescape(s) if "&" in s else s)

    while (m := _TOKEN.search(html, at)) is not None:
        start, end = m.span()
        if start > at:
            text(html[at:start])
        at = end
        cdata, close, tag, raw = m.groups()
        if cdata is not None:
            stack[-1].parts.append(cdata)
        if not tag:
            continue
        tag = tag.lower()
        if close:
            if depth := _open_one(stack, tag):
                del stack[depth:]
            continue
        if tag in ENDS:
            ends, within = ENDS[tag]
            bound = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in within), 0)
            first = next((i for i in range(bound + 1, len(stack)) if stack[i].tag in ends), 0)
            if first:
                del stack[first:]
        elif tag in BLOCKS:
            # a paragraph ends where a block begins
            first = _open_one(stack, "p")
            if first and not any(s.tag in BLOCKS for s in stack[first + 1 :]):
                del stack[first:]
        attrs = (_known_attrs if len(raw) < 128 else _read_attrs)(raw) if len(raw) > 4 else {}
        node = Node(tag, attrs)
        stack[-1].parts.append(node)
        if tag in RAW and not raw.endswith("/"):
            closed = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.IGNORECASE).search(html, at)
            # what such an element holds is no markup; without an end tag it holds the rest
            at = closed.end() if closed else len(html)
        elif tag not in VOID:
            stack.append(node)
    text(html[at:])
    return root


@lru_cache(1 << 14)
def named_aside(names: str, subjects: bool = False) -> bool:
    """Is one of these names that of a part beside the article? The name ends in such a word, or goes on with what is a part of a page.
    With ``subjects`` words that an article can be about do not count."""
    for name in names.lower().split():
        words = [w for w in (x.rstrip("0123456789") for x in re.split("[_-]+", name)) if w]
        if not words or words[0] in STATES or "by" in words:
            continue
        while len(words) > 1 and words[-1] in PART_WORDS and words[-1] not in ASIDE_NAMES:
            words.pop()
        if words[-1] in ASIDE_NAMES and not (subjects and words[-1] in SUBJECTS):
            return True
    return False


def _apart(n: Node, inside: bool) -> bool:
    """Is the part no article by tag, role or state?"""
    if n.tag in ASIDE or n.tag == "header" and not inside:
        return True
    a = n.attrs
    return bool(a) and ("hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in ASIDE_ROLES)


def _named(n: Node, inside: bool) -> bool:
    """Is the part no article by its class or id? ``inside`` an article headings are the article's, and ids of sections tell their subject."""
    a = n.attrs
    if not a or n.tag in ("html", "body", "main") or a.get("itemprop", "").lower() == "articlebody" or inside and n.tag in HEADINGS:
        return False
    section = inside and n.tag == "section"
    return any(named_aside(a[k], section) for k in (("class",) if section else ("class", "id")) if a.get(k))


def set_aside(n: Node, inside: bool) -> bool:
    """Is the part named as something else than an article? ``inside`` an article a header is the article's."""
    return _apart(n, inside) or _named(n, inside)


def spared(top: Node) -> set[int]:
    """Nodes below ``top`` (by id) that are set aside by name only but hold most of the text."""
    order, named, stack = [], [], [top]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [c for c in n.children if not _apart(c, True)]
        if n is not top and _named(n, True):
            named.append(n)
    if not named:
        return set()
    size: dict[int, int] = {}
    for n in reversed(order):
        size[id(n)] = sum(len(p.strip()) if isinstance(p, str) else size.get(id(p), 0) for p in n.parts)
    return {id(n) for n in named if 2 * size[id(n)] > size[id(top)]}


def _is_article(n: Node) -> bool:
    return n.tag in ("article", "main") or n.attrs.get("role", "").lower() in ("main", "article") or n.attrs.get("itemprop", "").lower() == "articlebody"


def weight(n: Node, template: Set[int] = frozenset()) -> int:
    """Characters of text below a node that is not set aside, without what template nodes say."""
    total, stack, most = 0, [n], spared(n)
    while stack:
        n = stack.pop()
        silent = id(n) in template
        for p in n.parts:
            if isinstance(p, str):
                total += 0 if silent else len(p)
            elif id(p) in most or not set_aside(p, True):
                stack.append(p)
    return total


def article_of(page: Node, template: Set[int] = frozenset()) -> tuple[Node, bool]:
    """The node that holds the article and whether it is marked as one. Of several the one with the most varying text is taken, then with the most text.
    A mark on what is mostly template is wrong if more than that varies elsewhere."""
    # a marked article in a part set aside by name counts if it has most of the text: the name is wrong
    for aside in (set_aside, _apart):
        found, stack = [], [page]
        while stack:
            for c in stack.pop().children:
                if aside(c, False):
                    continue
                if _is_article(c):
                    inner = [x for x in _marked_below(c) if c.tag == "main"]
                    found += inner or [c]
                else:
                    stack.append(c)
        if not found:
            continue
        best = found[0] if len(found) == 1 else max(found, key=lambda n: (weight(n, template), weight(n)))
        whole = weight(best)
        varying = weight(best, template) if template else whole
        if template and 2 * varying < whole < weight(page, template) - varying:
            return page, False
        if whole if aside is set_aside else 2 * whole > _bulk(page):
            return best, True
    return page, False


def _bulk(n: Node) -> int:
    """Characters of text below a node, whatever its parts are named."""
    total, stack = 0, [n]
    while stack:
        for p in stack.pop().parts:
            if isinstance(p, str):
                total += len(p)
            elif not _apart(p, True):
                stack.append(p)
    return total


def _marked_below(n: Node) -> list[Node]:
    out, stack = [], [n]
    while stack:
        for c in stack.pop().children:
            if set_aside(c, True):
                continue
            if _is_article(c):
                out.append(c)
            else:
                stack.append(c)
    return out


def label(n: Node) -> str:
    return f"{n.tag} {n.attrs.get('class', '')}" if n.attrs else n.tag


class Wrapper:
    """A host's aligned tree: label, children, how many pages have the node, and on how many it says what it says most."""

    __slots__ = ("label", "children", "pages", "said")

    def __init__(self, name: str, children: list[Wrapper], pages: int, said: dict[int, int]):
        self.label, self.children, self.pages, self.said = name, children, pages, said

    @staticmethod
    def of(n: Node) -> Wrapper:
        top = Wrapper("", [], 0, {})
        stack = [(n, top)]
        while stack:
            n, above = stack.pop()
            own = n.own()
            w = Wrapper(label(n), [], 1, {digest(own): 1} if own else {})
            above.children.append(w)
            stack += [(c, w) for c in reversed(n.children)]
        return top.children[0]

    def listed(self, count: int) -> list[list]:
        """In page order: label, place of the node above, and the digest of the text that makes the node template (0: a slot)."""
        out, stack = [], [(self, -1)]
        while stack:
            w, above = stack.pop()
            here = len(out)
            text, times = max(w.said.items(), key=lambda x: (x[1], -x[0]), default=(0, 0))
            out.append([w.label, above, text if times >= max(LEAST_PAGES, CONSTANT * count) else 0])
            stack += [(c, here) for c in reversed(w.children)]
        return out


def digest(text: str) -> int:
    raw = text.encode("utf-8", "replace")
    return (zlib.crc32(raw) | zlib.adler32(raw) << 32) & (1 << 63) - 1 or 1


class Trees:
    """Trees by number, equal ones by the same: label, numbers of the children, nodes; and how two of them match best."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.labels: list[str] = []
        self.children: list[tuple[int, ...]] = []
        self.sizes: list[int] = []
        self.matches: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
        self.inside = 0

    def number(self, name: str, children: tuple[int, ...]) -> int:
        key = (name, children)
        found = self.numbers.get(key)
        if found is None:
            found = self.numbers[key] = len(self.labels)
            self.labels.append(name)
            self.children.append(children)
            self.sizes.append(1 + sum(map(self.sizes.__getitem__, children)))
        return found

    def score(self, a: int, b: int) -> int:
        """Nodes that two trees have in common under simple tree matching, if those below them have been matched."""
        if a == b:
            return self.sizes[a]
        return self.matches[a, b][0] if self.labels[a] == self.labels[b] else 0

    def match(self, a: int, b: int) -> None:
        """Match two trees and, before, all below them that may meet; children have lower numbers than their parents."""
        todo, stack = set(), [(a, b)]
        while stack:
            pair = stack.pop()
            x, y = pair
            if x == y or self.labels[x] != self.labels[y] or pair in self.matches or pair in todo:
                continue
            todo.add(pair)
            p, q, _ = self.unequal(x, y)
            if p and q and not self.wide(p, q):
                others = set(q)
                stack += [(u, v) for u in set(p) for v in others]
        for x, y in sorted(todo):
            p, q, head = self.unequal(x, y)
            pairs, paired = self.paired(p, q)
            equal = self.children[x][:head] + self.children[x][head + len(p) :]
            score = 1 + sum(map(self.sizes.__getitem__, equal)) + paired
            self.matches[x, y] = (score, [(i + head, j + head) for i, j in pairs])

    def matched(self, a: int, b: int) -> list[tuple[int, int]]:
        """Places of the children that are paired, of two unequal trees of one label; what else is remembered may be forgotten."""
        if (a, b) not in self.matches:
            if len(self.matches) > MOST_MATCHES:
                self.matches.clear()
            self.match(a, b)
        return self.matches[a, b][1]

    def wide(self, p: tuple[int, ...], q: tuple[int, ...]) -> bool:
        """Whether children are so many different ones that those of one after the other are matched, which needs less memory."""
        return len(p) * len(q) > LARGE_KINDS and self.inside < MOST_INSIDE and len(set(p)) * len(set(q)) > LARGE_KINDS

    def unequal(self, a: int, b: int) -> tuple[tuple[int, ...], tuple[int, ...], int]:
        """Children without equal ones at both ends, which match best with each other, and how many there are in front."""
        p, q = self.children[a], self.children[b]
        most, head = min(len(p), len(q)), 0
        while head < most and p[head] == q[head]:
            head += 1
        tail = 0
        while tail < most - head and p[-1 - tail] == q[-1 - tail]:
            tail += 1
        return p[head : len(p) - tail], q[head : len(q) - tail], head

    def paired(self, p: tuple[int, ...], q: tuple[int, ...]) -> tuple[list[tuple[int, int]], int]:
        """Places of children that are paired, in order, so that most nodes match, and how many do."""
        if not p or not q:
            return [], 0
        kinds = sorted(set(q))
        place = {v: k for k, v in enumerate(kinds)}
        kind = [place[v] for v in q]
        if len(p) * len(q) > SMALL_TABLE:
            return self.paired_by_rows(p, kinds, np.array(kind))
        scores = {u: [self.score(u, v) for v in kinds] for u in set(p)}
        pairs, i, j = [], len(p), len(q)
        above = [0] * (len(q) + 1)
        table = [above]
        for u in p:
            row, told = [0] * (len(q) + 1), scores[u]
            for at, k in enumerate(kind, 1):
                best = above[at] if above[at] > row[at - 1] else row[at - 1]
                s = told[k]
                row[at] = above[at - 1] + s if s and above[at - 1] + s > best else best
            table.append(row)
            above = row
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((i, j))
        return pairs[::-1], above[-1]

    def paired_by_rows(self, p: tuple[int, ...], kinds: list[int], kind: np.ndarray) -> tuple[list[tuple[int, int]], int]:
        """The same for long lists of children; ``kind`` is the place of each of the others among their different trees, ``kinds``."""
        alike: dict[str, list[int]] = {}
        for k, v in enumerate(kinds):
            alike.setdefault(self.labels[v], []).append(k)
        wide, known, remembered = self.wide(p, tuple(kinds)), len(self.matches), {}

        def told(i: int) -> np.ndarray:
            u = p[i]
            if (row := remembered.get(u)) is None:
                row = np.zeros(len(kinds), np.int64)
                for k in alike.get(self.labels[u], ()):
                    if wide:
                        self.match(u, kinds[k])
                        row[k] = self.score(u, kinds[k])
                        # what was matched before may be needed by those who wait for this
                        if len(self.matches) - known > MOST_MATCHES:
                            while len(self.matches) > known:
                                self.matches.popitem()
                    else:
                        row[k] = self.score(u, kinds[k])
                if (len(remembered) + 1) * len(kinds) <= MOST_SCORES:
                    remembered[u] = row
            return row

        self.inside += wide
        found = best_pairs(told, len(p), kind)
        self.inside -= wide
        return found


def best_pairs(told: Callable[[int], np.ndarray], count: int, kind: np.ndarray) -> tuple[list[tuple[int, int]], int]:
    """Pairs of ``count`` rows and the columns, in order, of the highest sum, and that sum; ``told`` has a row's scores, of which ``kind`` is each column's place.

    A bit is kept for each step that pairs nothing. Of a table with more steps than LARGE_TABLE only some rows are kept, between
    which it is made again from the end, as far as the columns still matter.
    """
    pairs: list[tuple[int, int]] = []
    total = 0

    def rows(first: int, past: int, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        nonlocal total
        kinds = kind[: len(last) - 1]
        for i in range(first, past):
            row = np.zeros(len(last), np.int64)
            np.maximum.accumulate(np.maximum(last[1:], last[:-1] + told(i)[kinds]), out=row[1:])
            if i == count - 1:
                total = int(row[-1])
            yield last, row
            last = row

    def trace(first: int, past: int, start: np.ndarray, j: int) -> int:
        """Adds the pairs of some rows, from the last up; gives the columns that are left for the rows above."""
        start = start[: j + 1]
        if (past - first) * j > LARGE_TABLE and past - first > 1:
            step = -(-(past - first) // PARTS)
            begins = list(range(first, past, step))
            marks = [start]
            for i, (_, row) in enumerate(rows(first, begins[-1], start), first + 1):
                if (i - first) % step == 0:
                    marks.append(row)
            for begin in reversed(begins):
                j = trace(begin, min(begin + step, past), marks.pop(), j)
            return j
        steps = [(np.packbits(row == last), np.packbits(row[1:] == row[:-1])) for last, row in rows(first, past, start)]
        for i in range(past - 1, first - 1, -1):
            up, left = steps.pop()
            while j and not up[j >> 3] >> (7 - (j & 7)) & 1 and left[j - 1 >> 3] >> (7 - (j - 1 & 7)) & 1:
                j -= 1
            if not j:
                break
            if not up[j >> 3] >> (7 - (j & 7)) & 1:
                j -= 1
                pairs.append((i, j))
        return j

    trace(0, count, np.zeros(len(kind) + 1, np.int64), len(kind))
    return pairs[::-1], total


class Laid:
    """A tree's nodes in page order, the places of each one's children, and its number among ``trees``."""

    __slots__ = ("nodes", "children", "numbers")

    def __init__(self, root, name, below, trees: Trees):
        self.nodes, self.children, stack = [], [], [(root, None)]
        while stack:
            n, above = stack.pop()
            if above is not None:
                self.children[above].append(len(self.nodes))
            inner = below(n)
            if inner:
                here = len(self.nodes)
                stack += [(c, here) for c in reversed(inner)]
            self.nodes.append(n)
            self.children.append([])
        self.numbers = [0] * len(self.nodes)
        for i in range(len(self.nodes) - 1, -1, -1):
            self.numbers[i] = trees.number(name(self.nodes[i]), tuple([self.numbers[c] for c in self.children[i]]))


def align(a_label, a_children, b_label, b_children, a, b) -> list[tuple]:
    """Simple tree matching of two trees: pairs of nodes of equal labels whose parents are paired, in order, as many as can be."""
    trees = Trees()
    left, right = Laid(a, a_label, a_children, trees), Laid(b, b_label, b_children, trees)
    return [(left.nodes[i], right.nodes[j]) for i, j in aligned(left, right, trees)]


def aligned(a: Laid, b: Laid, trees: Trees) -> list[tuple[int, int]]:
    """Places of the nodes that match."""
    if trees.labels[a.numbers[0]] != trees.labels[b.numbers[0]]:
        return []
    trees.match(a.numbers[0], b.numbers[0])
    pairs, stack = [], [(0, 0)]
    while stack:
        i, j = stack.pop()
        x, y = a.numbers[i], b.numbers[j]
        if x == y:
            # equal trees lie alike in page order
            size = trees.sizes[x]
            pairs += zip(range(i, i + size), range(j, j + size), strict=True)
            continue
        pairs.append((i, j))
        p, q = a.children[i], b.children[j]
        middle, other, head = trees.unequal(x, y)
        stack += zip(p[:head], q[:head], strict=True)
        stack += [(p[u], q[v]) for u, v in trees.matched(x, y)]
        stack += zip(p[head + len(middle) :], q[head + len(other) :], strict=True)
    return pairs


class Matcher:
    """A host's wrapper, with which pages are aligned one after the other: of every node in page order its label, the place of the node above
    (-1: none) and the digest of the text that makes it template (0: a slot)."""

    def __init__(self, wrapper: list[list]):
        self.wrapper = wrapper
        self.below: list[list[int]] = [[] for _ in wrapper]
        for i, (_, above, _) in enumerate(wrapper):
            if above >= 0:
                self.below[above].append(i)
        self.renew()

    def renew(self) -> None:
        self.trees = Trees()
        self.laid = Laid(0, lambda i: self.wrapper[i][0], lambda i: self.below[i], self.trees)

    def pairs(self, page: Node) -> list[tuple[int, Node]]:
        """Nodes of a page with the numbers of the wrapper's nodes that they match."""
        if len(self.trees.labels) + len(self.trees.matches) > REMEMBERED:
            self.renew()
        laid = Laid(page, label, lambda n: n.children, self.trees)
        return [(i, laid.nodes[j]) for i, j in aligned(self.laid, laid, self.trees)]


def induce(pages: list[str]) -> str | None:
    """The wrapper of a host, as JSON, from some of its pages; None if they are too few."""
    trees = [parse(p) for p in pages]
    if len(trees) < LEAST_PAGES:
        return None
    # a page of middling size stands for the others
    size = [_count(t) for t in trees]
    middle = sorted(range(len(trees)), key=lambda i: (size[i], i))[len(trees) // 2]
    wrapper = Wrapper.of(trees[middle])
    for i, t in enumerate(trees):
        if i == middle:
            continue
        pairs = align(lambda w: w.label, lambda w: w.children, label, lambda n: n.children, wrapper, t)
        known = {id(n): w for w, n in pairs}
        for w, n in pairs:
            w.pages += 1
            if any(id(c) not in known for c in n.children):
                # what the tree lacks so far comes before the next node that both have
                new: dict[int, list[Wrapper]] = {}
                waiting: list[Wrapper] = []
                for c in n.children:
                    if (met := known.get(id(c))) is None:
                        waiting.append(Wrapper.of(c))
                    elif waiting:
                        new[id(met)], waiting = waiting, []
                w.children = [x for c in w.children for x in (*new.get(id(c), ()), c)] + waiting
            if own := n.own():
                d = digest(own)
                w.said[d] = w.said.get(d, 0) + 1
    return json.dumps(wrapper.listed(len(trees)), ensure_ascii=False, separators=(",", ":"))


def _count(n: Node) -> int:
    total, stack = 0, [n]
    while stack:
        c = stack.pop().children
        total += len(c)
        stack += c
    return total


def template_nodes(page: Node, matcher: Matcher | None) -> set[int]:
    """Nodes of a page (by id) that say what the host's template says."""
    if not matcher:
        return set()
    told = [w[2] for w in matcher.wrapper]
    return {id(n) for i, n in matcher.pairs(page) if told[i] and digest(n.own()) == told[i]}


def blocks_of(article: Node, template: set[int]) -> list[str]:
    """Texts of the blocks of an article in page order, white space made one space."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        if text := " ".join("".join(line).split()):
            out.append(text)
        line.clear()

    most = spared(article)
    stack: list = [article]
    while stack:
        p = stack.pop()
        if p is None:
            end()
        elif isinstance(p, str):
            line.append(p)
        elif p.tag == "br":
            line.append(" ")
        elif p is article or id(p) in most or not set_aside(p, True):
            silent = id(p) in template
            parts = [x for x in p.parts if not (silent and isinstance(x, str))]
            if p.tag in BLOCKS:
                end()
                stack.append(None)
            stack += reversed(parts)
    end()
    return out


def main_text(html: str | None, wrapper: Matcher | list | None = None) -> str:
    page = parse(html or "")
    template = template_nodes(page, Matcher(wrapper) if isinstance(wrapper, list) else wrapper)
    article, marked = article_of(page, template)
    if template:
        # the content itself is never template, however often it is repeated
        content = article if marked else content_of(article, template)
        inner, stack = set(), [content]
        while stack:
            n = stack.pop()
            inner.add(id(n))
            stack += n.children
        template -= inner
    return "\n".join(blocks_of(article, template))


def content_of(body: Node, template: set[int]) -> Node:
    """The least part of an unmarked body that holds most of what is no template; the body itself if most of it is template, as on copies."""
    order, stack = [], [body]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [c for c in n.children if not set_aside(c, True)]
    varying: dict[int, int] = {}
    for n in reversed(order):
        varying[id(n)] = (0 if id(n) in template else len(n.own())) + sum(varying.get(id(c), 0) for c in n.children)
    constant = sum(len(n.own()) for n in order if id(n) in template)
    if constant > COPIES * (constant + varying[id(body)]):
        return body
    while True:
        best = max(body.children, key=lambda c: varying.get(id(c), 0), default=None)
        # a single paragraph is not the content
        if best is None or 2 * varying.get(id(best), 0) <= varying[id(body)] or not any(c.tag in BLOCKS for c in best.children):
            return body
        body = best


def said_by(page: Node) -> int:
    """Digest of what a page says at its nodes; pages of one digest are copies."""
    said, stack = set(), [page]
    while stack:
        n = stack.pop()
        said.add(n.own())
        stack += n.children
    return digest("\n".join(sorted(said)))


def layout_of(page: Node) -> int:
    """Digest of the labels at the top of a page's body, numbers in them aside."""
    while (inner := next((c for c in page.children if c.tag in ("html", "body")), None)) is not None:
        page = inner
    return digest("\n".join(sorted({re.sub("[0-9]+", "0", label(c)) for c in page.children if c.tag in BLOCKS})))


def different(pages: list[str]) -> list[str]:
    """One page of those that say the same at all their nodes."""
    return list({said_by(parse(page)): page for page in reversed(pages)}.values())[::-1]


@lru_cache(1 << 16)
def _path(above: int, name: str, place: int) -> int:
    return int.from_bytes(blake2b(f"{above} {place} {name}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def places_of(page: Node) -> tuple[int, list[tuple[int, int]]]:
    """:func:`said_by`, and of every node with a text the digests of its place (the labels from the top, each with its
    number among the siblings that have it) and of what it says."""
    said, out, stack = set(), [], [(page, 0)]
    while stack:
        n, path = stack.pop()
        own = n.own()
        said.add(own)
        if own:
            out.append((path, digest(own)))
        times: dict[str, int] = {}
        for c in n.children:
            name = label(c)
            times[name] = place = times.get(name, 0) + 1
            stack.append((c, _path(path, name, place)))
    return digest("\n".join(sorted(said))), out


def _laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every page, and for every text at a place of a host's pages one for each of LEAST_PAGES different pages of a batch, the smallest."""
    kinds = (("_host", pa.string()), ("_digest", pa.int64()), ("_layout", pa.int64()), ("_copy", pa.int64()), ("_path", pa.int64()), ("_text", pa.int64()), ("_size", pa.int64()))
    names = [n for n, _ in kinds]
    least: dict[tuple[str, int, int], list[tuple[int, int]]] = {}

    def out() -> pa.RecordBatch:
        rows = [(host, None, None, copy, path, text, size) for (host, path, text), pages in least.items() for size, copy in pages]
        least.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for b in batches:
        trees = []
        for host, t in zip(b.column("_host").to_pylist(), map(parse, b.column("html").to_pylist()), strict=True):
            copy, places = places_of(t)
            trees.append((layout_of(t), copy))
            page = (len(places), copy)
            for path, text in places:
                pages = least.setdefault((host, path, text), [])
                if page not in pages:
                    if len(pages) < LEAST_PAGES:
                        pages.append(page)
                    elif page < (most := max(pages)):
                        pages[pages.index(most)] = page
            if len(least) > MOST_PLACES:
                yield out()
        none = pa.nulls(b.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("_host"), b.column("_digest"), pa.array([x for x, _ in trees], pa.int64()), pa.array([x for _, x in trees], pa.int64()), none, none, none], names)
    if least:
        yield out()


def _said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What pages say at the nodes of their host's wrapper, and with which other texts."""
    last, matcher = None, None
    for b in batches:
        out: dict[tuple, None] = {}
        for host, html, raw in zip(b.column("_host").to_pylist(), b.column("html").to_pylist(), b.column("_wrapper").to_pylist(), strict=True):
            if raw != last:
                last, matcher = raw, Matcher(json.loads(raw))
            page = parse(html)
            copy = said_by(page)
            for i, n in matcher.pairs(page):
                own = n.own()
                out[host, i, digest(own) if own else 0, copy] = None
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["_host", "_node", "_said", "_copy"])


def _induced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    host, pages = None, []

    def out() -> Iterator[pa.RecordBatch]:
        if pages and (w := induce(different(pages))):
            yield pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([w], pa.string())], ["_host", "_wrapper"])

    for b in batches:
        for h, page in zip(b.column("_host").to_pylist(), b.column("html").to_pylist(), strict=True):
            if h != host:
                yield from out()
                host, pages = h, []
            pages.append(page)
    yield from out()


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """_host, _wrapper and _template of every host with LEAST_PAGES different pages or more.

    Which nodes there are is told by all pages: every place of a node (its labels from the top) at which LEAST_PAGES
    different pages say the same, as of template they must, is proposed by the smallest page that says so. So are, of every layout of a host,
    PAGES different ones whose digests are least, found in two steps, the first
    on 64 parts of a layout, so that none is in one task. Layouts of fewer
    than LEAST_PAGES pages are taken together. What is template is
    decided from all pages: a text is, if CONSTANT of the different pages that
    have a node say it there, and LEAST_PAGES at least.
    """
    pages = pages.where("html is not null").select("_host", "html")
    kind = "_host string, _digest long, _layout long, _copy long, _path long, _text long, _size long"
    laid = keep(pages.withColumn("_digest", F.xxhash64("html")).mapInArrow(_laid_out, kind), "parsed")
    seen = keep(laid.where("_path is null").groupBy("_host", "_layout", "_copy").agg(F.min("_digest").alias("_digest")), "layouts")
    said = laid.where("_path is not null").select("_host", "_path", "_text", "_size", "_copy").distinct()
    said = said.groupBy("_host", "_path", "_text").agg(F.count("*").alias("_n"), F.min(F.struct("_size", "_copy")).alias("_least")).where(F.col("_n") >= LEAST_PAGES)
    placed = said.groupBy("_host", "_path").agg(F.min("_least").alias("_least")).select("_host", "_least._copy").distinct()
    proposing = seen.join(placed, ["_host", "_copy"], "left_semi").groupBy("_host", "_copy").agg(F.min("_digest").alias("_digest")).select("_host", "_digest")
    rare = seen.groupBy("_host", "_layout").agg(F.count("*").alias("_n")).where(F.col("_n") < LEAST_PAGES).select("_host", "_layout", F.lit(True).alias("_rare"))
    slim = seen.join(rare, ["_host", "_layout"], "left").select("_host", F.when(F.col("_rare"), 0).otherwise(F.col("_layout")).alias("_layout"), "_digest")
    # read again, so that the window's salted shuffle is not spared by the join's, which deals a layout to one task
    slim = keep(slim, "layouts")
    salted = W.partitionBy("_host", "_layout", F.pmod(F.col("_digest"), F.lit(64))).orderBy("_digest")
    few = slim.withColumn("_n", F.row_number().over(salted)).where(F.col("_n") <= PAGES)
    few = few.withColumn("_n", F.row_number().over(W.partitionBy("_host", "_layout").orderBy("_digest"))).where(F.col("_n") <= PAGES).select("_host", "_digest")
    few = keep(few.union(proposing).distinct(), "proposing")
    found = pages.withColumn("_digest", F.xxhash64("html")).join(few, ["_host", "_digest"], "left_semi")
    found = found.groupBy("_host", "_digest").agg(F.min("html").alias("html"))
    found = keep(found.repartition("_host").sortWithinPartitions("_host", "_digest").mapInArrow(_induced, "_host string, _wrapper string"), "wrappers")
    said = pages.join(found, "_host").select("_host", "html", "_wrapper").mapInArrow(_said, "_host string, _node int, _said long, _copy long")
    counts = said.distinct().groupBy("_host", "_node", "_said").agg(F.count("*").alias("_n"))
    nodes = counts.groupBy("_host", "_node").agg(F.sum("_n").alias("_pages"), F.max(F.when(F.col("_said") != 0, F.struct("_n", "_said"))).alias("_most"))
    fixed = nodes.where((F.col("_most._n") >= LEAST_PAGES) & (F.col("_most._n") >= CONSTANT * F.col("_pages")))
    fixed = fixed.groupBy("_host").agg(F.to_json(F.sort_array(F.collect_list(F.array(F.col("_node").cast("long"), F.col("_most._said"))))).alias("_template"))
    return keep(found.join(fixed, "_host", "left"), "templates")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, Matcher] = {}
    for b in batches:
        texts = []
        for page, w, fixed in zip(b.column("html").to_pylist(), b.column("_wrapper").to_pylist(), b.column("_template").to_pylist(), strict=True):
            key = (w, fixed)
            if w is not None and key not in known:
                if len(known) > 256:
                    known.clear()
                told = dict(json.loads(fixed or "[]"))
                known[key] = Matcher([[name, above, told.get(i, 0)] for i, (name, above, _) in enumerate(json.loads(w))])
            texts.append(main_text(page, known.get(key)))
        names = [n for n in b.schema.names if n not in ("_wrapper", "_template")]
        yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(n)) for n in names], pa.array(texts, pa.string())], [*names, "_text"])


def extract_articles(pages: DataFrame) -> DataFrame:
    """``pages`` (with ``url`` and ``html``) and ``_text``, the main text of every page.

    Blocks are joined by one line feed. Null and empty pages, and pages
    without an article, give an empty text; a page whose url has no host is
    read without a wrapper; repeated rows are each extracted; an empty table
    gives no rows. Columns of ``pages`` named ``_host``, ``_wrapper``,
    ``_template``, ``_digest`` and ``_text`` are replaced. Pages meet their wrappers in a
    join on the host that adaptive execution broadcasts or splits where a host is large.
    """
    pages = pages.drop("_host", "_wrapper", "_template", "_digest", "_text").withColumn("_host", F.lower(F.try_parse_url(F.col("url"), F.lit("HOST"))))
    wrapped = pages.join(induce_wrappers(pages.where("_host is not null")), "_host", "left").select(*[c for c in pages.columns if c != "_host"], "_wrapper", "_template")
    schema = wrapped.drop("_wrapper", "_template").withColumn("_text", F.lit("").cast("string")).schema
    return wrapped.mapInArrow(_extracted, schema)
