"""Main text of pages by wrapper induction: same-host trees are aligned, what stays constant is template, slots are content."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property, lru_cache
from html import unescape
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import BROADCAST_BYTES, unused

# Fixed values of HTML: elements without an end tag, elements that stand in a line of text, and what opens no block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
#: Elements that never hold the article.
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select option textarea input fieldset iframe "
    "object svg math canvas audio video dialog menu map frameset noframes title".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
#: Words of class and id values that may name a part beside the article. They count for block elements, and only for
#: what the wrapper leaves in doubt.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs pagination pager sidebar aside footer masthead topbar toolbar cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments commentlist disqus respond replies reply "
    "widget copyright legal disclaimer skip search".split()
)
#: Before such a word they tell of a layout, as in "with-sidebar".
LAYOUT = frozenset("no not with without has have hide".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
SCOPES = frozenset("ul ol dl table article main section div body html".split())
#: Elements whose content is no markup.
RAW = frozenset("script style title textarea iframe noframes noembed xmp".split())

_ATTRS = r"(?:[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+"
_MARKUP = re.compile(rf"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)({_ATTRS})(?:>|\Z)|[!?/][^>]*(?:>|\Z))")
_COMMENT_END = re.compile("--!?>")
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")
_TELLING = re.compile("class|id|role|hidden|style", re.IGNORECASE)
_CLASS = re.compile(r"\bclass\s*=\s*[\"']?([^\"'>]*)", re.IGNORECASE)
_MAIN_ROLE = re.compile(r"\brole\s*=\s*[\"']?main\b", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
#: A constant node is template with this share of a host's different pages, and at least so many pages; more inside
#: an article element, where equal texts are likelier to be copies.
SHARE, PAGES = 0.6, 3
SHARE_INSIDE, PAGES_INSIDE = 0.9, 5
#: Pages with more pairs of nodes of one depth are aligned in arrays, a row of all tables of a depth at once. The
#: pairs found are the same.
PAIRS = 10_000
#: Choices of so many cells, of two bits each, are held at a time; earlier ones are computed again from a kept row.
HELD = 1 << 28


class Node:
    __slots__ = ("tag", "label", "children", "dropped", "inside", "named", "text", "digest")

    def __init__(self, tag: str, label: str, dropped: bool, inside: bool, named: bool = False):
        self.tag, self.label, self.dropped, self.inside, self.named = tag, label, dropped, inside, named
        self.children: list[Node] = []
        self.text: str | None = None
        self.digest = 0


class Tree:
    """Block elements and, as leaves, the blocks of text between their tags.

    An element that holds one block of text and nothing else is itself the leaf. What lies in a dropped part is left
    out; of the part, its element stays. Open tags, comments and scripts that never end reach to the end of the page.
    """

    def __init__(self, html: str):
        self.root = Node("", "", False, False)
        self.stack = [self.root]
        self.run: list[str] = []
        self.has_main, self.articles = False, 0
        at, find = 0, _MARKUP.search
        while m := find(html, at):
            if m.start() > at:
                self.run.append(html[at : m.start()])
            at = m.end()
            name = m[3]
            if name:
                tag = name.lower()
                if m[2]:
                    self._end(tag)
                else:
                    self._start(tag, m[4])
                    if tag in RAW:
                        end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                        at = end.start() if end else len(html)
            elif m[1]:
                end = _COMMENT_END.search(html, at - 2)
                at = end.end() if end else len(html)
        if at < len(html):
            self.run.append(html[at:])
        self._pop_to(1)
        self._flush()

    def _flush(self) -> None:
        if not self.run:
            return
        top = self.stack[-1]
        if not top.dropped:
            text = " ".join(unescape("".join(self.run)).split())
            if text:
                leaf = Node("#", "#", False, top.inside)
                leaf.text, leaf.digest = text, xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
                top.children.append(leaf)
        self.run = []

    def _pop_to(self, at: int) -> None:
        self._flush()
        for node in self.stack[at:]:
            if len(node.children) == 1 and node.children[0].tag == "#":
                only = node.children.pop()
                node.text, node.digest = only.text, only.digest
        del self.stack[at:]

    def _beside(self, tag: str, attrs: str) -> bool:
        if tag in DROPPED:
            return True
        if not _TELLING.search(attrs):
            return False
        for m in _ATTRIBUTE.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "role" and value.strip() in ROLES:
                return True
            if name == "style" and "display:none" in value.replace(" ", ""):
                return True
        return False

    def _named(self, tag: str, attrs: str) -> bool:
        if tag in ("html", "body", "main") or not _TELLING.search(attrs):
            return False
        for m in _ATTRIBUTE.finditer(attrs):
            if m[1].lower() in ("class", "id"):
                words = _WORDS.findall((m[2] or m[3] or m[4] or "").lower())
                if any(w in BESIDE and before not in LAYOUT for before, w in zip(["", *words], words, strict=False)):
                    return True
        return False

    def _close_last(self, tags: tuple[str, ...]) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag in tags:
                self._pop_to(at)
                return

    def _start(self, tag: str, attrs: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.run.append("\n")
            elif tag == "hr":
                self._flush()
            return
        beside = self._beside(tag, attrs)
        if tag in INLINE and not beside:
            return
        self._flush()
        if tag in ("article", "main"):
            # An open menu, page header or footer was never closed.
            self._close_last(("nav", "header", "footer", "head"))
        elif tag == "body":
            self._close_last(("head",))
        if tag in CLOSES_P:
            self._close_open(("p",))
        if tag in SIBLINGS:
            self._close_open(SIBLINGS[tag])
        top = self.stack[-1]
        inside = top.inside
        dropped = top.dropped or beside or (tag == "header" and not inside)
        if not dropped and (tag in ("article", "main") or _MAIN_ROLE.search(attrs)):
            if tag == "article":
                self.articles += not inside
            else:
                self.has_main = True
            inside = True
        classes = _CLASS.search(attrs)
        node = Node(tag, f"{tag}.{classes[1]}" if classes else tag, dropped, inside, self._named(tag, attrs))
        if not top.dropped:
            top.children.append(node)
        self.stack.append(node)

    def _close_open(self, tags: tuple[str, ...]) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag in tags:
                self._pop_to(at)
                return
            if self.stack[at].tag in SCOPES:
                return

    def _end(self, tag: str) -> None:
        if tag in VOID:
            return
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                self._pop_to(at)
                return
            if self.stack[at].tag in ("article", "main", "body") and tag not in ("article", "main", "body", "html"):
                return


def leaves(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        n = stack.pop()
        if n.text is not None:
            yield n
        stack.extend(reversed(n.children))


def _generations(root: Node) -> list[list[Node]]:
    """The nodes below a root by depth, in page order."""
    found, nodes = [], root.children
    while nodes:
        found.append(nodes)
        nodes = [c for n in nodes for c in n.children]
    return found


class Level:
    """One depth of a pivot tree as arrays; the children of one parent are a segment.

    Scores of a segment are raised by its base, more than any score (``far``) above the segment before, so that a
    running maximum over the whole array never passes from one segment to the next.
    """

    def __init__(self, parents: list[Node], far: int):
        self.nodes = [c for p in parents for c in p.children]
        sizes = np.array([len(p.children) for p in parents])
        self.ends = sizes.cumsum() - 1
        self.starts = self.ends - sizes + 1
        bases = np.arange(len(parents)) * far
        self.base = np.repeat(bases.astype(np.int32 if bases[-1] + far < 1 << 31 else np.int64), sizes)
        self.codes: dict[str, int] = {}
        self.code = np.array([self.codes.setdefault(n.label, len(self.codes)) for n in self.nodes], np.int32)
        self.inner = np.flatnonzero([bool(n.children) for n in self.nodes])
        places: dict[tuple[str, int], list[int]] = {}
        for j, n in enumerate(self.nodes):
            if not n.children:
                places.setdefault((n.label, n.digest), []).append(j)
        #: Places of nodes without children by label and text.
        self.same = {key: np.array(js) for key, js in places.items()}

    def before(self, row: np.ndarray) -> np.ndarray:
        """The value left of each place, in its segment."""
        out = np.empty_like(row)
        out[1:] = row[:-1]
        out[self.starts] = self.base[self.starts]
        return out


class Wrapper:
    """The tree of a host's pivot page, against which its other pages are aligned."""

    def __init__(self, html: str):
        self.html = html
        self.tree = Tree(html).root
        self.slot = {id(n): i for i, n in enumerate(leaves(self.tree))}
        self.widths = [len(nodes) for nodes in _generations(self.tree)]

    @cached_property
    def levels(self) -> list[Level]:
        parents = [[self.tree], *([n for n in nodes if n.children] for nodes in _generations(self.tree))]
        # A node counts twice at most.
        return [Level(some, 2 * sum(self.widths) + 2) for some in parents if some and some[0].children]

    def slots(self, html: str, page: Node) -> dict[int, int]:
        """``align`` for the tree of a page; a copy of the pivot has its slots."""
        if html == self.html:
            return {id(n): i for i, n in enumerate(leaves(page))}
        return self.align(page)

    def align(self, page: Node) -> dict[int, int]:
        """Slot of every aligned text leaf of a page (by the leaf's ``id``): simple tree matching, top down."""
        pairs = sum(len(nodes) * width for nodes, width in zip(_generations(page), self.widths, strict=False))
        return self._by_arrays(page) if pairs > PAIRS else self._by_lists(page)

    def _by_lists(self, page: Node) -> dict[int, int]:
        out: dict[int, int] = {}
        pending = [(page, self.tree)]
        memo: dict[tuple[int, int], int] = {}
        while pending:
            a, b = pending.pop()
            for x, y in _matched(a.children, b.children, memo):
                if x.text is not None and y.text is not None:
                    out[id(x)] = self.slot[id(y)]
                elif x.children and y.children:
                    pending.append((x, y))
        return out

    def _by_arrays(self, page: Node) -> dict[int, int]:
        """Rows of the tables go from the first child to the last, choices are followed from the last to the first.

        A row is that of one page node beside all pivot nodes of its depth. Nodes come after their children, so that
        one row for each depth is all that the next node needs.
        """
        levels, order = self.levels, self._order(page)
        step = max(1, HELD // (max(self.widths, default=0) + 1000))
        rows, kept = [level.base for level in levels], []
        for at, (node, _, depth) in enumerate(order[: (len(order) - 1) // step * step]):
            if at % step == 0:
                kept.append(rows.copy())
            self._advance(rows, node, depth)
        kept.append(rows)
        out: dict[int, int] = {}
        #: By depth: the matched page node whose children are being followed, and what is left of its partner's children.
        open_: list[tuple[Node | None, int, int]] = [(None, 0, -1)] * len(levels)
        if levels:
            open_[0] = (page, 0, len(levels[0].nodes) - 1)
        while kept:
            rows, some = kept.pop(), order[len(kept) * step : (len(kept) + 1) * step]
            choices = []
            for node, _, depth in some:
                last = rows[depth]
                row = self._advance(rows, node, depth)
                choices.append((np.packbits(row == last).tobytes(), np.packbits(row == levels[depth].before(row)).tobytes()))
            for (node, parent, depth), (up, left) in zip(reversed(some), reversed(choices), strict=True):
                whose, first, j = open_[depth]
                if whose is not parent:
                    continue
                while j >= first and not _bit(up, j) and _bit(left, j):
                    j -= 1
                if j >= first and not _bit(up, j):
                    other = levels[depth].nodes[j]
                    if node.text is not None and other.text is not None:
                        out[id(node)] = self.slot[id(other)]
                    elif node.children and other.children:
                        below, segment = levels[depth + 1], np.searchsorted(levels[depth].inner, j)
                        open_[depth + 1] = (node, int(below.starts[segment]), int(below.ends[segment]))
                    j -= 1
                open_[depth] = (whose, first, j)
        return out

    def _order(self, page: Node) -> list[tuple[Node, Node, int]]:
        """Page nodes with parent and depth, children before parents; without those of a label the pivot has not there."""
        found, stack = [], [(c, page, 0) for c in page.children]
        while stack:
            node, _, depth = entry = stack.pop()
            if depth < len(self.levels) and node.label in self.levels[depth].codes:
                found.append(entry)
                stack.extend((c, node, depth + 1) for c in node.children)
        return found[::-1]

    def _advance(self, rows: list[np.ndarray], node: Node, depth: int) -> np.ndarray:
        """Put the row of a page node in the place of the row of its sibling before it."""
        level = self.levels[depth]
        alike = level.code == level.codes[node.label]
        both = level.before(rows[depth])
        both += alike
        if (node.label, node.digest) in level.same:
            both[level.same[node.label, node.digest]] += 1
        if len(level.inner):
            more: np.ndarray | bool = node.digest == 0
            if node.children:
                below = self.levels[depth + 1]
                more = rows[depth + 1][below.ends] - below.base[below.ends]
                rows[depth + 1] = below.base
            both[level.inner] += alike[level.inner] * more
        np.maximum(both, rows[depth], out=both)
        rows[depth] = _running_maximum(both)
        return both


def _running_maximum(row: np.ndarray) -> np.ndarray:
    """In place; a row that drops at few places only is filled behind each."""
    drops = np.flatnonzero(row[1:] < row[:-1])
    if len(drops) > 8:
        return np.maximum.accumulate(row, out=row)
    for at, end in zip(drops, [*drops[1:], len(row) - 1], strict=False):
        rising = row[at + 1 : end + 1]
        rising[: np.searchsorted(rising, row[at])] = row[at]
    return row


def _bit(packed: bytes, j: int) -> int:
    return packed[j >> 3] >> (7 - (j & 7)) & 1


def _score(a: Node, b: Node, memo: dict) -> int:
    """Size of the largest matching of two trees that keeps order and ancestors; equal texts count twice.

    Pairs below come first, by a stack of their own, so that the depth of pages has no bound.
    """
    if not a.children or not b.children:
        return 2 if a.digest == b.digest else 1
    top = (id(a), id(b))
    if top in memo:
        return memo[top]
    stack = [(a, b)]
    while stack:
        x, y = stack[-1]
        key = (id(x), id(y))
        if key in memo:
            stack.pop()
        else:
            others = [d for d in y.children if d.children]
            below = [
                (c, d) for c in x.children if c.children for d in others if c.label == d.label and (id(c), id(d)) not in memo
            ]
            if below:
                stack.extend(below)
            else:
                memo[key] = 1 + _table(x.children, y.children, memo)[-1][-1]
    return memo[top]


def _table(xs: list[Node], ys: list[Node], memo: dict) -> list[list[int]]:
    rows = [[0] * (len(ys) + 1)]
    others = [(y.label, y.digest, y.children, y) for y in ys]
    for x in xs:
        label, digest, inner = x.label, x.digest, x.children
        last, row, best = rows[-1], [0], 0
        for j, (other, other_digest, other_inner, y) in enumerate(others):
            if last[j + 1] > best:
                best = last[j + 1]
            if label == other:
                both = last[j] + (_score(x, y, memo) if inner and other_inner else 2 if digest == other_digest else 1)
                if both > best:
                    best = both
            row.append(best)
        rows.append(row)
    return rows


def _matched(xs: list[Node], ys: list[Node], memo: dict) -> list[tuple[Node, Node]]:
    if not xs or not ys:
        return []
    rows, i, j, pairs = _table(xs, ys, memo), len(xs), len(ys), []
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((xs[i], ys[j]))
    return pairs


@lru_cache(maxsize=256)
def _wrapper(html: str) -> Wrapper:
    return Wrapper(html)


def _key(slot: int, leaf: Node) -> int:
    """A constant as one signed number: its slot, its text, and whether it is in an article element."""
    value = xxhash.xxh64_intdigest(f"{slot} {int(leaf.inside)} {leaf.digest}".encode()) >> 1 << 1 | leaf.inside
    return value - (1 << 64) if value >> 63 else value


def constants(html: str | None, pivot: str | None) -> list[int]:
    """Keys of all aligned texts outside dropped parts."""
    if not html or not pivot:
        return []
    tree = Tree(html)
    slots = _wrapper(pivot).slots(html, tree.root)
    return [_key(slots[id(n)], n) for n in leaves(tree.root) if id(n) in slots]


def _doubtful(root: Node, weights: dict[int, int]) -> set[int]:
    """Leaves (by ``id``) in elements whose class or id names a part beside the article.

    Elements around an article or main element, or around more than half of the weight, are not such parts.
    """
    order: list[int] = []
    #: Per open named element its first leaf, and how many article and main elements came before it.
    parts, opened, mains = [], [], 0
    stack = [(root, False)]
    while stack:
        node, left = stack.pop()
        if left:
            first, before = opened.pop()
            parts.append((first, len(order), mains > before))
            continue
        mains += node.tag in ("article", "main")
        if node.named:
            opened.append((len(order), mains))
            stack.append((node, True))
        if node.text is not None:
            order.append(id(node))
        stack.extend((child, False) for child in reversed(node.children))
    sums = [0, *accumulate(weights.get(i, 0) for i in order)]
    depth = [0] * (len(order) + 1)
    for first, end, around in parts:
        if not around and 2 * (sums[end] - sums[first]) <= sums[-1]:
            depth[first] += 1
            depth[end] -= 1
    return {i for i, d in zip(order, accumulate(depth), strict=False) if d}


def main_text(html: str | None, pivot: str | None, template: frozenset[int]) -> str:
    """The blocks of the article in page order, two line feeds between them.

    The wrapper decides first: aligned texts of the template go, aligned texts that vary stay. What it leaves in doubt
    goes if its class or id names a part beside the article. A main element, or an only article, that holds half of
    what stays or more, is then the whole text.
    """
    if not html:
        return ""
    tree = Tree(html)
    kept, slots = list(leaves(tree.root)), {}
    if template and pivot:
        slots = _wrapper(pivot).slots(html, tree.root)
        kept = [n for n in kept if id(n) not in slots or _key(slots[id(n)], n) not in template]
    weights = {id(n): len(n.text) for n in kept}
    beside = _doubtful(tree.root, weights) - slots.keys()
    kept = [n for n in kept if id(n) not in beside] or kept
    inside = [n for n in kept if n.inside]
    if (tree.has_main or tree.articles == 1) and 2 * sum(weights[id(n)] for n in inside) >= sum(weights[id(n)] for n in kept):
        kept = inside
    return "\n\n".join(n.text for n in kept)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _small(table: DataFrame, measure: str) -> DataFrame:
    """The table with a broadcast hint while its measured bytes allow it; else a join on the host that may split skew."""
    size = table.agg(F.sum(F.expr(measure))).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def _written(table: DataFrame, name: str) -> DataFrame:
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


def pivots(pages: DataFrame) -> DataFrame:
    """(host, pivot): for each host the page whose length is nearest to the lower quartile, ties by hash."""
    sized = pages.select("host", F.length("html").alias("size"), F.xxhash64("html").alias("hash")).where("size > 0")
    quarter = _written(sized.groupBy("host").agg(F.percentile_approx("size", 0.25, 100).alias("goal")), "lengths")
    near = sized.join(_small(quarter, "octet_length(host) + 16"), "host")
    chosen = near.groupBy("host").agg(F.min(F.struct(F.abs(F.col("size") - F.col("goal")).alias("far"), "hash")).alias("m"))
    chosen = chosen.select("host", F.col("m.hash").alias("hash"))
    marked = pages.select("host", "html", F.xxhash64("html").alias("hash"))
    return marked.join(_small(chosen, "octet_length(host) + 16"), ["host", "hash"]).groupBy("host").agg(F.min("html").alias("pivot"))


def templates(pages: DataFrame, pivot: DataFrame) -> DataFrame:
    """(host, template): the keys of texts that stay constant over a host's different pages.

    All pages are aligned. Copies of a page count once; keys are counted before and after the shuffle, so that a host
    with a third of all pages is no large group.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("host", "hash", "html", "pivot")), strict=True)
            found = [(host, hash_, key) for host, hash_, html, p in rows for key in constants(html, p)]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            types = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["host", "hash", "key"]
            )

    marked = pages.select("host", "html", F.xxhash64("html").alias("hash")).join(pivot, "host")
    keys = marked.select("host", "hash", "html", "pivot").mapInArrow(align, "host string, hash bigint, key bigint")
    seen = keys.distinct().groupBy("host", "key").agg(F.count("*").alias("n")).where(f"n >= {PAGES}")
    different = pages.where(F.length("html") > 0).select("host", F.xxhash64("html").alias("hash")).distinct()
    sizes = _small(_written(different.groupBy("host").agg(F.count("*").alias("pages")), "hosts"), "octet_length(host) + 16")
    inside = "(key & 1) = 1"
    enough = f"n >= if({inside}, {SHARE_INSIDE}, {SHARE}) * pages and n >= if({inside}, {PAGES_INSIDE}, {PAGES})"
    return seen.join(sizes, "host").where(enough).groupBy("host").agg(F.array_sort(F.collect_list("key")).alias("template"))


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``text`` and ``n_chars`` (code points) to every page; columns of these names are replaced.

    Null and empty pages have the empty text. Pages without host are one host. Pages of any length are aligned by the
    same rule, in time that grows with the product of a page's and its pivot's nodes of one depth. Menus, page headers,
    footers and the like go by element, role and hidden attributes, then the constant texts of the host's wrapper; see
    ``main_text`` for what class and id words and ``article`` or ``main`` elements do after that. Pages are never
    shuffled while one pivot page and the template of each host fit ``BROADCAST_BYTES``.
    """
    hosted = pages.select(host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"))
    wrappers = _small(_written(pivots(hosted), "wrappers"), "octet_length(host) + octet_length(pivot)")
    learned = _small(_written(templates(hosted, wrappers), "templates"), "octet_length(host) + 8 * size(template)")

    @F.arrow_udf("string")
    def text_of(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for htmls, wrappers_, templates_ in batches:
            rows = zip(htmls, wrappers_, templates_, strict=True)
            yield pa.array([main_text(h.as_py(), p.as_py(), frozenset(t.as_py() or ())) for h, p, t in rows], pa.string())

    host, pivot_host, pivot, template_host, template = (
        unused(pages, c) for c in ("_host", "_pivot_host", "_pivot", "_template_host", "_template")
    )
    joined = pages.withColumn(host, host_of(F.col(f"`{url}`")))
    joined = joined.join(wrappers.toDF(pivot_host, pivot), F.col(host) == F.col(pivot_host), "left")
    joined = joined.join(learned.toDF(template_host, template), F.col(host) == F.col(template_host), "left")
    # The wrapper matters only where the host has a template.
    needed = F.when(F.col(template).isNotNull(), F.col(pivot))
    out = joined.withColumn("text", text_of(F.col(f"`{html}`").cast("string"), needed, F.col(template)))
    out = out.withColumn("n_chars", F.length("text").cast("bigint"))
    return out.select(*[c for c in pages.columns if c not in ("text", "n_chars")], "text", "n_chars")
