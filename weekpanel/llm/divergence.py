"""Source divergence audit: how the term frequencies of a language's sources differ, summed over a frequent-pattern tree.

A kept term is a row of counts by source, mostly zeros. The divergence of two sources is a sum over all kept terms of
``f(p, q)``, where ``p`` and ``q`` depend on the counts alone. Written from its value at zero counts,

    f(c, d) = f(0, 0) + [f(c, 0) - f(0, 0)] + [f(0, d) - f(0, 0)] + [f(c, d) - f(c, 0) - f(0, d) + f(0, 0)],

only nonzero counts have to be visited: the single corrections once for each (source, count), the last one for pairs of
nonzero counts in one row. Rows are inserted into the tree in the order of sources, equal ones with their multiplicity, so
that a pair of counts on a shared path is corrected once for all rows below.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import BROADCAST_BYTES

LEAST_DOCUMENTS, TOP_TERMS = 10, 10
SCALE, SMOOTHING = 1_000_000_000, 2
#: Terms held with their counts in a worker until they go to the shuffle.
HELD_TERMS = 1_000_000
#: So many groups in a block; the tree is built for two blocks of groups at a time.
BLOCK_GROUPS = 1000

#: Bytes of terms stay, A-Z lower-cased; all others are separators. Bytes from 0x80 belong to other letters.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_COUNTED = "lang string, source string, term string, n bigint, n_docs bigint"


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split() if text else []


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of the terms of each group and their documents, summed over as many texts as a worker holds.

    Documents matter by language, so that a term's go with whichever group has it first.
    """
    held: dict[tuple[str, str], Counter] = defaultdict(Counter)
    in_docs: dict[str, Counter] = defaultdict(Counter)

    def leave() -> Iterator[pa.RecordBatch]:
        for (lang, source), n in held.items():
            docs = in_docs[lang]
            columns = [
                pa.repeat(pa.scalar(lang), len(n)), pa.repeat(pa.scalar(source), len(n)), pa.array(list(n), pa.binary()).cast(pa.string()),
                pa.array(np.fromiter(n.values(), np.int64, len(n))), pa.array(np.fromiter((docs.pop(w, 0) for w in n), np.int64, len(n))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "n_docs"])
        held.clear()
        in_docs.clear()

    seen = 0
    for batch in batches:
        for lang, source, text in zip(*(batch[c] for c in ("lang", "source", "text")), strict=True):
            words = terms(text.as_py())
            if not words:
                continue
            n = held[lang.as_py(), source.as_py()]
            before = len(n)
            n.update(words)
            in_docs[lang.as_py()].update(set(words))
            seen += len(n) - before
            if seen > HELD_TERMS:
                yield from leave()
                seen = 0
    yield from leave()


def term_rows(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Kept terms of each language: (lang, term, n, counts), counts by source in order. Written out."""
    partial_counts = docs.mapInArrow(_count, _COUNTED)
    counts = partial_counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    # A row holds one number for each source of the language.
    rows = counts.groupBy("lang", "term").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts")
    )
    return cut_lineage(rows.where(F.col("n_docs") >= least).drop("n_docs"))


def _share(n: Column, total: Column) -> Column:
    """p of a count: 1 + floor(10^9 (n + 2) / total), exact whatever the counts; null without kept terms."""
    scaled = (n.cast("decimal(20,0)") + SMOOTHING) * F.lit(SCALE)
    return F.call_function("div", scaled, F.nullif(total, F.lit(0)).cast("decimal(20,0)")) + 1


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def group_table(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Every (lang, source) with ``total`` = N + 2 V of the group, ``lang_total``, the language's, and ``v``, its kept terms."""
    languages = rows.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_n"))
    sums = rows.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("n"))
    every = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(languages, "lang", "left")
    v = F.coalesce("v", F.lit(0))
    return cut_lineage(
        every.select(
            "lang", "source", v.alias("v"), (F.coalesce("n", F.lit(0)) + SMOOTHING * v).alias("total"),
            (F.coalesce("lang_n", F.lit(0)) + SMOOTHING * v).alias("lang_total"),
        )
    )


class PatternTree:
    """The frequent-pattern tree of one language's rows, a batch of sorted rows at a time.

    A row's nodes are those beyond the prefix that it shares with the row before; the rows below a node follow it until one
    shares less. Each node is corrected once against every node above it, times the number of rows below; batches add up.
    ``side`` splits the sources into two blocks, of which only pairs between the blocks are given; with one block all are.
    """

    def __init__(self, sources: list[tuple[str, int, int]]):
        self.names = [s for s, _, _ in sources]
        self.total = np.array([t for _, t, _ in sources], np.int64)
        self.side = np.array([b for _, _, b in sources])
        self.two = len(set(self.side.tolist())) > 1
        every = np.arange(len(sources))
        self.zero = self.share(np.zeros(len(sources), np.int64), every)
        self.sums = np.zeros((len(sources), len(sources)), np.int64)
        self.single: Counter = Counter()

    def share(self, n: np.ndarray, i: np.ndarray) -> np.ndarray:
        if n.max(initial=0) >= 1 << 33:  # beyond 64 bits
            n = n.astype(object)
        return (1 + SCALE * (n + SMOOTHING) // self.total[i]).astype(np.int64)

    @staticmethod
    def f(p, q):
        # At most 10^9 + 1 each: the square stays below 2^63.
        return (p - q) * (p - q) // (p + q)

    def insert(self, source: np.ndarray, n: np.ndarray, sizes: np.ndarray, multiplicity: np.ndarray) -> None:
        """Sorted rows: ``sizes`` numbers each of (place of the source, count), one row after another."""
        rows, longest = len(sizes), int(sizes.max(initial=0))
        row, at = np.repeat(np.arange(rows), sizes), np.arange(len(n)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        index, count, p = (np.full((rows, longest), -1, np.int64) for _ in range(3))
        index[row, at], count[row, at], p[row, at] = source, n, self.share(n, source)
        same = (index[1:] == index[:-1]) & (count[1:] == count[:-1]) & (index[1:] >= 0)
        shared = np.concatenate(([0], np.logical_and.accumulate(same, axis=1).sum(1)))
        before = np.concatenate(([0], np.cumsum(multiplicity)))
        for depth in range(longest):
            leaves = np.flatnonzero(shared <= depth)  # rows that leave all nodes at this depth
            node = leaves[sizes[leaves] > depth]
            end = np.append(leaves, rows)[np.searchsorted(leaves, node, side="right")]
            below = before[end] - before[node]
            i, c, own = index[node, depth], count[node, depth], p[node, depth]
            pairs, which = np.unique(np.stack((i, c)), axis=1, return_inverse=True)
            sums = np.zeros(pairs.shape[1], np.int64)
            np.add.at(sums, which.ravel(), below)
            for a, b, m in zip(*pairs.tolist(), sums.tolist(), strict=True):
                self.single[a, b] += m
            if depth:
                above, q = index[node, :depth], p[node, :depth]
                i, own, m = i[:, None], own[:, None], below[:, None]
                zero, other = self.zero[i], self.zero[above]
                both = self.f(own, q) - self.f(own, other) - self.f(zero, q) + self.f(zero, other)
                np.add.at(self.sums, (np.broadcast_to(i, above.shape), above), m * both)

    def corrections(self) -> tuple[list[str], list[str], list[int]]:
        """(source, other, sum) of all pairs of different sum than at zero counts, each pair once."""
        for (i, n), m in self.single.items():
            p = self.share(np.array([n]), np.array([i]))
            self.sums[i] += m * (self.f(p, self.zero) - self.f(self.zero[i], self.zero))
        self.single.clear()
        whole = self.sums + self.sums.T
        wanted = np.triu(whole != 0, 1)
        if self.two:
            wanted &= self.side[:, None] != self.side[None, :]
        i, j = np.nonzero(wanted)
        return [self.names[k] for k in i], [self.names[k] for k in j], whole[i, j].tolist()


def _grow(groups: dict[str, list[tuple[str, int, int]]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of the rows (lang, counts, multiplicity) of a task, which come sorted."""
    lang, tree, places = None, None, None

    def leave() -> Iterator[pa.RecordBatch]:
        if tree is not None:
            found = tree.corrections()
            columns = [[lang] * len(found[0]), *found]
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "source", "item", "delta"])

    for batch in batches:
        names = batch["lang"].to_pylist()
        starts = [*(k for k in range(len(names)) if not k or names[k] != names[k - 1]), len(names)]
        for a, b in zip(starts, starts[1:], strict=False):
            if names[a] != lang:
                yield from leave()
                lang, tree = names[a], PatternTree(groups[names[a]])
                places = pa.array(tree.names, pa.string())
            some = batch.slice(a, b - a)
            flat = some["counts"].flatten()
            source = pc.index_in(flat.field("source"), places).to_numpy(zero_copy_only=False)
            sizes = pc.list_value_length(some["counts"]).to_numpy(zero_copy_only=False)
            tree.insert(source, flat.field("n").to_numpy(), sizes, some["multiplicity"].to_numpy())
    yield from leave()


def corrections(rows: DataFrame, groups: DataFrame, block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """(lang, source, item, delta): for source < item what the sum over all kept terms has beyond its value at zero counts.

    The groups of two blocks at a time go to the tasks, at most some ``2 * block_groups``; with more groups there are more
    passes, and none sees more.
    """
    n_blocks = max(1, -(-groups.count() // block_groups))
    of_group = F.pmod(F.xxhash64("source"), F.lit(n_blocks))
    out = None
    for a in range(n_blocks):
        for b in range(a, n_blocks):
            known = groups.where("v > 0").withColumn("block", of_group).where(F.col("block").isin(a, b))
            by_lang: dict[str, list] = {}
            for g in known.collect():
                by_lang.setdefault(g["lang"], []).append((g["source"], g["total"], g["block"]))
            by_lang = {k: sorted(v, key=lambda g: g[0].encode()) for k, v in by_lang.items()}
            counts = F.col("counts")
            if n_blocks > 1:
                counts = F.filter(counts, lambda c: F.pmod(F.xxhash64(c["source"]), F.lit(n_blocks)).isin(a, b))
            equal = rows.select("lang", counts.alias("counts")).groupBy("lang", "counts").agg(F.count("*").alias("multiplicity"))
            dealt = equal.where(F.size("counts") > 0).repartitionByRange("lang", "counts").sortWithinPartitions("lang", "counts")
            found = dealt.mapInArrow(partial(_grow, by_lang), "lang string, source string, item string, delta bigint")
            if a != b:
                first = F.pmod(F.xxhash64("source"), F.lit(n_blocks)) != F.pmod(F.xxhash64("item"), F.lit(n_blocks))
                found = found.where(first)
            out = found if out is None else out.unionByName(found)
    return out.groupBy("lang", "source", "item").agg(F.sum("delta").alias("delta"))


def pair_part(rows: DataFrame, groups: DataFrame, block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """Divergence of every source from each other one of its language, over all kept terms."""
    zero = _share(F.lit(0), F.col("total"))
    own = groups.select("lang", "source", "v", zero.alias("p"))
    other = groups.select("lang", F.col("source").alias("item"), zero.alias("q"))
    # The result itself has a row for each of these pairs.
    pairs = own.join(other, "lang").where("source < item")
    base = F.coalesce(F.col("v") * _divergence(F.col("p"), F.col("q")), F.lit(0))
    found = pairs.join(corrections(rows, groups, block_groups), ["lang", "source", "item"], "left")
    once = found.select("lang", "source", "item", (base + F.coalesce("delta", F.lit(0))).alias("value"))
    once = cut_lineage(once)  # both directions read it
    both = once.unionByName(once.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    return both.select("lang", "source", F.lit("pair").alias("part"), "item", "value")


def term_part(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Terms that a group uses more than its language as a whole."""
    exploded = rows.select("lang", "term", F.col("n").alias("lang_n"), F.explode("counts").alias("c"))
    flat = exploded.select("lang", "c.source", "term", "lang_n", "c.n")
    size = groups.agg(F.sum(F.octet_length("lang") + F.octet_length("source") + 64)).first()[0] or 0
    joined = flat.join(F.broadcast(groups) if size <= BROADCAST_BYTES else groups, ["lang", "source"])
    shares = joined.select(
        "lang", "source", F.col("term").alias("item"), _share(F.col("n"), F.col("total")).alias("p"), _share(F.col("lang_n"), F.col("lang_total")).alias("q")
    )
    return shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", _divergence(F.col("p"), F.col("q")).alias("value"))


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS, block_groups: int = BLOCK_GROUPS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from the others of its language, and by which terms.

    Part ``pair`` has every other source of the language, part ``term`` the ``top`` terms that the group uses more than
    its language. Null lang, source and text are the empty text; texts without terms make groups, but no terms. Repeated
    rows count each. Ranks go by value, then by item in UTF-8 order. Very long texts are split into terms at once, in
    memory of a few times their size. An empty table gives no rows; other columns are left out.
    """
    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    rows = term_rows(named, least)
    groups = group_table(named, rows)

    def ranked(part: DataFrame) -> DataFrame:
        return part.selectExpr("*", "row_number() over (partition by lang, source order by value desc, item) as rank")

    # The limit on ranks reaches the tasks before the shuffle: a group sends its first terms only.
    return ranked(pair_part(rows, groups, block_groups)).unionByName(ranked(term_part(rows, groups)).where(F.col("rank") <= top))
