"""SimHash near-duplicates: fingerprints, a Gray-order hierarchical index that links them, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .common import BROADCAST_BYTES, lower_ascii, text_columns, unused

SHINGLE, SEED, DISTANCE = 3, 42, 2
#: Pairs that differ in at most two of four 16-bit blocks share the other two; these are the keys of a first bucket.
BLOCK_PAIRS = [(a, b) for a in range(4) for b in range(a + 1, 4)]
#: Larger buckets are dealt out again by six of the eight 4-bit blocks left; they then hold 256 fingerprints at most.
BUCKET_ROWS = 2048
LEAF, FANOUT = 16, 8
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None) -> int:
    """64 majority bits over the hashes of all shingles, repeats included; 0 without words."""
    words = lower_ascii(text).split() if text else []
    if not words:
        return 0
    counts, n = np.zeros(64, np.int64), 0
    total = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, 50_000):
        w = words[at : min(at + 50_000, total) + SHINGLE - 1]
        shingles = zip(w, w[1:], w[2:], strict=False) if len(words) >= SHINGLE else [words]
        hashes = np.array([digest(s, SEED) for s in map(b" ".join, shingles)], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """Add the fingerprint as a signed 64-bit number. Null, empty and wordless texts have fingerprint 0."""
    return text_columns(docs, f"{name} bigint", lambda: None, lambda _, t: (signed(fingerprint(t)),), text)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Where each number stands in the reflected Gray sequence."""
    rank = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints in Gray order under a hierarchy of shared bit patterns.

    Neighbours in Gray order agree in most bits. Every node keeps the bits in which all fingerprints below it agree (a
    mask and a value); bits already kept by its parent are masked out, so that differences add up along a path and a
    group is left as soon as they pass the limit.
    """

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        both = self._level(self.values, self.values, LEAF)
        levels = [both]
        while len(levels[-1][0]) > 1:
            levels.append(self._level(*levels[-1], FANOUT))
        self.levels = []
        for depth, (ones, zeros) in enumerate(levels):
            mask = ones | ~zeros  # bits that are 1 everywhere or 0 everywhere below
            parent = np.zeros(len(mask), np.uint64)
            if depth + 1 < len(levels):
                up = levels[depth + 1]
                parent = np.repeat(up[0] | ~up[1], FANOUT)[: len(mask)]
            self.levels.append((mask & ~parent, ones))

    @staticmethod
    def _level(ones: np.ndarray, any_one: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        starts = np.arange(0, len(ones), width)
        return np.bitwise_and.reduceat(ones, starts), np.bitwise_or.reduceat(any_one, starts)

    def pairs(self, queries: np.ndarray, limit: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
        """Positions (query, indexed fingerprint in Gray order) of all pairs within ``limit``."""
        q = np.arange(len(queries))
        node, far = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            mask, value = self.levels[depth]
            far = far + np.bitwise_count((queries[q] ^ value[node]) & mask[node]).astype(np.int64)
            keep = far <= limit
            q, node, far = q[keep], node[keep], far[keep]
            width = FANOUT if depth else LEAF
            below = len(self.levels[depth - 1][0]) if depth else len(self.values)
            child = (node[:, None] * width + np.arange(width)).ravel()
            q, far = np.repeat(q, width), np.repeat(far, width)
            inside = child < below
            q, node, far = q[inside], child[inside], far[inside]
        near = np.bitwise_count(queries[q] ^ self.values[node]) <= limit
        return q[near], node[near]


def linked(values: np.ndarray, limit: int = DISTANCE) -> list[tuple[int, int]]:
    """A spanning set of links (larger, smaller) of the fingerprints of one bucket; never all of its pairs."""
    index = GrayIndex(np.unique(values))
    own = index.values
    root = np.arange(len(own))
    for at in range(0, len(own), 128):
        q, node = index.pairs(own[at : at + 128], limit)
        while True:  # the smallest root of each pair, then of the roots themselves
            a, b = root[q + at], root[node]
            low = np.minimum(a, b)
            if (a == b).all():
                break
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            while (root[root] != root).any():
                root = root[root]
    child = np.flatnonzero(root != np.arange(len(own)))
    return list(zip(own[child].tolist(), own[root[child]].tolist(), strict=True))


def bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every bucket; rows (key, fp) come sorted by key, buckets may reach over batches and are bounded."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held_key, held = None, []

    def links(groups: list[np.ndarray]) -> pa.RecordBatch:
        found = [p for g in groups if len(g) > 1 for p in linked(g.view(np.uint64))]
        ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        key, fp = batch["key"].to_pylist(), batch["fp"].to_numpy(zero_copy_only=False).astype(np.int64)
        starts = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
        ready = []
        for a, b in zip(starts, starts[1:], strict=False):
            if key[a] != held_key:
                if held:
                    ready.append(np.concatenate(held))
                held_key, held = key[a], []
            held.append(fp[a:b])
        yield links(ready)
    if held:
        yield links([np.concatenate(held)])


def _block(fp: str, bits: int, i: int) -> str:
    return f"(shiftrightunsigned({fp}, {bits * i}) & {(1 << bits) - 1})"


def finer_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of large buckets: the bucket, which two of the eight 4-bit blocks outside its own key are left out, the rest."""
    nibbles = [[4 * b + j for b in range(4) if b not in pair for j in range(4)] for pair in BLOCK_PAIRS]
    for batch in batches:
        fps, keys = [], []
        for fp, i, k in zip(*(batch[c].to_pylist() for c in ("fp", "i", "k")), strict=True):
            value = fp & 0xFFFFFFFFFFFFFFFF
            for x in range(8):
                for y in range(x + 1, 8):
                    left_out = 0xF << 4 * nibbles[i][x] | 0xF << 4 * nibbles[i][y]
                    fps.append(fp)
                    keys.append(f"{i}.{k}.{x}.{y}.{value & ~left_out:x}")
        yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(keys, pa.string())], names=["fp", "key"])


def links(classes: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect all that differ in at most two bits.

    Fingerprints meet in buckets of two shared 16-bit blocks of four: of two bits that differ, each spoils one block at
    most. Buckets with more than ``bucket_rows`` are dealt out by a finer key of six of the eight remaining 4-bit
    blocks, which leaves 256 fingerprints at most. So no bucket is large, and none is dropped.
    """
    keys = [f"struct({i} as i, {_block('fp', 16, a)} << 16 | {_block('fp', 16, b)} as k)" for i, (a, b) in enumerate(BLOCK_PAIRS)]
    dealt = classes.selectExpr("fp", f"explode(array({', '.join(keys)})) as c").selectExpr("fp", "c.i as i", "c.k as k")
    sizes = dealt.groupBy("i", "k").agg(F.count("*").alias("n")).where("n > 1")
    met = dealt.join(sizes, ["i", "k"])
    small = met.where(F.col("n") <= bucket_rows).selectExpr("fp", "concat_ws('.', i, k) as key")
    large = met.where(F.col("n") > bucket_rows).select("fp", "i", "k").mapInArrow(finer_keys, "fp bigint, key string")
    sorted_keys = small.unionByName(large).repartition("key").sortWithinPartitions("key")
    return sorted_keys.mapInArrow(bucket_links, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b): stars are joined until nothing changes.

    Each round is written to the shared folder, so that a lost executor costs at most one round.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "stars")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = written(edges.selectExpr("greatest(a, b) as a", "least(a, b) as b").where("a <> b").distinct())
    before = state(current)
    while before[0]:
        both = current.union(current.selectExpr("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").selectExpr("v as a", "m as b").union(low.selectExpr("u as a", "m as b"))
        current = written(small.where("a <> b").distinct())
        after = state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.selectExpr("a as node", "b as root").unionByName(roots.selectExpr("node", "node as root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most two differing bits; repeated ids and rows stay.
    Rows with a null id take part; they get the smallest other id they reach, or null. All texts without words have
    fingerprint 0 and are linked like any other. Very long texts are hashed in portions. An empty table gives no rows.
    """
    marked = cut_lineage(fingerprints(docs.select(F.col(key).alias("id"), F.col(text).alias("text"))).select("id", "fp"))
    classes = marked.groupBy("fp").agg(F.min("id").alias("low"))
    rooted = with_root(classes)
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("id").alias(key), "fp", "component_id")


def with_root(classes: DataFrame) -> DataFrame:
    """Add ``root``, one of its fingerprints, to distinct fingerprints ``fp``: the same for all of a component."""
    roots = components(links(classes.select("fp")))
    return classes.join(roots, classes["fp"] == roots["node"], "left").select(*[classes[c] for c in classes.columns], F.coalesce("root", "fp").alias("root"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group: that of the least id, known ids first, and of the least text hash among rows of one id.

    Rows of the same id and text are one document, null ids too; of such rows the one is kept whose other columns hash
    least. So every group keeps exactly one row, whatever ids repeat. Null and empty texts are a group like any other; an
    empty table stays empty. What must go is broadcast while it fits ``BROADCAST_BYTES``, else joined.
    """
    named = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    marked = cut_lineage(fingerprints(named.withColumn("text_hash", F.xxhash64("text"))).select("id", "text_hash", "fp"))
    document = F.struct(F.col("id").isNull().alias("unknown"), "id", "text_hash")
    # The least document of each fingerprint, then of each component: no group of copies is ever in one place.
    least = with_root(marked.groupBy("fp").agg(F.min(document).alias("d")))
    chosen = least.groupBy("root").agg(F.min("d").alias("d")).select("d.id", "d.text_hash")
    counted = marked.groupBy("id", "text_hash").agg(F.count("*").alias("n"))
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & F.col("a.text_hash").eqNullSafe(F.col("b.text_hash"))
    known = counted.alias("a").join(chosen.withColumn("kept", F.lit(True)).alias("b"), same, "left")
    fate = cut_lineage(known.select("a.id", "a.text_hash", "a.n", F.col("b.kept").isNotNull().alias("kept")).where("not kept or n > 1"))
    own = [unused(docs, c) for c in ("_key", "_hash", "_rank")]
    as_key, as_hash = F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`").cast("string"))

    def matched(df: DataFrame, rows: DataFrame, how: str) -> DataFrame:
        rows = rows.select(F.col("id").alias(own[0]), F.col("text_hash").alias(own[1]))
        if rows.count() * 24 <= BROADCAST_BYTES:
            rows = F.broadcast(rows)
        return df.join(rows, as_key.eqNullSafe(F.col(own[0])) & (as_hash == F.col(own[1])), how)

    kept = matched(docs, fate.where("not kept"), "left_anti")
    repeated = fate.where("kept")
    if repeated.isEmpty():
        return kept
    # Equal rows meet in one aggregate, reduced in each task before they move.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.xxhash64(F.to_json(row))
    one = matched(kept, repeated, "left_semi").groupBy(as_key.alias(own[0]), as_hash.alias(own[1])).agg(F.min_by(row, order).alias(own[2]))
    return matched(kept, repeated, "left_anti").unionByName(one.select(f"{own[2]}.*"))
