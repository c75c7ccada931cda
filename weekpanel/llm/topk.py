"""Exact top-k by inner product over a bit-sliced index: slices are added as bitmaps, the best rows picked slice by slice."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, SCALE = 20, 64
#: Rows of one index block, and queries that are broadcast at a time.
BLOCK_ROWS = 65_536
QUERY_ROWS = 20_000
#: Vectors with a quantised component beyond this size are compared in whole numbers of any length, without slices.
LARGEST = 1 << 31
#: Scores beyond 64 bits are given as the nearest number of 64 bits.
LEAST_SCORE, GREATEST_SCORE = -(1 << 63), (1 << 63) - 1


class BitSlices:
    """Rows of one block as bitmaps: bit b of component d of every row, over the block's smallest value of d."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        n, self.dims = values.shape
        above = self.values - self.values.min(0)
        self.bits = max(1, int(above.max(initial=0)).bit_length())
        self.words = -(-n // 64)
        padded = np.zeros((self.words * 64, self.dims), np.int64)
        padded[:n] = above
        self.slices = np.stack([self._pack((padded >> b) & 1) for b in range(self.bits)], axis=1)
        self.rows = self._pack((np.arange(self.words * 64) < n)[:, None])[0]

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        packed = np.packbits(bits.T.astype(np.uint8), axis=1, bitorder="little")
        return np.ascontiguousarray(packed).view(np.uint64)

    def sum(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, least significant first, of the inner product of every row, up to a constant of query and block.

        A component of weight w adds its slices once for each bit set in |w|; those of negative weight are complemented,
        so that only positive numbers are added. Three bitmaps of one position become a sum and a carry.
        """
        size = np.abs(query)
        at: list[list[np.ndarray]] = [[] for _ in range(int(size.max(initial=0)).bit_length() + self.bits + 1)]
        for p in range(int(size.max(initial=0)).bit_length()):
            chosen = (size >> p) & 1 == 1
            plain, turned = self.slices[chosen & (query > 0)], ~self.slices[chosen & (query < 0)]
            for b in range(self.bits):
                at[p + b] += [plain[:, b], turned[:, b]]
        out, p = [], 0
        while p < len(at):
            here = np.concatenate(at[p]) if at[p] else np.zeros((0, self.words), np.uint64)
            while len(here) > 1:
                t = max(1, len(here) // 3)
                if len(here) == 2:
                    total, carry, rest = here[:1] ^ here[1:], here[:1] & here[1:], here[2:]
                else:
                    a, b, c, rest = here[:t], here[t : 2 * t], here[2 * t : 3 * t], here[3 * t :]
                    either = a ^ b
                    total, carry = either ^ c, (a & b) | (either & c)
                if p + 1 == len(at):
                    at.append([])
                at[p + 1].append(carry)
                here = np.concatenate((total, rest))
            out.append(here[0] if len(here) else np.zeros(self.words, np.uint64))
            p += 1
        return out

    def top(self, query: np.ndarray, own: int, k: int = K) -> list[tuple[int, int]]:
        """(id, score) of the k best rows but those of id ``own``; ties to the smaller id."""
        left = self.rows.copy()
        for row in range(*np.searchsorted(self.ids, [own, own + 1]).tolist()):
            left[row >> 6] &= ~np.uint64(1 << (row & 63))
        sure = np.zeros_like(left)
        for s in reversed(self.sum(query)):
            high = left & s
            n = int(np.bitwise_count(sure | high).sum())
            if n > k:
                left = high
            else:
                sure, left = sure | high, left & ~s
                if n == k:
                    break
        certain = self._positions(sure)
        # Rows of the boundary score; ids ascend with positions.
        chosen = np.concatenate((certain, self._positions(left)[: k - len(certain)]))
        scores = self.values[chosen].astype(object) @ query.astype(object) if len(chosen) else []
        return sorted(zip(self.ids[chosen].tolist(), map(int, scores), strict=True), key=lambda r: (-r[1], r[0]))

    def _positions(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


class WideRows:
    """Rows of which some component is too large for the slices: compared one by one."""

    def __init__(self, ids: list[int], values: list[list[int]]):
        order = sorted(range(len(ids)), key=lambda i: (ids[i], values[i]))
        self.ids, self.values = np.array([ids[i] for i in order], np.int64), np.array([values[i] for i in order], object)
        self.dims = self.values.shape[1]


def best_rows(index: BitSlices | WideRows, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """(id, score) of the k best rows of a block: by its slices, or in long numbers where the block or the query is wide."""
    if isinstance(index, BitSlices) and query.dtype != object:
        return index.top(query, own, k)
    scores = (index.values.astype(object) @ query.astype(object)).tolist()
    rows = ((min(max(s, LEAST_SCORE), GREATEST_SCORE), i) for s, i in zip(scores, index.ids.tolist(), strict=True) if i != own)
    return [(i, s) for s, i in heapq.nsmallest(k, rows, key=lambda r: (-r[0], r[1]))]


def _floor(x: Column) -> Column:
    """The floor as a double. Beyond 2^52 a double is whole already, and its floor may not fit 64 bits."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def quantised(vector: Column) -> Column:
    """floor(64 x) of each component: exact as a double, whatever its size."""
    return F.transform(vector, lambda x: _floor(x.cast("double") * SCALE))


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, wide): quantised vectors without null or non-finite components; null ids and vectors are left out. ``wide``
    ones have a component too large for the slices."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) * SCALE < float("inf"))
    whole = F.col(vector).isNotNull() & F.col(key).isNotNull() & F.forall(F.col(vector), fine) & (F.size(vector) > 0)
    rows = df.where(whole).select(F.col(key).cast("bigint").alias("id"), quantised(F.col(vector)).alias("v"))
    return rows.withColumn("wide", F.exists("v", lambda x: F.abs(x) >= LARGEST))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[BitSlices | WideRows]:
    """Blocks of at most ``BLOCK_ROWS`` rows of one dimension each."""
    held: dict[tuple[int, bool], list[tuple[int, list[float]]]] = {}

    def block(wide: bool, rows: list) -> BitSlices | WideRows:
        if wide:
            return WideRows([r[0] for r in rows], [[int(x) for x in r[1]] for r in rows])
        return BitSlices(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float).astype(np.int64))

    for batch in batches:
        for i, v, wide in zip(*(batch[c].to_pylist() for c in ("id", "v", "wide")), strict=True):
            kind = len(v), wide
            rows = held.setdefault(kind, [])
            rows.append((i, v))
            if len(rows) == BLOCK_ROWS:
                yield block(kind[1], held.pop(kind))
    for (_, wide), rows in held.items():
        yield block(wide, rows)


def top_k(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest integer inner product for each query row.

    Every usable row but those of the query's own id is a candidate, if it has as many components. Queries are read in
    blocks of ``QUERY_ROWS``; each block is broadcast and meets every index block where the vectors lie, so that vectors
    are never shuffled and only ``k`` rows a query and block are. Of query rows that repeat an id, the least vector
    counts; repeated candidate rows count each. Vectors of any finite size take part; scores beyond 64 bits are given as
    the nearest number of 64 bits. An empty table gives no rows.
    """
    spark, vectors = df.sparkSession, usable(df, key, vector)
    queries = usable(df.where(is_query), key, vector).groupBy("id").agg(F.min("v").alias("v"))
    schema = "query_id bigint, vec_id bigint, score bigint"
    parts, block = [], []

    def against(some: list[tuple[int, list[float]]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(some)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = [(i, np.array([int(x) for x in v], np.int64 if max(map(abs, v)) < LARGEST else object)) for i, v in sent.value]
            for index in _blocks(batches):
                found = [(i, *r) for i, q in asked if len(q) == index.dims for r in best_rows(index, q, i, k)]
                columns = list(zip(*found, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
                )

        return vectors.mapInArrow(search, schema)

    for row in queries.toLocalIterator():
        block.append((row["id"], list(row["v"])))
        if len(block) == QUERY_ROWS:
            parts.append(against(block))
            block = []
    if block or not parts:
        parts.append(against(block))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
