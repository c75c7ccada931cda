"""Benchmark decontamination: training windows are looked up in a broadcast hash set of benchmark n-grams, then verified."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import BROADCAST_BYTES, rows_where, text_columns

WINDOW = 13
#: A document counts as contaminated if at least one word in this many is hit.
SHARE = 20
#: A block of items is broadcast at a time; its words take at most this many bytes.
BLOCK_BYTES = BROADCAST_BYTES // 8

# Lower-cases A-Z, turns every other byte that is no word byte into a space.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


class Windows:
    """The hash set of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        self.items: dict[bytes, set[str]] = {}
        by_length: dict[int, set[bytes]] = {}
        for item, words in items:
            if not words:
                continue
            for w in words:
                self.ids.setdefault(w, len(self.ids))
            n = min(window, len(words))
            for at in range(len(words) - n + 1):
                key = b" ".join(words[at : at + n])
                self.items.setdefault(key, set()).add(item)
                by_length.setdefault(n, set()).add(key)
        self.hashes = {
            n: np.unique(
                np.array([self._hash(np.array([self.ids[w] for w in k.split()]), n)[0] for k in keys], np.uint64)
            )
            for n, keys in sorted(by_length.items())
        }

    @staticmethod
    def _hash(ids: np.ndarray, n: int) -> np.ndarray:
        values = ids.astype(np.uint64) + np.uint64(1)
        out = np.zeros(len(ids) - n + 1, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(n):
                out = out * _BASE + values[j : j + len(out)]
        return out

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans (start, end) of the windows that occur, and their items."""
        found: set[str] = set()
        spans: list[tuple[int, int]] = []
        if not words or not self.hashes:
            return spans, found
        ids = np.array(list(map(self.ids.get, words, repeat(-1))), np.int64)
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        for n, hashes in self.hashes.items():
            if n > len(ids):
                continue
            whole = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(whole):
                continue
            rolled = np.zeros(len(whole), np.uint64)
            with np.errstate(over="ignore"):
                for j in range(n):
                    rolled = rolled * _BASE + (ids[whole + j].astype(np.uint64) + np.uint64(1))
            for at in whole[np.isin(rolled, hashes)].tolist():
                items = self.items.get(b" ".join(words[at : at + n]))
                if items:  # equal hashes are verified word by word
                    spans.append((at, at + n))
                    found |= items
        return spans, found


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of bounded size; the iterator holds one partition of the benchmark at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(item).cast("string"), F.col(text).cast("string")).toLocalIterator():
        if row[0] is None or not (words := words_of(row[1])):
            continue
        cost = sum(map(len, words)) + len(words)
        if block and size + cost > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += cost
    yield block


def find(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (merged word spans as start:end, comma-joined), ``n_hit``, ``hit_items`` (sorted
    strings) and ``contaminated`` to every document; columns of these names are replaced.

    The benchmark is read in blocks of at most ``BLOCK_BYTES``. Each block is broadcast and scanned by one narrow pass;
    a benchmark of any size takes more passes, never a larger broadcast, and documents are never shuffled. Null texts
    have no words; null item ids are left out; a null or wordless item has no window; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    out = docs.drop("hit_spans", "hit_items")
    for k, block in enumerate(_blocks(benchmark, item, "text")):
        sent = spark.sparkContext.broadcast((block, window))
        out = _pass(out, sent, text, first=k == 0)
    n_hit = "aggregate(transform(filter(split(hit_spans, ','), s -> s <> ''), s -> " \
        "bigint(split(s, ':')[1]) - bigint(split(s, ':')[0])), 0L, (a, b) -> a + b)"
    return out.withColumn("n_hit", F.expr(n_hit)).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _pass(docs: DataFrame, sent, text: str, first: bool) -> DataFrame:
    """Scan for one block; a later pass adds its spans and items to those of the passes before."""
    if first:
        def one(windows: Windows, t: str | None) -> tuple:
            words = words_of(t)
            spans, items = windows.scan(words)
            return len(words), ",".join(f"{a}:{b}" for a, b in _merge(spans)), sorted(items)

        fields = "n_words bigint, hit_spans string, hit_items array<string>"
        return text_columns(docs, fields, lambda: Windows(*sent.value), one, text)

    schema = to_arrow_schema(docs.schema)

    def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(*sent.value)
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            spans_out, items_out = [], []
            rows = zip(columns[text], columns["hit_spans"], columns["hit_items"], strict=True)
            for t, spans, items in rows:
                new, found = windows.scan(words_of(t.as_py()))
                old = [tuple(map(int, s.split(":"))) for s in spans.as_py().split(",") if s]
                spans_out.append(",".join(f"{a}:{b}" for a, b in _merge(old + new)))
                items_out.append(sorted({*items.as_py(), *found}))
            columns |= {"hit_spans": pa.array(spans_out, pa.string()), "hit_items": pa.array(items_out, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(
                [columns[f.name].cast(f.type) for f in schema], schema=schema
            )

    return docs.mapInArrow(more, docs.schema)


def digests(found: DataFrame) -> DataFrame:
    """``n_items`` and ``items_sha256`` from the items of each document."""
    joined = F.array_join("hit_items", ",")
    return found.withColumns({"n_items": F.size("hit_items").cast("bigint"), "items_sha256": F.sha2(joined, 256)})


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with the columns they had."""
    return rows_where(docs, [text], lambda d: find(d, benchmark, text), "not contaminated")
