"""Substring dedup: spans of words that repeat in the corpus are found with suffix automata of routed shards and removed.

An automaton of the corpus grows with it and can't be broadcast, nor can every document stream through every shard. So
shards are routed: every window of ``WINDOW`` words names one of its ``GRAM``-word grams, the one of least hash, as its
anchor. Equal windows name equal anchors at equal places, hence meet in the shard of that anchor. The automaton of a
shard is built where its contexts meet; contexts stream through it, and matching statistics tell the repeated windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..session import scratch_path
from .common import BROADCAST_BYTES, ascii_words, unused

WINDOW, GRAM = 35, 8
PLACES = WINDOW - GRAM + 1  # grams of a window, hence places an anchor may have in it
#: Shards of more different contexts are split by the words that windows of near places share; smaller ones get an automaton.
SHARD_CONTEXTS = 512
#: Bits of the table of repeated anchors: at least so many per anchor, within these bounds. It is broadcast. A fuller
#: table lets more anchors pass; they are told apart afterwards, so that its size never changes a result.
BITS_PER_ANCHOR, LEAST_BITS, MOST_BITS = 16, 16, 27
#: Word hashes kept in each Python worker.
MEMO_WORDS = 500_000
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word) >> 1 | 1
        if len(self) < MEMO_WORDS:
            self[word] = value
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as asked."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _ODD), ("down", _INVERSE)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))
        return self.up[:n], self.down[:n]


class Anchors:
    """Anchors of a document: their place, hash, the windows that name them, and the hash of the words of these windows."""

    def __init__(self, words: list[bytes], hashes: WordHashes, powers: Powers):
        n = len(words)
        h = _mix(np.fromiter(map(hashes.__getitem__, words), np.int64, n).astype(np.uint64))
        up, down = powers.upto(n + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[:n], dtype=np.uint64)))
            grams = _mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
            named = np.lib.stride_tricks.sliding_window_view(grams, PLACES).argmin(1) + np.arange(n - WINDOW + 1)
            change = np.flatnonzero(np.diff(named)) + 1
            self.first = np.concatenate(([0], change))  # first and last window that names the anchor
            self.last = np.concatenate((change - 1, [len(named) - 1]))
            self.place = named[self.first]
            self.gram = grams[self.place]
            end = self.last + WINDOW
            spread = _mix((sums[end] - sums[self.first]) * down[self.first])
            shape = (self.place - self.first) * 64 + (self.last - self.first)
            self.context = _mix(spread + shape.astype(np.uint64) * np.uint64(_ODD))


class SuffixAutomaton:
    """Suffix automaton of several sequences; ``count`` of a state is in how many places its substrings end."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, q: int, letter: int) -> int:
        """The state of the substrings of ``q`` that end at ``letter`` after ``p``."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(letter) == q:
            self.next[p][letter] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        following, link, length, count = self.next, self.link, self.length, self.count
        for letter in sequence:
            known = following[last].get(letter)
            if known is not None:
                last = self._split(last, known, letter)
            else:
                new, p = self._state(length[last] + 1, 0, {}), last
                while p >= 0 and letter not in following[p]:
                    following[p][letter] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, following[p][letter], letter)
                last = new
            count[last] += 1

    def finish(self) -> None:
        """Carry the counts along the suffix links."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def statistics(self, sequence: list[int], least: int = 2) -> Iterator[int]:
        """For each position, how long the longest substring that ends there and occurs ``least`` times is."""
        state = matched = 0
        following, link, length, count = self.next, self.link, self.length, self.count
        for letter in sequence:
            while True:
                to = following[state].get(letter)
                if to is not None and count[to] >= least:
                    state, matched = to, matched + 1
                    break
                if not state:
                    matched = 0
                    break
                state = link[state]
                matched = length[state]
            yield matched


def shard_masks(contexts: list[tuple[int, list[bytes]]]) -> list[int]:
    """For each context (words before the anchor, words) the places of the anchor whose window another context has too.

    Letters carry their distance from the anchor, so that windows match in equal places only: two anchors of one
    document may lie so near that their contexts hold the same window, which is then no repetition.
    """
    ids: dict[bytes, int] = {}
    letters = [[ids.setdefault(w, len(ids)) * 128 + i - left + WINDOW for i, w in enumerate(words)] for left, words in contexts]
    automaton = SuffixAutomaton()
    for sequence in letters:
        automaton.add(sequence)
    automaton.finish()
    masks = []
    for (left, _), sequence in zip(contexts, letters, strict=True):
        mask = 0
        for i, matched in enumerate(automaton.statistics(sequence)):
            if matched >= WINDOW:
                mask |= 1 << (left + WINDOW - 1 - i)
        masks.append(mask)
    return masks


def _anchored(emit: Callable, schema: pa.Schema) -> Callable:
    """A batch function over (id, text_hash, text) that calls ``emit(row, words, anchors)`` for documents with windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, powers = WordHashes(), Powers()
        for batch in batches:
            columns = [[] for _ in schema]
            seen: set = set()
            keys = [batch[c].to_pylist() for c in batch.schema.names if c != "text"]
            for *key, text in zip(*keys, batch["text"], strict=True):
                words = ascii_words(text.as_py())
                if len(words) >= WINDOW:
                    for column, values in zip(columns, emit(key, words, Anchors(words, hashes, powers), seen), strict=True):
                        column.append(values)
            arrays = [
                pa.chunked_array(c, f.type).combine_chunks() if c else pa.array([], f.type) for c, f in zip(columns, schema, strict=True)
            ]
            flat = [a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in arrays]
            yield pa.RecordBatch.from_arrays(flat, schema=schema)

    return run


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _statistics(docs: DataFrame) -> DataFrame:
    """(h, differs) of every anchor hash that occurs again; ``differs`` if not all of its contexts are equal."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64())])

    def emit(key: list, words: list, a: Anchors, seen: set) -> tuple:
        return _signed(a.gram), _signed(a.context)

    every = docs.select("text").mapInArrow(_anchored(emit, schema), "h bigint, c bigint")
    counted = every.groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
    return counted.where("n > 1").selectExpr("h", "low <> high as differs")


def _bit_tables(repeated: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Two bit tables over anchor hashes: the repeated ones, and those of different contexts. Never a wrong no."""
    n = repeated.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_PER_ANCHOR * max(1, n)).bit_length()))
    at = F.expr(f"h & {(1 << bits) - 1}L")
    one = F.expr("shiftleft(1L, cast(at & 63 as int))")
    rows = (
        repeated.select(at.alias("at"), "differs")
        .select(F.expr("shiftright(at, 6)").alias("word"), one.alias("one"), F.when(F.col("differs"), one).otherwise(0).alias("two"))
        .groupBy("word").agg(F.bit_or("one").alias("one"), F.bit_or("two").alias("two"))
    )
    found = rows.toArrow()
    tables = np.zeros((2, (1 << bits) // 64), np.uint64)
    word = found["word"].to_numpy()
    for i, name in enumerate(("one", "two")):
        tables[i, word] = found[name].to_numpy().astype(np.int64).view(np.uint64)
    return tables[0], tables[1], bits


def _candidates(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Anchors that may be repeated: whose they are, where, the places they have in windows that name them, and the words
    of these windows where contexts differ (once a batch for equal contexts)."""
    tables = docs.sparkSession.sparkContext.broadcast(_bit_tables(repeated))
    fields = [("id", pa.int64()), ("text_hash", pa.int64()), ("place", pa.int64()), ("own", pa.int64()), ("h", pa.int64()), ("c", pa.int64()), ("words", pa.binary())]
    schema = pa.schema(fields)

    def passes(table: np.ndarray, grams: np.ndarray, bits: int) -> np.ndarray:
        at = grams & np.uint64((1 << bits) - 1)
        return (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def emit(key: list, words: list, a: Anchors, seen: set) -> tuple:
        one, two, bits = tables.value
        k = np.flatnonzero(passes(one, a.gram, bits))
        differs = passes(two, a.gram[k], bits)
        far, near = a.place[k] - a.first[k], a.place[k] - a.last[k]
        own = (np.left_shift(2, far) - 1) & ~(np.left_shift(1, near) - 1)
        payload: list[bytes | None] = []
        for i, d in zip(k.tolist(), differs.tolist(), strict=True):
            pair = (int(a.gram[i]), int(a.context[i]))
            if d and pair not in seen:
                seen.add(pair)
                payload.append(bytes([a.place[i] - a.first[i]]) + b" ".join(words[a.first[i] : a.last[i] + WINDOW]))
            else:
                payload.append(None)
        same = lambda v: pa.array([v] * len(k), pa.int64())
        return same(key[0]), same(key[1]), pa.array(a.place[k]), pa.array(own), _signed(a.gram[k]), _signed(a.context[k]), pa.array(payload, pa.binary())

    ddl = "id bigint, text_hash bigint, place bigint, own bigint, h bigint, c bigint, words binary"
    return docs.select("id", "text_hash", "text").mapInArrow(_anchored(emit, schema), ddl)


def _context(payload: bytes) -> tuple[int, list[bytes]]:
    return payload[0], payload[1:].split(b" ")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of the contexts of each shard; rows (shard, h, c, words) come sorted by shard and c, shards are bounded."""
    held: list[tuple[int, int, int, bytes]] = []

    def done() -> list[tuple[int, int, int]]:
        masks = shard_masks([_context(w) for *_, w in held]) if len(held) > 1 else []
        return [(h, c, m) for (_, h, c, _), m in zip(held, masks, strict=False) if m]

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["h", "c", "mask"])

    for batch in batches:
        out: list[tuple[int, int, int]] = []
        for shard, h, c, words in zip(*(batch[n].to_pylist() for n in ("shard", "h", "c", "words")), strict=True):
            if held and held[-1][0] != shard:
                out += done()
                held = []
            if not held or held[-1][1:3] != (h, c):
                held.append((shard, h, c, words))
        yield batch_of(out)
    yield batch_of(done())


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each context once for either half of its places, with the hash of the words common to the windows of that half.

    Contexts that share a window with its anchor in some place share these words, so they stay together.
    """
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    for batch in batches:
        rows = []
        for h, c, low, high, payload in zip(*(batch[n].to_pylist() for n in ("h", "c", "low", "high", "words")), strict=True):
            left, words = _context(payload)
            middle = (low + high + 1) // 2
            for a, b in ((low, middle - 1), (middle, high)):
                if a <= b and left >= a and left + WINDOW - len(words) <= b:
                    core = b" ".join(words[left - a : left + WINDOW - b])
                    shard = xxhash.xxh3_64_intdigest(core, seed=h % (1 << 64) ^ a << 8 ^ b) - (1 << 63)
                    rows.append((shard, h, c, a, b, payload))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["shard", "h", "c", "low", "high", "words"]
        )


def _split_large(rows: DataFrame, shard_contexts: int, written: Callable) -> tuple[DataFrame, DataFrame]:
    """Contexts (h, c, words) of large shards: (shard, h, c, words) of the shards that they fall into, and the masks
    (h, c, mask) of those that stay large down to a single window.

    The places of the anchor are halved, and contexts dealt out by the words that all windows of a half have in common.
    Contexts alone in their part leave; parts of at most ``shard_contexts`` become shards; others are halved again. At
    the end of five rounds a part is one window in one place, which all of its contexts then repeat.
    """
    schema = "shard bigint, h bigint, c bigint, low bigint, high bigint, words binary"
    current = rows.withColumns({"low": F.lit(0).cast("bigint"), "high": F.lit(PLACES - 1).cast("bigint")})
    small = []
    for level in range((PLACES - 1).bit_length()):
        dealt = written(current.select("h", "c", "low", "high", "words").mapInArrow(_halves, schema), f"halves-{level}")
        sizes = dealt.groupBy("shard", "h").agg(F.count("*").alias("n")).where("n > 1")
        met = dealt.join(sizes, ["shard", "h"])
        small.append(met.where(F.col("n") <= shard_contexts).select("shard", "h", "c", "words"))
        current = met.where(F.col("n") > shard_contexts)
    shards = small[0]
    for more in small[1:]:
        shards = shards.unionByName(more)
    return shards, current.select("h", "c", F.expr("shiftleft(1L, int(low))").alias("mask"))


def _if_small(table: DataFrame, row_bytes: int) -> DataFrame:
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def _spans(marks: pa.Array) -> list[tuple[int, int]]:
    """Word spans, merged, of marks (place of an anchor and the places that it has in repeated windows)."""
    starts = sorted(place - a for m in marks for place in [m >> PLACES] for a in range(PLACES) if m >> a & 1)
    spans: list[tuple[int, int]] = []
    for s in starts:
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], s + WINDOW)
        else:
            spans.append((s, s + WINDOW))
    return spans


def _packed_spans(marks: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in marks:
        yield pa.array([np.array(_spans(m), "<i8").tobytes() for m in batch.to_pylist()], pa.binary())


def repeated_spans(docs: DataFrame, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """(id, text_hash, spans) of documents (id, text_hash, text) with words in repeated windows; spans are pairs of 64-bit
    numbers, start and end in words."""
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    found = written(_candidates(docs, written(_statistics(docs), "anchors")), "candidates")
    contexts = found.groupBy("h", "c").agg(F.count("*").alias("n"))
    large = written(contexts.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > shard_contexts).select("h"), "large")
    large = _if_small(large, 16)
    known = found.where("words is not null").select("h", "c", "words")
    shards = known.join(large, "h", "left_anti").select(F.col("h").alias("shard"), "h", "c", "words")
    masks = [contexts.where("n > 1").select("h", "c", F.lit((1 << PLACES) - 1).cast("bigint").alias("mask"))]
    if not large.isEmpty():
        once = known.join(large, "h", "left_semi").groupBy("h", "c").agg(F.min("words").alias("words"))
        parts, in_large = _split_large(written(once, "large-contexts"), shard_contexts, written)
        shards = shards.unionByName(parts)
        masks.append(in_large)
    routed = shards.repartition("shard").sortWithinPartitions("shard", "h", "c")
    masks.append(routed.mapInArrow(_shards, "h bigint, c bigint, mask bigint"))
    union = masks[0]  # a context that occurs twice repeats in all of its windows
    for more in masks[1:]:
        union = union.unionByName(more)
    # Written, so that the join below is one of two plain tables, in which a context of very many documents can be split.
    union = written(union.groupBy("h", "c").agg(F.expr("bit_or(mask)").alias("mask")), "masks")
    marked = found.drop("words").join(union, ["h", "c"]).where("mask & own <> 0")
    mark = F.expr(f"shiftleft(place, {PLACES}) | (mask & own)")
    # A set: rows of one id and text have the same marks, however many there are, so that it is bounded by the text.
    by_document = marked.groupBy("id", "text_hash").agg(F.collect_set(mark).alias("marks"))
    return by_document.select("id", "text_hash", F.arrow_udf(_packed_spans, BinaryType())("marks").alias("spans"))


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """Add ``n_words``, ``n_removed`` and ``kept`` (kept words joined by one space); columns of these names are replaced.

    A word goes if a window of ``WINDOW`` words over it starts anywhere else too. Null, empty and short texts lose
    nothing. Repeated rows and repeated or null ids count as documents of their own (equal texts of one id alike). The
    spans are broadcast while they fit ``BROADCAST_BYTES``, else joined.
    """
    spark = docs.sparkSession
    as_id = F.xxhash64(F.lit("id"), F.col(f"`{key}`").cast("string"))
    as_text = F.col(f"`{text}`").cast("string")
    keyed = docs.select(as_id.alias("id"), F.xxhash64(as_text).alias("text_hash"), as_text.alias("text")).where(F.length("text") >= 2 * WINDOW - 1)
    path = scratch_path(spark, "spans")
    repeated_spans(keyed, shard_contexts).write.parquet(path)
    own = [unused(docs, c) for c in ("_span_id", "_span_text", "_spans", "_cut")]
    spans = spark.read.parquet(path).toDF(*own[:3])
    size = spans.agg(F.sum(F.octet_length(own[2]) + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        spans = F.broadcast(spans)
    joined = docs.join(spans, (as_id == F.col(own[0])) & (F.xxhash64(as_text) == F.col(own[1])), "left")

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept: string>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, packed in batches:
            rows = []
            for t, p in zip(texts, packed, strict=True):
                words = ascii_words(t.as_py())
                n = len(words)
                for start, end in np.frombuffer(p.as_py() or b"", "<i8").reshape(-1, 2)[::-1].tolist():
                    del words[start:end]
                rows.append({"n_words": n, "n_removed": n - len(words), "kept": b" ".join(words).decode()})
            yield pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))

    result = joined.withColumn(own[3], cut(as_text, F.col(own[2])))
    names = ("n_words", "n_removed", "kept")
    return result.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names], *[F.col(f"{own[3]}.{c}") for c in names])
