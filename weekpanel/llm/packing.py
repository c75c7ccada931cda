"""Best-fit packing: token pieces go into sequences by the sum-of-squares rule, shard by shard."""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import Assigned, split_special, text_columns, tokenizer_path
from .merges import byte_alphabet

VOCABULARY = "word_bpe_49k.json"
CAPACITY, END_ID = 4096, 1
#: Pieces that one task packs. A shard ends with a few sequences that no piece fills; so many pieces make them rare.
SHARD_PIECES = 65_536
#: Sequences with more than this share of room left are opened again, and their pieces packed with those of other shards.
REOPEN_SHARE = 8
#: Orders of a shard's items: above this share of the capacity longest first, below at random.
ORDERS = (0.1, 0.5, 0)
#: Runs, and pre-tokens, kept with their ids in each Python worker.
MEMO_CHUNKS = 500_000
KEPT_LENGTH = 64
#: Separators that Python takes for white space, but the vocabulary's pattern does not.
_CONTROL_SEPARATORS = regex.compile("[\x1c-\x1f]")

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = "shard bigint, row bigint, sequence bigint, offset bigint, room bigint"


class WordIds:
    """Packed ids of texts under a vocabulary file that lower-cases and drops white space, as the library gives them.

    No pre-token reaches over white space. So the library's model sees each distinct pre-token once, and ids are kept for
    each distinct run without white space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        first = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or first["type"] != "Split" or first["behavior"] != "Removed":
            raise ValueError(f"{path} normalises or splits in another way")
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        # The model takes bytes as the characters that stand for them.
        self.alphabet = [byte_alphabet()[b] for b in range(256)]
        self.words = regex.compile(first["pattern"]["Regex"])
        self.special = {t["content"]: struct.pack("<I", t["id"]) for t in spec["added_tokens"]}
        self.split = split_special(list(self.special))
        self.assigned = Assigned()
        self.memo: dict[str, bytes] = {}
        self.word_memo: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        packed = self.word_memo.get(word)
        if packed is None:
            ids = [t.id for t in self.model.tokenize("".join(map(self.alphabet.__getitem__, word.encode())))]
            packed = struct.pack(f"<{len(ids)}I", *ids)
            if len(word) <= KEPT_LENGTH:
                if len(self.word_memo) >= MEMO_CHUNKS:
                    self.word_memo.clear()
                self.word_memo[word] = packed
        return packed

    def _run(self, run: str) -> bytes:
        packed = self.memo.get(run)
        if packed is None:
            packed = b"".join(map(self._word, self.words.findall(run)))
            if len(run) <= KEPT_LENGTH:
                if len(self.memo) >= MEMO_CHUNKS:
                    self.memo.clear()
                self.memo[run] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out = []
        for k, part in enumerate(self.split.split(text) if self.split else [text]):
            if k % 2:
                out.append(self.special[part])
            elif not self.assigned.all_of(part):
                out.append(np.array(self.library.encode(part, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                if not part.isascii():
                    # Lower case is by character: no final form of sigma.
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                part = part.lower()
                runs = self.words.findall(part) if _CONTROL_SEPARATORS.search(part) else part.split()
                packed = [*map(self.memo.get, runs)]
                if None in packed:
                    packed = [self._run(r) if p is None else p for r, p in zip(runs, packed, strict=True)]
                out += packed
        return b"".join(out)


_KNOWN: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    """One for each vocabulary and worker, so that what a task has learned serves the worker's next one."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def _cut(capacity: int, end_id: int, ids: WordIds, text: str | None) -> tuple[list[int], list[int]]:
    """Lengths and checksums of the pieces of a text: its ids and the closing one, cut at the capacity."""
    whole = memoryview(ids.encode(text or "") + struct.pack("<I", end_id))
    cuts = [whole[at : at + 4 * capacity] for at in range(0, len(whole), 4 * capacity)]
    return [len(c) // 4 for c in cuts], [zlib.crc32(c) for c in cuts]


def pieces(
    docs: DataFrame, path: str | None = None, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row for each piece of each row: its columns other than the text, and ``piece``, ``start``, ``length``,
    ``ids_crc32``. Columns of these names are replaced. Null and empty texts have one piece, the closing id."""
    kept = [c for c in docs.columns if c.lower() not in ("piece", "start", "length", "ids_crc32", "_lengths", "_crcs", "_p", text.lower())]
    setup = partial(_word_ids, path or tokenizer_path(VOCABULARY))
    fields = "_lengths array<bigint>, _crcs array<bigint>"
    cut = text_columns(docs.select(*[F.col(f"`{c}`") for c in (*kept, text)]), fields, setup, partial(_cut, capacity, end_id), text)
    own = [f"`{c}`" for c in kept]
    return cut.selectExpr(*own, "posexplode(arrays_zip(_lengths, _crcs)) as (piece, _p)").selectExpr(
        *own, "piece", f"bigint(piece) * {capacity} as start", "_p._lengths as length", "_p._crcs as ids_crc32"
    )


class SquaresPacker:
    """Open bins by the room they have left. An item goes where the sum of the squared counts of open bins over all
    rooms becomes smallest; of equal places into the fullest bin, and into a new one last."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms: list[int] = []

    def place(self, size: int) -> tuple[int, int]:
        """Bin and offset of an item of 1 to ``capacity``."""
        n, capacity = self.counts, self.capacity
        best, change = capacity, 2 * n[capacity - size] + 1 if size < capacity else 0
        if size < capacity:
            # Moving a bin from room g to g - size changes the sum by 2 (n[g - size] - n[g] + 1); closed bins do not count.
            moved = 2 * (n[: capacity - size] - n[size:capacity]) + 2
            moved[0] = 1 - 2 * n[size]
            moved[n[size:capacity] == 0] = np.iinfo(np.int64).max
            at = int(moved.argmin())
            if moved[at] <= change:
                best = size + at
        if best == capacity:
            self.rooms.append(capacity)
            bin_id = len(self.rooms) - 1
        else:
            bin_id = self.open[best].pop()
            n[best] -= 1
        offset = capacity - self.rooms[bin_id]
        left = self.rooms[bin_id] = best - size
        if left:
            n[left] += 1
            self.open[left].append(bin_id)
        return bin_id, offset


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[int, int]], SquaresPacker]:
    """Places (bin, offset) of the items of one shard, and its packer.

    The rule takes items as they come, so the order matters: items over a share of the capacity come longest first, the
    others at random. Of the orders tried the one of fewest bins is taken, at once if it needs no more than the sum does.
    """
    mixed = np.random.default_rng(len(lengths)).permutation(len(lengths))
    falling = mixed[np.argsort(-lengths[mixed], kind="stable")]
    best = None
    for share in ORDERS:
        long = lengths > share * capacity
        order = np.concatenate((falling[long[falling]], mixed[~long[mixed]])).tolist()
        packer, places = SquaresPacker(capacity), [(0, 0)] * len(order)
        for k in order:
            places[k] = packer.place(int(lengths[k]))
        if best is None or len(packer.rooms) < len(best[1].rooms):
            best = places, packer
        if len(best[1].rooms) * capacity - int(lengths.sum()) < capacity:
            break
    return best


def _pack_shards(capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the rows of every shard; rows (shard, row, length) come sorted by shard."""
    schema = pa.schema([(f.split()[0], pa.int64()) for f in PLACED.split(", ")])
    shard, rows, lengths = None, [], []

    def done() -> Iterator[pa.RecordBatch]:
        if rows:
            places, packer = pack_lengths(np.array(lengths, np.int64), capacity)
            bins, offsets = zip(*places, strict=True)
            columns = ([shard] * len(rows), rows, bins, offsets, [packer.rooms[b] for b in bins])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    for batch in batches:
        for s, row, length in zip(*(batch[c].to_pylist() for c in ("shard", "row", "length")), strict=True):
            if s != shard:
                yield from done()
                shard, rows, lengths = s, [], []
            rows.append(row)
            lengths.append(length)
    yield from done()


def _round(rows: DataFrame, n_shards: int, capacity: int, seed: int) -> DataFrame:
    """Rows (row, length) dealt to shards by the hash of the row number and packed there; written out."""
    dealt = rows.select(F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(n_shards)).alias("shard"), "row", "length")
    by_shard = dealt.repartition("shard") if n_shards > 1 else dealt.coalesce(1)
    sorted_rows = by_shard.sortWithinPartitions("shard", "row")
    return cut_lineage(sorted_rows.mapInArrow(partial(_pack_shards, capacity), PLACED))


def pack(items: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length`` from 1 to ``capacity``, so that sequences are gapless.

    Rows are dealt at random to shards of about ``shard_pieces``; each is packed in one task by
    ``pack_lengths``. What a shard leaves more than an eighth empty is opened again and packed together with that of
    other shards, until one shard is left or a round saves nothing. So a task holds ``shard_pieces`` numbers however large
    the table is. Rows are told apart by their place in the written table, not by an id: repeated ids and rows are packed
    one by one. An empty table gives no rows; columns of the new names are replaced.
    """
    kept = [c for c in items.columns if c.lower() not in ("sequence_id", "offset", "_row")]
    # The number is given once and written with the row: a repeated task reads the same ones.
    table = cut_lineage(items.select(*[F.col(f"`{c}`") for c in kept]).withColumn("_row", F.monotonically_increasing_id()))
    rows = table.select(F.col("_row").alias("row"), "length")
    n, settled, level = rows.count(), None, 0
    while True:
        n_shards = max(1, -(-n // shard_pieces))
        placed = _round(rows, n_shards, capacity, level).withColumn("level", F.lit(level))
        again = F.col("room") * REOPEN_SHARE > capacity
        if n_shards > 1:
            n_again = placed.where(again).count()
            last = not n_again or n_again * 2 > n
        else:
            last = True
        final = placed if last else placed.where(~again)
        settled = final if settled is None else settled.unionByName(final)
        if last:
            break
        lengths = rows.withColumnRenamed("row", "_r")
        opened = placed.where(again).select("row")
        rows = cut_lineage(lengths.join(opened, lengths["_r"] == opened["row"]).select("row", "length"))
        n, level = n_again, level + 1
    # Numbers of levels, shards and bins do not meet: a shard has fewer than 2^24 bins, and levels shrink fast.
    number = F.col("level") * (1 << 56) + F.col("shard") * (1 << 24) + F.col("sequence")
    places = settled.select(F.col("row").alias("_row"), number.alias("sequence_id"), "offset")
    return table.join(places, "_row").select(*[F.col(f"`{c}`") for c in kept], "sequence_id", "offset")


def pack_documents(
    docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset): all texts as token ids with a closing id, packed.

    Only documents longer than a sequence are cut, into full pieces and a rest. Null and empty texts are one piece of
    one id. Repeated and null ids stay, row by row; an empty table gives no rows; other columns are left out. Very long
    texts are encoded whole, in the memory of their own ids.
    """
    named = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text"))
    return pack(pieces(named, path, "text", capacity), capacity, shard_pieces)
