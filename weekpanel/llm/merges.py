"""Byte-pair merges of many short words at once, each over its own contiguous rank array."""

from __future__ import annotations

import heapq

import numpy as np

#: Words of more parts are merged one by one through a heap: scans of a rank array take the square of its length.
SHORT = 96
_NONE = np.int32(np.iinfo(np.int32).max)


class PairMerges:
    """The merge rules of a vocabulary: (left id, right id) in order of rank, and the id of each merged part."""

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int]):
        rank_of: dict[int, int] = {}
        for rank, (left, right) in enumerate(pairs):
            rank_of.setdefault(left << 32 | right, rank)
        self.rank_of, self.merged = rank_of, np.array(merged, np.int32)
        keys = np.array(list(rank_of), np.int64)
        order = np.argsort(keys)
        self.keys = np.concatenate((keys[order], [np.iinfo(np.int64).max]))
        self.ranks = np.concatenate((np.array(list(rank_of.values()), np.int32)[order], [_NONE]))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of adjacent parts; the highest number where no rule merges them or a part is missing (-1)."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)

    def merge(self, words: list[list[int]]) -> list[list[int]]:
        """Ids of each word given as first ids: merge the adjacent pair of lowest rank, the leftmost of equals, to the end."""
        out: list[list[int]] = [[]] * len(words)
        by_width: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w) > SHORT:
                out[k] = self.merge_long(w)
            else:
                by_width.setdefault(-(-len(w) // 4) * 4, []).append(k)
        for width, ks in by_width.items():
            for at in range(0, len(ks), 4096):
                some = ks[at : at + 4096]
                parts = np.array([words[k] + [-1] * (width - len(words[k])) for k in some], np.int32)
                for k, ids in zip(some, self._merge_block(parts.reshape(len(some), width)), strict=True):
                    out[k] = ids
        return out

    def _merge_block(self, parts: np.ndarray) -> list[list[int]]:
        """One merge a round in every word of the block. A merge deletes one boundary, so that all arrays narrow by one."""
        out: list[list[int]] = [[]] * len(parts)
        row = np.arange(len(parts))
        ranks = self.rank(parts[:, :-1], parts[:, 1:]) if parts.shape[1] > 1 else np.empty((len(parts), 0), np.int32)
        while len(row):
            if ranks.shape[1]:
                at = ranks.argmin(1)
                low = ranks[np.arange(len(row)), at]
                done = low == _NONE
            else:
                done = np.ones(len(row), bool)
            if done.any():
                for k, ids in zip(row[done].tolist(), parts[done].tolist(), strict=True):
                    out[k] = ids[: ids.index(-1)] if ids and ids[-1] == -1 else ids
                if done.all():
                    break
                parts, ranks, row, at, low = parts[~done], ranks[~done], row[~done], at[~done], low[~done]
            n = np.arange(len(row))
            parts[n, at] = self.merged[low]
            columns = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), 1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.rank(parts[left, at[left] - 1], parts[left, at[left]])
            right = np.flatnonzero(at < ranks.shape[1])
            ranks[right, at[right]] = self.rank(parts[right, at[right]], parts[right, at[right] + 1])
        return out

    def merge_long(self, word: list[int]) -> list[int]:
        """The same merges of one word over a linked list and a heap."""
        ids, n, rank_of = list(word), len(word), self.rank_of
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or rank_of.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank_of.get(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank_of.get(ids[h] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (r, h))
        return [i for i in ids if i >= 0]


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in vocabulary files: itself if printable, else one from 256 up."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def read_merges(spec: dict) -> PairMerges:
    """The rules of a tokenizer file's BPE model."""
    vocab = spec["model"]["vocab"]
    pairs = [tuple(p) if isinstance(p, list) else tuple(p.split(" ")) for p in spec["model"]["merges"]]
    return PairMerges([(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs])
