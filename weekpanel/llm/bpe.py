"""Byte-level BPE: short words are merged over contiguous rank arrays; the decoder undoes it."""

from __future__ import annotations

import hashlib
import json
import struct
from functools import partial
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import Assigned, split_special, text_columns, tokenizer_path
from .merges import byte_alphabet, read_merges

VOCABULARY = "byte_bpe_50k.json"
#: The pre-token pattern of byte-level BPE vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept with their ids in each Python worker; the memo is emptied beyond that. Longer words are not kept.
MEMO_WORDS = 300_000
KEPT_LENGTH = 64
#: Words of one very long text are taken in portions of so many.
PORTION = 200_000


class Bpe:
    """Ids of texts under a byte-level vocabulary file, equal to those of the tokenizers library without added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        to_char = byte_alphabet()
        to_byte = {c: b for b, c in to_char.items()}
        self.byte_id = [vocab[to_char[b]] for b in range(256)]
        self.merges = read_merges(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.piece: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.piece[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            self.piece[i] = token.encode()
        self.split = split_special(list(self.special))
        self.words = regex.compile(PATTERN)
        self.path, self.library, self.assigned = path, None, Assigned()
        self.memo: dict[str, bytes] = {}

    def _split_by_library(self, part: str) -> list[str]:
        """Pre-tokens of a text with unassigned characters, whose classes depend on the library's Unicode version."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return [part[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(part)]

    def portions(self, text: str):
        """Lists of pre-tokens of a text in order; a special string is the only one in its list."""
        for k, part in enumerate(self.split.split(text) if self.split else [text]):
            if k % 2 or not part:
                yield [part] if part else []
            elif not self.assigned.all_of(part):
                yield self._split_by_library(part)
            elif len(part) <= PORTION:
                yield self.words.findall(part)
            else:
                found = (m.group() for m in self.words.finditer(part))
                while some := list(islice(found, PORTION)):
                    yield some

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of words that the memo lacks; short ones go into the memo."""
        new = list(words)
        byte_id = self.byte_id
        ids = self.merges.merge([[byte_id[b] for b in w.encode()] for w in new])
        packed = {w: struct.pack(f"<{len(i)}I", *i) for w, i in zip(new, ids, strict=True)}
        packed |= {w: struct.pack("<I", self.special[w]) for w in new if w in self.special}
        if len(self.memo) + len(packed) > MEMO_WORDS:
            self.memo.clear()
        self.memo.update((w, p) for w, p in packed.items() if len(w) <= KEPT_LENGTH)
        return packed

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        found = [[*self.portions(t)] for t in texts]
        wanted: set[str] = set()
        for portions in found:
            for words in portions:
                wanted.update(words)
        known = {w: p for w in wanted if (p := self.memo.get(w)) is not None}
        known |= self.learn(wanted - known.keys())
        get = known.__getitem__
        return [b"".join([b"".join(map(get, words)) for words in portions]) for portions in found]

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        pieces = map(self.piece.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(pieces).decode("utf-8", "replace")


def _digests(bpe: Bpe, texts: list[str | None]) -> list[tuple]:
    out = []
    for ids in bpe.encode([t or "" for t in texts]):
        decoded = bpe.decode(ids).encode()
        out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    return out


def _ids(bpe: Bpe, texts: list[str | None]) -> list[tuple]:
    encoded = bpe.encode([t or "" for t in texts])
    return [(np.frombuffer(ids, "<u4").astype("i4"), len(ids) // 4, bpe.decode(ids)) for ids in encoded]


def encode(df: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """Add ``ids`` (array<int>), ``n_tokens`` and ``decoded`` for each row; columns of these names are replaced.

    Null and empty texts have no ids and decode to the empty text. Repeated rows stay, an empty table stays empty.
    """
    setup = partial(Bpe, path or tokenizer_path(VOCABULARY))
    return text_columns(df, "ids array<int>, n_tokens bigint, decoded string", setup, _ids, text, many=True)


def digests(df: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: as ``encode``, without carrying the ids."""
    setup = partial(Bpe, path or tokenizer_path(VOCABULARY))
    return text_columns(df, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", setup, _digests, text, many=True)
