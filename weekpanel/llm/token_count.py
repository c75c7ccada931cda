"""Token counts without ids: pieces are counted once for each distinct pre-token, then summed by its frequency."""

from __future__ import annotations

import json
import os
import unicodedata
from collections import Counter
from functools import partial

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Assigned, split_special, text_columns, tokenizer_path
from .merges import byte_alphabet, read_merges

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Pre-tokens kept with their piece counts in each Python worker; the memo is emptied beyond that.
MEMO_WORDS = 400_000
KEPT_LENGTH = 64


class PieceCounter:
    """Counts for a vocabulary file that lower-cases, drops white space and splits by one pattern (its own `Split` rule).

    The pieces of a pre-token don't depend on what stands around it, so that a text's count is the sum over its distinct
    pre-tokens of frequency times pieces. Special strings inside texts are one token each, as the library has it.
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
        self.merges, vocab, end = read_merges(spec), spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        chars = byte_alphabet()
        self.byte_id = [vocab[chars[b]] for b in range(256)]
        self.last_id = [vocab[chars[b] + end] for b in range(256)]
        self.words = regex.compile(first["pattern"]["Regex"])
        self.split = split_special([t["content"] for t in spec["added_tokens"]])
        self.assigned = Assigned()
        self.memo: dict[str, int] = {}

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """Distinct pre-tokens of a text with how often they occur, and how many tokens it has besides.

        Special strings are besides, and parts with unassigned characters, whose classes depend on the library's Unicode.
        """
        parts = self.split.split(text) if self.split else [text]
        counts: Counter = Counter()
        besides = len(parts) // 2
        for part in parts[::2]:
            if not self.assigned.all_of(part):
                besides += len(self.library.encode(part, add_special_tokens=False).ids)
                continue
            if not part.isascii():
                # Lower case is by character: no final form of sigma.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
            if len(part) <= 500_000:
                counts.update(self.words.findall(part))
            else:
                counts.update(m.group() for m in self.words.finditer(part))
        return counts, besides

    def pieces(self, words: list[str]) -> list[int]:
        """How many pieces each pre-token has; the last byte of a word has a symbol of its own."""
        first, last = self.byte_id, self.last_id
        ids = [[*map(first.__getitem__, raw[:-1]), last[raw[-1]]] for w in words for raw in [w.encode()]]
        return [*map(len, self.merges.merge(ids))]

    def count(self, texts: list[str]) -> list[int]:
        found = [self.frequencies(t) for t in texts]
        wanted = set().union(*(f.keys() for f, _ in found))
        known = {w: n for w in wanted if (n := self.memo.get(w)) is not None}
        new = list(wanted - known.keys())
        learned = dict(zip(new, self.pieces(new), strict=True))
        if len(self.memo) + len(learned) > MEMO_WORDS:
            self.memo.clear()
        self.memo.update((w, n) for w, n in learned.items() if len(w) <= KEPT_LENGTH)
        known |= learned
        return [besides + sum(n * known[w] for w, n in f.items()) for f, besides in found]


def _count(counter: PieceCounter, texts: list[str | None]) -> list[tuple]:
    return [(n,) for n in counter.count([t or "" for t in texts])]


def token_counts(df: DataFrame, path: str | None = None, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows stay, an empty table stays empty, columns of the new
    names are replaced. Frequencies are taken per text and joined to the worker's dictionary of pieces; a table of all
    distinct pre-tokens grows with the data and could be neither broadcast nor shuffled within the disk limit.
    """
    counted = text_columns(df, "n_tokens bigint", partial(PieceCounter, path or tokenizer_path(VOCABULARY)), _count, text, True)
    n_bytes = F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)).cast("bigint")
    return counted.withColumns({"n_bytes": n_bytes, "over_limit": F.col("n_tokens") > limit})
