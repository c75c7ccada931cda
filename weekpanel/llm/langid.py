"""Language identification by rank order: the out-of-place distance of a text's commonest n-grams to learned profiles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_hash, fold, is_held_out, text_columns

#: Length of a profile, of languages and of texts alike.
RANKS = 300
#: About so many documents of each language are learned from, chosen by the hash of their id; it bounds the fit.
FIT_ROWS = 400
#: Documents of more characters take no part in the fit (they are judged whole like any other).
FIT_CHARS = 50_000
UNKNOWN = "und"
#: Letters are numbered by their code points. With three of them a gram's number stays below 2^61.
BASE = 0x110001


@dataclass
class Profiles:
    langs: list[str]
    grams: list[np.ndarray]  # of each language: its n-gram numbers, ascending
    ranks: list[np.ndarray]  # their ranks


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(letters: np.ndarray) -> np.ndarray:
    """Numbers of all 1-, 2- and 3-grams of a text in letters; 0 stands between words, single zeros are no gram."""
    if not len(letters):
        return np.zeros(0, np.int64)
    padded = np.concatenate(([0], letters, [0])).astype(np.int64)
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] > 0) | (padded[:-1] > 0)  # white space of any length counts once
    x = padded[keep]
    two = x[:-1] * BASE + x[1:]
    three = two[:-1] * BASE + x[2:]
    # Grams don't reach over a word's end.
    return np.concatenate((x[x > 0], BASE + two, BASE + BASE * BASE + three[x[1:-1] > 0]))


def top(codes: np.ndarray, k: int = RANKS) -> np.ndarray:
    """The commonest codes in order; ties by the smaller code."""
    values, counts = np.unique(codes, return_counts=True)
    if len(values) > 4 * k:
        floor = np.partition(counts, len(counts) - k)[len(counts) - k]
        values, counts = values[counts >= floor], counts[counts >= floor]
    return values[np.lexsort((values, -counts))][:k]


class Judge:
    def __init__(self, profiles: Profiles):
        self.p = profiles
        self.alpha = letter_table()

    def judge(self, text: str | None) -> tuple[str, float]:
        """The language and a score: how much nearer it is than the next, against the largest distance possible."""
        if not text or not self.p.langs:
            return UNKNOWN, 0.0
        cp = points(text)
        letters = np.where(self.alpha[cp], cp, 0)
        # Lower case may make a letter of none, never the other way round; the contract asks for the text itself.
        if not letters.any() or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        own = top(grams(letters))
        far = np.array([self.distance(k, own) for k in range(len(self.p.langs))])
        order = np.argsort(far, kind="stable")
        near = far[order[0]]
        if len(order) == 1:
            return self.p.langs[0], 1.0
        second = max(1, far[order[1]])
        return self.p.langs[order[0]], float(min(1.0, 0.5 + 0.5 * (second - near) / second))

    def distance(self, k: int, own: np.ndarray) -> int:
        """Out-of-place distance of a language's profile: a gram that it lacks counts as of the rank after its last."""
        known, ranks = self.p.grams[k], self.p.ranks[k]
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        theirs = np.where(known[at] == own, ranks[at], RANKS) if len(known) else np.full(len(own), RANKS)
        return int(np.abs(theirs - np.arange(len(own))).sum())


def build(counts: dict[str, dict[str, int]]) -> Profiles:
    """Profiles from the frequencies of words (letters only, lower case) of each language."""
    langs = sorted(counts)
    out = Profiles(langs, [], [])
    for lang in langs:
        total: dict[int, int] = {}
        for w, n in counts[lang].items():
            for g in grams(points(w)).tolist():
                total[g] = total.get(g, 0) + n
        best = np.array(sorted(total, key=lambda g: (-total[g], g))[:RANKS], np.int64)
        order = np.argsort(best)
        out.grams.append(best[order])
        out.ranks.append(order.astype(np.int64))
    return out


def sample_counts(docs: DataFrame, key: str, text: str, lang: str, rows: int) -> dict[str, dict[str, int]]:
    """Word frequencies of a bounded sample outside fold 0, counted on the executors."""
    known = docs.select(F.col(key).alias("k"), F.col(lang).cast("string").alias("l"), F.col(text).cast("string").alias("t"))
    known = known.where(F.col("l").isNotNull() & (fold("k") != 0) & (F.length("t") <= FIT_CHARS))
    sizes = known.groupBy("l").agg(F.count("*").alias("n"))
    chosen = by_hash(known.join(F.broadcast(sizes), "l"), "k", rows / F.col("n"), 2).select("l", "t")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alpha = letter_table()
        for batch in batches:
            langs, out = [], []
            for l, t in zip(batch["l"], batch["t"], strict=True):
                low = t.as_py().lower()
                marked = "".join(c if alpha[ord(c)] else " " for c in low)
                for w in marked.split():
                    langs.append(l.as_py())
                    out.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.string())], names=["l", "w"])

    counted = chosen.mapInArrow(words, "l string, w string").groupBy("l", "w").agg(F.count("*").alias("n"))
    result: dict[str, dict[str, int]] = {}
    for r in counted.toLocalIterator():
        result.setdefault(r["l"], {})[r["w"]] = r["n"]
    return result


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = FIT_ROWS) -> Profiles:
    return build(sample_counts(docs, key, text, lang, rows))


def identify(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``held_out``, ``lang_pred`` and ``score`` to every document; columns of these names are replaced.

    ``und`` with score 0 stands for null and empty texts, texts without a letter, and for all where nothing was learned.
    Ties in distance go to the language first in the alphabet. Letters of any script count; a profile is 300 numbers for
    each language. Repeated rows are judged each, very long texts whole, in memory of some 50 bytes a character.
    """
    sent = docs.sparkSession.sparkContext.broadcast(profiles)
    judged = text_columns(docs, "lang_pred string, score double", lambda: Judge(sent.value), lambda j, t: j.judge(t), text)
    return judged.withColumn("held_out", is_held_out(key))
