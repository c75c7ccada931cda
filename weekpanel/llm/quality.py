"""Quality by compression: zstandard dictionaries of good and bad labelled text, and the calibrated difference of sizes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_hash, fold, is_held_out, py_fold, rows_where, text_columns

#: The fit takes about this many labelled documents of each label at most, chosen by the hash of their id.
FIT_ROWS = 1500
#: Labelled documents of more characters take no part in the fit (they are scored whole like any other).
FIT_CHARS = 30_000
DICTIONARY_BYTES = 512 << 10
LEVEL = 9
THRESHOLD = 0.3


@dataclass
class Model:
    """Two dictionaries, and the logistic curve from size differences to a probability of label 1."""

    good: bytes
    bad: bytes
    weights: np.ndarray
    prior: float


class Sizes:
    """Compressed sizes of a text: with the good dictionary, with the bad one, with none."""

    def __init__(self, model: Model):
        self.model = model
        self.by = [zstandard.ZstdCompressor(level=LEVEL, dict_data=as_dictionary(d), write_checksum=False, write_content_size=False, write_dict_id=False) for d in (model.good, model.bad)]
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)

    def features(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode()
        good, bad = (len(c.compress(raw)) for c in self.by)
        plain = len(self.plain.compress(raw))
        n = max(1, len(raw))
        return np.array([(bad - good) / plain, (bad - good) / n, np.log(plain / n), np.log1p(len(raw)) / 10, 1.0])

    def score(self, text: str | None) -> float:
        if not text:
            return self.model.prior
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.model.weights, -30, 30))))


def as_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def dictionary(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """Raw dictionary content: an equal share of each text, cut from its middle, up to ``size`` bytes in all."""
    raws = [t.encode() for t in texts if t]
    share = max(64, size // max(1, len(raws)))
    parts = [r[max(0, (len(r) - share) // 2) :][:share] for r in raws]
    return b"\n".join(parts)[:size]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + ridge * w)
    return w


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> list[tuple]:
    """(id, label, text) of a bounded sample of the labelled rows outside fold 0, about as many of each label.

    Ids with two labels count with the larger one. Null ids, labels and texts take no part.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).alias("y")).where("k is not null and y is not null")
    known = known.where(fold("k") != 0).groupBy("k").agg((F.max("y") > 0).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return []
    share = F.when(F.col("y") == 1, rows / counts[1]).otherwise(rows / counts[0])
    ids = by_hash(known, "k", share, 1)
    texts = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where(F.length("t") <= FIT_CHARS)
    # At most about 2 x rows ids, whatever the table's size.
    got = texts.join(F.broadcast(ids), "k").dropDuplicates(["k"]).select("k", "y", "t").collect()
    return sorted((r["k"], r["y"], r["t"]) for r in got)


def fit(rows: list[tuple], true_share: float | None = None) -> Model:
    """Dictionaries from two thirds of the sample, the curve from the remaining third.

    The sample holds both labels alike; the offset is put back to ``true_share``, the labels' own share of ones.
    Without both labels the score is that share, or a half.
    """
    part = {y: [r for r in rows if r[1] == y] for y in (0, 1)}
    prior = 0.5 if true_share is None else true_share
    if not part[0] or not part[1]:
        return Model(b" ", b" ", np.zeros(5), prior)
    for_words = lambda r: py_fold(("dictionary", r[0])) % 3 != 0 or min(map(len, part.values())) < 6
    model = Model(*(dictionary([r[2] for r in part[y] if for_words(r)]) for y in (1, 0)), np.zeros(5), prior)
    rest = [r for r in rows if py_fold(("dictionary", r[0])) % 3 == 0]
    if len({r[1] for r in rest}) < 2:
        rest = rows
    sizes = Sizes(model)
    x, y = np.array([sizes.features(r[2]) for r in rest]), np.array([r[1] for r in rest], float)
    model.weights = logistic(x, y)
    if true_share is not None and 0 < true_share < 1:
        seen = y.mean()
        model.weights[-1] += np.log(true_share / (1 - true_share)) - np.log(seen / (1 - seen))
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> Model:
    share = labels.where((fold(key) != 0) & F.col(label).isNotNull()).agg(F.avg((F.col(label) > 0).cast("int"))).first()[0]
    return fit(sample(docs, labels, key, text, label, rows), share)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``held_out``, ``score`` and ``predicted`` to every document; columns of these names are replaced.

    Null and empty texts get the share of label 1. Every text is compressed whole. Two dictionaries of at most
    ``DICTIONARY_BYTES`` each go to the tasks.
    """
    scored = text_columns(docs, "score double", lambda: Sizes(model), lambda s, t: (s.score(t),), text)
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.withColumns({"held_out": is_held_out(key), "predicted": predicted})


def accept(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents predicted to be good, with the columns they had."""
    return rows_where(docs, [key, text], lambda d: score(d, model, key, text), "predicted = 1")
