"""Secret scans: three base patterns, and a character convolutional network over every other candidate in its context."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_hash, text_columns

#: Kinds of spans in the order that breaks ties at one start; `net` are those that only the network finds.
KINDS = ("assign", "access", "hex", "net")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20
#: A candidate is a maximal run of key characters, this long, with a digit and a letter.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

#: Context characters before and after a candidate; shorter candidates are padded. Training windows have this many inside.
BEFORE, INSIDE, AFTER = 16, 40, 8
#: Positions of a long candidate that are convolved at a time.
LONG_POSITIONS = 4096
#: Fit sample: at most about so many documents that hold a base finding, and so many others, chosen by the hash of their id.
FIT_ROWS = 600
#: Documents of more characters than this take no part in the fit (they are scanned like any other).
FIT_CHARS = 50_000
#: The threshold keeps at least this share of the labelled findings set aside for it.
RECALL = 0.95


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of base findings in order, leftmost and non-overlapping per kind; code points."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    # A maximal run: asking for its length inside the pattern gives the spans that a filter afterwards would.
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    if not _DIGIT.search(text):
        return []
    return [m.span() for m in CANDIDATE.finditer(text) if _DIGIT.search(m.group()) and _LETTER.search(m.group())]


def window(text: str, start: int, end: int, inside: int | None = INSIDE) -> str:
    """Context before, the candidate, context after. With ``inside`` its head of so many characters, for training in
    windows of one length; else the whole of it."""
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0")
    after = text[end : end + AFTER].ljust(AFTER, "\0")
    stop = end if inside is None else min(end, start + inside)
    return before + text[start:stop].ljust(INSIDE, "\0") + after


def encode(windows: list[str]) -> np.ndarray:
    """Printable ASCII has a class each, white space one, the padding one, everything else one."""
    width = len(windows[0]) if windows else BEFORE + INSIDE + AFTER
    points = np.array([[ord(c) for c in w] for w in windows], np.int64).reshape(len(windows), width)
    out = np.full(points.shape, 97, np.int64)
    printable = (points > 32) & (points < 127)
    out[printable] = points[printable] - 32
    out[(points == 32) | ((points >= 9) & (points <= 13))] = 96
    out[points == 0] = 0
    return out


class CharNet:
    """Embedding, one convolution of width 5, maximum over positions, logistic output; in numpy."""

    CLASSES, DIM, WIDTH, FILTERS = 98, 12, 5, 24

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        shape = lambda *s: rng.normal(0, (2 / s[0]) ** 0.5, s)
        self.p = {
            "embed": rng.normal(0, 0.5, (self.CLASSES, self.DIM)),
            "conv": shape(self.WIDTH * self.DIM, self.FILTERS),
            "bias": np.zeros(self.FILTERS),
            "out": shape(self.FILTERS, 1),
            "shift": np.zeros(1),
        }
        self.slope, self.offset, self.threshold = 1.0, 0.0, 0.5

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        e = self.p["embed"][x]
        n = x.shape[1] - self.WIDTH + 1
        cols = np.concatenate([e[:, j : j + n] for j in range(self.WIDTH)], axis=2)
        z = cols @ self.p["conv"] + self.p["bias"]
        best = z.argmax(1)
        top = np.maximum(np.take_along_axis(z, best[:, None], 1)[:, 0], 0)
        return (top @ self.p["out"])[:, 0] + self.p["shift"][0], (cols, best, top)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        logit, (cols, best, top) = self.forward(x)
        d = ((1 / (1 + np.exp(-logit))) - y)[:, None] / len(y)
        g = {"out": top.T @ d, "shift": d.sum(0)}
        d_top = (d @ self.p["out"].T) * (top > 0)
        chosen = np.take_along_axis(cols, best[:, :, None], 1)
        g["conv"] = np.einsum("nfk,nf->kf", chosen, d_top)
        g["bias"] = d_top.sum(0)
        d_cols = np.einsum("nf,kf->nfk", d_top, self.p["conv"]).reshape(len(x), self.FILTERS, self.WIDTH, self.DIM)
        g["embed"] = np.zeros_like(self.p["embed"])
        for j in range(self.WIDTH):
            np.add.at(g["embed"], np.take_along_axis(x, best + j, 1), d_cols[:, :, j])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, rate: float = 0.01, batch: int = 128) -> None:
        rng = np.random.default_rng(5)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                step += 1
                some = order[at : at + batch]
                for k, g in self.gradients(x[some], y[some]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float = RECALL) -> None:
        """Platt scaling, then the highest threshold that keeps ``recall`` of the positives."""
        logit, _ = self.forward(x)
        a, b = 1.0, 0.0
        target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
            w = p * (1 - p) + 1e-6
            g = np.array([((p - target) * logit).sum() + 1e-3 * (a - 1), (p - target).sum()])
            h = np.array([[(w * logit * logit).sum() + 1e-3, (w * logit).sum()], [(w * logit).sum(), w.sum()]])
            a, b = np.array([a, b]) - 0.5 * np.linalg.solve(h + 1e-9 * np.eye(2), g)
        self.slope, self.offset = float(a), float(b)
        positive = np.sort(self.probability(x[y > 0]))
        self.threshold = float(positive[int((1 - recall) * len(positive))]) if len(positive) else 1.01

    def long_logit(self, x: np.ndarray) -> float:
        """The output for one window of any length: the maximum over positions is taken a part at a time."""
        best = np.zeros(self.FILTERS)  # the activation cuts off below
        for at in range(0, len(x) - self.WIDTH + 1, LONG_POSITIONS):
            e = self.p["embed"][x[at : at + LONG_POSITIONS + self.WIDTH - 1]]
            n = len(e) - self.WIDTH + 1
            cols = np.concatenate([e[j : j + n] for j in range(self.WIDTH)], axis=1)
            best = np.maximum(best, (cols @ self.p["conv"] + self.p["bias"]).max(0))
        return float(best @ self.p["out"][:, 0] + self.p["shift"][0])

    def calibrated(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.offset, -30, 30)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.forward(x)[0]) if len(x) else np.zeros(0)

    def judge(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        """Probabilities of the candidates of a text, whole ones whatever their length."""
        long = np.array([b - a > INSIDE for a, b in spans], bool)
        out = np.zeros(len(spans))
        out[~long] = self.probability(encode([window(text, a, b) for (a, b), far in zip(spans, long, strict=True) if not far]))
        out[long] = self.calibrated(
            np.array([self.long_logit(encode([window(text, a, b, None)])[0]) for (a, b), far in zip(spans, long, strict=True) if far])
        )
        return out


def labelled(text: str) -> list[tuple[str, int]]:
    """Windows with labels: findings of the base patterns against other candidates and ordinary long words.

    Candidates that a base pattern would take in another letter case are in doubt and left out.
    """
    base = base_spans(text)
    folded = base_spans(text.lower()) if len(text.lower()) == len(text) else base
    out = []
    for start, _, end in base:
        run = CANDIDATE.search(text, start, end) if end - start >= 16 else None
        if run:
            out.append((window(text, run.start(), end), 1))
    for start, end in candidates(text):
        if not any(a < end and start < b for a, _, b in folded):
            out.append((window(text, start, end), 0))
    for k, m in enumerate(re.finditer(r"\S{10,}", text)):
        if k % 16 == 0 and not any(a < m.end() and m.start() < b for a, _, b in folded):
            out.append((window(text, m.start(), m.end()), 0))
    return out


def _varied(windows: list[str], labels: list[int]) -> tuple[list[str], list[int]]:
    """Each window, and copies in capitals and without its context, so that neither alone decides."""
    w, y = list(windows), list(labels)
    for text, label in zip(windows, labels, strict=True):
        w += [text.upper()[: len(text)].ljust(len(text), "\0"), "\0" * BEFORE + text[BEFORE : BEFORE + INSIDE] + "\0" * AFTER]
        y += [label, label]
    return w, y


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = FIT_ROWS) -> CharNet | None:
    """Train on a bounded sample chosen by hash of the id; None where it has no finding or no other window.

    Documents are searched for base findings on the executors. Only windows of fixed length reach the driver.
    """
    whole = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    whole = whole.where(F.col("k").isNotNull() & (F.length("t") <= FIT_CHARS))
    hinted = whole.where(F.col("t").rlike("(?i)(passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}"))
    counts = whole.agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("t").rlike("(?i)(passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}"), 1)).alias("h"),
    ).first()
    if not counts["h"]:
        return None
    parts = by_hash(hinted, "k", F.lit(rows / counts["h"]), 3).union(by_hash(whole, "k", F.lit(rows / counts["n"]), 4))

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch["k"].to_pylist(), batch["t"].to_pylist(), strict=True)
            found = [(str(k), w, y) for k, t in rows for w, y in labelled(t)]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            types = (pa.string(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["k", "w", "y"]
            )

    got = parts.mapInArrow(windows_of, "k string, w string, y int").distinct().orderBy("k", "w", "y").collect()
    if len({r["y"] for r in got}) < 2:
        return None
    aside = [int(hashlib.md5(r["k"].encode()).hexdigest(), 16) % 4 == 0 for r in got]
    if not any(a and r["y"] for a, r in zip(aside, got, strict=True)) or not any(r["y"] and not a for a, r in zip(aside, got, strict=True)):
        aside = [i % 4 == 0 for i in range(len(got))]
    net = CharNet()
    for part, use in ((False, net.fit), (True, net.calibrate)):
        w, y = _varied([r["w"] for r, a in zip(got, aside, strict=True) if a == part], [r["y"] for r, a in zip(got, aside, strict=True) if a == part])
        use(encode(w), np.array(y, float))
    return net


def scan(net: CharNet | None, text: str | None) -> list[tuple[int, int, int]]:
    """Base findings, and the candidates beside them that the network takes for secrets."""
    if not text:
        return []
    base = base_spans(text)
    if net is None:
        return base
    rest = [(a, b) for a, b in candidates(text) if not any(s < b and a < e for s, _, e in base)]
    if not rest:
        return base
    p = net.judge(text, rest)
    return sorted(base + [(a, 3, b) for (a, b), q in zip(rest, p, strict=True) if q >= net.threshold])


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _found(net: CharNet | None, text: str | None) -> tuple:
    spans = scan(net, text)
    base = [s for s in spans if s[1] < 3]
    kinds = [k for _, k, _ in base]
    return kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)


def _redact(mark: str, net: CharNet | None, text: str | None) -> tuple:
    if text is None:
        return (None,)
    out, at = [], 0
    for start, _, end in scan(net, text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return ("".join([*out, text[at:]]),)


def find(docs: DataFrame, text: str = "text", key: str = "doc_id", net: CharNet | None = None) -> DataFrame:
    """Add ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``; columns of these names are replaced.

    Null and empty texts have none. A table without any labelled finding has base spans only. The network is fitted once
    on a bounded sample (``FIT_ROWS``); it weighs some 20 kB in each task. Repeated rows are scanned each. Texts are scanned
    whole and candidates judged whole, however long; an empty table stays empty.
    """
    net = net or fit(docs, key, text)
    fields = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return text_columns(docs, fields, lambda: net, _found, text)


def redact(docs: DataFrame, text: str = "text", key: str = "doc_id", mark: str = "[SECRET]", net: CharNet | None = None) -> DataFrame:
    """The same columns, with every found span of the text replaced by ``mark``; null texts stay null, repeated rows stay,
    an empty table stays empty."""
    net = net or fit(docs, key, text)
    return text_columns(docs, f"`{text}` string", lambda: net, partial(_redact, mark), text).select(*docs.columns)

