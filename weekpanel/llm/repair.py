"""Conversation structure repair: weighted CYK over spans of rows, with a repair grammar in Chomsky normal form.

The grammar of a whole conversation's role initials is ``(s?(ua)+)?``. A nonterminal ``[p, q]`` stands for all edited
spans that lead from ``p`` to ``q``, where these are what stands before a place: nothing, a system row, a user row, or an
assistant row. The binary rules are ``[p, q] -> [p, r] [r, q]``, the terminal ones are the edits of one row, and rows
inserted before it are closed over in its cell. Since ``r`` names all that two neighbouring spans must agree on, every
split of a span gives the same minimum; so the chart needs the spans of repeated halving only, and a conversation may lie
in several tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTED = (NOTHING, ASSISTANT)
#: What may follow each state, by role initial.
NEXT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Spans of up to so many rows are looked up by their rows' kinds.
KNOWN_SPAN, KNOWN_SPANS = 16, 100_000
_PATTERN_SPACE = r"[\x20\x09-\x0D]"

Cell = tuple  # of (cost, audit) or None, by 4 * p + q


def better(a: tuple | None, b: tuple | None) -> tuple | None:
    return b if a is None or b is not None and b < a else a


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: for each [p, q] the least (cost, audit) over [p, r] [r, q].

    Of one span an audit determines its cost, so that no audit is the beginning of another one of equal cost, and least
    parts make the least whole.
    """
    out = []
    for p in STATES:
        for q in STATES:
            best = None
            for r in STATES:
                a, b = left[4 * p + r], right[4 * r + q]
                if a is not None and b is not None:
                    best = better(best, (a[0] + b[0], a[1] + b[1]))
            out.append(best)
    return tuple(out)


def _step(edits: list[tuple[int, int, int, str]]) -> Cell:
    out: list[tuple | None] = [None] * 16
    for p, q, cost, initial in edits:
        out[4 * p + q] = better(out[4 * p + q], (cost, initial))
    return tuple(out)


EMPTY = _step([(p, p, 0, "") for p in STATES])


def _closure() -> Cell:
    """Cells of the empty span: any number of inserted user and assistant rows."""
    one = _step([(p, q, INSERT, "I") for (p, c), q in NEXT.items() if c in ROLES])
    closed = EMPTY
    for _ in STATES:  # no way over four states needs more steps
        closed = tuple(map(better, EMPTY, join(closed, one)))
    return closed


INSERTED = _closure()


@lru_cache(256)
def leaf(kind: str) -> Cell:
    """One row with what is inserted before it. ``kind`` is its role initial (x: another one), as capital if its text is
    truncated, or d if it must be deleted."""
    edits = [(p, p, DELETE, "D") for p in STATES]
    more = TRUNCATED if kind.isupper() else 0
    if kind != "d":
        edits += [(p, q, more, "K") for (p, c), q in NEXT.items() if c == kind.lower()]
        edits += [(p, q, REROLE + more, "R") for (p, c), q in NEXT.items() if c in ROLES]
    return join(INSERTED, _step(edits))


@lru_cache(KNOWN_SPANS)
def _known(kinds: str) -> Cell:
    if len(kinds) == 1:
        return leaf(kinds)
    half = len(kinds) // 2
    return join(_known(kinds[:half]), _known(kinds[half:]))


def joined(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans, bottom-up: spans of twice the length in each pass."""
    while len(cells) > 1:
        pairs = [join(a, b) for a, b in zip(cells[::2], cells[1::2], strict=False)]
        cells = pairs + cells[len(cells) - len(cells) % 2 :]
    return cells[0] if cells else EMPTY


def span(kinds: str) -> Cell:
    """The cell of the span of rows of these kinds."""
    return joined([_known(kinds[at : at + KNOWN_SPAN]) for at in range(0, len(kinds), KNOWN_SPAN)])


def repaired(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation; rows may be inserted at its end too."""
    whole, best = join(cell, INSERTED), None
    for q in ACCEPTED:
        best = better(best, whole[4 * NOTHING + q])
    return best


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after damage. A conversation that loses a row also gets a row without
    ``role``, so that it is still known when it has lost all."""
    key = F.concat(_text("conv_id"), F.lit(":"), _text("turn"))
    named = rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), (F.crc32(key) % 20).alias("_k"))
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_k") == 4, "user").when(F.col("_k") > 0, F.col("role"))
    copies = F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    lost = F.col("_k") == 0
    return named.select(
        "conv_id", F.when(~lost, F.col("turn")).alias("turn"), role.alias("role"), F.when(~lost, text).alias("text"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Equal rows once, with their number ``n``, a digest of the text, its own kind, and whether it is the first of its
    conversation with this role and text. The texts stay behind."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?]" + _PATTERN_SPACE + r"*\z")
    facts = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), blank.alias("blank"), (~blank & ~ended).alias("truncated")
    )
    counted = facts.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")
    )
    table = cut_lineage(counted)
    # Least turn, nulls first. The join is on the whole key, so that no conversation or text is a hot one.
    first = table.groupBy("conv_id", "role", "digest").agg(
        F.when(F.count("turn") == F.count("*"), F.min("turn")).alias("turn"), F.lit(True).alias("first")
    )
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("conv_id", "turn", "role", "digest")]
    return table.alias("t").join(first.alias("f"), same, "left").select("t.*", F.coalesce("f.first", F.lit(False)).alias("first"))


_ORDER = ("conv_id", "turn", "role", "digest")
_SEGMENT = (
    "conv_id bigint, place bigint, n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
    "low bigint, high bigint, head string, tail string, costs array<bigint>, audits array<string>"
)
_LEGAL = {"su", "ua", "au"}


class Segment:
    """Neighbouring rows of one conversation within one task."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.kinds: list[str] = []
        self.cells: list[Cell] = []
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.head = self.tail = None

    def add(self, turn, role: str | None, n: int, blank: bool, truncated: bool, first: bool) -> None:
        if role is None:  # only says that the conversation is there
            return
        initial = role[:1]
        self.illegal += (self.n > 0 and self.tail + initial not in _LEGAL) + (n - 1) * (initial * 2 not in _LEGAL)
        self.head = initial if self.head is None else self.head
        self.tail = initial
        self.n += n
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if blank:
            self.blank += n
        else:
            self.duplicate += n - first
            self.truncated += first and truncated
        live = first and not blank
        if live:
            kind = initial if initial in ("s", "u", "a") else "x"
            self.kinds.append(kind.upper() if truncated else kind)
        self.kinds.extend("d" * (n - live))
        if len(self.kinds) > 4096:
            self.cells.append(span("".join(self.kinds)))
            self.kinds = []

    def row(self, place: int) -> tuple:
        cell = joined([*self.cells, span("".join(self.kinds))] if self.kinds else self.cells)
        numbers = (self.n, self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high, self.head, self.tail)
        return (self.conv_id, place, *numbers, [c and c[0] for c in cell], [c and c[1] for c in cell])


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
_SEGMENT_SCHEMA = pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in _SEGMENT.split(", ")])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows; a conversation that reaches over several tasks has one in each, in the order of tasks."""
    place, current, out = TaskContext.get().partitionId(), None, []
    columns = ("conv_id", "turn", "role", "n", "blank", "truncated", "first")

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SEGMENT_SCHEMA, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=_SEGMENT_SCHEMA)

    for batch in batches:
        for conv_id, *row in zip(*(batch[c].to_pylist() for c in columns), strict=True):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    out.append(current.row(place))
                current = Segment(conv_id)
            current.add(*row)
        if len(out) > 1000:
            yield batch_of(out)
            out = []
    if current is not None:
        out.append(current.row(place))
    if out:
        yield batch_of(out)


def _whole(parts: list[dict]) -> tuple:
    """Numbers, cost and audit of a conversation from its segments in order."""
    blank = duplicate = truncated = illegal = turns = 0
    low = high = tail = None
    cells = []
    for s in parts:
        if not s["n"]:
            continue
        illegal += s["illegal"] + (tail is not None and tail + s["head"] not in _LEGAL)
        tail = s["tail"]
        blank, duplicate, truncated = blank + s["blank"], duplicate + s["duplicate"], truncated + s["truncated"]
        if s["low"] is not None:
            turns += s["turns"] - (s["low"] == high)
            low, high = s["low"] if low is None else low, s["high"]
        cells.append(tuple(None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"], strict=True)))
    cost, audit = repaired(joined(cells))
    gaps = 0 if low is None else high - low + 1 - turns
    return gaps, blank, duplicate, truncated, illegal, cost, audit


_NUMBERS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _combine(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    names = [f.split()[0] for f in _NUMBERS.split(", ")]
    types = [pa.string() if n == "audit" else pa.int64() for n in names]
    for batch in batches:
        rows = [_whole(parts) for parts in batch.to_pylist()]
        columns = [*zip(*rows, strict=True)] or [[] for _ in names]
        yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def audits(rows: DataFrame) -> DataFrame:
    """Numbers, cost and audit of each conversation of damaged ``rows`` (see ``repair``); no text is moved."""
    order = [F.asc_nulls_first(c) for c in _ORDER]
    sorted_rows = distinct_rows(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    segments = sorted_rows.mapInArrow(_segments, _SEGMENT)
    parts = F.sort_array(F.collect_list(F.struct("place", *[c for c in segments.columns if c not in ("conv_id", "place")])))
    whole = F.arrow_udf(_combine, _NUMBERS)(F.col("parts"))
    return segments.groupBy("conv_id").agg(parts.alias("parts")).select("conv_id", whole.alias("w")).select("conv_id", "w.*")


def edited(audit: str, row_of) -> Iterator[tuple[str, str]]:
    """(role, text) of every row that the audit leaves; ``row_of`` gives the next row of the conversation."""
    left = len(audit) - audit.count("D")
    at = 0
    for edit in audit:
        row = None if edit == "I" else row_of()
        if edit == "D":
            continue
        # Pairs from the end: an odd number of rows begins with the system's.
        role = row[0] if edit == "K" else ROLES["au"[(left - at) % 2 == 0]]
        yield role, "" if row is None else row[1]
        at += 1


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation's repaired rows. Its audit comes first, then its rows in order, each used at once."""
    names = [f.split()[0] for f in _NUMBERS.split(", ")]
    schema = pa.schema([("conv_id", pa.int64()), *[(n, pa.string() if n == "audit" else pa.int64()) for n in names], ("repaired_sha256", pa.string())])
    stream = (r for batch in batches for r in batch.to_pylist())
    row = next(stream, None)
    out = []
    while row is not None:
        head = row
        copies, waiting = [0], [next(stream, None)]

        def row_of():
            current = waiting[0]
            copies[0] += 1
            if copies[0] == current["n"]:
                copies[0], waiting[0] = 0, next(stream, None)
            return current["role"], current["text"]

        digest, between = hashlib.sha256(), b""
        for role, text in edited(head["audit"], row_of):
            digest.update(between + f"{role}:{text}".encode())
            between = b"\n"
        out.append((head["conv_id"], *[head[n] for n in names], digest.hexdigest()))
        row = waiting[0]
        if len(out) == 1000 or row is None:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []


def repair(rows: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of damaged ``rows`` (as ``damage`` gives them): gaps, faults, and the cheapest repair.

    ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal`` count faults, ``cost`` and ``audit`` are the least
    edits (K keep, R rerole, D delete, I insert), ``repaired_sha256`` is the digest of the repaired ``role:text`` lines.

    Null role and text are one space; null turns come first and leave gaps alone; a null conv_id is a conversation of its
    own. Rows of equal turn are ordered by role and the digest of the text, so that equal ones are neighbours. Equal rows
    are counted before they move. Conversations without rows have zeros, an empty audit and the empty text's digest. Other
    columns are left out; an empty table gives no rows. A long conversation lies in several tasks, each of which reduces
    its rows to one cell; only its digest, which is a chain, needs one task that its texts pass through one by one.
    """
    found = audits(rows)
    head = found.select("conv_id", F.lit(0).alias("_part"), *[f.split()[0] for f in _NUMBERS.split(", ")])
    texts = (
        rows.where(F.col("role").isNotNull())
        .withColumn("digest", F.unhex(F.sha2("text", 256)))
        .groupBy("conv_id", "turn", "role", "digest")
        .agg(F.first("text").alias("text"), F.count("*").alias("n"))
        .withColumn("_part", F.lit(1))
    )
    both = head.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    sorted_rows = both.sortWithinPartitions("conv_id", "_part", *[F.asc_nulls_first(c) for c in _ORDER[1:]])
    return sorted_rows.drop("_part", "digest").mapInArrow(_hashes, f"conv_id bigint, {_NUMBERS}, repaired_sha256 string")
