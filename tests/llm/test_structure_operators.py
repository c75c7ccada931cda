"""Packing, source audit and conversation repair against brute force, libraries and SQL."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weekpanel.llm import divergence, packing, queries, repair
from weekpanel.llm.common import tokenizer_path


# --- packing


def _library_pieces(texts: list[str | None]) -> list[list[tuple]]:
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(packing.VOCABULARY))
    out = []
    for t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        cuts = [ids[at : at + 4096] for at in range(0, len(ids), 4096)]
        out.append([(k, 4096 * k, len(c), zlib.crc32(c.tobytes())) for k, c in enumerate(cuts)])
    return out


def _assert_packed(rows: list, capacity: int) -> int:
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_equal_the_library_and_sequences_are_full(spark, docs):
    rows = packing.pack_documents(docs).collect()
    found: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        found.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    given = docs.select("doc_id", "text").collect()
    assert found == {r["doc_id"]: p for r, p in zip(given, _library_pieces([r["text"] for r in given]), strict=True)}
    tokens = sum(r["length"] for r in rows)
    assert _assert_packed(rows, 4096) <= -(-tokens // 4096) + 2


def test_ids_of_odd_strings_equal_the_library():
    rng = random.Random(5)
    parts = [
        "It's", "WE'LL", "don't", "naïve", "ΟΔΟΣ", "İ", "\x1c", "\x1f", "\x85", "　", "᠎", "é", "ﬁ", "12345", "!?.", "<|endoftext|>",
        "<|startoftext|>x", "͸", "日本語", "👩‍👧", "a\tb\r\nc", "''s", " ", "\n",
    ]
    texts = [rng.choice(["", " "]).join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    ids = packing.WordIds(tokenizer_path(packing.VOCABULARY))
    packed = [ids.encode(t) for t in texts]
    want = ids.library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [w.ids for w in want]


def test_items_go_where_squares_become_smallest():
    rng, capacity = random.Random(2), 30
    packer, rooms = packing.SquaresPacker(capacity), []
    for _ in range(300):
        size = rng.randint(1, capacity)
        bin_id, offset = packer.place(size)

        def squares(at: int) -> int:
            after = [r - size * (k == at) for k, r in enumerate([*rooms, capacity] if at == len(rooms) else rooms)]
            return sum(after.count(r) ** 2 for r in range(1, capacity))

        costs = {at: squares(at) for at in [*(k for k, r in enumerate(rooms) if r >= size), len(rooms)]}
        assert costs[bin_id] == min(costs.values())
        assert offset == (capacity - rooms[bin_id] if bin_id < len(rooms) else 0)
        if bin_id == len(rooms):
            rooms.append(capacity)
        rooms[bin_id] -= size
    assert rooms == packer.rooms


def test_packing_in_many_shards_stays_close_to_one(spark):
    rng = random.Random(9)
    rows = [(k % 40, rng.randint(1, 100)) for k in range(3000)]
    df = spark.createDataFrame(rows, "key int, length bigint").repartition(5)
    one = packing.pack(df, 100).collect()
    many = packing.pack(df, 100, 300).collect()
    assert sorted((r["key"], r["length"]) for r in many) == sorted(rows)
    assert len(one) == 3000
    least = -(-sum(n for _, n in rows) // 100)
    assert _assert_packed(one, 100) <= 1.03 * least
    assert _assert_packed(many, 100) <= 1.05 * least


def test_packing_of_odd_and_empty_tables(odd, empty):
    rows = packing.pack_documents(odd).collect()
    _assert_packed(rows, 4096)
    by_id: dict = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [(r["length"], r["start"]) for r in by_id[1]] == [(1, 0)]
    assert by_id[2][0]["ids_crc32"] == zlib.crc32(b"\x01\0\0\0")
    whole = [r for r in by_id[5] if r["piece"] == 0]
    assert len(whole) == 2 and all(r["length"] == 4096 for r in whole)
    assert len(by_id[None]) == 1
    assert packing.pack_documents(empty).count() == 0
    assert packing.pieces(odd).where("score = 'mine'").count() == len(rows)


# --- source audit


def _by_hand(rows: list[tuple], least: int) -> list[tuple]:
    """(lang, source, part, item, value, rank) of (lang, source, text) rows, term by term."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        n_docs: dict[str, int] = {}
        counts: dict[str, dict[str, int]] = {s: {} for la, s, _ in rows if la == lang}
        for la, s, text in rows:
            if la != lang:
                continue
            words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
            for w in words:
                counts[s][w] = counts[s].get(w, 0) + 1
            for w in set(words):
                n_docs[w] = n_docs.get(w, 0) + 1
        kept = [w for w, n in n_docs.items() if n >= least]
        v = len(kept)
        total = {s: sum(c.get(w, 0) for w in kept) for s, c in counts.items()}

        def p(n: int, total_n: int) -> int:
            return 1 + 10**9 * (n + 2) // (total_n + 2 * v)  # noqa: B023

        def f(a: int, b: int) -> int:
            return (a - b) ** 2 // (a + b)

        every = {w: sum(c.get(w, 0) for c in counts.values()) for w in kept}
        for s, c in counts.items():
            pairs = [
                (-sum(f(p(c.get(w, 0), total[s]), p(d.get(w, 0), total[t])) for w in kept), t.encode(), t) for t, d in counts.items() if t != s
            ]
            own = [(w, p(c[w], total[s]), p(every[w], sum(total.values()))) for w in kept if c.get(w)]
            words = [(-f(a, b), w.encode(), w) for w, a, b in own if a > b]
            for part, found, limit in (("pair", pairs, None), ("term", words, 10)):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(sorted(found)[:limit])]
    return sorted(out)


def _random_texts(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gAmma", "é", "日本", "x1y", "zz-top", "ÀB", "k", "m"]
    rows = [
        (rng.choice(["en", "", None, "fr"]), rng.choice(["a", "b", "B", "é", None, "c"]), " ".join(rng.choices(words, k=rng.randint(0, 9))))
        for _ in range(150)
    ]
    return [*rows, ("de", "only", "word"), ("de", "other", None), ("it", "lone", "a a a"), ("en", "a", None), ("en", "silent", "")]


@pytest.mark.parametrize("block_groups", [1000, 3])
def test_audit_equals_term_by_term_sums(spark, block_groups):
    rows = _random_texts(4)
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({"term": F.lit("mine"), "n": F.lit("mine")})
    got = divergence.audit(df.repartition(6), least=3, block_groups=block_groups).collect()
    assert sorted(map(tuple, got)) == _by_hand(rows, 3)


def test_audit_equals_its_sql_on_the_given_table(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    got = queries.op12_source_audit(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(queries.OP12_SQL).fetchall())


def test_audit_of_odd_and_empty_tables(odd, empty):
    rows = [tuple(r) for r in odd.select("lang", "source", "text").collect()]
    assert sorted(map(tuple, divergence.audit(odd, least=1).collect())) == _by_hand(rows, 1)
    assert divergence.audit(empty).count() == 0


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_tree_counts_shared_paths_once(batches):
    tree = divergence.PatternTree([("a", 100, 0), ("b", 90, 0), ("c", 80, 0)])
    rows = [([(0, 1), (1, 2)], 5), ([(0, 1), (1, 2), (2, 1)], 2), ([(0, 1), (2, 3)], 1), ([(1, 4)], 7)]
    for k in range(0, 4, 4 // batches):
        some = rows[k : k + 4 // batches]
        flat = np.array([e for r, _ in some for e in r])
        tree.insert(flat[:, 0], flat[:, 1], np.array([len(r) for r, _ in some]), np.array([m for _, m in some]))
    assert tree.single == {(0, 1): 8, (1, 2): 7, (2, 1): 2, (2, 3): 1, (1, 4): 7}

    def f(c, s, d, t):
        p, q = tree.share(np.array([c, d]), np.array([s, t])).tolist()
        return tree.f(p, q)

    found = dict(zip(*(lambda a, b, v: (zip(a, b, strict=True), v))(*tree.corrections()), strict=True))
    for s, t in ((0, 1), (0, 2), (1, 2)):
        want = sum(m * (f(dict(row).get(s, 0), s, dict(row).get(t, 0), t) - f(0, s, 0, t)) for row, m in rows)
        assert found["abc"[s], "abc"[t]] == want


# --- conversation repair

_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def _damaged(rows: list[tuple]) -> dict:
    out: dict = {}
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            kept += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)

    def order(r: tuple) -> tuple:
        return r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()

    return {c: sorted(v, key=order) for c, v in out.items()}


def _cheapest(rows: list[tuple]) -> tuple:
    """Faults and the least repair by uniform-cost search over (rows used, state)."""
    faults, seen = [], set()
    for _, role, text in rows:
        inner = text.strip(" \t\n\v\f\r")
        faults.append("b" if not inner else "d" if (role, text) in seen else "t" if inner[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, q, kept = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in (0, 3):
            break
        steps = [("I", 2, i, n, ("user" if c == "u" else "assistant", "")) for c in "ua" if (n := _NEXT.get((q, c)))]
        if i < len(rows):
            (_, role, text), fault = rows[i], faults[i]
            steps.append(("D", 3, i + 1, q, None))
            if fault not in ("b", "d"):
                if n := _NEXT.get((q, role[:1])):
                    steps.append(("K", fault == "t", i + 1, n, (role, text)))
                steps += [
                    ("R", 2 + (fault == "t"), i + 1, n, ("user" if c == "u" else "assistant", text)) for c in "ua" if (n := _NEXT.get((q, c)))
                ]
        for edit, more, j, n, row in steps:
            heapq.heappush(heap, (cost + more, audit + edit, j, n, kept if row is None else (*kept, row)))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest


def _random_conversations(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", None, "", "User"], [None, "a.", "b", "c! ", "é?", "", "x ", " d.\n", "a."]
    return [
        (c if c else None, rng.choice([None, 0, 1, 2, 3, 5, 9, 12, -4]), rng.choice(roles), rng.choice(texts))
        for c in range(200)
        for _ in range(rng.randint(1, 14))
    ]


def test_repair_equals_a_search_over_all_edits(spark):
    rows = _random_conversations(3)
    clash = {c: F.lit("mine") for c in ("n", "digest", "_k", "_copy", "place", "gaps", "first", "blank")}
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns(clash).repartition(7)
    got = {r[0]: tuple(r)[1:] for r in repair.repair(repair.damage(df)).collect()}
    assert got == {c: _cheapest(v) for c, v in _damaged(rows).items()}


def test_repair_of_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, "/root/testdata/sf0.001").collect()}
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got == {c: _cheapest(v) for c, v in _damaged(rows).items()}


def test_a_long_conversation_lies_in_several_tasks(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"text {rng.randint(0, 300)}" + rng.choice([".", ""])) for t in range(2000)]
    df = spark.createDataFrame([*rows, (2, 1, "user", "hi.")], "conv_id bigint, turn bigint, role string, text string")
    damaged = repair.damage(df)
    sorted_rows = repair.distinct_rows(damaged).repartitionByRange(6, *repair._ORDER).sortWithinPartitions(*repair._ORDER)
    assert sorted_rows.mapInArrow(repair._segments, repair._SEGMENT).where("conv_id = 1").count() > 3
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r[0]: tuple(r)[1:] for r in repair.repair(damaged).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got[1] == _cheapest(_damaged(rows)[1])


def test_halving_gives_what_the_whole_chart_gives():
    """All spans and all splits, as in the textbook's table."""
    rng = random.Random(1)
    for _ in range(60):
        kinds = "".join(rng.choices("suaxSUAXd", k=rng.randint(1, 12)))
        chart = {(i, i + 1): repair.leaf(k) for i, k in enumerate(kinds)}
        for length in range(2, len(kinds) + 1):
            for i in range(len(kinds) - length + 1):
                cells = [repair.join(chart[i, m], chart[m, i + length]) for m in range(i + 1, i + length)]
                assert len(set(cells)) == 1
                chart[i, i + length] = cells[0]
        assert repair.span(kinds) == chart[0, len(kinds)]


def test_repair_of_an_empty_table_and_of_lost_conversations(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert repair.repair(repair.damage(df)).count() == 0
    lost = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    row = repair.repair(repair.damage(spark.createDataFrame([(7, lost, "user", "x.")], df.schema))).first()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
