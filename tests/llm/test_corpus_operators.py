from __future__ import annotations

import hashlib
import re
from collections import Counter
from html import unescape

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from weekpanel.llm import html_extract, simhash, substring, topk
from weekpanel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# HTML extraction


def _article(html):
    body = html[html.index("<article>") + 9 : html.index("</article>")]
    blocks = (" ".join(unescape(re.sub("</?b>|<br>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", body))
    return "\n\n".join(b for b in blocks if b)


def test_op1_gives_every_article_whole(spark):
    sf = "/root/testdata/sf0.01"
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op1_html_extraction"](spark, sf).collect()
    assert len(rows) == len(html)
    for r in rows:
        assert r["text"] == _article(html[r["page_id"]]) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<header>S</header><nav><a>m</a><article><h1>A &amp; B</h1><p>x <b>y</b>\n z<p>q<br>r</article><footer>f", "A & B\n\nx y z\n\nq r"),
        ("<main><p>a</p><aside>s</aside><form>f<input></form><ul><li>1<li>2</ul><script>'<p>'</script></main>", "a\n\n1\n\n2"),
        ("<body><div id=menu>m</div><p>One</p>two<p>&eacute;&nbsp;x</p><div class='cookie-notice'>c</div>", "One\n\ntwo\n\né x"),
        ("<article><p>a<div class='comments'><p>b</div><p hidden>c<p role=alert>d<p style='display: none'>e</article>", "a"),
        ("<p>a < b <!-- x --> c<p>d <!--", "a < b c\n\nd"),
        ("<p title=\"a>b\">z</p><p title=it's>w</p><p class=\"", "z\n\nw"),
        ("plain &lt;b&gt; &#65; text", "plain <b> A text"),
        ("", ""), (None, ""), ("<nav>only", ""), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ],
)
def test_blocks(html, text):
    assert html_extract.main_text(html, None, frozenset()) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class='content with-sidebar'><p>One<p>Two</div><div class=sidebar>s</div>", "One\n\nTwo"),
        ("<div id=search-results><article><p>Story</article></div><p>a long line of text that is outside", "Story\n\na long line of text that is outside"),
        ("<div class=no-sidebar><p>ab</div><p>a much longer line than that", "ab\n\na much longer line than that"),
        ("<div class=story><p>A whole story in plain divs</div><article>t1</article><article>t2</article>", "A whole story in plain divs\n\nt1\n\nt2"),
        ("<div class=story><p>A whole story in plain divs</div><article>teaser</article>", "A whole story in plain divs\n\nteaser"),
        ("<p>in <span class=search-hit>one</span> line</p>", "in one line"),
        ("<div class=share><p>one</div><div class=legal><p>two</div>", "one\n\ntwo"),
    ],
)
def test_class_words_and_teasers_take_no_article(html, text):
    assert html_extract.main_text(html, None, frozenset()) == text


def test_the_wrapper_decides_before_class_words(spark):
    def page(i):
        return f"<div class=legal><p>Case {i}</div><p>A text of page {i}, longer than the rest</p><div><p>All rights</div>"

    pages = spark.createDataFrame([(f"http://h.example/{i}", page(i)) for i in range(6)], "url string, html string")
    got = {r["text"] for r in html_extract.extract(pages).collect()}
    assert got == {f"Case {i}\n\nA text of page {i}, longer than the rest" for i in range(6)}


def test_constant_nodes_are_template_and_slots_content(spark):
    def page(i, extra=""):
        return f"<body><div><p>Welcome to the site</p></div><div><p>Story {i}</p><p>More {i}{extra}</p></div><div><p>Call us</p></div>"

    rows = [(i, "http://h.example/a", page(i)) for i in range(6)] + [(9, "http://h.example/a", page(3))] * 3
    rows += [(20, "http://lone.example/", page(1)), (21, None, page(2)), (22, "http://h.example/", None), (23, "x", "")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").withColumn("text", F.lit("mine"))
    got = [(r["page_id"], r["text"]) for r in html_extract.extract(pages).collect()]
    for i in range(6):
        assert (i, f"Story {i}\n\nMore {i}") in got
    assert got.count((9, "Story 3\n\nMore 3")) == 3
    assert (20, "Welcome to the site\n\nStory 1\n\nMore 1\n\nCall us") in got
    assert (22, "") in got and (23, "") in got and len(got) == len(rows)
    assert html_extract.extract(pages.where("false")).count() == 0


def test_tree_matching_by_brute_force():
    rng = np.random.default_rng(4)

    def tree(depth):
        node = html_extract.Node(str(rng.integers(2)), str(rng.integers(2)), False, False)
        if depth and rng.random() < 0.7:
            node.children = [tree(depth - 1) for _ in range(rng.integers(1, 4))]
        else:
            node.text, node.digest = "t", int(rng.integers(3))
        return node

    def best(a, b):
        if a.label != b.label:
            return 0
        if not a.children or not b.children:
            return 2 if a.digest == b.digest else 1

        def rows(i, j):
            if i == len(a.children) or j == len(b.children):
                return 0
            both = best(a.children[i], b.children[j])
            return max(rows(i + 1, j), rows(i, j + 1), both and both + rows(i + 1, j + 1))

        return 1 + rows(0, 0)

    for _ in range(60):
        a, b = tree(2), tree(2)
        if a.label == b.label:
            assert html_extract._score(a, b, {}) == best(a, b)


@pytest.mark.parametrize("held", [1 << 28, 4000, 1])
def test_alignments_by_lists_and_by_arrays_agree(monkeypatch, held):
    monkeypatch.setattr(html_extract, "HELD", held)
    rng = np.random.default_rng(9)

    def part(depth):
        tag = rng.choice(["div", "div class=a", "p"])
        if depth and rng.random() < 0.7:
            return f"<div>{''.join(part(depth - 1) for _ in range(rng.integers(1, 6)))}</div>"
        return f"<{tag}>{rng.choice(['', 'x', 'y', 'z'])}</{tag.split()[0]}>"

    aligned = 0
    for _ in range(200):
        html, pivot = ("".join(part(3) for _ in range(rng.integers(1, 6))) for _ in range(2))
        wrapper, page, copy = html_extract.Wrapper(pivot), html_extract.Tree(html).root, html_extract.Tree(pivot).root
        slots = wrapper._by_lists(page)
        assert wrapper._by_arrays(page) == slots
        assert wrapper._by_arrays(copy) == wrapper._by_lists(copy) == wrapper.slots(pivot, copy)
        aligned += len(slots)
    assert aligned > 500


@pytest.mark.parametrize("blocks", [5, 700, 3000])
def test_long_child_lists_are_aligned_as_short_ones(spark, blocks):
    def page(i):
        return f"<p>Welcome</p><p class=legal>Case {i}</p>{''.join(f'<p>Block {k} of {i}</p>' for k in range(blocks))}<p>Call us</p>"

    pages = spark.createDataFrame([(i, "http://long.example/", page(i)) for i in range(6)], "page_id int, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert got == {i: "\n\n".join([f"Case {i}", *[f"Block {k} of {i}" for k in range(blocks)]]) for i in range(6)}


def test_a_lone_page_of_very_many_nested_elements(spark):
    deep = "<div>" * 4000 + "<p>core" + "</div><p>x" * 10
    got = html_extract.extract(spark.createDataFrame([("http://deep.example/", deep)], "url string, html string")).collect()
    assert got[0]["text"] == "\n\n".join(["core", *["x"] * 10])


# Substring dedup


def _kept(texts):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[s : s + 35]) for w in docs for s in range(len(w) - 34))
    out = []
    for w in docs:
        gone = {p for s in range(len(w) - 34) if seen[tuple(w[s : s + 35])] > 1 for p in range(s, s + 35)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def _corpus():
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 400, n)]
    shared = [word(k) for k in (34, 35, 36, 60, 120)]
    texts = [None, "", "few words"]
    for _ in range(60):
        parts = [word(rng.integers(0, 50))]
        for _ in range(rng.integers(0, 4)):
            passage = shared[rng.integers(len(shared))]
            cut = rng.integers(0, max(1, len(passage) - 34))
            parts += [passage[cut:], word(rng.integers(0, 12))]
        texts.append(rng.choice([" ", "\n", "\t  "]).join(w for p in parts for w in p))
    texts += ["a " * 34, "a " * 35, "a " * 36, "a b " * 40, " ".join(shared[4]), " ".join(shared[4]), "nul x " + " ".join(shared[3])]
    return texts


@pytest.mark.parametrize("shard_contexts", [512, 1])
def test_substring_brute_force(spark, shard_contexts):
    texts = _corpus()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.remove(docs.repartition(5), shard_contexts=shard_contexts).collect()}
    assert [got[i] for i in range(len(texts))] == _kept(texts)


def test_suffix_automaton_counts():
    rng = np.random.default_rng(1)
    seqs = [rng.integers(0, 3, 30).tolist() for _ in range(4)]
    automaton = substring.SuffixAutomaton()
    for s in seqs:
        automaton.add(s)
    automaton.finish()
    grams = Counter(tuple(s[i:j]) for s in seqs for i in range(30) for j in range(i + 1, 31))
    for s in seqs:
        want = [max([0, *(n for n in range(1, e + 2) if grams[tuple(s[e + 1 - n : e + 1])] > 1)]) for e in range(30)]
        assert list(automaton.statistics(s)) == want


def test_substring_odd_tables(odd, empty):
    rows = substring.remove(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[5]["n_removed"] == by_id[5]["n_words"] == 40_000  # the row is there twice
    assert by_id[1]["n_words"] == 0 and by_id[4]["kept"] == "one two" and by_id[4]["words"] == "mine"
    assert substring.remove(empty).count() == 0


# Top-k


def test_bit_slices_add_up():
    rng = np.random.default_rng(3)
    values = rng.integers(-40, 40, (130, 7))
    index = topk.BitSlices(np.arange(130), values)
    for q in rng.integers(-30, 30, (20, 7)):
        sums = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << i) for i, s in enumerate(index.sum(q)))
        assert len(set((sums - values @ q).tolist())) == 1
        score = values @ q
        want = sorted(((int(i), int(score[i])) for i in range(130) if i != 5), key=lambda r: (-r[1], r[0]))[:20]
        assert index.top(q, 5) == want


def test_topk_brute_force_with_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 64]) for i in range(150)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4), (None, [0.0] * 4), (220, [1.0]), (240, [])]
    rows += [rows[7], rows[20]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("mine"))
    got = sorted(tuple(r) for r in topk.top_k(df.repartition(3), F.col("vec_id") % 20 == 0).collect())
    good = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows if i is not None and i < 200]
    want = []
    for q in sorted({i for i, _ in good if i % 20 == 0}):
        vector = next(v for i, v in good if i == q)
        best = sorted(((int(v @ vector), i) for i, v in good if i != q), key=lambda r: (-r[0], r[1]))[:20]
        want += [(q, k + 1, i, s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk.top_k(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_topk_takes_vectors_of_any_finite_size(spark):
    rows = [(0, [5e7, 1.0]), (1, [4e7, 1.0]), (2, [0.5, -1.0]), (3, [-6e9, 2.0]), (20, [1.0, 1.0]), (40, [1e200, 0.0]), (5, [-1e-3, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("wide", F.lit("mine"))
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    for q in (0, 20, 40):
        scores = ((sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        near = sorted(((min(max(s, -(1 << 63)), (1 << 63) - 1), i) for s, i in scores), key=lambda r: (-r[0], r[1]))
        assert sorted(got[q]) == [(k + 1, i, s) for k, (s, i) in enumerate(near)]


# SimHash


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 2:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_op10_brute_force(spark, texts):
    ids = sorted(texts)
    fps = [_fingerprint(texts[i]) for i in ids]
    want = {(i, f"{fp:016x}", ids[c]) for i, fp, c in zip(ids, fps, _components(fps), strict=True)}
    assert {tuple(r) for r in QUERIES["op10_simhash"](spark, SF).collect()} == want


@pytest.mark.parametrize("bucket_rows", [2048, 2])
def test_links_connect_all_within_two_bits(spark, bucket_rows):
    rng = np.random.default_rng(5)
    values = set()
    for base in rng.integers(0, 2**63, 12).tolist():
        for _ in range(40):
            x = base
            for bit in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << bit
            values.add(x)
    values |= {next(iter(values)) ^ (1 << a) ^ (1 << b) for a in range(0, 64, 9) for b in range(64)}
    values = sorted(values)
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp bigint")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, bucket_rows)).collect()}
    got = [roots.get(simhash.signed(v), simhash.signed(v)) for v in values]
    want = _components(values)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(9)
    values = np.unique(np.array([int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in rng.integers(0, 2**63, 5) for i, j in rng.integers(0, 64, (60, 2))], np.uint64))
    index = simhash.GrayIndex(values)
    q, node = index.pairs(values)
    got = {(int(values[a]), int(index.values[b])) for a, b in zip(q, node, strict=True)}
    assert got == {(int(a), int(b)) for a in values for b in values if (int(a) ^ int(b)).bit_count() <= 2}


def test_long_chains_and_empty_edges(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(70)], "a bigint, b bigint")
    assert {r["root"] for r in simhash.components(chain).collect()} == {0}
    assert simhash.components(chain.where("false")).count() == 0


def test_simhash_odd_tables(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["fp"] == by_id[2]["fp"] == by_id[3]["fp"] == 0
    assert by_id[3]["component_id"] == 1 and by_id[None]["component_id"] is None
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 4, 5, None, 6, 7])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


# Pipeline


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        before = list(frames.values())[-1]
        frames[name] = stage(spark, before, sf).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frames[name].columns == docs.columns
    ids = {k: {r["doc_id"]: r for r in v.collect()} for k, v in frames.items()}
    names = list(ids)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    gone = set(ids[""]) - set(ids[names[1]])
    assert np.mean([i in gone for i, y in labels.items() if y == 0]) > 0.6
    assert np.mean([i in gone for i, y in labels.items() if y == 1]) < 0.02
    order = sorted(ids[names[1]])
    comps = _components([_fingerprint(ids[names[1]][i]["text"]) for i in order])
    assert set(ids[names[2]]) == {order[c] for c in comps}
    items = [r["text"].split()[:13] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(len(w) == 13 and " ".join(w) in r["text"] and len(r["text"].split()) < 200 for w in items for r in ids[names[3]].values())
    assert set(ids[names[4]]) == set(ids[names[3]]) == set(ids[names[5]])
    assert not any(re.search("[0-9a-f]{24}", r["text"]) for r in ids[names[4]].values())
    for i, r in ids[names[5]].items():
        text = ids[names[4]][i]["text"]
        assert r["round_trip"] and r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert ids[names[4]][i]["n_chars"] == len(text)


def test_one_row_of_each_group_stays_whatever_ids_repeat(spark):
    a, b, c = ("alpha beta gamma delta " * 6).strip(), ("one two three four " * 6).strip(), ("some other words here " * 6).strip()
    rows = [(5, a, "x"), (5, b, "x"), (3, b, "x"), (None, c, "y"), (None, c, "x"), (9, "", "x"), (8, None, "z"), (8, None, "y"), (7, c + " end of it all", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("_hash", F.lit("mine"))
    kept = [tuple(r)[:2] for r in simhash.keep_one(df).collect()]
    # Null and empty texts are one group; the text with a tail of its own is not a copy.
    assert sorted(kept, key=repr) == sorted([(5, a), (3, b), (None, c), (8, None), (7, c + " end of it all")], key=repr)
    assert simhash.keep_one(df).columns == df.columns
    assert simhash.keep_one(df.where("false")).count() == 0


def test_copies_without_ids_are_one_set_of_marks(spark):
    text = " ".join(f"w{i}" for i in range(80))
    df = spark.range(300).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(text).alias("text"))
    out = substring.remove(df).select("n_words", "n_removed", "kept").distinct().collect()
    assert [tuple(r) for r in out] == [(80, 80, "")]
