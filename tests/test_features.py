from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from weekpanel.functions import text as TX
from weekpanel.operators import assemble as AS
from weekpanel.operators import encoding as E
from weekpanel.operators import features as X
from weekpanel.operators import insights as K
from weekpanel.operators import ranking as R
from weekpanel.operators import tfidf as T
from weekpanel.operators.dedupe import dedupe_first, keep_first, keep_last
from weekpanel.operators.quantile import grouped_percentile


def test_freshness(spark):
    df = spark.sql(
        "select * from values (1, date'2024-01-08', date'2024-01-01'), (2, date'2024-01-08', date'2024-01-10'), "
        "(3, date'2024-01-08', date'2024-01-08'), (4, date'2024-01-08', null) t(id, week_start, last_air_date)"
    )
    got = [tuple(r)[3:] for r in X.freshness(df).orderBy("id").collect()]
    assert got == [(7, 7, 0), (-2, 0, 1), (0, 0, 0), (None, None, 0)]


def test_mode_ties_weights_and_all_null(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("a", 1), (None, 9)], "certification string, n_weeks int")
    assert {r[0] for r in X.impute_mode(df).collect()} == {"a", "b"}
    assert X.mode_value(df, "certification").first()[0] == "a"
    heavier = df.withColumn("n_weeks", F.when(F.col("certification") == "b", 3).otherwise(F.col("n_weeks")))
    assert X.mode_value(heavier, "certification").first()[0] == "b"
    empty = df.withColumn("certification", F.lit(None).cast("string"))
    assert {r[0] for r in X.impute_mode(empty).select("certification").collect()} == {None}


def test_percentile_against_numpy_with_a_hot_group(spark):
    rng = np.random.default_rng(7)
    rows = [("hot", float(v), int(w)) for v, w in zip(rng.integers(0, 3000, 4000), rng.integers(1, 5, 4000), strict=True)]
    rows += [(f"g{i % 50}", float(v), 1) for i, v in enumerate(rng.normal(0, 10, 3000))]
    rows += [("one", 4.0, 1), ("same", 2.0, 5), ("same", 2.0, 2), ("none", None, 3)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    for q in (0.0, 0.5, 0.8, 1.0):
        got = {r["g"]: r["q"] for r in grouped_percentile(df, ["g"], "v", q, "w").collect()}
        want = {}
        for g in {r[0] for r in rows} - {"none"}:
            values = np.repeat([r[1] for r in rows if r[0] == g], [r[2] for r in rows if r[0] == g])
            want[g] = np.quantile(values, q)
        assert got.keys() == want.keys()
        assert all(got[g] == pytest.approx(want[g]) for g in want)
    every = np.repeat([r[1] for r in rows if r[1] is not None], [r[2] for r in rows if r[1] is not None])
    assert grouped_percentile(df, [], "v", 0.5, "w").first()["q"] == pytest.approx(np.median(every))


def test_group_median_then_overall_median(spark):
    rows = [(1, "a", 10.0, 1), (2, "a", 20.0, 3), (3, "a", None, 1), (4, "b", None, 2), (5, "", 7.0, 1)]
    df = spark.createDataFrame(rows, "id int, genres string, episode_run_time_mean double, n_weeks int")
    got = {r["id"]: r["episode_run_time_mean"] for r in X.impute_group_median(df).collect()}
    # Group a: 10, 20, 20, 20. The filled column is 10, 20 x3, 20 and 7.
    assert got == {1: 10.0, 2: 20.0, 3: 20.0, 4: 20.0, 5: 7.0}


def test_lists_and_vocabulary(spark):
    rows = [(1, " a , ,b", 1), (2, "", 5), (3, None, 5), (4, "b,c,c", 2)]
    df = spark.createDataFrame(rows, "id int, g string, n_weeks int")
    lists = [r[0] for r in df.orderBy("id").select(TX.split_list("g")).collect()]
    assert lists == [["a", "b"], [], [], ["b", "c", "c"]]
    top = X.top_tokens(df, "g", 2)
    assert [tuple(r) for r in top.collect()] == [("c", 4), ("b", 3)]
    kept = X.keep_tokens(df, "g", X.names_of(top), "kept").orderBy("id")
    assert [r["kept"] for r in kept.collect()] == [["b"], [], [], ["b", "c"]]


def test_search_terms(spark):
    rows = [("A", "B", "N1, N2"), ("", "B", None), (None, None, "N"), ("  ", "B", "N"), ("A", "B", "tv series")]
    df = spark.createDataFrame(rows, "name string, original string, networks string")
    got = [r[0] for r in df.select(TX.search_terms("name", "original", "networks")).collect()]
    assert got == [
        ["A tv series", "A N1", "A N1 tv series"],
        ["B tv series"],
        [],
        [],
        ["A tv series", "A tv series tv series"],
    ]


def test_labels_and_keywords(spark):
    one = spark.range(1)
    assert one.select(TX.pretty_keyword(F.lit("kw_dark_comedy"))).first()[0] == "Dark comedy"
    assert one.select(TX.label_id(F.lit("The (id=3) show (id=42)"))).first()[0] == 42
    assert one.select(TX.label_id(F.lit("no id"))).first()[0] is None
    label = TX.run_label(F.lit("2024"), F.lit("r1"), F.lit("w"))
    assert one.select(TX.run_label_id(label)).first()[0] == "r1"


DOCS = ["Blue café blue", "x blue RED_1", "", None, "red red café über"]


def brute_tfidf(weights, vocab=None, limit=3):
    import regex

    words = [regex.findall(r"[\p{L}\p{N}_]{2,}", (d or "").lower()) for d in DOCS]
    n, df = Counter(), Counter()
    for ws, w in zip(words, weights, strict=True):
        for t, c in Counter(ws).items():
            n[t] += c * w
            df[t] += w
    vocab = vocab or sorted(n, key=lambda t: (-n[t], t))[:limit]
    idf = {t: math.log((1 + sum(weights)) / (1 + df[t])) + 1 for t in vocab}
    out = {}
    for i, ws in enumerate(words):
        raw = {t: c * idf[t] for t, c in Counter(ws).items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out |= {(i, t): v / norm for t, v in raw.items()}
    return out


@pytest.mark.parametrize("vocab", [None, ["blue", "unseen", "über"]])
def test_tfidf_against_brute_force_and_row_grain(spark, vocab):
    weights = [3, 1, 2, 1, 4]
    rows = [(i, d, w) for i, (d, w) in enumerate(zip(DOCS, weights, strict=True))]
    df = spark.createDataFrame(rows, "id int, text string, w int")
    scored, fitted = T.tfidf(df, "text", 3, "w", vocab)
    got = {(r["id"], r["term"]): r["score"] for r in T.scores_long(scored, fitted).collect()}
    want = brute_tfidf(weights, vocab)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    # One row per week gives the same fit as one weighted row per entity.
    repeated = df.withColumn("copy", F.explode(F.sequence(F.lit(1), "w")))
    assert T.fit(repeated, "text", 3, None, vocab) == fitted


def test_tfidf_without_words(spark):
    df = spark.createDataFrame([(1, ""), (2, None)], "id int, text string")
    scored, fitted = T.tfidf(df, "text", 3)
    assert fitted.names == () and T.scores_long(scored, fitted).count() == 0


def _vectors(spark):
    """Sparse, dense and empty vectors, with zeros and odd numbers stored, a null id and an id that comes twice."""
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as ST

    nan = float("nan")
    rows = [
        (1, Vectors.sparse(3, [0, 2], [0.25, 0.75])),
        (1, Vectors.sparse(3, [0, 2], [0.25, 0.75])),
        (2, Vectors.dense([0.0, 1.0, 0.0])),
        (3, Vectors.sparse(3, [], [])),
        (4, Vectors.sparse(3, [0, 1, 2], [0.0, -1.0, 0.5])),
        (5, Vectors.dense([nan, -1.0, 1.0])),
        (None, Vectors.sparse(3, [1], [1.0])),
    ]
    schema = ST.StructType([ST.StructField("id", ST.LongType()), ST.StructField(T.SCORES, VectorUDT())])
    fitted = T.Terms(("a", "b", "c"), (1, 1, 1), (1, 1, 1), (1.0, 1.0, 1.0))
    return spark.createDataFrame(rows, schema), fitted


def test_present_terms_of_odd_vectors(spark):
    df, fitted = _vectors(spark)
    spread = vector_to_array(T.SCORES)
    wanted = F.filter(F.array(*[F.when(spread[i] > 0, t) for i, t in enumerate(fitted.names)]), lambda t: t.isNotNull())
    rows = df.select("id", T.present_terms(fitted).alias("got"), wanted.alias("wanted")).collect()
    assert all(r["got"] == r["wanted"] for r in rows) and len(rows) == 7
    assert [r["got"] for r in rows if r["id"] == 1] == [["a", "c"]] * 2
    nothing = T.Terms((), (), (), ())
    unscored = T.score(spark.createDataFrame([(1, "")], "id int, text string"), "text", nothing)
    assert unscored.select(T.present_terms(nothing)).first()[0] == []


def test_keyword_insights_work_on_the_series_once(spark, sf_dir):
    from weekpanel.plans import inputs as I

    words = spark.sql("select * from values (1L, 'a'), (2L, 'a'), (2L, 'b'), (null, 'b') as t(id, term)")
    found = K.keyword_insights(K.entity_sums(I.trends(spark, sf_dir)), words)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "lineitem" not in text


def test_keyword_insights_of_rows_without_id_and_repeated_words(spark):
    rows = spark.sql("select * from values (1, 2D), (1, null), (2, 4D), (null, 6D), (null, null) as t(id, interest)")
    words = spark.sql("select * from values (1, 'a'), (1, 'a'), (null, 'a'), (7, 'b') as t(id, term)")
    got = [tuple(r) for r in K.keyword_insights(K.entity_sums(rows), words).collect()]
    # The rows without id count in the totals only; a word that comes twice counts its entity's rows twice.
    assert got == [("kw__a", 80.0, 2.0, 8.0, -6.0, -2.0, "A")]
    assert K.keyword_insights(K.entity_sums(rows.limit(0)), words).count() == 0


def test_clean_columns_do_not_spread_vectors_over_the_vocabulary(spark):
    from weekpanel.plans import q_features as Q

    df, fitted = _vectors(spark)
    clean = df.selectExpr(
        "*", "date'2024-01-01' as week_start", "1D as interest", "1D as roll_std_4w", "'C' as certification",
        "2D as episode_run_time_mean", "1 as freshness_days", "array('g', 'h') as genres_kept",
        "array() as networks_kept",
    )
    out = Q._clean_columns(Q._listed(clean, fitted))
    assert "UDF" not in out._jdf.queryExecution().executedPlan().toString()
    rows = [(r["genres_kept"], r["networks_kept"], r["terms"]) for r in out.where("id = 4").collect()]
    assert rows == [("g,h", "", "c")]


def test_lists_become_text_below_the_join(spark, sf_dir):
    from weekpanel.plans import q_features as Q

    text = Q.panel_clean_narrow(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert text.index("Join") < text.index("unwrap_udt") and text.count("unwrap_udt") == text[text.index("Join") :].count("unwrap_udt")


def test_lists_of_entities_equal_lists_of_their_rows(spark):
    """Also for a null id, an id that comes twice, empty and missing lists, and an entity without rows."""
    from weekpanel.operators import panel as P
    from weekpanel.plans import q_features as Q
    from weekpanel.plans.refresh import clean_entities, clean_panel

    catalog = spark.sql(
        """select * from values
        (1L, date'2024-01-09', 'C1', 30D, 'Drama, Crime,, Drama', 'N1', 'dark dark moon'),
        (1L, date'2024-01-09', 'C1', 30D, 'Drama, Crime,, Drama', 'N1', 'dark dark moon'),
        (2L, null, null, null, null, '', null),
        (3L, date'2024-01-01', 'C2', null, 'Drama', 'N1,N2', ''),
        (4L, date'2024-01-01', 'C2', 45D, 'Crime', 'N2', 'sun'),
        (null, date'2024-01-01', 'C2', 45D, 'Crime', 'N2', 'moon')
        as t(id, last_air_date, certification, episode_run_time_mean, genres, networks, keywords)"""
    )
    weeks = spark.sql(
        """select id, date_add(date'2024-01-01', 7 * w) as week_start, interest from values
        (1L, 0, 5D), (1L, 1, null), (1L, 2, 7D), (2L, 0, 1D), (3L, 0, 2D), (3L, 1, double('nan')), (9L, 0, 1D), (null, 0, 3D)
        as t(id, w, interest)"""
    )
    series = P.add_time_features(P.clean_trends(weeks, collapse=False))
    entities, _, fitted = clean_entities(series, catalog, n_genres=5, n_networks=5, n_terms=5)
    below = Q._clean_columns(clean_panel(series, Q._listed(entities, fitted)))
    above = Q._clean_columns(Q._listed(clean_panel(series, entities), fitted))
    rows = sorted(map(repr, below.collect()))
    assert rows == sorted(map(repr, above.collect())) and below.schema == above.schema
    texts = {(r["id"], r["genres_kept"], r["networks_kept"], r["terms"]) for r in below.collect()}
    assert len(rows) == 6
    assert texts == {(1, "Crime,Drama", "N1", "dark,moon"), (2, "", "", ""), (3, "Drama", "N1,N2", "")}


def test_codes_for_training_and_serving(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id int, status string")
    codes = E.category_codes(train)
    new = spark.createDataFrame([(1, "c"), (2, "zzz"), (3, None)], "id int, status string")
    assert [r["status"] for r in E.encode_train(train, codes).orderBy("id").collect()] == [1, 0, 3, 2]
    assert [r["status"] for r in E.encode_train(new, codes).orderBy("id").collect()] == [2, 3, 3]
    assert [r["status"] for r in E.encode_serve(new, codes).orderBy("id").collect()] == [2, -1, -1]


def test_contract(spark):
    df = spark.createDataFrame([(1, "x", 2.0, None, True)], "id bigint, name string, b double, a double, f boolean")
    assert E.feature_columns(df) == ["b", "a", "f"]
    assert E.missing_features(df, ["a", "nope"]) == ["nope"]
    row = E.contract_projection(df, ["f", "nope", "name", "a"]).first()
    assert tuple(row) == (1, 1.0, 0.0, 0.0, 0.0)
    assert tuple(E.encode_matrix(df, ["a", "name"]).first()) == (1, -1.0, 0.0)


def test_vector_matches_wide_columns(spark):
    df = spark.createDataFrame(
        [(1, "r", 2.0, ["Sci-Fi & Fantasy"], ["N.1"], "dark dark moon"), (2, None, None, [], ["N.2", "N.1"], "sun")],
        "id bigint, status string, x double, genres_kept array<string>, networks_kept array<string>, keywords string",
    )
    scored, fitted = T.tfidf(df, "keywords", 5)
    spec = AS.describe(scored, ["Sci-Fi & Fantasy"], ["N.1", "N.2"], fitted.names)
    assert spec.names() == [
        "status", "x", "genre__Sci-Fi & Fantasy", "net__N.1", "net__N.2", "kw__dark", "kw__moon", "kw__sun",
    ]
    wide = AS.widen(scored, spec)
    assert wide.columns[-6:] == spec.names()[2:]
    vectors = AS.with_vector(scored, spec, ["id"]).withColumn("v", vector_to_array("features"))
    for w, v in zip(wide.orderBy("id").collect(), vectors.orderBy("id").collect(), strict=True):
        assert list(w)[-6:] == v["v"][2:]
    assert [r["v"][:2] for r in vectors.orderBy("id").collect()] == [[0.0, 2.0], [1.0, -1.0]]


def test_full_width_of_the_published_run(spark):
    """22 catalog columns, 15 genres, 20 networks and 200 terms make 270 columns, 274 with targets, 259 features."""
    from weekpanel.operators.panel import add_time_features, attach_catalog
    from weekpanel.plans.refresh import frame_shape

    trends = spark.sql("select 1L as id, date'2024-01-01' as week_start, 1.0D as interest")
    catalog = spark.sql(
        "select 1L as id, 'a' as name, 'b' as original_name, null as first_air_date, null as last_air_date, "
        "'s' as status, 't' as type, true as in_production, 1 as number_of_seasons, 2 as number_of_episodes, "
        "1.0D as episode_run_time_mean, 1.0D as popularity, 1.0D as vote_average, 1L as vote_count, 1 as num_cast, "
        "1 as num_directors, 'k' as keywords, 'c' as certification, 'i' as imdb_id, 'g' as genres, 'n' as networks, "
        "'l' as language"
    )
    panel = attach_catalog(add_time_features(trends), catalog)
    assert len(panel.columns) == 32
    clean = X.freshness(panel)
    names = [[f"{p}{i}" for i in range(n)] for p, n in (("g", 15), ("n", 20), ("k", 200))]
    listed = clean.withColumns({AS.GENRES: F.array(F.lit("g1")), AS.NETWORKS: F.array(F.lit("n1"))})
    spec = AS.describe(listed, *names)
    assert len(spec.names()) == 259
    assert frame_shape(listed, spec, [1, 2, 3, 4])["n_cols"] == 274


def test_ranking_with_a_hot_value(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 7 else id end as v", "hash(id) as h")
    order = [F.desc("v"), F.asc("id")]
    got = [r["id"] for r in R.global_rank(df.orderBy("h"), order).orderBy("rank").collect()]
    rows = sorted(((7 if i % 3 == 0 else i), i) for i in range(3000))
    assert got == [i for _, i in sorted(rows, key=lambda r: (-r[0], r[1]))]
    ranks = [r["rank"] for r in R.global_rank(df, order).collect()]
    assert sorted(ranks) == list(range(1, 3001))
    second = R.page(df, order, 2, 50).orderBy("rank")
    assert [r["id"] for r in second.collect()] == got[50:100]
    assert R.page_count(df).first()[0] == 60


def test_dedupe_is_stable_and_idempotent(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b"), (2, 4, None)], "k int, seq int, v string")
    once = dedupe_first(df, "k", "seq")
    assert sorted(tuple(r) for r in once.collect()) == [(1, 1, "a"), (2, 2, "b")]
    assert dedupe_first(once, "k", "seq").exceptAll(once).isEmpty()
    assert [tuple(r) for r in dedupe_first(df, "k", "seq", 1).collect()] == [(1, 1, "a")]
    assert sorted(tuple(r) for r in keep_last(df, ["k"], ["seq"]).collect()) == [(1, 3, "c"), (2, 4, None)]
    assert keep_first(df.select("k"), ["k"]).count() == 2


def test_keyword_insights_edge_cases(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, None), (3, 9.0)], "id int, interest double")
    sums = K.entity_sums(rows)
    words = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c"), (2, "c"), (3, "c")], "id int, term string")
    got = {r["keyword"]: r for r in K.keyword_insights(sums, words).collect()}
    assert got["kw__a"]["mean_interest_present"] == 3.0 and got["kw__a"]["mean_interest_absent"] == 9.0
    assert got["kw__b"]["mean_interest_present"] is None and got["kw__b"]["coverage_%"] == 25.0
    assert got["kw__c"]["mean_interest_absent"] is None
    assert K.keyword_lift(K.keyword_insights(sums, words.limit(0))).count() == 0


def test_nice_bins():
    assert K.nice_width(0, 100) == 5.0
    assert K.nice_width(0, 1) == 0.05
    assert K.nice_width(3, 3) > 0


def test_display(spark):
    from weekpanel.operators import display as DS

    df = spark.createDataFrame(
        [("a", 0.25, -0.25, None, 1)], "name string, last_interest double, `predicted_t+1` double, `delta_t+1` double, id int"
    )
    assert tuple(DS.formatted(df, DS.MOVERS).first()) == ("a", "0.2", "-0.2", "—")
    ranked = df.withColumn("rank_popularity", F.lit(1))
    assert tuple(DS.formatted(ranked, DS.OVERVIEW).first())[:2] == (1, "a")
    words = spark.sql("select 'Dark' as keyword_readable, 12.34D as `coverage_%`, null as mean_interest_present")
    assert tuple(DS.formatted(words, DS.KEYWORD_COVERAGE).first()) == ("Dark", "12.3", "—")
    assert DS.renamed(df, DS.MOVERS).columns == ["Show", "Latest interest", "Forecast (t+1)", "Net change (t+1)"]


def _boosted(spark, n):
    from pyspark.ml.functions import array_to_vector

    rows = spark.range(n).withColumn("x", F.pmod(F.xxhash64("id"), F.lit(997)) / 997.0)
    rows = rows.withColumn("y", 10 * F.sin(F.col("x") * 6) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(97)) / 10.0)
    return rows.select(
        "id", F.lit(0).alias("week_start"), F.col("y").alias("interest_t+1"), array_to_vector(F.array("x")).alias("features"),
        F.when(F.col("id") % 10 == 0, "val").otherwise("train").alias("split"), F.lit("w").alias("cutoff_week"),
    )


def test_the_second_family_runs_all_rounds_and_the_first_only_stops_on_many_rows(spark):
    from weekpanel.operators import model as M

    assert not any("validationTol" in settings for settings in M.FAMILIES.values())
    assert [M.FAMILIES[f]["maxIter"] for f in ("hgbr", "lgbm")] == [100, 1200]
    frame = _boosted(spark, 900)
    for family in M.FAMILIES:
        models, records = M.train_family(frame, family, [1], {"maxIter": 12, "maxDepth": 2})
        assert len(models[1].treeWeights) == records[0]["n_trees"] == 12


def test_early_stop_has_patience(spark, monkeypatch):
    from weekpanel.operators import model as M

    falling = [1 / (i + 1) for i in range(40)]
    assert M.rounds_kept(falling) == 40 and M.rounds_kept([]) == 0
    assert M.rounds_kept(falling + [1.0] * 9) == 49
    assert M.rounds_kept(falling + [1.0] * 30) == 50
    monkeypatch.setattr(M, "HELD_MORE_THAN", 500)
    monkeypatch.setattr(M, "PATIENCE", 2)
    models, records = M.train_family(_boosted(spark, 900), "hgbr", [1], {"maxIter": 40, "maxDepth": 2, "stepSize": 0.9})
    n = records[0]["n_trees"]
    assert 3 <= n < 40 and len(models[1].treeWeights) == n
    assert M.train_family(_boosted(spark, 900), "lgbm", [1], {"maxIter": 20, "maxDepth": 2})[1][0]["n_trees"] == 20
