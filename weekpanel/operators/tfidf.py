"""TF-IDF over documents that stay one row each.

Fitting takes one shuffle, the partially aggregated term counts; what reaches the driver is the
vocabulary, at most ``max_features`` terms. Scoring is row by row: count, weigh, scale to length 1.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekpanel.functions.text import tokens

# Marks a word that counts its document; no word character.
_ONCE = "#"
SCORES = "keywords_tfidf"


@dataclass(frozen=True)
class Terms:
    """A fitted vocabulary in alphabetical order, with its counts and weights."""

    names: tuple[str, ...]
    n: tuple[int, ...]
    df: tuple[int, ...]
    idf: tuple[float, ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(self.names, range(len(self.names)), self.n, self.df, self.idf, strict=True))
        return spark.createDataFrame(rows, "term string, idx int, n bigint, df bigint, idf double")


def corpus_counts(docs: DataFrame, text: str, weight: str | None = None) -> DataFrame:
    """Total count and document count of every term.

    Each text is split once. Its words are exploded for the total counts, and its distinct words, marked, for the
    document counts; both are added up before the shuffle.
    """
    w = F.col(weight) if weight else F.lit(1)
    words = docs.select(tokens(text).alias("_words"), w.cast("bigint").alias("_w"))
    once = F.transform(F.array_distinct("_words"), lambda t: F.concat(F.lit(_ONCE), t))
    # The outer form: a plain explode adds a size filter that repeats the splitting below it.
    each = words.select(F.explode_outer(F.concat("_words", once)).alias("_t"), "_w").where(F.col("_t").isNotNull())
    sums = each.groupBy("_t").agg(F.sum("_w").alias("_n"))
    in_documents = F.col("_t").startswith(_ONCE)
    term = F.when(in_documents, F.substring("_t", len(_ONCE) + 1, 1 << 30)).otherwise(F.col("_t"))
    return sums.groupBy(term.alias("term")).agg(
        F.sum(F.when(~in_documents, F.col("_n"))).alias("n"), F.sum(F.when(in_documents, F.col("_n"))).alias("df")
    )


def top_terms(counts: DataFrame, max_features: int) -> DataFrame:
    """The most frequent terms."""
    return counts.orderBy(F.desc("n"), F.asc("term")).limit(max_features)


def fit(
    df: DataFrame, text: str, max_features: int, weight: str | None = None, vocabulary: Sequence[str] | None = None
) -> Terms:
    """Vocabulary and smoothed inverse document frequencies of a corpus.

    With ``vocabulary`` the terms are fixed and only their frequencies are fitted; an unseen term has df 0.
    """
    spark = df.sparkSession
    needed = df.select(F.col(text).alias("_text"), *([weight] if weight else []))
    counts = corpus_counts(needed, "_text", weight)
    if vocabulary is None:
        found = top_terms(counts, max_features).collect()
    else:
        wanted = spark.createDataFrame([(t,) for t in vocabulary], "term string")
        found = counts.join(F.broadcast(wanted), "term", "left_semi").collect()
    by_term = {r["term"]: (r["n"], r["df"]) for r in found}
    names = tuple(sorted(by_term if vocabulary is None else set(vocabulary)))
    n_docs = df.agg(F.sum(F.col(weight) if weight else F.lit(1))).first()[0] or 0
    n, doc_counts = zip(*[by_term.get(t, (0, 0)) for t in names], strict=True) if names else ((), ())
    idf = tuple(math.log((1 + n_docs) / (1 + d)) + 1 for d in doc_counts)
    return Terms(names, n, doc_counts, idf)


def score(df: DataFrame, text: str, fitted: Terms, out: str = SCORES) -> DataFrame:
    """Add the sparse vector of raw tf times idf, scaled to length 1; other words are dropped."""
    if not fitted.names:
        return df.withColumn(out, F.lit(None).cast(VectorUDT()))
    steps = [
        CountVectorizerModel.from_vocabulary(list(fitted.names), "_words", "_tf"),
        ElementwiseProduct(scalingVec=Vectors.dense(fitted.idf), inputCol="_tf", outputCol="_raw"),
        Normalizer(p=2.0, inputCol="_raw", outputCol=out),
    ]
    scored = df.withColumn("_words", tokens(text))
    for step in steps:
        scored = step.transform(scored)
    return scored.drop("_words", "_tf", "_raw")


def tfidf(
    df: DataFrame, text: str, max_features: int, weight: str | None = None, vocabulary: Sequence[str] | None = None
) -> tuple[DataFrame, Terms]:
    """Scored documents and what was fitted on them."""
    fitted = fit(df, text, max_features, weight, vocabulary)
    return score(df, text, fitted), fitted


def _entries(column: str) -> tuple[Column, Column]:
    """Positions and values that a vector stores, without spreading a sparse one over the whole vocabulary."""
    vector = F.unwrap_udt(F.col(column))
    values = vector["values"]
    # A dense vector stores all values and no positions.
    return F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(values) - 1)), values


def _names(fitted: Terms) -> Column:
    return F.array(*[F.lit(t) for t in fitted.names]).cast("array<string>")


def present_terms(fitted: Terms, column: str = SCORES) -> Column:
    """The terms with a positive score in a row's vector, in alphabetical order."""
    places, values = _entries(column)
    scored = F.filter(places, lambda _, k: F.get(values, k) > 0)
    terms = F.transform(scored, lambda i: F.get(_names(fitted), i))
    # Without a vocabulary there is no vector.
    return F.coalesce(terms, F.array().cast("array<string>"))


def scores_long(scored: DataFrame, fitted: Terms, id_col: str = "id", column: str = SCORES) -> DataFrame:
    """(id, term, score) rows of the sparse matrix."""
    if not fitted.names:
        return scored.select(id_col, F.lit("").alias("term"), F.lit(0.0).alias("score")).limit(0)
    names = F.array(*[F.lit(t) for t in fitted.names])
    cells = F.arrays_zip(names.alias("term"), vector_to_array(column).alias("score"))
    # Zeros go before the rows are multiplied.
    found = scored.select(id_col, F.explode_outer(F.filter(cells, lambda c: c["score"] > 0)).alias("_c"))
    return found.where(F.col("_c").isNotNull()).select(id_col, "_c.term", "_c.score")
