"""Landed JSON documents to the entity list and the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weekpanel.functions.text import join_names
from weekpanel.schemas import DETAIL_DOC, LIST_PAGE

# Whose rating is preferred, and which crew job is counted.
RATING_COUNTRY = "US"
DIRECTOR = "Director"
_CORRUPT = "_malformed"
PLAIN_FIELDS = (
    "name", "original_name", "first_air_date", "last_air_date", "status", "type", "in_production",
    "number_of_seasons", "number_of_episodes",
)


def read_documents(spark: SparkSession, path: str, schema: str, *, multi_line: bool = False) -> DataFrame:
    """JSON documents, one per line or one per file; a malformed one is dropped.

    The text is parsed whole whatever columns are used later, so that the same documents are dropped each time.
    """
    return _parsed(spark, path, schema, multi_line).where(f"doc is not null and doc.{_CORRUPT} is null").select(
        *[F.col(f"doc.{f.name}") for f in StructType.fromDDL(schema).fields]
    )


def malformed(spark: SparkSession, path: str, schema: str, *, multi_line: bool = False) -> int:
    """How many documents ``read_documents`` drops."""
    return _parsed(spark, path, schema, multi_line).where(f"doc is null or doc.{_CORRUPT} is not null").count()


def _parsed(spark: SparkSession, path: str, schema: str, multi_line: bool) -> DataFrame:
    lines = spark.read.text(path, wholetext=multi_line).where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return lines.select(F.from_json("value", f"{schema}, {_CORRUPT} string", options).alias("doc"))


def read_list_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_documents(spark, path, LIST_PAGE, **options)


def read_details(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_documents(spark, path, DETAIL_DOC, **options)


def entity_list(pages: DataFrame) -> DataFrame:
    """One row per listed entity, countries as comma-separated text."""
    items = pages.select(F.explode("results").alias("r"))
    same = ("id", "name", "original_name", "first_air_date", "popularity", "vote_average", "vote_count")
    return items.select(
        *[F.col(f"r.{c}") for c in same],
        F.coalesce(F.array_join("r.origin_country", ","), F.lit("")).alias("origin_country"),
        F.col("r.original_language").alias("language"),
    )


def _mean(values: Column | str) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(values) > 0, total / F.nullif(F.size(values), F.lit(0)))


def _length(values: Column | str) -> Column:
    return F.coalesce(F.array_size(values), F.lit(0))


def _nameless(values: Column | str) -> Column:
    return F.coalesce(F.exists(values, lambda x: x["name"].isNull()), F.lit(False))


def flatten_details(docs: DataFrame) -> DataFrame:
    """Nested documents to catalog rows; documents without id or with unnamed list items are skipped."""
    lists = ("genres", "networks", "keywords.results")
    good = docs.where(F.col("id").isNotNull())
    for c in lists:
        good = good.where(~_nameless(c))
    ratings = "content_ratings.results"
    preferred = F.get(F.filter(ratings, lambda r: r["iso_3166_1"] == RATING_COUNTRY), F.lit(0))
    rating = F.when(preferred.isNotNull(), preferred["rating"]).otherwise(F.get(ratings, F.lit(0))["rating"])
    directors = F.filter("credits.crew", lambda c: c["job"] == DIRECTOR)
    return good.select(
        "id",
        *PLAIN_FIELDS,
        _mean("episode_run_time").alias("episode_run_time_mean"),
        "popularity",
        "vote_average",
        "vote_count",
        _length("credits.cast").alias("num_cast"),
        _length(directors).alias("num_directors"),
        join_names("keywords.results").alias("keywords"),
        rating.alias("certification"),
        F.col("external_ids.imdb_id").alias("imdb_id"),
        join_names("genres").alias("genres"),
        join_names("networks").alias("networks"),
        F.col("original_language").alias("language"),
    )
