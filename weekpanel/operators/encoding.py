"""Category codes, the feature contract and the numeric matrix."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekpanel.functions.casts import finite, to_number
from weekpanel.operators.panel import HORIZONS
from weekpanel.operators.ranking import global_rank
from weekpanel.session import broadcast_if_small, value_bytes

# Which columns are categories, and which never are features.
CATEGORY_COLUMNS = ("status", "type", "language", "certification")
NOT_FEATURES = (
    "id", "name", "original_name", "week_start", "label", "genres", "networks", "keywords",
    "imdb_id", "first_air_date", "last_air_date",
)
MISSING_NUMBER = -1.0
UNKNOWN_CODE = -1


def category_codes(df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS) -> DataFrame:
    """(column, value, code): the sorted distinct values of each column, numbered from 0."""
    present = [c for c in columns if c in df.columns]
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present]
    )
    values = (
        df.select(F.explode(entries).alias("_e"))
        .select("_e.column", "_e.value")
        .where(F.col("value").isNotNull())
        .distinct()
    )
    ranked = global_rank(values, [F.asc("column"), F.asc("value")], "_rank")
    # One row per category column.
    first = ranked.groupBy("column").agg(F.min("_rank").alias("_first"))
    return ranked.join(F.broadcast(first), "column").select(
        "column", "value", (F.col("_rank") - F.col("_first")).cast("int").alias("code")
    )


def _encode(df: DataFrame, codes: DataFrame, columns: Sequence[str], missing: dict[str, int]) -> DataFrame:
    counted = codes.groupBy("column").agg(F.count("*").alias("n"), value_bytes(codes).alias("size")).collect()
    sizes, n_bytes = {r["column"]: r["n"] for r in counted}, {r["column"]: r["size"] for r in counted}

    def one(acc: DataFrame, c: str) -> DataFrame:
        lookup = codes.where(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("code").alias("_code")
        )
        joined = acc.join(
            broadcast_if_small(lookup, n_bytes.get(c, 0)), F.col(c).cast("string") == F.col("_value"), "left"
        )
        code = F.coalesce("_code", F.lit(missing.get(c, sizes.get(c, 0))))
        return joined.withColumn(c, code).drop("_value", "_code")

    return reduce(one, [c for c in columns if c in df.columns], df)


def encode_train(df: DataFrame, codes: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS) -> DataFrame:
    """Training codes: missing or unseen values get the code after the last one."""
    return _encode(df, codes, columns, {})


def encode_serve(df: DataFrame, codes: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS) -> DataFrame:
    """Serving codes: missing or unseen values get -1."""
    return _encode(df, codes, columns, {c: UNKNOWN_CODE for c in columns})


def feature_columns(df: DataFrame, horizons: Sequence[int] = HORIZONS) -> list[str]:
    """Names of the numeric and boolean columns that are features, in table order."""
    excluded = {*NOT_FEATURES, *(f"interest_t+{h}" for h in horizons)}
    return [
        f.name
        for f in df.schema.fields
        if f.name not in excluded and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def missing_features(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Contract columns the table lacks."""
    return [n for n in names if n not in df.columns]


def contract_projection(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ("id",)) -> DataFrame:
    """Exactly the contract's columns in order, as doubles; absent or unusable values become 0."""
    zero = F.lit(0.0)

    def value(n: str):
        return F.coalesce(to_number(F.col(f"`{n}`")), zero) if n in df.columns else zero

    return df.select(*keep, *[value(n).alias(n) for n in names])


def encode_matrix(
    df: DataFrame,
    names: Sequence[str],
    keep: Sequence[str] = ("id",),
    codes: DataFrame | None = None,
    out: Sequence[str] | None = None,
) -> DataFrame:
    """The numeric matrix used for fitting and scoring: text to training codes, missing numbers to -1.

    ``codes`` are those of the training table; without them the table at hand is the training table.
    ``out`` renames the matrix columns.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    text = [n for n in names if isinstance(types[n], T.StringType)]
    if text:
        df = encode_train(df, category_codes(df, text) if codes is None else codes, text)
    missing = F.lit(MISSING_NUMBER)
    values = [
        F.coalesce(finite(F.col(f"`{n}`").cast("double")), missing).alias(o)
        for n, o in zip(names, out or names, strict=True)
    ]
    return df.select(*keep, *values)
