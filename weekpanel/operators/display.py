"""Tables as shown and exported: chosen columns, readable headers, formatted numbers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekpanel.functions.casts import plain, signed

# Headers of the shown columns, in their order.
MOVERS = {
    "name": "Show",
    "last_interest": "Latest interest",
    "predicted_t+1": "Forecast (t+1)",
    "delta_t+1": "Net change (t+1)",
}
OVERVIEW = {"rank_popularity": "Popularity rank", **MOVERS}
KEYWORD_LIFT = {
    "keyword_readable": "Keyword",
    "coverage_%": "Coverage (%)",
    "mean_interest_present": "Mean interest (keyword present)",
    "mean_interest_absent": "Mean interest (keyword absent)",
    "lift_present_minus_absent": "Lift (present − absent)",
}
KEYWORD_COVERAGE = {
    "keyword_readable": "Keyword",
    "coverage_%": "Coverage (%)",
    "mean_interest_present": "Mean interest (present)",
}
# Digits of the shown numbers, and which show their sign.
DIGITS = {
    "last_interest": 1,
    "predicted_t+1": 1,
    "delta_t+1": 1,
    "coverage_%": 1,
    "mean_interest_present": 2,
    "mean_interest_absent": 2,
    "lift_present_minus_absent": 2,
}
SIGNED = ("delta_t+1", "lift_present_minus_absent")
NO_VALUE = "—"


def renamed(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Only the labelled columns, under their headers."""
    return df.select(*[F.col(f"`{c}`").alias(label) for c, label in labels.items()])


def _text(column: str) -> Column:
    c = F.col(f"`{column}`")
    if column not in DIGITS:
        return c
    shown = (signed if column in SIGNED else plain)(c, DIGITS[column])
    return F.when(c.isNull(), NO_VALUE).otherwise(shown)


def formatted(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """As ``renamed``, numbers as text."""
    return df.select(*[_text(c).alias(label) for c, label in labels.items()])
