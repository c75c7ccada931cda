"""Tolerant casts, finite checks and other scalar helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c: Column | str) -> Column:
    """True for a real number, false for NULL, NaN and both infinities."""
    x = _col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def finite(c: Column | str) -> Column:
    """The value if it is a real number, else NULL."""
    x = _col(c)
    return F.when(is_finite(x), x)


def to_number(c: Column | str) -> Column:
    """Cast to double; what is no real number becomes NULL."""
    return finite(_col(c).try_cast("double"))


def to_id(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def to_date(c: Column | str) -> Column:
    """Cast to date; an impossible date becomes NULL."""
    return _col(c).try_cast("date")


def clean_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities to NULL in every floating-point column."""
    floats = {
        f.name: finite(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def fill_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Empty string for missing text, for those of ``columns`` the table has."""
    present = [c for c in columns if c in df.columns]
    return df.na.fill("", subset=present) if present else df


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> DataFrame:
    """Raise before any work starts if a needed column is absent."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} misses required columns: {missing}")
    return df


def clip(c: Column | str, low: float, high: float) -> Column:
    """Clip to [low, high]; NULL stays NULL, and what is no real number becomes NULL."""
    x = finite(c)
    return F.when(x < low, F.lit(float(low))).when(x > high, F.lit(float(high))).otherwise(x)


def direction(c: Column | str, up: str, down: str) -> Column:
    """Label a signed number; zero counts as up."""
    return F.when(_col(c) >= 0, F.lit(up)).otherwise(F.lit(down))


def signed(c: Column | str, digits: int = 1) -> Column:
    """Text with an explicit sign, such as ``+3.0``; halves go to the even digit."""
    return F.format_string(f"%+.{digits}f", F.bround(_col(c), digits))


def plain(c: Column | str, digits: int = 1) -> Column:
    """Text with a fixed number of digits; halves go to the even digit."""
    return F.format_string(f"%.{digits}f", F.bround(_col(c), digits))
