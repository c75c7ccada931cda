"""Keep one row per key. Both forms combine map-side, so a hot key costs one row per input task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None, last: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    # Of the first rows, a missing order value comes last.
    ordered = [F.col(f"`{c}`") if last else F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in order or ()]
    by = F.struct(*ordered, row) if order else row
    chosen = (F.max if last else F.min)(by).alias("_row")
    picked = df.groupBy(*keys).agg(chosen)
    source = f"_row.col{len(order) + 1}" if order else "_row"
    cols = [F.col(f"`{c}`") if c in keys else F.col(f"{source}.`{c}`").alias(c) for c in df.columns]
    return picked.select(*cols)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The first row of every key by ``order``; ties, or no order, go to the smallest row."""
    return _pick(df, keys, order, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The last row of every key by ``order``; ties, or no order, go to the largest row."""
    return _pick(df, keys, order, last=True)


def dedupe_first(df: DataFrame, key: str, order: str, limit: int | None = None) -> DataFrame:
    """First-seen row of every key, and of those the first ``limit`` in ``order``."""
    kept = keep_first(df, [key], [order])
    return kept.orderBy(order, key).limit(limit) if limit is not None else kept
