"""Week, run and time-stamp helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weekpanel.functions.casts import _col

# Fixed value: what a run id made from a date starts with.
RUN_PREFIX = "airflow_"


def week_start(c: Column | str) -> Column:
    """Monday of the date's week."""
    return F.trunc(_col(c).cast("date"), "WEEK")


def run_id_for(run_id: Column | str, run_date: Column | str) -> Column:
    """The given run id, or one made from the run date."""
    made = F.concat(F.lit(RUN_PREFIX), F.date_format(_col(run_date), "yyyyMMdd"))
    return F.coalesce(F.nullif(_col(run_id), F.lit("")), made)


def weeks_after(week: Column | str, n: Column | int) -> Column:
    weeks = F.lit(n) if isinstance(n, int) else n
    return F.date_add(_col(week), (weeks * 7).cast("int"))


def utc_iso(ts: Column | str | None = None) -> Column:
    """``2026-01-04T20:56:12Z`` in UTC whatever the session's time zone."""
    t = F.current_timestamp() if ts is None else _col(ts)
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), t.cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
