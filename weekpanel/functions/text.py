"""Text helpers: lists inside strings, search terms, labels and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weekpanel.functions.casts import _col

# What counts as white space, and what a word is.
WHITE_SPACE = " \t\n\r\f\v"
WORD = r"[\p{L}\p{N}_]{2,}"


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def split_list(c: Column | str) -> Column:
    """Comma-separated text to a list of trimmed, non-empty items; missing text gives no items."""
    parts = F.split(F.coalesce(_col(c), F.lit("")), ",")
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def join_names(c: Column | str, field: str = "name") -> Column:
    """Array of structs to comma-separated text of one field."""
    names = F.transform(_col(c), lambda x: x[field])
    return F.coalesce(F.array_join(names, ","), F.lit(""))


def search_terms(name: Column | str, original_name: Column | str, networks: Column | str) -> Column:
    """Search phrases of a show, best first, without repeats; none when it has no name."""
    blank = F.lit("")
    base = strip(
        F.coalesce(F.nullif(_col(name), blank), F.nullif(_col(original_name), blank), blank)
    )
    network = F.get(split_list(networks), F.lit(0))
    phrases = F.array(
        F.concat(base, F.lit(" tv series")),
        F.concat(base, F.lit(" "), network),
        F.concat(base, F.lit(" "), network, F.lit(" tv series")),
    )
    return F.when(base == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.array_compact(phrases))
    )


def pretty_keyword(c: Column | str) -> Column:
    """``kw__dark_comedy`` to ``Dark comedy``."""
    bare = F.replace(F.replace(_col(c), F.lit("kw_"), F.lit("")), F.lit("KW_"), F.lit(""))
    spaced = strip(F.replace(bare, F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.left(spaced, F.lit(1))), F.substr(spaced, F.lit(2)))


def entity_label(name: Column | str, entity_id: Column | str) -> Column:
    return F.format_string("%s (id=%s)", F.coalesce(_col(name), F.lit("(unknown)")), _col(entity_id))


def label_id(label: Column | str) -> Column:
    """The id inside an entity label, NULL when there is none."""
    return F.regexp_extract(_col(label), r"id=([0-9]+)\)*$", 1).try_cast("bigint")


def run_label(created: Column | str, run_id: Column | str, week: Column | str) -> Column:
    return F.concat(
        _col(created), F.lit(" • "), _col(run_id), F.lit(" • week="), F.coalesce(_col(week), F.lit(""))
    )


def run_label_id(label: Column | str) -> Column:
    return strip(F.get(F.split(_col(label), "•"), F.lit(1)))


def tokens(c: Column | str) -> Column:
    """Lower-cased words of two or more word characters, in text order."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit(WORD), F.lit(0))
