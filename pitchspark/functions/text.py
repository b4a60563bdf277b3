"""Keys and labels derived from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchspark.functions.money import strip_ws

# Season suffixes removed from a league file stem (P5).
LEAGUE_STEM_NOISE = [".csv", "_25_26", "_2026", "_2025"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_key(col: str | Column) -> Column:
    """Lower-case and strip surrounding whitespace."""
    return F.lower(strip_ws(col))


def title_case(col: str | Column) -> Column:
    """Python ``str.title()`` (P3): a capital after any non-letter.

    ``initcap`` alone gives ``D'ivoire``; splitting into letter runs and
    non-letter runs and capitalising each letter run matches Python.
    """
    runs = F.regexp_extract_all(_col(col), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda t: F.initcap(t)), "")


def label_from_stem(col: str | Column, suffix: str = ".csv") -> Column:
    """Entity label from a file name (P4): drop suffix, capitalise, ``_`` -> space."""
    stem = F.replace(_col(col), F.lit(suffix), F.lit(""))
    cap = F.concat(F.upper(F.substring(stem, 1, 1)), F.lower(F.substring(stem, 2, 1 << 30)))
    return F.replace(cap, F.lit("_"), F.lit(" "))


def league_key(col: str | Column) -> Column:
    """League key from a file name (P5): season tokens removed anywhere."""
    c = _col(col)
    for token in LEAGUE_STEM_NOISE:
        c = F.replace(c, F.lit(token), F.lit(""))
    return c
