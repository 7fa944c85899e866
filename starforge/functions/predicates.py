"""Boolean and defaulting column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_blank(col: Column | str) -> Column:
    """Null, empty or only spaces. Safe for every type: 0 is not blank."""
    c = _c(col)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def not_in(col: Column | str, values: Iterable) -> Column:
    """Outside a literal domain. Null stays null, as in SQL."""
    return ~_c(col).isin(*list(values))


def clean_date(
    col: Column | str,
    lo: str | None = None,
    hi: str | None = None,
    not_before: Column | str | None = None,
    default: str = "1900-01-01",
) -> Column:
    """Replace a date by ``default`` when out of [lo, hi] or before another date."""
    c = _c(col).cast("date")
    sentinel = F.lit(default).cast("date")
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo).cast("date"))
    if hi is not None:
        bad = bad | (c > F.lit(hi).cast("date"))
    if not_before is not None:
        bad = bad | (_c(not_before).cast("date") > c)
    return F.when(bad, sentinel).otherwise(c)


def date_class(
    col: Column | str,
    lo: str | None = None,
    hi: str | None = None,
    not_before: Column | str | None = None,
) -> Column:
    """Name the first rule a date breaks: too_early, too_late, before_other or ok."""
    c = _c(col).cast("date")
    rules = []
    if lo is not None:
        rules.append((c < F.lit(lo).cast("date"), "too_early"))
    if hi is not None:
        rules.append((c > F.lit(hi).cast("date"), "too_late"))
    if not_before is not None:
        rules.append((_c(not_before).cast("date") > c, "before_other"))
    out = F.when(c.isNull(), F.lit("missing"))
    for condition, name in rules:
        out = out.when(condition, F.lit(name))
    return out.otherwise(F.lit("ok"))
