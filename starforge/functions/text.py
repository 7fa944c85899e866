"""Text extraction, rewriting and hashing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from .predicates import _c


def full_name(*cols: Column | str) -> Column:
    return F.concat_ws(" ", *[_c(c) for c in cols])


def lenient_int(col: Column | str) -> Column:
    """Cast that gives null for text that is not a number."""
    return _c(col).try_cast("int")


def hash_id(*cols: Column | str) -> Column:
    """Repeatable surrogate id: md5 of the values, each after its length.

    Needs no shuffle and gives the same id on every load. The lengths keep
    ``('a|b', 'c')`` and ``('a', 'b|c')`` apart; null is ``-``, which no value
    gives. The text of a timestamp depends on the session's time zone, so
    timestamps are refused: pass ``F.unix_micros(column)``.
    """
    return F.md5(F.concat(*[_sized(_c(c)) for c in cols]))


def _sized(col: Column) -> Column:
    text = col.cast("string")
    zoned = F.typeof(col) == "timestamp"
    refused = F.raise_error(F.lit("hash_id: pass unix_micros() of a timestamp")).cast("string")
    sized = F.concat(F.length(text).cast("string"), F.lit(":"), text)
    return F.when(zoned, refused).otherwise(F.coalesce(sized, F.lit("-")))


def row_json(*cols: Column | str) -> Column:
    return F.to_json(F.struct(*[_c(c) for c in cols]))


def extract_columns(
    df: DataFrame,
    source: str,
    pattern: str,
    columns: Mapping[str, tuple[int, str]],
    keep_unmatched: bool = False,
) -> DataFrame:
    """Split a text column into typed columns, one per regex group.

    Lines that miss the pattern are left out, see ``unmatched``.
    """
    matched = df if keep_unmatched else df.where(F.col(source).rlike(pattern))
    return matched.select(
        *[
            F.regexp_extract(source, pattern, group).try_cast(kind).alias(name)
            for name, (group, kind) in columns.items()
        ]
    )


def unmatched(df: DataFrame, source: str, pattern: str) -> DataFrame:
    """The lines that ``extract_columns`` leaves out, null ones too; count them to see what is lost."""
    return df.where(~F.coalesce(F.col(source).rlike(pattern), F.lit(False)))


def rewrite(df: DataFrame, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Apply ordered (column, pattern, replacement) rules in one projection."""
    current: dict[str, Column] = {}
    for name, pattern, replacement in rules:
        current[name] = F.regexp_replace(
            current.get(name, F.col(name)), F.lit(pattern), F.lit(replacement)
        )
    return df.withColumns(current)


@dataclass(frozen=True)
class Repair:
    """Set columns on the rows whose ``column`` matches ``pattern``, and on no others."""

    column: str
    pattern: str
    assign: Mapping[str, str] = field(default_factory=dict)


def repair(df: DataFrame, repairs: Sequence[Repair]) -> DataFrame:
    """First matching repair wins. All tests see the row as it was read."""
    targets = {name for r in repairs for name in r.assign}
    updates = {}
    for name in targets:
        branch = None
        for r in repairs:
            value = F.lit(r.assign[name]) if name in r.assign else F.col(name)
            hit = F.col(r.column).rlike(r.pattern)
            branch = F.when(hit, value) if branch is None else branch.when(hit, value)
        updates[name] = branch.otherwise(F.col(name))
    return df.withColumns(updates)


def drop_matching(df: DataFrame, column: str, patterns: Sequence[str]) -> DataFrame:
    """Remove rows whose text matches any of the patterns; null text is kept."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | F.col(column).rlike(pattern)
    return df.where(~F.coalesce(hit, F.lit(False)))
