"""Lines that do not fit their schema: marked by the readers, kept apart by the loads."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import discard, materialise
from .writers import write_parquet, write_text

BAD_LINE = "_bad_line"


def as_schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def marked(reader, schema: StructType | str):
    """A batch or stream reader whose rows have the text of a bad line in
    ``_bad_line``, null in good ones."""
    fields = [f for f in as_schema(schema).fields if f.name != BAD_LINE]
    whole = StructType([*fields, StructField(BAD_LINE, StringType())])
    return reader.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)


def failing(reader, schema: StructType | str):
    """A batch or stream reader that stops at a bad line, also if the query asks
    for few of the columns."""
    return reader.schema(schema).option("mode", "FAILFAST").option("columnPruning", False)


def is_marked(df: DataFrame) -> bool:
    return BAD_LINE in df.columns


def write_judged(judged: DataFrame, target: str, bad_records: str, mode: str) -> None:
    """Good rows to ``target`` as Parquet, bad lines to ``bad_records`` as text,
    both replaced or both added to.

    The judged rows are written once, so the source is read and parsed once for
    the two sinks. The bad lines go first: a load that dies between the two
    leaves rows out, not rejects.
    """
    with judged_once(judged) as (good, bad):
        write_text(bad, bad_records, mode=mode)
        write_parquet(good, target, mode=mode)


@contextmanager
def judged_once(judged: DataFrame):
    """Good rows and bad lines (column ``value``) of rows that are read once."""
    kept = materialise(judged, "judged-lines")
    good = kept.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    try:
        yield good, kept.where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("value"))
    finally:
        discard(kept)
