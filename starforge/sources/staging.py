"""Staging loads: JSON by field or path, dated folders, monthly slices."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from ..session import path_exists
from .readers import scan_csv, scan_json, scan_text
from .rejects import BAD_LINE, write_judged
from .writers import write_parquet

LOAD_MODES = ("truncate_load", "append_only")


def check_mode(mode: str) -> str:
    if mode not in LOAD_MODES:
        raise ValueError(f"load mode must be one of {LOAD_MODES}, got {mode!r}")
    return mode


# One step of a JSONPath: .name, [0], ['name'] or ["name"].
_STEP = re.compile(r"""\.([A-Za-z_][\w]*)|\[\s*(\d+)\s*\]|\[\s*'((?:[^'\\]|\\.)*)'\s*\]|\[\s*"((?:[^"\\]|\\.)*)"\s*\]""")
_ITEM = object()


def parse_json_path(path: str) -> list[str | int]:
    """Names and array positions of ``$.a.b``, ``$['a']["b"]``, ``$.a[0]``.

    Anything else (wildcards, filters, a bare ``$``) raises ``ValueError``."""
    if not path.startswith("$"):
        raise ValueError(f"a JSON path starts with $: {path!r}")
    steps: list[str | int] = []
    at = 1
    while at < len(path):
        found = _STEP.match(path, at)
        if not found:
            raise ValueError(f"not supported in a JSON path: {path[at:]!r} of {path!r}")
        name, position, single, double = found.groups()
        quoted = single if single is not None else double
        if position is not None:
            steps.append(int(position))
        else:
            steps.append(name if name is not None else re.sub(r"\\(.)", r"\1", quoted))
        at = found.end()
    if not steps or isinstance(steps[0], int):
        raise ValueError(f"a JSON path names a field first: {path!r}")
    return steps


def _path_column(steps: Sequence[str | int]) -> Column:
    column = F.col("`" + str(steps[0]).replace("`", "``") + "`")
    for step in steps[1:]:
        column = F.get(column, step) if isinstance(step, int) else column.getField(step)
    return column


def stage_json(
    spark: SparkSession,
    path: str | Sequence[str],
    target: str,
    schema: StructType | str | None = None,
    mapping: Mapping[str, tuple[str, str]] | None = None,
    mode: str = "truncate_load",
    bad_records: str | None = None,
) -> DataFrame:
    """Load JSON lines into a staging table and return its scan.

    Without ``mapping`` fields are taken by name from ``schema``. With it each
    target column is ``name: (json path, type)``, see ``parse_json_path``.

    A line that is no JSON, or whose values do not fit their types, stops the
    load. With ``bad_records`` such lines are written there as text instead, and
    all others are loaded; a load that appends adds to the rejects too.
    """
    check_mode(mode)
    if mapping is None:
        wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        fields = None
    else:
        steps = {name: parse_json_path(json_path) for name, (json_path, _) in mapping.items()}
        wanted = _schema_of(list(steps.values()))
        fields = {name: (_path_column(steps[name]), kind) for name, (_, kind) in mapping.items()}
    save = "overwrite" if mode == "truncate_load" else "append"
    if bad_records is None:
        rows = scan_json(spark, path, wanted, strict=True)
        staged = rows if fields is None else rows.select(*[c.cast(k).alias(n) for n, (c, k) in fields.items()])
        write_parquet(staged, target, mode=save)
        return spark.read.schema(staged.schema).parquet(target)
    if wanted is None:
        raise ValueError("bad_records needs a schema or a mapping")
    lines = scan_text(spark, path).where(F.trim("value") != "")
    parsed = F.from_json("value", wanted.add(BAD_LINE, "string"), {"columnNameOfCorruptRecord": BAD_LINE})
    rows = lines.select("value", parsed.alias("row")).select("value", "row.*")
    bad = F.col(BAD_LINE).isNotNull()
    for column, kind in (fields or {}).values():
        bad = bad | (column.isNotNull() & column.try_cast(kind).isNull())
    names = [f.name for f in wanted.fields if f.name != BAD_LINE]
    columns = {n: F.col(f"`{n}`") for n in names} if fields is None else {n: c.try_cast(k) for n, (c, k) in fields.items()}
    judged = rows.select(*[c.alias(n) for n, c in columns.items()], F.when(bad, F.col("value")).alias(BAD_LINE))
    write_judged(judged, target, bad_records, save)
    return spark.read.schema(judged.drop(BAD_LINE).schema).parquet(target)


def stage_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    target: str,
    schema: StructType | str,
    mode: str = "truncate_load",
    bad_records: str | None = None,
    **options,
) -> DataFrame:
    """Load CSV files with headers into a staging table and return its scan.

    A line that does not fit the schema stops the load before anything is
    loaded; with ``bad_records`` it is written there as text instead, replaced or
    added to as the load's mode says.
    """
    check_mode(mode)
    save = "overwrite" if mode == "truncate_load" else "append"
    if bad_records is None:
        write_parquet(scan_csv(spark, path, schema, strict=True, **options), target, mode=save)
    else:
        write_judged(scan_csv(spark, path, schema, mark_bad=True, **options), target, bad_records, save)
    return spark.read.schema(schema).parquet(target)


def _schema_of(paths: Sequence[Sequence[str | int]]) -> StructType:
    """Nested schema with a text leaf per path, so that a line is parsed once."""
    tree: dict = {}
    for steps in paths:
        node = tree
        for step in steps:
            node = node.setdefault(_ITEM if isinstance(step, int) else step, {})

    def build(node: dict) -> DataType:
        if not node:
            return StringType()
        if _ITEM in node:
            if len(node) > 1:
                raise ValueError("a JSON value is taken both as an array and as an object")
            return ArrayType(build(node[_ITEM]))
        return StructType([StructField(name, build(child)) for name, child in node.items()])

    for steps in paths:
        node = tree
        for step in steps:
            node = node[_ITEM if isinstance(step, int) else step]
        if node:
            raise ValueError(f"the JSON value at {list(steps)} is taken both whole and in parts")
    return build(tree)


def dated_paths(template: str, first: dt.date, last: dt.date) -> list[str]:
    """``template`` filled for every day of the inclusive range."""
    days = (last - first).days
    return [
        template.format(date=first + dt.timedelta(days=n), ds=(first + dt.timedelta(days=n)).isoformat())
        for n in range(days + 1)
    ]


def missing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    return [p for p in paths if not path_exists(spark, p)]


def stage_dates(
    spark: SparkSession,
    template: str,
    first: dt.date,
    last: dt.date,
    target: str,
    schema: StructType | str,
    mode: str = "append_only",
    allow_missing: bool = False,
) -> DataFrame:
    """Backfill: stage the dated paths as one multi-path scan.

    Days without input raise before anything is loaded. ``allow_missing`` loads
    the days that exist; ``missing_paths`` tells which those are not. Appending
    the same days again doubles their rows, as any append does.
    """
    check_mode(mode)
    paths = dated_paths(template, first, last)
    missing = missing_paths(spark, paths)
    if len(missing) == len(paths) or (missing and not allow_missing):
        raise FileNotFoundError(f"{len(missing)} of {len(paths)} days have no input, the first: {missing[0]}")
    gone = set(missing)
    return stage_json(spark, [p for p in paths if p not in gone], target, schema=schema, mode=mode)


def ingest_slices(
    spark: SparkSession,
    slices: Mapping[str, Callable[[], DataFrame]],
    target: str,
    partition_by: Sequence[str],
) -> list[str]:
    """Append named slices to one partitioned dataset; finished slices are skipped.

    Each slice lands in its own ``slice=<name>`` folder by one overwrite job, so
    a job that died half-way is redone whole and never doubles rows.
    """
    done = []
    for name, build in slices.items():
        folder = f"{target}/slice={name}"
        if path_exists(spark, f"{folder}/_SUCCESS"):
            continue
        write_parquet(build(), folder, partition_by=partition_by, mode="overwrite")
        done.append(name)
    return done
