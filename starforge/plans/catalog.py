"""Named tables that are built once and read from Parquet afterwards."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import star_query, within
from ..operators.ranking import rank_groups
from ..session import path_exists
from ..sources.writers import write_json, write_parquet

Builder = Callable[["Catalog"], DataFrame]


@dataclass(frozen=True)
class Period:
    """A part of a calendar (``only``) and the columns by which the fact is
    partitioned, each with the calendar's column of the same values."""

    table: str
    columns: Mapping[str, str]
    only: Callable[[], Column]


@dataclass(frozen=True)
class Question:
    """A business question: measures of a fact by columns of its dimensions.

    ``dims`` holds (table, key, "inner" | "left"), the key being called the same
    in the fact. ``derived`` adds columns to the fact and ``only`` limits its
    rows; both are made when asked, since columns need a session. With ``rank``
    the groups are ranked by ``rank_by`` (default: the first measure), and the
    answer is ordered by rank and groups; otherwise by ``order_by``.
    """

    text: str
    fact: str
    dims: tuple[tuple[str, str, str], ...]
    group_by: Mapping[str, str]
    measures: Mapping[str, tuple[str, str]]
    rank: str | None = None
    rank_by: str | None = None
    dense: bool = False
    order_by: tuple[str, ...] = ()
    hidden: tuple[str, ...] = ()
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    only: Callable[[], Column] | None = None

    @property
    def tables(self) -> tuple[str, ...]:
        return (self.fact, *[table for table, _, _ in self.dims])

    def groups(self, tables: Mapping[str, DataFrame], period: Period | None = None) -> DataFrame:
        """The rows of the answer in no order, hidden columns included; with
        ``period`` only the fact's folders of that part of the calendar are read."""
        fact = tables[self.fact]
        if period is not None:
            fact = within(fact, tables[period.table].where(period.only()), period.columns)
        if self.only is not None:
            fact = fact.where(self.only())
        fact = fact.withColumns({name: make() for name, make in self.derived.items()})
        dims = [(tables[table], key, key, how) for table, key, how in self.dims]
        found = star_query(fact, dims, self.group_by, self.measures)
        if self.rank is None:
            return found
        return rank_groups(found, self.rank_by or next(iter(self.measures)), self.rank, self.dense)

    def answer(self, tables: Mapping[str, DataFrame], period: Period | None = None) -> DataFrame:
        """The ordered answer."""
        order = self.order_by if self.rank is None else (self.rank, *self.group_by)
        return self.groups(tables, period).orderBy(*order).drop(*self.hidden)

    def as_rows(self, tables: Mapping[str, DataFrame], name: str, period: Period | None = None) -> DataFrame:
        """The answer as ``question, rank, row``: rank null where none is asked for,
        the other columns as a JSON text."""
        found = self.groups(tables, period).drop(*self.hidden)
        rank = F.lit(None) if self.rank is None else F.col(self.rank)
        shown = [c for c in found.columns if c != self.rank]
        row = F.to_json(F.struct(*shown), {"ignoreNullFields": "false"})
        return found.select(F.lit(name).alias("question"), rank.cast("int").alias("rank"), row.alias("row"))


@dataclass
class _Entry:
    builder: Builder
    partition_by: tuple[str, ...]
    dealt: bool = False
    lock: Lock = field(default_factory=Lock)


@dataclass
class Catalog:
    """Tables below ``root``, each produced by a builder that may ask for others.

    ``get`` returns a scan of the stored Parquet. A table is stored when its
    folder carries the success marker, so a half-written one is built again.
    """

    spark: SparkSession
    root: str
    _entries: dict[str, _Entry] = field(default_factory=dict)
    _open: dict[str, DataFrame] = field(default_factory=dict)

    def add(
        self, name: str, builder: Builder, partition_by: Sequence[str] = (), dealt: bool = False
    ) -> "Catalog":
        """Declare a table; ``dealt``: the builder's rows are with their partition already."""
        self._entries[name] = _Entry(builder, tuple(partition_by), dealt)
        return self

    def names(self) -> list[str]:
        return list(self._entries)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def is_stored(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.path(name)}/_SUCCESS")

    def get(self, name: str) -> DataFrame:
        if name not in self._entries:
            raise KeyError(f"no table {name!r} in this catalog")
        entry = self._entries[name]
        with entry.lock:  # builders form no cycles, so waiting for a dependency ends
            if name not in self._open:
                if not self.is_stored(name):
                    write_parquet(entry.builder(self), self.path(name), entry.partition_by, dealt=entry.dealt)
                self._open[name] = self.spark.read.parquet(self.path(name))
            return self._open[name]

    def build(self, *names: str) -> dict[str, DataFrame]:
        """Several tables at once; those that do not depend on each other run as
        concurrent Spark jobs."""
        with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
            return dict(zip(names, pool.map(self.get, names)))

    def answer(self, question: Question, export_to: str | None = None, period: Period | None = None) -> DataFrame:
        """The ordered answer, built on the needed tables; export as JSON lines."""
        calendar = [period.table] if period is not None else []
        result = question.answer(self.build(*dict.fromkeys([*question.tables, *calendar])), period)
        if export_to is not None:
            write_json(result, export_to)
        return result

    def answers(self, questions: Mapping[str, Question], period: Period | None = None) -> DataFrame:
        """Several answers from one set of tables: ``question, rank, row``.

        Every table is built once, and the answers are worked out as concurrent
        jobs over what was stored.
        """
        calendar = [period.table] if period is not None else []
        names = dict.fromkeys([table for q in questions.values() for table in q.tables] + calendar)
        tables = self.build(*names)
        with ThreadPoolExecutor(max_workers=max(1, len(questions))) as pool:
            parts = pool.map(lambda item: item[1].as_rows(tables, item[0], period), questions.items())
            return reduce(DataFrame.unionByName, parts)
