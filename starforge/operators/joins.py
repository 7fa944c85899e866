"""Lookup, enrichment, validation, anti and semi joins.

No join here carries an unconditional broadcast hint on data that can grow.
Catalyst compares a side's size with ``spark.sql.autoBroadcastJoinThreshold``
and AQE repeats the test with measured sizes; beyond it the join is sort-merge,
where AQE splits a hot partition. ``salts`` adds an explicit split of hot keys
for inputs where that is not enough.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Normalise = Callable[[Column], Column]
NULL_SPREAD = 4096


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first in the stated order, ties by the other columns.

    The smallest row per key is a partial aggregate: a hot key is reduced to one
    row per input task before the shuffle. Columns must be orderable (no maps).
    """
    return _pick(df, keys, order_by, columns, F.min)


def latest_by(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the last in the stated order, ties by the other columns."""
    return _pick(df, keys, order_by, columns, F.max)


def _pick(df, keys, order_by, columns, extreme) -> DataFrame:
    keys = list(keys)
    rest = [c for c in (columns or df.columns) if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    # One struct that starts with the order: every value is shuffled once.
    fields: dict[str, Column] = {}
    for i, o in enumerate(order_by):
        if isinstance(o, str) and o in rest:
            fields.setdefault(o, F.col(o))
        elif not (isinstance(o, str) and o in keys):
            fields[f"_o{i}"] = F.col(o) if isinstance(o, str) else o
    for c in rest:
        fields.setdefault(c, F.col(c))
    chosen = extreme(F.struct(*[col.alias(name) for name, col in fields.items()])).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: never more than 1/share of them."""
    floor = max(1, math.ceil(df.count() * share))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= floor).drop("_n")


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    order_by: Sequence[str] | None = None,
    normalise: Normalise | Mapping[str, Normalise] | None = None,
    unique: bool = False,
    salts: int | None = None,
    hot_share: float = 0.01,
) -> DataFrame:
    """Left lookup that never multiplies fact rows.

    ``on`` maps fact column to dim column, ``take`` maps new column to dim
    column. The dim is first reduced to one row per (normalised) key, the first
    in ``order_by`` (default: the taken columns). Unmatched rows get nulls.
    ``unique`` says that the key is the dim's primary key, which saves the
    reduction. ``salts`` splits the rows of keys that hold at least
    ``hot_share`` of the fact over that many partitions.
    """

    def norm(name: str, col: Column) -> Column:
        fn = normalise.get(name) if isinstance(normalise, Mapping) else normalise
        return fn(col) if fn else col

    key_names = [f"_k{i}" for i in range(len(on))]
    dim_keys = [norm(f, F.col(d)).alias(k) for k, (f, d) in zip(key_names, on.items())]
    taken = [f"_t_{new}" for new in take]
    carried = {d: f"_t_{new}" for new, d in take.items()}
    order = {d: carried.get(d, f"_by_{d}") for d in (order_by or take.values())}
    slim = dim.select(
        *dim_keys,
        *[F.col(d).alias(f"_t_{new}") for new, d in take.items()],
        *[F.col(d).alias(name) for d, name in order.items() if d not in carried],
    ).dropna(subset=key_names)
    slim = slim.select(*key_names, *taken) if unique else first_per_key(slim, key_names, list(order.values()), taken)

    keyed = fact.withColumns({k: norm(f, F.col(f)) for k, f in zip(key_names, on)})
    # Rows with a null key match nothing; a second key spreads them over all tasks.
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key_names])
    nowhere = F.pmod(F.xxhash64(*fact.columns), F.lit(NULL_SPREAD)).cast("int")
    keyed = keyed.withColumn("_spot", F.when(some_null, nowhere).otherwise(F.lit(0)))
    slim = slim.withColumn("_spot", F.lit(0))
    if salts:
        keyed, slim, join_on = _salted(keyed, slim, key_names, salts, hot_share)
    else:
        join_on = [*key_names, "_spot"]
    joined = keyed.join(slim, join_on, "left").withColumnsRenamed(
        {f"_t_{new}": new for new in take}
    )
    return joined.select(*[c for c in fact.columns if c not in take], *take)


def _salted(keyed: DataFrame, slim: DataFrame, keys: list[str], salts: int, share: float):
    """Split the rows of hot keys over ``salts`` buckets and copy their dim rows to each."""
    hot = hot_keys(keyed.select(*keys).dropna(), keys, share).withColumn("_hot", F.lit(True))
    marked = hot.withColumnsRenamed({k: f"{k}_h" for k in keys})
    pairs = [(k, f"{k}_h") for k in keys]
    helper = [f"{k}_h" for k in keys]
    # The hot list has at most 1/share rows, so it may be broadcast.
    spread = F.pmod(F.xxhash64(*keyed.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    left = (
        keyed.withColumn("_spread", spread)
        .join(F.broadcast(marked), _null_safe(keyed, marked, pairs), "left")
        .withColumn("_salt", F.when(F.col("_hot"), F.col("_spread")).otherwise(F.lit(0)))
        .drop("_hot", "_spread", *helper)
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = (
        slim.join(F.broadcast(marked), _null_safe(slim, marked, pairs), "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_hot", *helper)
    )
    return left, right, [*keys, "_spot", "_salt"]


def enrich(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    defaults: Mapping[str, object],
    **kwargs,
) -> DataFrame:
    """Lookup whose missing values become a sentinel."""
    out = lookup_join(df, dim, on, take, **kwargs)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def validate_fk(fact: DataFrame, dim: DataFrame, fk: str, pk: str, default) -> DataFrame:
    """Point unknown and null foreign keys at the default member."""
    allowed = dim.select(F.col(pk).alias(fk)).distinct().withColumn("_known", F.lit(True))
    joined = fact.join(allowed, fk, "left")
    known = F.when(F.col("_known"), F.col(fk)).otherwise(F.lit(default))
    return joined.withColumn(fk, known).drop("_known").select(*fact.columns)


def anti(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; null keys compare as equal.

    The right side is reduced to distinct keys first, so a hot key on that side
    costs one row per input task.
    """
    pairs = list(on.items()) if isinstance(on, Mapping) else [(c, c) for c in on]
    keys = right.select(*[F.col(r).alias(f"_a{i}") for i, (_, r) in enumerate(pairs)]).distinct()
    return left.join(keys, _null_safe(left, keys, [(l, f"_a{i}") for i, (l, _) in enumerate(pairs)]), "left_anti")


def referenced_only(dim: DataFrame, fact: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Distinct dim rows that the fact refers to, by semi join."""
    keys = fact.select(*[F.col(f).alias(d) for d, f in on.items()]).distinct()
    return dim.join(keys, list(on), "left_semi").distinct()


def backfill(df: DataFrame, source: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Replace columns by those of ``source``, matched by row id."""
    kept = df.drop(*columns)
    return kept.join(source.select(on, *columns), on, "inner").select(*df.columns, *[c for c in columns if c not in df.columns])


def within(fact: DataFrame, dim: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The fact rows whose partition columns (keys of ``columns``) occur in a
    filtered dim (its values), most often a calendar limited to a period.

    The join is on the columns that the fact is partitioned by, so its scan is
    pruned at run time: Spark reads the dim first and opens only the folders
    that match, provided the dim is small enough to be broadcast.
    """
    wanted = dim.select(*[F.col(c).alias(p) for p, c in columns.items()]).distinct()
    return fact.join(wanted, list(columns), "left_semi")


def star_query(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, str, str, str]],
    group_by: Mapping[str, str],
    measures: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Join a fact to dims and aggregate.

    ``dims`` holds (dim, fact key, dim key, "inner" | "left"), ``group_by`` maps
    output to column name, ``measures`` maps output to ("count" | "sum", column).
    Measures are additive, so the fact is aggregated by its foreign keys before
    it is joined: what is shuffled is one row per key combination and task,
    however many rows a hot key has.
    """
    dim_columns = {c for dim, *_ in dims for c in dim.columns}
    fact_keys = [fk for _, fk, _, _ in dims]
    fact_groups = [c for c in group_by.values() if c not in dim_columns and c not in fact_keys]
    partial = {
        out: (F.count(F.col(c)) if kind == "count" else F.sum(F.col(c))).alias(f"_m_{out}")
        for out, (kind, c) in measures.items()
    }
    reduced = fact.groupBy(*dict.fromkeys([*fact_keys, *fact_groups])).agg(*partial.values())
    for dim, fk, pk, how in dims:
        wanted = [c for c in dim.columns if c in group_by.values() or c == pk]
        slim = dim.select(*[F.col(c).alias(f"_pk_{fk}") if c == pk and c != fk else F.col(c) for c in wanted],
                          *([F.col(pk)] if pk != fk and pk in group_by.values() else []))
        if pk == fk:
            reduced = reduced.join(slim, fk, how)
        else:
            reduced = reduced.join(slim, F.col(fk) == F.col(f"_pk_{fk}"), how).drop(f"_pk_{fk}")
    return reduced.groupBy(*[F.col(c).alias(out) for out, c in group_by.items()]).agg(
        *[F.sum(f"_m_{out}").alias(out) for out in measures]
    )
