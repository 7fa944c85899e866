"""Mixing sources to target weights by weighted fair queueing.

Every document, in a shuffled order within its source, gets a virtual finish
time: the tokens of its source up to and including it, divided by the source's
target. Serving documents by finish time keeps all sources in proportion to
their targets, and the service stops when the budget is spent. A source whose
target exceeds its tokens is queued again. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.keys import with_row_id
from ..session import materialise
from .common import WORD, prepare

WEIGHTS = (3.0, 1.0, 2.0)
EPOCHS = 2
# Leading hex digits of the shuffle key that cut each source's queue into
# stretches; positions are summed by stretch, so no task orders a whole source.
STRETCH_DIGITS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_key(source: Column) -> Column:
    """Sorts like the source by code point, with null last."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("t"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget_share: float = 1.5, cap: float = EPOCHS
) -> tuple[DataFrame, int]:
    """``_s, source_size`` to ``_s, source_size, target``, and the budget.

    The weights repeat over the sources in the order of ``_s``. The budget,
    ``budget_share`` of all sizes, is dealt by weight; targets above ``cap``
    times a source's size are set to that and the excess is dealt again, until
    none is above. Each round is one aggregate of the source table; the driver
    holds the water level (budget per unit of weight) only.
    """
    ranked = with_row_id(sizes, "_rank", ["_s"], start=0)
    turn = (F.col("_rank") % len(weights) + 1).cast("int")
    table = materialise(
        ranked.select(
            "_s",
            "source_size",
            F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("_w"),
            (F.col("source_size") * float(cap)).alias("_cap"),
        ),
        "mix-targets",
    )
    total, open_weight = table.agg(F.sum("source_size"), F.sum("_w")).first()
    budget = (total or 0) * budget_share
    level, held = (budget / open_weight if open_weight else 0.0), 0
    while True:
        above = F.col("_cap") < F.col("_w") * level
        n, capped, left = table.agg(
            F.sum(above.cast("long")),
            F.sum(F.when(above, F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("_w"))),
        ).first()
        if not n or n == held or not left:
            break
        held, level = n, (budget - capped) / left
    targets = table.select("_s", "source_size", F.least("_cap", F.col("_w") * level).alias("target"))
    return targets, int(budget)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget_share: float = 1.5,
    cap: int = EPOCHS,
    seed: int = 9,
    size: Column | None = None,
) -> DataFrame:
    """All rows of ``docs`` with ``size``, ``source_size``, ``target``, ``taken``.

    ``size`` is the number of words of ``text`` (null: 0) unless another column
    is given; ``taken`` counts the words that the mix takes of the row, repeats
    included, at most ``cap`` times its size. The sum of ``taken`` is the whole
    part of the budget. A row that crosses the target of its source is served in
    two pieces, so a row may be taken in part.
    Columns of ``docs`` with these names are replaced (names that start with
    ``_mix`` too), others pass through. Rows with a null source form one source
    of their own. The order is by a hash of the id, then by size; rows that
    agree in id, source and size are interchangeable, so reruns agree. An empty
    table gives an empty result, rows without words have ``taken`` 0.

    The rows are written once with a number each; what is shuffled after that
    are numbers and sizes. Positions in a queue come from sums by source and
    stretch of the shuffle key, which spreads a hot source. The global order is
    a range partitioning by finish time: whole partitions before the end of the
    budget need their sum only, and one partition is ordered inside.
    """
    prepare(docs.sparkSession)
    measured = F.coalesce(size, F.lit(0)).cast("long") if size is not None else word_count()
    results = ("size", "source_size", "target", "taken")
    rows = docs.withColumn("_mix_size", measured).drop(*results)
    rows = materialise(rows.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-rows")
    queue = rows.select(
        "_mix_row",
        source_key(F.col("source")).alias("_s"),
        F.col("_mix_size").alias("size"),
        shuffle_key(F.col("doc_id"), seed).alias("_key"),
    ).withColumn("_stretch", F.substring("_key", 1, STRETCH_DIGITS))

    sums = materialise(queue.groupBy("_s", "_stretch").agg(F.sum("size").alias("_sum")), "mix-stretches")
    targets, budget = source_targets(
        sums.groupBy("_s").agg(F.sum("_sum").alias("source_size")), weights, budget_share, cap
    )
    earlier = Window.partitionBy("_s").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_s", "_stretch", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    starts = starts.join(targets, "_s")

    order = ("_key", "size", "_mix_row")
    so_far = Window.partitionBy("_s", "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = queue.join(starts, ["_s", "_stretch"]).withColumn("_end", F.col("_start") + F.sum("size").over(so_far))
    placed = materialise(placed.drop("_start", "_stretch"), "mix-queue")

    # A copy that crosses its source's target is queued as two pieces.
    last = F.col("_end") + F.col("_epoch") * F.col("source_size")
    first = last - F.col("size")
    goal = F.floor("target")
    inner = (first < goal) & (goal < last)
    pieces = F.array(
        F.struct(F.when(inner, goal - first).otherwise(F.col("size")).alias("n"), F.when(inner, goal).otherwise(last).alias("at")),
        F.struct(F.when(inner, last - goal).otherwise(0).alias("n"), last.alias("at")),
    )
    copies = (
        placed.filter("size > 0")
        .withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(int(cap) - 1))))
        .select("_mix_row", "_key", "target", F.inline(pieces))
        .filter("n > 0")
        .select("_mix_row", "_key", F.col("n").alias("size"), (F.col("at") / F.col("target")).alias("_finish"))
    )
    taken = _serve(copies, budget, ("_finish", *order)).groupBy("_mix_row").agg(F.sum("_part_taken").alias("taken"))
    placed = placed.select("_mix_row", "source_size", "target").join(taken, "_mix_row", "left")
    return (
        rows.join(placed, "_mix_row")
        .withColumn("taken", F.coalesce("taken", F.lit(0)))
        .withColumnRenamed("_mix_size", "size")
        .drop("_mix_row")
    )


def _serve(copies: DataFrame, budget: int, order: Sequence[str]) -> DataFrame:
    """Copies served in ``order`` until ``budget`` words are spent, with the words taken of each."""
    ranged = materialise(
        copies.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-ranges"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(F.sum("size").alias("_all"))
    # One row per range partition.
    bases = parts.select("_part", "_all", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_base"))
    served = ranged.join(F.broadcast(bases.filter(F.col("_base") < budget)), "_part")
    whole = F.col("_base") + F.col("_all") <= budget
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_base") + F.sum("size").over(inside)
    last = served.filter(~whole).withColumn("_end", end)
    return served.filter(whole).select("_mix_row", F.col("size").alias("_part_taken")).unionByName(
        last.select(
            "_mix_row",
            F.greatest(F.lit(0), F.least("size", F.lit(budget) - F.col("_end") + F.col("size"))).alias("_part_taken"),
        )
    )
