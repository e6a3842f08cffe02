"""Row-frame windows over long series, split so that no entity is one task."""

from collections.abc import Callable

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK_DAYS = 1461


def over_series(
    df: DataFrame,
    entity: str,
    day: str,
    back: int,
    ahead: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Apply window expressions that look ``back`` and ``ahead`` rows.

    The result equals a window over the whole series of each entity, but the
    unit of work is (entity, block of ``chunk_days`` calendar days): with one
    row per entity and day a task's group has at most ``chunk_days`` rows plus
    the borrowed ones. Rows, not days, are borrowed: each block receives the
    last ``back`` rows before it and the first ``ahead`` rows after it, from
    however many blocks away, so gaps in the calendar change nothing.

    The series is shuffled once: borrowed rows come from the same exchange.
    They are whole rows, so whatever columns a reader drops are pruned from
    both sides alike and the exchange stays shared.
    """
    block = F.floor(F.unix_date(day) / F.lit(chunk_days)).cast("int")
    blocks = df.withColumn("_block", block).repartition(entity, "_block")
    borrowed = _borrowed_rows(blocks, entity, day, back, ahead)
    rows = blocks.withColumn("_own", F.lit(True)).unionByName(
        borrowed.withColumn("_own", F.lit(False))
    )
    in_order = W.partitionBy(entity, "_block").orderBy(day)
    return compute(rows, in_order).filter("_own").drop("_block", "_own")


def _borrowed_rows(
    blocks: DataFrame, entity: str, day: str, back: int, ahead: int
) -> DataFrame:
    """Rows near the edges of their block, once per other block that needs them."""
    whole = W.partitionBy(entity, "_block")
    edges = blocks.withColumns(
        {
            "_earlier": F.row_number().over(whole.orderBy(day)) - 1,
            "_size": F.count(F.lit(1)).over(whole),
        }
    ).filter((F.col("_earlier") < ahead) | (F.col("_size") - F.col("_earlier") <= back))
    # Blocks are never empty, so `back` and `ahead` neighbours are enough.
    ranked = edges.withColumn(
        "_rank", F.dense_rank().over(W.partitionBy(entity).orderBy("_block"))
    )
    by_rank = W.partitionBy(entity).orderBy("_rank")
    neighbour = F.collect_set(F.struct("_block", "_size"))
    reached = ranked.withColumns(
        {
            "_next": F.array_sort(neighbour.over(by_rank.rangeBetween(1, back))),
            "_previous": F.reverse(
                F.array_sort(neighbour.over(by_rank.rangeBetween(-ahead, -1)))
            ),
        }
    )
    # A neighbour needs the row if fewer rows than it looks at lie in between.
    between = "aggregate(slice({0}, 1, i), 0L, (rows, b) -> rows + b._size)"
    needing = f"""concat(
        filter(_next, (x, i) -> _size - _earlier - 1 + {between.format("_next")} < {back}),
        filter(_previous, (x, i) -> _earlier + {between.format("_previous")} < {ahead}))"""
    return (
        reached.withColumn("_block", F.explode(F.expr(f"{needing}._block")))
        .select(*blocks.columns)
        .repartition(entity, "_block")
    )
