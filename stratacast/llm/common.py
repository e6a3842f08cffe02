"""What the operators share: tables, ids, distributed ranks and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

# Stands for a null id inside the operators: it sorts last and joins with itself.
NULL_ID = (1 << 63) - 1
# Most bytes of an Arrow batch of texts. A batch is held several times over, by the Python
# worker and outside the executor's heap, and neither gives all of it back.
ARROW_BYTES = 1 << 22
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def known_id(name: str) -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NULL_ID))


def given_id(name: str) -> Column:
    return F.when(F.col(name) != NULL_ID, F.col(name))


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside send texts to Python in batches of ARROW_BYTES."""
    before = spark.conf.get(_ARROW_BYTES, None)
    spark.conf.set(_ARROW_BYTES, str(ARROW_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ARROW_BYTES)
        else:
            spark.conf.set(_ARROW_BYTES, before)


def written_by_python(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for a frame that texts pass through Python for."""
    with small_batches(df.sparkSession):
        return materialize(df, name)


def ranked(rows: DataFrame, keys: list[str], order: list[str], rank: str) -> DataFrame:
    """Position from 0 of each row among the rows of its keys, ordered by ``order``.

    ``rows`` should be thin and cheap to read twice. They are dealt out by range of
    (keys, order), so a key with any share of the rows spreads over many tasks; a
    second, small table (one row per key and task) tells how many came before.
    Keys must not be null; rows that tie in every order column rank arbitrarily.
    """
    by = [*keys, *order]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    dealt = materialize(
        dealt.withColumn("_part", F.spark_partition_id()).withColumn(
            "_at", F.monotonically_increasing_id()
        ),
        "ranked",
    )
    runs = dealt.groupBy(*keys, "_part").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first")
    )
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    shift = runs.select(*keys, "_part", (before - F.col("_first")).alias("_shift"))
    shift = broadcast_if_small(*materialize_sized(shift, "shift"))
    return (
        dealt.join(shift, [*keys, "_part"])
        .withColumn(rank, F.col("_at") + F.col("_shift"))
        .drop("_part", "_at", "_shift")
    )


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): node and its smallest member.

    Alternates large stars (each node's larger neighbours move to its smallest one)
    and small stars (so do its smaller ones) until nothing changes. Each round is
    written, so lost executors cost one round; only a count and a sum of hashes reach
    the driver. Nodes without an edge to another node are absent.
    """
    now = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), "m")
        large = large.where("a <> m").distinct()
        # now a > m in every row
        least = large.groupBy("a").agg(F.min("m").alias("s"))
        small = large.join(least, "a").select(F.col("m").alias("a"), F.col("s").alias("b"))
        small = small.union(least.select("a", F.col("s").alias("b")))
        now = materialize(small.where("a <> b").distinct(), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )
