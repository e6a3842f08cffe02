"""Shards of equal row counts along a Hilbert curve through metadata dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField

from stratacast.llm.common import given_id, known_id, ranked, table, text_of
from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.session import materialize

SHARDS = 8
# Each dimension is cut into 2**BITS cells that hold about equally many rows.
BITS = 5
DIMENSIONS = ("source", "lang", "n_chars")


def _rotate(x: int, by: int, n: int) -> int:
    by %= n
    return ((x << by) | (x >> (n - by))) & ((1 << n) - 1)


def curve_table(n: int) -> list[int]:
    """Step of the curve in ``n`` dimensions: state and corner to digit and next state.

    A state is where the curve enters a cell and along which axis it leaves; entry
    ``state * 2**n + corner`` holds ``digit * states + next state``.
    """
    states = n << n
    made = []
    for state in range(states):
        enter, axis = state // n, state % n
        for corner in range(1 << n):
            gray = _rotate(corner ^ enter, n - axis - 1, n)
            digit = gray
            for shift in range(1, n):
                digit ^= gray >> shift
            base = 2 * ((digit - 1) // 2) if digit else 0
            ones = digit if digit % 2 else max(digit - 1, 0)
            turn = ((~ones & (ones + 1)).bit_length() - 1) % n
            new_enter = enter ^ _rotate(base ^ (base >> 1), axis + 1, n)
            made.append(digit * states + new_enter * n + (axis + turn + 1) % n)
    return made


def with_curve_index(rows: DataFrame, cells: list[str], bits: int, name: str) -> DataFrame:
    """Adds the Hilbert index of integer columns ``cells``, each of ``bits`` bits."""
    n = len(cells)
    states = n << n
    steps = F.array(*[F.lit(v) for v in curve_table(n)])
    rows = rows.withColumns({"_at": F.lit(0).cast("long"), "_state": F.lit(0)})
    for bit in reversed(range(bits)):
        corner = F.lit(0)
        for k, c in enumerate(cells):
            one = F.shiftright(F.col(c), bit).bitwiseAND(F.lit(1))
            corner = corner + one * (1 << k)
        rows = rows.withColumn(
            "_step", F.element_at(steps, (F.col("_state") * (1 << n) + corner + 1).cast("int"))
        )
        rows = rows.withColumns(
            {
                "_at": F.col("_at") * (1 << n) + F.floor(F.col("_step") / states),
                "_state": F.pmod("_step", F.lit(states)),
            }
        )
    return rows.withColumnRenamed("_at", name).drop("_state", "_step")


def _ordered(field: StructField) -> Column:
    """A number that orders a column: itself, or the first seven bytes of its text."""
    if isinstance(field.dataType, NumericType):
        number = F.col(f"`{field.name}`").cast("double")
        return F.when(~F.isnan(number), number)
    start = F.substring(F.encode(F.col(f"`{field.name}`").cast("string"), "utf-8"), 1, 7)
    return F.conv(F.hex(F.rpad(start, 7, F.lit(b"\x00"))), 16, 10).cast("double")


def with_cells(rows: DataFrame, dimensions: tuple[str, ...], bits: int) -> DataFrame:
    """Adds ``_cell0``, ... : each dimension's equal-depth cell; null is in the first.

    The edges are quantiles over all rows, 2**bits - 1 numbers a dimension.
    """
    own = {f"_d{k}": _ordered(rows.schema[d]) for k, d in enumerate(dimensions)}
    rows = rows.withColumns(own)
    cuts = F.array(*[F.lit(k / (1 << bits)) for k in range(1, 1 << bits)])
    edges = rows.agg(*[F.percentile_approx(d, cuts, 10_000).alias(d) for d in own]).first()
    cells = {}
    for k, d in enumerate(own):
        cell = F.lit(0)
        for edge in sorted(set(edges[d] or ())):
            weight = list(edges[d]).count(edge)
            cell = cell + F.when(F.col(d) >= edge, weight).otherwise(0)
        cells[f"_cell{k}"] = cell
    return rows.withColumns(cells).drop(*own)


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    dimensions: tuple[str, ...] = DIMENSIONS,
    bits: int = BITS,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Cuts the curve through ``dimensions`` into runs of rows, one per shard.

    Returns one row per input row: doc_id, size (UTF-8 bytes of the text plus 1),
    text_crc32, law (``rows``: counts differ by one at most), shard, slot (gapless from 0
    along the curve), grown_shard (null under this law) and curve, the index. Rows near
    each other in all dimensions lie near each other on the curve, so a file holds
    narrow ranges of several columns at once and readers can skip it by either.

    Null texts count as empty; a null dimension lies in the first cell, null ids sort
    last. Repeated rows are placed one by one. Other columns are ignored.
    """
    thin = docs.select(
        known_id(id).alias("_id"),
        (F.octet_length(text_of(text)) + F.lit(1).cast("long")).cast("long").alias("size"),
        F.crc32(F.encode(text_of(text), "utf-8")).alias("text_crc32"),
        *[F.col(d).alias(f"dim{k}") for k, d in enumerate(dimensions)],
    )
    thin = materialize(thin, "metadata")
    names = tuple(f"dim{k}" for k in range(len(dimensions)))
    placed = with_curve_index(
        with_cells(thin, names, bits), [f"_cell{k}" for k in range(len(names))], bits, "curve"
    )
    placed = placed.select("_id", "size", "text_crc32", "curve")
    total = max(thin.count(), 1)
    ranks = ranked(placed, [], ["curve", "text_crc32", "_id"], "_rank")
    # In whole numbers: shard s begins at the ceiling of s * total / shards.
    shard = F.expr(f"(_rank * {shards}L) div {total}L")
    begin = F.expr(f"(_shard * {total}L + {shards - 1}L) div {shards}L")
    return ranks.withColumn("_shard", shard).select(
        given_id("_id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_rank") - begin).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id: str = "doc_id") -> DataFrame:
    """Writes the documents as one folder per shard, in curve order; ids must be unique.

    Returns what each shard holds: rows, bytes and the range of the curve.
    """
    own = assigned.select(F.col("doc_id").alias("_id"), "shard", "slot")
    own = broadcast_if_small(*materialize_sized(own, "shards"))
    rows = docs.join(own, docs[id].eqNullSafe(own["_id"])).drop("_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").drop(
        "slot"
    ).write.partitionBy("shard").parquet(path)
    return assigned.groupBy("shard").agg(
        F.count("*").alias("rows"),
        F.sum("size").alias("bytes"),
        F.min("curve").alias("first_curve"),
        F.max("curve").alias("last_curve"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))
