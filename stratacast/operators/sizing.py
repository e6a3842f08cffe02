"""Broadcast decisions that rest on a measured size."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratacast.session import materialize

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = 16  # generous bound for one number, date or timestamp


def _total_bytes(df: DataFrame) -> Column:
    """Size of a flat frame of scalar columns, as an aggregate."""
    width = F.lit(_FIXED_WIDTH * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes")


def measured_bytes(df: DataFrame) -> int:
    return df.agg(_total_bytes(df)).first()["bytes"]


def broadcast_if_small(df: DataFrame, size: int | None = None) -> DataFrame:
    """Hint a broadcast once the measured size allows it.

    Larger frames come back unhinted; the join is then a shuffle join, where
    adaptive execution splits skewed partitions.
    """
    size = measured_bytes(df) if size is None else size
    return F.broadcast(df) if size <= MAX_BROADCAST_BYTES else df


def materialize_sized(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A written frame and its size, measured by the job that writes it."""
    size = Observation(name)
    written = materialize(df.observe(size, _total_bytes(df)), name)
    return written, size.get["bytes"]
