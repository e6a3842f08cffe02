"""Newest version per entity, with and without ties."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratacast.operators.sizing import broadcast_if_small, materialize_sized

# Before any version.
FIRST_DAY = date(1000, 1, 1)


def latest_snapshot(
    log: DataFrame, entity: str, version: str, version_day: str | None = None
) -> DataFrame:
    """All rows of each entity's newest version; rows tied on it all stay.

    The maximum per entity reads two columns only and is combined map-side. It
    is written once, then measured and joined back: while it is small the rows
    themselves (whole payloads) are not shuffled. ``version_day`` names a
    partition column holding the day of ``version``: it is then joined on as
    well, so that only days that are some entity's newest are read, also when
    an entity has had no version for long.
    """
    newest, size = materialize_sized(
        log.groupBy(entity).agg(F.max(version).alias(version)), "newest"
    )
    keys = [entity, version]
    if version_day is not None:
        # Spark prunes partitions by a joined side only if that side is filtered.
        day = F.to_date(version)
        newest = newest.withColumn(version_day, day).filter(day >= F.lit(FIRST_DAY))
        keys.append(version_day)
    joined = log.join(broadcast_if_small(newest, size), keys, "inner")
    return joined.select(*log.columns)


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], version: str, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Exactly one row per key, the one with the newest version.

    Spark keeps at most one row per key and map task before the shuffle
    (window group limit), so a hot key sends few rows to its reducer.
    """
    newest_first = W.partitionBy(*keys).orderBy(
        F.col(version).desc(), *[F.col(c).desc() for c in tie_breakers]
    )
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter("_rank = 1").drop("_rank")
