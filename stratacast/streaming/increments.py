"""Silver rows kept up to date from the append-only snapshot logs.

The logs only grow, and unpacking looks at one payload at a time, so a daily
run need not parse the payloads of earlier runs again.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratacast.plans.silver import actual_rows, newest_actuals, silver_hourly_history
from stratacast.schemas import HISTORICAL_RAW, WEATHER_RAW

EVERY_AGE = "36500d"


def unpacked(
    spark: SparkSession, log: str, unpack: Callable[[DataFrame], DataFrame], folder: str
) -> DataFrame:
    """All rows that ``unpack`` gives for a log, of which new ones are added now.

    Only snapshots landed since the last call are parsed. Progress is recorded
    next to the rows; a call that dies is resumed from there, and no snapshot
    is added twice.
    """
    # By default, files much older than the newest one seen would be passed over: a restored
    # or copied partition would be missing.
    snapshots = spark.readStream.option("maxFileAge", EVERY_AGE).table(log)
    new_rows = unpack(snapshots)
    (
        new_rows.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(new_rows.schema).parquet(f"{folder}/rows")


def incremental_history(spark: SparkSession, folder: str, log: str = WEATHER_RAW) -> DataFrame:
    return unpacked(spark, log, silver_hourly_history, f"{folder}/hourly_history")


def incremental_actuals(spark: SparkSession, folder: str, log: str = HISTORICAL_RAW) -> DataFrame:
    """Rows are unpacked incrementally; which run is newest is decided at read."""
    return newest_actuals(unpacked(spark, log, actual_rows, f"{folder}/actual_rows"))
