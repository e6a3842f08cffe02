"""Tables kept up to date: a run redoes only the partitions that its inputs changed.

Each table remembers the state of every partition of its input that it was made from. A run
compares the states, rewrites what depends on partitions that differ, and only then remembers
the new ones. So a run that dies is done again by the next, a day that is landed anew, late or
twice replaces what it was, and nothing depends on the session or on who ran before.
"""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.operators.accuracy import compare_forecasts, daily_forecasts
from stratacast.operators.states import error_states
from stratacast.plans.silver import actual_rows, newest_actuals, silver_hourly_history
from stratacast.schemas import (
    ACCURACY_STATES,
    ACTUAL_ROWS,
    DAILY_ACTUALS,
    DAILY_FORECASTS,
    HISTORICAL_RAW,
    HOURLY,
    HOURLY_HISTORY,
    INCREMENTS,
    INGEST_DATE,
    LEAD_TIME_ACCURACY,
    OBSERVED_MONTH,
    SCHEMAS,
    WEATHER_RAW,
    columns,
)
from stratacast.sources.tables import (
    ensure_table,
    named,
    overwrite_partitions,
    publish_view,
    read_table,
)


def _stored(spark: SparkSession, table: str) -> DataFrame:
    """A table with its partition columns, as it is now."""
    ensure_table(spark, table)
    spark.catalog.refreshTable(named(spark, table))
    return spark.table(named(spark, table))


def file_states(spark: SparkSession, table: str, part: str) -> DataFrame:
    """(part, state) per partition: a sum over its rows of the file that each is in.

    Rows cannot change without a file that has another name, size or time. No column of the
    rows is read, only how many there are in each file.
    """
    meta = [F.col(f"_metadata.file_{c}") for c in ("path", "size", "modification_time")]
    rows = _stored(spark, table).select(F.col(part).alias("part"), F.xxhash64(*meta).alias("of"))
    return rows.groupBy("part").agg(F.sum(F.col("of").cast("decimal(38,0)")).alias("state"))


def row_states(rows: DataFrame, part: str, of: list[str]) -> DataFrame:
    """(part, state) per value of ``part``: a sum over its rows of the columns ``of``."""
    own = F.xxhash64(*of).cast("decimal(38,0)")
    return rows.groupBy(F.col(part).alias("part")).agg(F.sum(own).alias("state"))


@dataclass
class Changes:
    """Partitions of an input whose state differs from the one a target was made from."""

    spark: SparkSession
    target: str
    parts: list[date]
    states: dict[date, Decimal]

    def record(self) -> None:
        """Remember the new states; call it once all that depends on them is written."""
        if self.parts:
            rows = [(self.target, part, state) for part, state in self.states.items()]
            states = self.spark.createDataFrame(rows, SCHEMAS[INCREMENTS])
            overwrite_partitions(states, INCREMENTS, F.col("target") == self.target)


def _collected(states: DataFrame) -> dict[date, Decimal]:
    rows = states.filter(F.col("part").isNotNull()).select("part", "state").collect()
    return {r["part"]: r["state"] for r in rows}


def changes(
    states: DataFrame, target: str, covered: Callable[[date], bool] = lambda part: True
) -> Changes:
    """Compare ``states`` with those remembered for ``target``.

    ``covered`` tells which parts the states are of; by default all. One number per part
    reaches the driver, and parts are days or months: the calendar bounds them.
    """
    spark = states.sparkSession
    known = _collected(_stored(spark, INCREMENTS).filter(F.col("target") == target))
    now = {p: s for p, s in known.items() if not covered(p)} | _collected(states)
    parts = sorted(p for p in {*known, *now} if known.get(p) != now.get(p))
    return Changes(spark, target, parts, now)


def _refresh_unpacked(
    spark: SparkSession, log: str, table: str, unpack: Callable[[DataFrame], DataFrame]
) -> list[date]:
    """Unpack the snapshots of ingestion days that changed; the days."""
    ensure_table(spark, table)
    found = changes(file_states(spark, log, INGEST_DATE), table)
    if found.parts:
        days = F.col(INGEST_DATE).isin(found.parts)
        rows = unpack(_stored(spark, log).filter(days))
        rows = rows.withColumn(INGEST_DATE, F.to_date("ingested_at"))
        if table == ACTUAL_ROWS:
            rows = rows.withColumn(OBSERVED_MONTH, F.trunc("observed_date", "month"))
        overwrite_partitions(rows, table, days)
    found.record()
    return found.parts


def refresh_history(spark: SparkSession) -> DataFrame:
    """The rows of every forecast run, with those of new or changed ingestion days redone."""
    _refresh_unpacked(spark, WEATHER_RAW, HOURLY_HISTORY, silver_hourly_history)
    return read_table(spark, HOURLY_HISTORY)


def publish_newest(spark: SparkSession) -> DataFrame:
    """The rows of each city's newest run, as a view that follows the log and the history.

    The newest run is decided by the log, also if it has no usable hour. Days before the
    oldest of the newest runs are not read.
    """
    for table in (WEATHER_RAW, HOURLY_HISTORY):
        ensure_table(spark, table)
    log, history = named(spark, WEATHER_RAW), named(spark, HOURLY_HISTORY)
    shown = ", ".join(f"rows.{c}" for c in columns(HOURLY))
    return publish_view(
        spark,
        HOURLY,
        f"""
        SELECT {shown}
        FROM {history} rows
        JOIN (SELECT city, max(ingested_at) AS newest FROM {log} GROUP BY city) runs
          ON rows.city = runs.city AND rows.ingested_at = runs.newest
        WHERE rows.{INGEST_DATE} >= (
          SELECT min(day) FROM (
            SELECT max({INGEST_DATE}) AS day FROM {log} GROUP BY city))""",
    )


def refresh_actuals(spark: SparkSession) -> DataFrame:
    """One row per city and observed day, with the months redone that changed runs touch."""
    _refresh_unpacked(spark, HISTORICAL_RAW, ACTUAL_ROWS, actual_rows)
    ensure_table(spark, DAILY_ACTUALS)
    found = changes(file_states(spark, ACTUAL_ROWS, INGEST_DATE), DAILY_ACTUALS)
    if found.parts:
        rows = _stored(spark, ACTUAL_ROWS)
        now = rows.filter(F.col(INGEST_DATE).isin(found.parts)).select(OBSERVED_MONTH)
        shown = _stored(spark, DAILY_ACTUALS)
        gone = shown.filter(F.to_date("ingested_at").isin(found.parts)).select(OBSERVED_MONTH)
        touched = now.union(gone).distinct().collect()
        months = F.col(OBSERVED_MONTH).isin([r[0] for r in touched])
        newest = newest_actuals(rows.filter(months))
        overwrite_partitions(newest, DAILY_ACTUALS, months)
    found.record()
    return read_table(spark, DAILY_ACTUALS)


def refresh_forecasts(spark: SparkSession) -> DataFrame:
    """Daily means of every run, with those of changed ingestion days redone."""
    refresh_history(spark)
    found = changes(file_states(spark, HOURLY_HISTORY, INGEST_DATE), DAILY_FORECASTS)
    if found.parts:
        rows = _stored(spark, HOURLY_HISTORY).filter(F.col(INGEST_DATE).isin(found.parts))
        days = daily_forecasts(rows).filter(F.col("forecast_date").isNotNull())
        made_on = F.col("forecast_made_on").isin(found.parts)
        overwrite_partitions(days, DAILY_FORECASTS, made_on)
    found.record()
    return _stored(spark, DAILY_FORECASTS)


def refresh_accuracy(spark: SparkSession) -> list[date]:
    """Compare anew the forecast days that have new runs or new actuals; which they were.

    Only their partitions of forecasts, actuals and comparisons are read and written, and of
    the actuals the months that changed at all. States of the errors are kept per day.
    """
    forecasts = refresh_forecasts(spark)
    refresh_actuals(spark)
    actuals = _stored(spark, DAILY_ACTUALS)
    runs = changes(
        file_states(spark, DAILY_FORECASTS, "forecast_date"), f"{LEAD_TIME_ACCURACY} forecasts"
    )
    months = changes(
        file_states(spark, DAILY_ACTUALS, OBSERVED_MONTH), f"{LEAD_TIME_ACCURACY} months"
    )
    observed = changes(
        row_states(
            actuals.filter(F.col(OBSERVED_MONTH).isin(months.parts)),
            "observed_date",
            ["city", "temperature_mean_c"],
        ),
        f"{LEAD_TIME_ACCURACY} actuals",
        lambda day: day.replace(day=1) in months.parts,
    )
    days = sorted({*runs.parts, *observed.parts})
    if days:
        forecast_day = F.col("forecast_date").isin(days)
        # The month, too, so that other months' partitions are not read.
        in_month = F.col(OBSERVED_MONTH).isin(sorted({d.replace(day=1) for d in days}))
        compared = compare_forecasts(
            forecasts.filter(forecast_day),
            actuals.filter(in_month & F.col("observed_date").isin(days)),
        )
        overwrite_partitions(compared, LEAD_TIME_ACCURACY, forecast_day)
        states = error_states(
            _stored(spark, LEAD_TIME_ACCURACY).filter(forecast_day),
            ["forecast_date", "lead_time_days"],
            F.col("abs_error_c"),
        )
        overwrite_partitions(states, ACCURACY_STATES, forecast_day)
    else:
        ensure_table(spark, LEAD_TIME_ACCURACY)
        ensure_table(spark, ACCURACY_STATES)
    for found in (runs, observed, months):
        found.record()
    return days
