"""Silver: typed rows out of the bronze payloads."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratacast.functions.payloads import explode_parallel
from stratacast.operators.latest import dedupe_latest, latest_snapshot
from stratacast.schemas import (
    DAILY_ACTUALS,
    HOURLY,
    HOURLY_HISTORY,
    INGEST_DATE,
    columns,
)

# Payload field and element type behind each silver column.
HOURLY_FIELDS = {
    "forecast_time_raw": ("time", "string"),
    "temperature_c": ("temperature_2m", "double"),
    "relative_humidity_pct": ("relative_humidity_2m", "double"),
    "precipitation_mm": ("precipitation", "double"),
    "wind_speed_kmh": ("wind_speed_10m", "double"),
}
DAILY_FIELDS = {
    "observed_date_raw": ("time", "string"),
    "temperature_mean_c": ("temperature_2m_mean", "double"),
    "temperature_max_c": ("temperature_2m_max", "double"),
    "temperature_min_c": ("temperature_2m_min", "double"),
    "precipitation_mm": ("precipitation_sum", "double"),
    "wind_speed_max_kmh": ("wind_speed_10m_max", "double"),
}
HOUR_FORMAT = "yyyy-MM-dd'T'HH:mm"


def hourly_rows(bronze: DataFrame) -> DataFrame:
    """Zipped payload arrays, before typing of the time and any filter."""
    entity = ["city", "country", "latitude", "longitude", "ingested_at"]
    return explode_parallel(bronze, "raw_response", "hourly", HOURLY_FIELDS, keep=entity)


def silver_hourly_history(bronze: DataFrame) -> DataFrame:
    """One row per city, run and forecast hour.

    Hours beyond a city's model horizon come as nulls and are dropped;
    humidity and precipitation may stay null.
    """
    covered = hourly_rows(bronze).filter(
        F.col("temperature_c").isNotNull() & F.col("wind_speed_kmh").isNotNull()
    )
    typed = covered.withColumn(
        "forecast_time", F.to_timestamp_ntz("forecast_time_raw", F.lit(HOUR_FORMAT))
    )
    return typed.select(*columns(HOURLY_HISTORY))


def silver_hourly(bronze: DataFrame) -> DataFrame:
    """One row per city and forecast hour of the city's newest run.

    The newest run is picked before any payload is parsed.
    """
    day = INGEST_DATE if INGEST_DATE in bronze.columns else None
    newest = latest_snapshot(bronze, "city", "ingested_at", version_day=day)
    return silver_hourly_history(newest).select(*columns(HOURLY))


def actual_rows(bronze: DataFrame) -> DataFrame:
    """One row per city, run and observed day that has a mean temperature.

    Days without one are not final yet.
    """
    rows = explode_parallel(
        bronze, "raw_response", "daily", DAILY_FIELDS, keep=["city", "country", "ingested_at"]
    )
    final = rows.filter(F.col("temperature_mean_c").isNotNull())
    typed = final.withColumn("observed_date", F.col("observed_date_raw").cast("date"))
    return typed.select(*columns(DAILY_ACTUALS))


def newest_actuals(rows: DataFrame) -> DataFrame:
    return dedupe_latest(rows, ["city", "observed_date"], "ingested_at")


def silver_daily_actuals(bronze: DataFrame) -> DataFrame:
    """One row per city and observed day, from the newest run that has a value.

    Days that are not final go before the runs are ranked, so they never hide
    an older run's value.
    """
    return newest_actuals(actual_rows(bronze))
