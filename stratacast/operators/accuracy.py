"""How stored forecasts compare with what was later observed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.schemas import (
    DAILY_ACTUALS,
    HOURLY_HISTORY,
    LEAD_TIME_ACCURACY,
    SCHEMAS,
    columns,
)
from stratacast.sources.tables import empty_table, read_table, table_exists


def daily_forecasts(history: DataFrame) -> DataFrame:
    """Mean forecast per city, forecast day and day it was made.

    Runs made on the same day are pooled.
    """
    return history.groupBy(
        "city",
        F.col("forecast_time").cast("date").alias("forecast_date"),
        F.col("ingested_at").cast("date").alias("forecast_made_on"),
    ).agg(F.avg("temperature_c").alias("forecast_temperature_c"))


def compare_forecasts(forecasts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Absolute error of every daily forecast that has an observed value.

    Neither side has a bounded size, so the join strategy is left to adaptive execution.
    """
    observed = actuals.select(
        "city",
        F.col("observed_date").cast("date").alias("forecast_date"),
        F.col("temperature_mean_c").alias("actual_temperature_c"),
    )
    compared = forecasts.join(observed, ["city", "forecast_date"], "inner")
    return compared.select(
        "city",
        "forecast_date",
        "forecast_made_on",
        F.datediff("forecast_date", "forecast_made_on").alias("lead_time_days"),
        "forecast_temperature_c",
        "actual_temperature_c",
        F.abs(F.col("forecast_temperature_c") - F.col("actual_temperature_c")).alias("abs_error_c"),
    ).select(*columns(LEAD_TIME_ACCURACY))


def lead_time_accuracy(history: DataFrame, actuals: DataFrame) -> DataFrame:
    """The same from hourly runs, which are reduced to days before the join."""
    return compare_forecasts(daily_forecasts(history), actuals)


def lead_time_accuracy_from_tables(
    spark: SparkSession, history: str = HOURLY_HISTORY, actuals: str = DAILY_ACTUALS
) -> DataFrame:
    """The same from named tables; empty, but typed, while one is missing."""
    if not (table_exists(spark, history) and table_exists(spark, actuals)):
        return empty_table(spark, SCHEMAS[LEAD_TIME_ACCURACY])
    return lead_time_accuracy(read_table(spark, history), read_table(spark, actuals))


def lead_time_curve(accuracy: DataFrame) -> DataFrame:
    """Mean error and number of comparisons per lead time."""
    return accuracy.groupBy("lead_time_days").agg(
        F.avg("abs_error_c").alias("mean_absolute_error_c"),
        F.count("abs_error_c").alias("n_observations"),
    )
