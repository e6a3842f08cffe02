"""What the dashboards read: filtered slices and small reports."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.functions.rounding import round_half_even
from stratacast.functions.units import CELSIUS, display_temperature, unit_label
from stratacast.schemas import (
    FEATURE_IMPORTANCE,
    GOLD_DAILY,
    GOLD_HOURLY,
    LEAD_TIME_ACCURACY,
    MODEL_EVALUATION,
    MODEL_PREDICTIONS,
)
from stratacast.sources.tables import require_table

DEFAULT_CITIES = 6
_DAILY_TEMPERATURES = ("avg_temperature", "min_temperature", "max_temperature")


def load_daily(spark: SparkSession) -> DataFrame:
    return require_table(spark, GOLD_DAILY, "forecast").orderBy("forecast_date", "city")


def load_hourly(spark: SparkSession) -> DataFrame:
    return require_table(spark, GOLD_HOURLY, "forecast").orderBy("forecast_time", "city")


def load_models(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(evaluation, best first; predictions; importance, largest first)."""
    evaluation = require_table(spark, MODEL_EVALUATION, "training").orderBy("mae_c")
    predictions = require_table(spark, MODEL_PREDICTIONS, "training")
    importance = require_table(spark, FEATURE_IMPORTANCE, "training")
    return evaluation, predictions, importance.orderBy(F.desc("importance"))


def load_accuracy(spark: SparkSession) -> DataFrame:
    detail = require_table(spark, LEAD_TIME_ACCURACY, "training")
    return detail.orderBy("forecast_date", "city", "lead_time_days")


def _in_days(day: Column, start: date, end: date | None) -> Column:
    """An inclusive range of days; one day alone is a range of one."""
    return day.between(F.lit(start), F.lit(end or start))


def slice_daily(
    gold: DataFrame,
    cities: Sequence[str],
    start: date,
    end: date | None = None,
    unit: str = CELSIUS,
) -> DataFrame:
    """Daily gold of some cities and days, plus temperatures in a display unit."""
    rows = gold.filter(F.col("city").isin(*cities) & _in_days(F.col("forecast_date"), start, end))
    return rows.withColumns(
        {
            f"{name}_display": display_temperature(F.col(f"{name}_c"), unit)
            for name in _DAILY_TEMPERATURES
        }
    )


def slice_hourly(
    gold: DataFrame,
    cities: Sequence[str],
    start: date,
    end: date | None = None,
    unit: str = CELSIUS,
) -> DataFrame:
    """Hourly gold of some cities and days.

    The days are compared as instants, a form that the file reader can use to
    skip row groups; a cast of the column could not be pushed down.
    """
    first = F.lit(start).cast("timestamp_ntz")
    beyond = F.date_add(F.lit(end or start), 1).cast("timestamp_ntz")
    time = F.col("forecast_time")
    rows = gold.filter(F.col("city").isin(*cities) & (time >= first) & (time < beyond))
    return rows.withColumn(
        "temperature_display", display_temperature(F.col("temperature_c"), unit)
    )


def display_table(daily_slice: DataFrame, unit: str = CELSIUS) -> DataFrame:
    """A daily slice with its temperatures rounded and labelled for reading."""
    shown = {
        f"{name} ({unit_label(unit)})": round_half_even(F.col(f"{name}_display"), 1)
        for name in _DAILY_TEMPERATURES
    }
    hidden = [f"{name}_{kind}" for name in _DAILY_TEMPERATURES for kind in ("c", "display")]
    return daily_slice.withColumns(shown).drop(*hidden)


def headline_metrics(gold: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Cities tracked, cities shown and the newest ingestion, to the minute."""
    return gold.agg(
        F.countDistinct("city").alias("cities_tracked"),
        F.lit(len(cities)).cast("bigint").alias("cities_shown"),
        F.substring(F.max("last_ingested_at").cast("string"), 1, 16).alias("last_ingested"),
    )


def city_list(df: DataFrame, column: str = "city") -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def first_cities(df: DataFrame, n: int = DEFAULT_CITIES) -> DataFrame:
    """The first cities by name, the default selection."""
    return city_list(df).limit(n)


def date_bounds(gold: DataFrame, day: str = "forecast_date") -> DataFrame:
    return gold.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def prediction_series(predictions: DataFrame, city: str | Column, model: str) -> DataFrame:
    """Actual and predicted values of one city and model, by date.

    The city may be a scalar of another frame, which is then looked up as the query runs.
    """
    rows = predictions.filter((F.col("city") == city) & (F.col("model_name") == model))
    return rows.select("observed_date", "actual_c", "predicted_c").orderBy("observed_date")


def best_model(evaluation: DataFrame) -> DataFrame:
    """The row with the lowest mean absolute error."""
    return evaluation.orderBy("mae_c", "model_name").limit(1)
