"""Gold: rollups for reporting."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratacast.functions.keys import surrogate_key
from stratacast.functions.rounding import round_half_away
from stratacast.schemas import GOLD_DAILY, GOLD_HOURLY, columns


def gold_daily(silver: DataFrame) -> DataFrame:
    """Daily weather per city; combined map-side, so a hot city shuffles little."""
    temperature = F.col("temperature_c")
    daily = silver.groupBy(
        "city", "country", F.col("forecast_time").cast("date").alias("forecast_date")
    ).agg(
        round_half_away(F.avg(temperature), 1).alias("avg_temperature_c"),
        round_half_away(F.min(temperature), 1).alias("min_temperature_c"),
        round_half_away(F.max(temperature), 1).alias("max_temperature_c"),
        round_half_away(F.avg("relative_humidity_pct"), 1).alias("avg_humidity_pct"),
        round_half_away(F.sum("precipitation_mm"), 2).alias("total_precipitation_mm"),
        round_half_away(F.max("wind_speed_kmh"), 1).alias("max_wind_speed_kmh"),
        F.max("ingested_at").alias("last_ingested_at"),
    )
    keyed = daily.withColumn("city_date_key", surrogate_key(F.col("city"), F.col("forecast_date")))
    return keyed.select(*columns(GOLD_DAILY))


def gold_hourly(silver: DataFrame) -> DataFrame:
    """Hourly temperature per city, already at its grain."""
    keyed = silver.withColumns(
        {
            "city_hour_key": surrogate_key(F.col("city"), F.col("forecast_time")),
            "last_ingested_at": F.col("ingested_at"),
        }
    )
    return keyed.select(*columns(GOLD_HOURLY))
