"""Features for predicting the next day's mean temperature."""

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from stratacast.functions.units import year_angle
from stratacast.operators.series import CHUNK_DAYS, over_series

# Lags, window length and column names of the published frame.
LAGS = (1, 2, 3, 7)
ROLLING_ROWS = 7
FEATURES = [
    "temp_lag_1",
    "temp_lag_2",
    "temp_lag_3",
    "temp_lag_7",
    "temp_rolling_mean_7",
    "temp_rolling_std_7",
    "precip_lag_1",
    "wind_lag_1",
    "doy_sin",
    "doy_cos",
]
TARGET = "target_temperature_next_day_c"


def _window_features(rows: DataFrame, in_order: WindowSpec) -> DataFrame:
    temperature = F.col("temperature_mean_c")
    prior = in_order.rowsBetween(-ROLLING_ROWS, -1)
    # A full frame of non-null values, not merely enough rows.
    full = F.count(temperature).over(prior) == ROLLING_ROWS
    lags = {f"temp_lag_{k}": F.lag(temperature, k).over(in_order) for k in LAGS}
    return rows.withColumns(
        lags
        | {
            "temp_rolling_mean_7": F.when(full, F.avg(temperature).over(prior)),
            "temp_rolling_std_7": F.when(full, F.stddev_samp(temperature).over(prior)),
            "precip_lag_1": F.lag("precipitation_mm", 1).over(in_order),
            "wind_lag_1": F.lag("wind_speed_max_kmh", 1).over(in_order),
            TARGET: F.lead(temperature, 1).over(in_order),
        }
    )


def build_features(actuals: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Lags, prior-week statistics, season and the next row's temperature.

    Only earlier rows of the same city enter a feature; the target is the one
    column that looks ahead. Lags count rows, so a missing day is not filled.
    """
    daily = actuals.withColumn("observed_date", F.col("observed_date").cast("date"))
    windowed = over_series(
        daily,
        entity="city",
        day="observed_date",
        back=max(ROLLING_ROWS, *LAGS),
        ahead=1,
        compute=_window_features,
        chunk_days=chunk_days,
    )
    angle = year_angle(F.col("observed_date"))
    seasonal = windowed.withColumns({"doy_sin": F.sin(angle), "doy_cos": F.cos(angle)})
    return seasonal.select(*daily.columns, *FEATURES, TARGET)
