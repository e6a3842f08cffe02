"""One explicit schema per published table.

Table and column names are fixed values: readers of the tables rely on them.
Instants are TIMESTAMP_NTZ in UTC; forecast times are the city's local clock.
"""

from pyspark.sql import types as T

WEATHER_RAW = "bronze.weather_raw"
HISTORICAL_RAW = "bronze.weather_historical_raw"
REJECTED_ANSWERS = "bronze.rejected_answers"
HOURLY = "silver.stg_weather_hourly"
HOURLY_HISTORY = "silver.stg_weather_hourly_history"
DAILY_ACTUALS = "silver.stg_weather_historical_daily"
GOLD_DAILY = "gold.gold_weather_daily"
GOLD_HOURLY = "gold.gold_weather_hourly"
MODEL_EVALUATION = "gold.model_evaluation"
MODEL_PREDICTIONS = "gold.model_predictions"
FEATURE_IMPORTANCE = "gold.model_feature_importance"
LEAD_TIME_ACCURACY = "gold.forecast_accuracy_by_lead_time"
# Kept between runs so that a run only does what its new snapshots ask for.
ACTUAL_ROWS = "silver.actual_rows"
DAILY_FORECASTS = "silver.daily_forecasts"
ACCURACY_STATES = "gold.accuracy_states"
INCREMENTS = "silver.increments"
MODEL_RUNS = "gold.model_runs"

# Storage-only partition columns: the day of ingested_at and the month of observed_date.
INGEST_DATE = "ingest_date"
OBSERVED_MONTH = "observed_month"

_TEXT, _NUMBER, _COUNT, _DAYS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_EXACT = T.DecimalType(38, 10)
_DAY, _TIME, _INSTANT = T.DateType(), T.TimestampNTZType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SCHEMAS = {
    WEATHER_RAW: _struct(
        ingested_at=_TIME,
        city=_TEXT,
        country=_TEXT,
        latitude=_NUMBER,
        longitude=_NUMBER,
        raw_response=_TEXT,
    ),
    HISTORICAL_RAW: _struct(
        ingested_at=_TIME,
        city=_TEXT,
        country=_TEXT,
        start_date=_DAY,
        end_date=_DAY,
        raw_response=_TEXT,
    ),
    REJECTED_ANSWERS: _struct(
        ingested_at=_TIME,
        log=_TEXT,
        city=_TEXT,
        country=_TEXT,
        status=_DAYS,
        reason=_TEXT,
    ),
    HOURLY: _struct(
        city=_TEXT,
        country=_TEXT,
        latitude=_NUMBER,
        longitude=_NUMBER,
        forecast_time=_TIME,
        temperature_c=_NUMBER,
        relative_humidity_pct=_NUMBER,
        precipitation_mm=_NUMBER,
        wind_speed_kmh=_NUMBER,
        ingested_at=_TIME,
    ),
    HOURLY_HISTORY: _struct(
        city=_TEXT,
        country=_TEXT,
        latitude=_NUMBER,
        longitude=_NUMBER,
        ingested_at=_TIME,
        forecast_time=_TIME,
        temperature_c=_NUMBER,
        relative_humidity_pct=_NUMBER,
        precipitation_mm=_NUMBER,
        wind_speed_kmh=_NUMBER,
    ),
    DAILY_ACTUALS: _struct(
        city=_TEXT,
        country=_TEXT,
        observed_date=_DAY,
        temperature_mean_c=_NUMBER,
        temperature_max_c=_NUMBER,
        temperature_min_c=_NUMBER,
        precipitation_mm=_NUMBER,
        wind_speed_max_kmh=_NUMBER,
        ingested_at=_TIME,
    ),
    GOLD_DAILY: _struct(
        city_date_key=_TEXT,
        city=_TEXT,
        country=_TEXT,
        forecast_date=_DAY,
        avg_temperature_c=_NUMBER,
        min_temperature_c=_NUMBER,
        max_temperature_c=_NUMBER,
        avg_humidity_pct=_NUMBER,
        total_precipitation_mm=_NUMBER,
        max_wind_speed_kmh=_NUMBER,
        last_ingested_at=_TIME,
    ),
    GOLD_HOURLY: _struct(
        city_hour_key=_TEXT,
        city=_TEXT,
        country=_TEXT,
        forecast_time=_TIME,
        temperature_c=_NUMBER,
        last_ingested_at=_TIME,
    ),
    MODEL_EVALUATION: _struct(
        model_name=_TEXT,
        mae_c=_NUMBER,
        rmse_c=_NUMBER,
        n_test_rows=_COUNT,
        trained_at=_INSTANT,
    ),
    MODEL_PREDICTIONS: _struct(
        model_name=_TEXT,
        city=_TEXT,
        observed_date=_DAY,
        actual_c=_NUMBER,
        predicted_c=_NUMBER,
    ),
    FEATURE_IMPORTANCE: _struct(
        model_name=_TEXT,
        feature=_TEXT,
        importance=_NUMBER,
    ),
    LEAD_TIME_ACCURACY: _struct(
        city=_TEXT,
        forecast_date=_DAY,
        forecast_made_on=_DAY,
        lead_time_days=_DAYS,
        forecast_temperature_c=_NUMBER,
        actual_temperature_c=_NUMBER,
        abs_error_c=_NUMBER,
    ),
    DAILY_FORECASTS: _struct(
        city=_TEXT,
        forecast_date=_DAY,
        forecast_made_on=_DAY,
        forecast_temperature_c=_NUMBER,
    ),
    ACCURACY_STATES: _struct(
        forecast_date=_DAY,
        lead_time_days=_DAYS,
        n=_COUNT,
        sum_abs=_EXACT,
        sum_squares=_EXACT,
    ),
    INCREMENTS: _struct(
        target=_TEXT,
        part=_DAY,
        state=T.DecimalType(38, 0),
    ),
    MODEL_RUNS: _struct(
        trained_at=_INSTANT,
        path=_TEXT,
    ),
}
SCHEMAS[ACTUAL_ROWS] = SCHEMAS[DAILY_ACTUALS]

# Partition columns and their types; those that a schema lacks are storage only.
PARTITIONS = {
    WEATHER_RAW: {INGEST_DATE: _DAY},
    HISTORICAL_RAW: {INGEST_DATE: _DAY},
    HOURLY_HISTORY: {INGEST_DATE: _DAY},
    ACTUAL_ROWS: {OBSERVED_MONTH: _DAY, INGEST_DATE: _DAY},
    DAILY_ACTUALS: {OBSERVED_MONTH: _DAY},
    DAILY_FORECASTS: {"forecast_date": _DAY, "forecast_made_on": _DAY},
    LEAD_TIME_ACCURACY: {"forecast_date": _DAY},
    ACCURACY_STATES: {"forecast_date": _DAY},
    INCREMENTS: {"target": _TEXT},
}


def columns(table: str) -> list[str]:
    return SCHEMAS[table].fieldNames()
