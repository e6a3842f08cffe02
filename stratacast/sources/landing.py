"""Requests for snapshots, and landing of the answers in the bronze logs.

Fetching itself is outside: ``fetched`` frames hold one row per request with
``city``, ``status`` (HTTP status, null without an answer) and ``raw_response``, and should
hold the ``country`` of the request.
"""

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratacast.operators.sizing import broadcast_if_small, materialize_sized
from stratacast.schemas import (
    HISTORICAL_RAW,
    INGEST_DATE,
    REJECTED_ANSWERS,
    WEATHER_RAW,
    columns,
)
from stratacast.session import materialize
from stratacast.sources.tables import append, named, table_exists

# Requested fields and horizons.
HOURLY_FIELDS = "temperature_2m,relative_humidity_2m,precipitation,wind_speed_10m"
DAILY_FIELDS = (
    "temperature_2m_mean,temperature_2m_max,temperature_2m_min,"
    "precipitation_sum,wind_speed_10m_max"
)
FORECAST_DAYS = 16
ARCHIVE_LAG_DAYS = 5


def backfill_window(
    as_of: Column, years: int = 2, window_days: int | None = None, lag_days: int = ARCHIVE_LAG_DAYS
) -> tuple[Column, Column]:
    """(first, last) day to request: the archive is final ``lag_days`` late.

    ``window_days`` asks for a short recent window instead of whole years.
    """
    span = 365 * years if window_days is None else window_days
    last = F.date_sub(as_of, lag_days)
    return F.date_sub(last, span), last


def forecast_requests(cities: DataFrame) -> DataFrame:
    return cities.select(
        "city",
        "country",
        "latitude",
        "longitude",
        F.lit(HOURLY_FIELDS).alias("hourly"),
        F.lit(FORECAST_DAYS).alias("forecast_days"),
        F.lit("auto").alias("timezone"),
    )


def archive_requests(
    cities: DataFrame, as_of: Column, years: int = 2, window_days: int | None = None
) -> DataFrame:
    first, last = backfill_window(as_of, years, window_days)
    return cities.select(
        "city",
        "country",
        "latitude",
        "longitude",
        first.cast("string").alias("start_date"),
        last.cast("string").alias("end_date"),
        F.lit(DAILY_FIELDS).alias("daily"),
        F.lit("auto").alias("timezone"),
    )


def _city_keys(answers: DataFrame) -> list[str]:
    """What names a city in the answers: two countries may share a city's name."""
    return ["city", "country"] if "country" in answers.columns else ["city"]


def attach_city(payloads: DataFrame, cities: DataFrame) -> DataFrame:
    """Payloads with their city's attributes; unknown cities drop out.

    Payloads that carry the country they were asked for go to the city of that country.
    """
    return payloads.join(broadcast_if_small(cities), _city_keys(payloads), "inner")


def _utc(instant: datetime | None) -> Column:
    """One instant for a whole run, fixed when the plan is built; default now."""
    instant = instant or datetime.now(timezone.utc)
    if instant.tzinfo is not None:
        instant = instant.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(instant.isoformat(sep=" ")).cast("timestamp_ntz")


def _as_text(fetched: DataFrame) -> DataFrame:
    """Bodies as JSON text; parsed ones (structs, variants) are written out whole."""
    if dict(fetched.dtypes)["raw_response"] == "string":
        return fetched
    text = F.to_json("raw_response", {"ignoreNullFields": "false"})
    return fetched.withColumn("raw_response", text)


def is_json(text: Column) -> Column:
    """Whether a whole text is one JSON value, by the letter of the standard.

    Parsers stop where a value ends, so what follows it would pass. Inside of both an array and
    an object it cannot: what closes the one early does not close the other. NaN and infinities,
    single quotes, repeated names in an object, bare control characters, byte order marks and
    empty texts are not accepted.
    """
    listed = F.concat(F.lit("["), text, F.lit("]"))
    named = F.concat(F.lit('{"x":'), text, F.lit("}"))
    strict = F.try_parse_json(listed).isNotNull() & F.try_parse_json(named).isNotNull()
    return F.coalesce(strict & (F.json_array_length(listed) == 1), F.lit(False))


def _reason(cities_known: Column) -> Column:
    """Why a request's answer is not landed; null if it is."""
    return (
        F.when(cities_known.isNull(), F.lit("unknown city"))
        .when(~cities_known, F.lit("city of several countries"))
        .when(F.col("status").isNull(), F.lit("no answer"))
        .when(F.col("status") >= 400, F.concat(F.lit("status "), F.col("status").cast("string")))
        .when(~is_json(F.col("raw_response")), F.lit("body is not JSON"))
    )


def _judged(fetched: DataFrame, cities: DataFrame, run_ts: datetime) -> DataFrame:
    """Every answer of a run with its city's attributes and why it is not landed, if it is not."""
    keys = _city_keys(fetched)
    # Without a country, a name that several countries share names none of them.
    named = cities.groupBy("city").agg(F.count("*").alias("_named"))
    known = cities.withColumn("_known", F.lit(True))
    if len(keys) == 1:
        known = known.join(named, "city").withColumn("_known", F.col("_named") == 1)
        known = known.drop("_named").dropDuplicates(["city"])
    known = broadcast_if_small(known)
    asked = F.col("country") if "country" in keys else F.lit(None).cast("string")
    answers = _as_text(fetched).withColumn("_asked", asked).join(known, keys, "left")
    judged = answers.withColumns({"reason": _reason(F.col("_known")), "ingested_at": _utc(run_ts)})
    return judged.drop("_known")


def _accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull()).drop("_asked", "reason", "status")


def _rejected(judged: DataFrame, *more: str) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull()).select(
        "ingested_at", "city", F.col("_asked").alias("country"), "status", "reason", *more
    )


def snapshot_batch(
    fetched: DataFrame, cities: DataFrame, run_ts: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) answers of one run.

    All accepted rows carry the same instant. A failing city does not stop the
    others; it shows up among the rejected with a reason, and with the country it was
    asked for, if known.
    """
    judged = _judged(fetched, cities, run_ts or datetime.now(timezone.utc))
    return _accepted(judged), _rejected(judged)


def _land(batch: DataFrame, table: str, run_ts: datetime) -> int:
    """Append what a run has not landed yet; how many answers of the run the table then has.

    The run's instant and the row itself are the key: a run that is repeated, or that died half
    way and is run again, adds what is missing, and an answer that comes twice lands once. Only
    the run's own rows of the table are compared, by digest, and payloads are not shuffled
    while the digests are small. An empty batch creates and writes nothing.
    """
    spark = batch.sparkSession
    # Nulls differ from empty texts.
    values = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns(table)]
    key = F.sha2(F.to_json(F.array(*values)), 256).alias("_key")
    wanted = batch.select(key, "_row").groupBy("_key").agg(F.min("_row").alias("_row"))
    wanted, size = materialize_sized(wanted, "wanted")
    count = wanted.count()
    if not count:
        return 0
    if table_exists(spark, table):
        landed = spark.table(named(spark, table)).filter(F.col("ingested_at") == _utc(run_ts))
        if INGEST_DATE in landed.columns:
            landed = landed.filter(F.col(INGEST_DATE) == F.to_date(_utc(run_ts)))
        landed = broadcast_if_small(*materialize_sized(landed.select(key), "landed"))
        wanted = wanted.join(landed, "_key", "left_anti")
    append(batch.join(broadcast_if_small(wanted, size), "_row", "left_semi"), table)
    return count


def _land_run(
    fetched: DataFrame, cities: DataFrame, run_ts: datetime, log: str, more: dict[str, Column]
) -> int:
    """Judge a run's answers once, write them down, and land both halves from there.

    Rejected answers keep why they were, next to the log they were meant for.
    """
    numbered = _judged(fetched, cities, run_ts).withColumn("_row", F.monotonically_increasing_id())
    judged = materialize(numbered, "judged")
    rejected = _rejected(judged, "_row").withColumns(
        {"log": F.lit(log), "status": F.col("status").cast("int")}
    )
    _land(rejected, REJECTED_ANSWERS, run_ts)
    return _land(_accepted(judged).withColumns(more), log, run_ts)


def land_forecasts(
    fetched: DataFrame, cities: DataFrame, run_ts: datetime | None = None
) -> int:
    return _land_run(fetched, cities, run_ts or datetime.now(timezone.utc), WEATHER_RAW, {})


def _window_columns(as_of: date, years: int, window_days: int | None) -> dict[str, Column]:
    first, last = backfill_window(F.lit(as_of), years, window_days)
    return {"start_date": first, "end_date": last}


def archive_batch(
    fetched: DataFrame,
    cities: DataFrame,
    run_ts: datetime,
    as_of: date,
    years: int = 2,
    window_days: int | None = None,
) -> DataFrame:
    accepted, _ = snapshot_batch(fetched, cities, run_ts)
    batch = accepted.withColumns(_window_columns(as_of, years, window_days))
    return batch.select(*columns(HISTORICAL_RAW))


def land_archive(
    fetched: DataFrame,
    cities: DataFrame,
    run_ts: datetime,
    as_of: date,
    years: int = 2,
    window_days: int | None = None,
) -> int:
    more = _window_columns(as_of, years, window_days)
    return _land_run(fetched, cities, run_ts, HISTORICAL_RAW, more)
