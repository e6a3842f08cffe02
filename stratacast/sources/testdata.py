"""The test tables seen as weather data: adapters for queries and benchmark.

Aggregates are order-free (max, min, count), so that the inputs built here are
the same whatever the partitioning. Cities are users, customers and suppliers, so
payloads and series grow with the data; what is collected into one payload is bounded by the
calendar: 72 hours of a forecast run, 31 days of an archive month.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that building a plan starts no job to read file footers.
_DDL = {
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_DDL[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A city dimension with one row per user."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("city"))
        .agg(
            F.lit("XX").alias("country"),
            F.max("value").alias("latitude"),
            F.min("value").alias("longitude"),
        )
    )


def forecast_answers(spark: SparkSession, sf_dir: str, precipitation: bool = False) -> DataFrame:
    """(city, ingest_day, raw_response): hourly forecasts of events, three runs each.

    Every hour of a user is forecast on its own day and on the two days
    before, 0.25 higher per day of lead; the longest lead lacks some hours. The
    precipitation array is absent unless asked for.
    """
    rain = "rows.low AS precipitation," if precipitation else ""
    return spark.sql(
        f"""
        WITH hourly AS (
          -- Quarter degrees: sums of them are exact, in whatever order they are added.
          SELECT CAST(user_id AS string) AS city, to_date(ts) AS day, hour(ts) AS hour,
                 floor(max(value) * 4) / 4 AS high, min(value) AS low, max(user_id) AS user,
                 max(CAST(get_json_object(props, '$.k') AS double)) AS k
          FROM {{events}} GROUP BY user_id, 2, 3),
        forecasts AS (
          SELECT city, date_sub(day, lead) AS ingest_day,
                 struct(concat(day, 'T', lpad(hour, 2, '0'), ':00') AS time,
                        CASE WHEN lead < 2 OR hour % 11 > 0 THEN high + 0.25D * lead END AS high,
                        k, low, user) AS row
          FROM hourly LATERAL VIEW explode(array(0, 1, 2)) AS lead),
        runs AS (
          SELECT city, ingest_day, array_sort(collect_list(row)) AS rows
          FROM forecasts GROUP BY city, ingest_day)
        SELECT city, ingest_day,
               to_json(struct(struct(
                 rows.time AS time, rows.high AS temperature_2m, rows.k AS relative_humidity_2m,
                 {rain} rows.user AS wind_speed_10m) AS hourly)) AS raw_response
        FROM runs
        """,
        events=table(spark, sf_dir, "events"),
    )


def forecast_bronze(spark: SparkSession, sf_dir: str, precipitation: bool = False) -> DataFrame:
    return forecast_answers(spark, sf_dir, precipitation).selectExpr(
        "CAST(ingest_day AS timestamp_ntz) AS ingested_at",
        "city",
        "'XX' AS country",
        "0D AS latitude",
        "0D AS longitude",
        "raw_response",
    )


def archive_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observations of events, one payload per city, month and run.

    The first run has every day. The second, later, has the days after the
    16th, 0.5 higher, and every third day of them is not final yet (null).
    """
    return spark.sql(
        """
        WITH daily AS (
          SELECT CAST(user_id AS string) AS city, to_date(ts) AS day,
                 max(value) AS high, min(value) AS low, count(*) AS n
          FROM {events} GROUP BY user_id, 2),
        observed AS (
          SELECT city, run, day,
                 struct(CAST(day AS string) AS time,
                        CASE WHEN run = 1 THEN high
                             WHEN day(day) % 3 <> 0 THEN high + 0.5D END AS mean,
                        high + 1 AS max, low, n) AS row
          FROM daily LATERAL VIEW explode(array(1, 2)) AS run
          WHERE run = 1 OR day(day) > 16),
        runs AS (
          SELECT city, run, trunc(day, 'month') AS start_date, max(day) AS end_date,
                 array_sort(collect_list(row)) AS rows
          FROM observed GROUP BY 1, 2, 3)
        SELECT CASE run WHEN 1 THEN TIMESTAMP_NTZ '2024-02-10'
                        ELSE TIMESTAMP_NTZ '2024-02-11' END AS ingested_at,
               city, 'XX' AS country, start_date, end_date,
               to_json(struct(struct(
                 rows.time AS time, rows.mean AS temperature_2m_mean,
                 rows.max AS temperature_2m_max, rows.low AS temperature_2m_min,
                 rows.low AS precipitation_sum, rows.n AS wind_speed_10m_max) AS daily))
                 AS raw_response
        FROM runs
        """,
        events=table(spark, sf_dir, "events"),
    )


def daily_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices per customer and day, as daily observations."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    high, low = F.max("o_totalprice"), F.min("o_totalprice")
    return joined.groupBy(
        F.col("c_name").alias("city"),
        F.lit("XX").alias("country"),
        F.to_date("o_orderdate").alias("observed_date"),
    ).agg(
        high.alias("temperature_mean_c"),
        high.alias("temperature_max_c"),
        low.alias("temperature_min_c"),
        low.alias("precipitation_mm"),
        F.count("*").cast("double").alias("wind_speed_max_kmh"),
    )


def shipped_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest line price per supplier and ship day, as daily observations."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(
        F.col("l_suppkey").cast("string").alias("city"),
        F.to_date("l_shipdate").alias("observed_date"),
    ).agg(F.max("l_extendedprice").alias("temperature_mean_c"))


def forecast_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line prices as forecasts for a supplier: made on the order day, for the ship day.

    Lines and orders both grow with the data: join them by shuffle, whatever
    their files' size suggests (compressed lines are far larger in memory).
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").cast("string").alias("city"),
        F.col("l_shipdate").alias("forecast_time"),
        F.col("o_orderdate").alias("ingested_at"),
        F.col("l_extendedprice").alias("temperature_c"),
    )
