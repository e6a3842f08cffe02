"""One city, and one of its days, with a third of all rows: results stay whole."""

import duckdb
import pytest

from stratacast.operators.accuracy import lead_time_accuracy, lead_time_curve
from stratacast.operators.latest import dedupe_latest
from stratacast.plans.gold import gold_daily

ROWS = 30_000


@pytest.fixture
def history(spark):
    # Quarter degrees, so that sums are exact in any order.
    return spark.range(ROWS, numPartitions=16).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('c', id % 50)) AS city",
        "'XX' AS country",
        "0D AS latitude",
        "0D AS longitude",
        """TIMESTAMP_NTZ '2024-01-01'
           + make_dt_interval(IF(id % 6 = 0, 0, CAST(id % 9 AS int)), CAST(id % 24 AS int))
           AS forecast_time""",
        "(hash(id) % 400) / 4D AS temperature_c",
        "CAST(id % 100 AS double) AS relative_humidity_pct",
        "(id % 8) / 4D AS precipitation_mm",
        "CAST(id % 30 AS double) AS wind_speed_kmh",
        "TIMESTAMP_NTZ '2023-12-28' + make_dt_interval(CAST(id % 5 AS int)) AS ingested_at",
    )


@pytest.fixture
def actuals(history):
    days = history.selectExpr(
        "city", "to_date(forecast_time) AS observed_date", "ingested_at", "temperature_c AS t"
    )
    newest = dedupe_latest(days, ["city", "observed_date"], "ingested_at", ["t"])
    return newest.withColumnRenamed("t", "temperature_mean_c")


def _same(spark_df, sql, **tables):
    connection = duckdb.connect()
    for name, table in tables.items():
        connection.register(name, table.toArrow())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = sorted(map(str, result.fetchall()))
    assert sorted(str(tuple(r)) for r in spark_df.select(*names).collect()) == expected
    return len(expected)


def test_rollup(history):
    sql = """select city, cast(forecast_time as date) as forecast_date,
        round(avg(temperature_c), 1) as avg_temperature_c,
        round(sum(precipitation_mm), 2) as total_precipitation_mm from h group by all"""
    assert _same(gold_daily(history), sql, h=history) > 100


def test_dedupe(history, actuals):
    sql = """select city, cast(forecast_time as date) as observed_date,
        arg_max(temperature_c, (ingested_at, temperature_c)) as temperature_mean_c
        from h group by all"""
    assert _same(actuals, sql, h=history) > 100


def test_accuracy(history, actuals):
    detail = lead_time_accuracy(history, actuals)
    sql = """select city, f as forecast_date, cast(f - m as integer) as lead_time_days,
        abs(t - temperature_mean_c) as abs_error_c
        from (select city, cast(forecast_time as date) as f, cast(ingested_at as date) as m,
              avg(temperature_c) as t from h group by all)
        join a using (city) where observed_date = f"""
    n = _same(detail, sql, h=history, a=actuals)
    counted = {r.lead_time_days: r.n_observations for r in lead_time_curve(detail).collect()}
    assert sum(counted.values()) == n
