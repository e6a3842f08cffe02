from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stratacast.operators import quality
from stratacast.plans import gold, serve
from stratacast.schemas import GOLD_DAILY, GOLD_HOURLY, HOURLY, SCHEMAS, columns

RUN = datetime(2024, 1, 1, 5, 30, 59)


@pytest.fixture
def hourly(spark):
    def hour(city, country, day, h, temperature, humidity, rain, wind):
        at = datetime(2024, 1, day, h)
        return (city, country, 0.0, 0.0, at, temperature, humidity, rain, wind, RUN)

    rows = [
        hour("A", "US", 1, 0, 10.0, 50.0, 0.1, 5.0),
        hour("A", "US", 1, 1, 10.5, None, 0.2, 7.25),
        hour("A", "US", 2, 0, -1.0, None, None, 1.0),
        hour("B", "GB", 1, 0, 20.0, 80.0, 0.0, 0.0),
        hour("A", "GB", 2, 0, 3.0, 60.0, 0.0, 2.0),
    ]
    return spark.createDataFrame(rows, SCHEMAS[HOURLY])


def test_daily_rollup(hourly):
    daily = gold.gold_daily(hourly)
    assert daily.schema.fieldNames() == columns(GOLD_DAILY)
    rows = {(r.city, r.country, r.forecast_date.day): r for r in daily.collect()}
    assert len(rows) == 4
    first = rows["A", "US", 1]
    assert (first.avg_temperature_c, first.min_temperature_c, first.max_temperature_c) == (
        10.3,
        10.0,
        10.5,
    )
    assert (first.avg_humidity_pct, first.total_precipitation_mm, first.max_wind_speed_kmh) == (
        50.0,
        0.3,
        7.3,
    )
    assert first.last_ingested_at == RUN
    dry = rows["A", "US", 2]
    assert dry.avg_humidity_pct is None and dry.total_precipitation_mm is None


def test_hourly_curation(hourly):
    rows = gold.gold_hourly(hourly)
    assert rows.columns == columns(GOLD_HOURLY)
    assert rows.count() == hourly.count()


def test_same_city_name_in_two_countries_is_reported_not_hidden(hourly):
    report = quality.quality_report({GOLD_DAILY: gold.gold_daily(hourly)}).collect()
    failures = {(r["column"], r["check"]): r.failures for r in report}
    assert len(failures) == 5
    assert failures.pop(("city_date_key", "unique")) == 1
    assert set(failures.values()) == {0}


def test_checks_raise_with_what_failed(hourly):
    with pytest.raises(quality.CheckFailed, match="gold_weather_daily.city_date_key unique: 1"):
        quality.require_checks(quality.quality_report({GOLD_DAILY: gold.gold_daily(hourly)}))
    nulls = hourly.withColumn("temperature_c", F.lit(None).cast("double"))
    report = quality.not_null(nulls, HOURLY, ["city", "temperature_c"]).collect()
    assert [(r["column"], r.failures) for r in report] == [("city", 0), ("temperature_c", 5)]
    with pytest.raises(quality.EmptyResult):
        quality.require_rows(hourly.filter("city = 'Z'"), "nothing")
    assert quality.require_rows(hourly, "something") is hourly


def test_null_keys_are_not_duplicates(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "k string")
    assert quality.unique(df, "t", "k").first().failures == 0


def test_slices(hourly):
    daily = gold.gold_daily(hourly)
    both = serve.slice_daily(daily, ["A"], date(2024, 1, 1), date(2024, 1, 2), unit="F")
    shown = {(r.country, r.forecast_date.day): r.avg_temperature_display for r in both.collect()}
    assert shown["US", 2] == -1.0 * 9 / 5 + 32
    assert len(shown) == 3
    one_day = serve.slice_daily(daily, ["A", "B"], date(2024, 1, 1))
    assert sorted(r.city for r in one_day.collect()) == ["A", "B"]
    by_hour = serve.slice_hourly(gold.gold_hourly(hourly), ["A"], date(2024, 1, 1))
    assert sorted(r.temperature_display for r in by_hour.collect()) == [10.0, 10.5]
    table = serve.display_table(both, unit="F")
    assert table.columns == [
        "city_date_key",
        "city",
        "country",
        "forecast_date",
        "avg_humidity_pct",
        "total_precipitation_mm",
        "max_wind_speed_kmh",
        "last_ingested_at",
        "avg_temperature (°F)",
        "min_temperature (°F)",
        "max_temperature (°F)",
    ]
    with pytest.raises(ValueError):
        serve.slice_daily(daily, ["A"], date(2024, 1, 1), unit="K")


def test_reports(hourly):
    daily = gold.gold_daily(hourly)
    metrics = serve.headline_metrics(daily, ["A", "B", "Z"]).first()
    assert tuple(metrics) == (2, 3, "2024-01-01 05:30")
    assert [r.city for r in serve.city_list(daily).collect()] == ["A", "B"]
    assert [r.city for r in serve.first_cities(daily, 1).collect()] == ["A"]
    assert tuple(serve.date_bounds(daily).first()) == (date(2024, 1, 1), date(2024, 1, 2))


def test_model_reports(spark):
    evaluation = spark.createDataFrame(
        [("b", 1.5, 2.0), ("a", 1.5, 3.0), ("c", 1.9, 1.0)],
        "model_name string, mae_c double, rmse_c double",
    )
    assert serve.best_model(evaluation).first().model_name == "a"
    predictions = spark.createDataFrame(
        [
            ("m", "A", date(2024, 1, 2), 1.0, 2.0),
            ("m", "A", date(2024, 1, 1), 3.0, 4.0),
            ("m", "B", date(2024, 1, 1), 5.0, 6.0),
            ("n", "A", date(2024, 1, 1), 7.0, 8.0),
        ],
        "model_name string, city string, observed_date date, actual_c double, predicted_c double",
    )
    series = serve.prediction_series(predictions, "A", "m").collect()
    assert [r.actual_c for r in series] == [3.0, 1.0]


def test_checks_of_a_table_take_one_scan(spark, tmp_path):
    rows = [("a", 1, None), ("a", None, 2.0), (None, 3, 2.0), (None, 4, 2.0), ("b", 5, None)]
    spark.createDataFrame(rows, "k string, n int, x double").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    report = quality.table_report(table, "t", ["k", "n", "x"], ["k"])
    assert report._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    found = {(r["column"], r["check"]): r["failures"] for r in report.collect()}
    assert found == {
        ("k", "not_null"): 2,
        ("n", "not_null"): 1,
        ("x", "not_null"): 2,
        ("k", "unique"): 1,
    }
    nothing = quality.table_report(table.limit(0), "t", ["k"], ["k"]).collect()
    assert [r["failures"] for r in nothing] == [0, 0]
    two = quality.table_report(table, "t", [], ["k", "x"]).collect()
    assert {r["column"]: r["failures"] for r in two} == {"k": 1, "x": 1}
