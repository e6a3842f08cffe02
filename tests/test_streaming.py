import json
import os
from datetime import datetime

from stratacast.plans.silver import silver_daily_actuals, silver_hourly_history
from stratacast.schemas import HISTORICAL_RAW, SCHEMAS, WEATHER_RAW
from stratacast.sources.tables import append
from stratacast.streaming.increments import incremental_actuals, incremental_history


def _run(spark, day):
    arrays = {"temperature_2m": [1.0 * day], "wind_speed_10m": [2]}
    doc = {"hourly": {"time": [f"2026-01-0{day}T00:00"], **arrays}}
    row = (datetime(2026, 1, day), "A", "US", 1.0, 2.0, json.dumps(doc))
    return spark.createDataFrame([row], SCHEMAS[WEATHER_RAW])


def test_increments_equal_the_batch_model(clean_catalog, tmp_path):
    spark = clean_catalog
    for day in (1, 2, 3):
        append(_run(spark, day), WEATHER_RAW)
        increments = incremental_history(spark, str(tmp_path / "history"))
        batch = silver_hourly_history(spark.table(WEATHER_RAW))
        assert increments.columns == batch.columns
        assert increments.count() == day
        assert batch.exceptAll(increments).isEmpty()
    assert incremental_history(spark, str(tmp_path / "history")).count() == 3


def test_late_corrections_arrive_incrementally(clean_catalog, tmp_path):
    spark = clean_catalog
    days = ["2026-01-01", "2026-01-02"]
    for day, means in ((1, [1.0, 2.0]), (2, [None, 2.5]), (3, [1.5, None])):
        doc = json.dumps({"daily": {"time": days, "temperature_2m_mean": means}})
        row = (datetime(2026, 1, day), "A", "US", None, None, doc)
        append(spark.createDataFrame([row], SCHEMAS[HISTORICAL_RAW]), HISTORICAL_RAW)
        increments = incremental_actuals(spark, str(tmp_path / "increments"))
        batch = silver_daily_actuals(spark.table(HISTORICAL_RAW))
        assert increments.columns == batch.columns
        assert increments.count() == 2
        assert batch.exceptAll(increments).isEmpty()
    means = [r.temperature_mean_c for r in increments.orderBy("observed_date").collect()]
    assert means == [1.5, 2.5]


def test_files_of_any_age_are_taken(clean_catalog, tmp_path):
    spark = clean_catalog
    for day in (1, 2, 3):
        append(_run(spark, day), WEATHER_RAW)
    files = spark.table(WEATHER_RAW).inputFiles()
    for days, file in zip((0, 6, 30), sorted(files)):
        path = file.removeprefix("file://").removeprefix("file:")
        then = os.stat(path).st_mtime - days * 86_400
        os.utime(path, (then, then))
    assert incremental_history(spark, str(tmp_path / "old")).count() == 3
