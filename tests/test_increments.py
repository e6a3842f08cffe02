"""Incremental tables equal the batch models, whatever lands, dies or reads in between."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratacast.operators.accuracy import lead_time_accuracy, lead_time_curve
from stratacast.operators.states import (
    curve_from_states,
    error_states,
    merge_states,
    metrics_from_states,
)
from stratacast.operators.evaluate import evaluate
from stratacast.plans import increments
from stratacast.plans.silver import silver_daily_actuals, silver_hourly, silver_hourly_history
from stratacast.schemas import (
    ACCURACY_STATES,
    DAILY_ACTUALS,
    HISTORICAL_RAW,
    HOURLY,
    HOURLY_HISTORY,
    INGEST_DATE,
    LEAD_TIME_ACCURACY,
    MODEL_PREDICTIONS,
    SCHEMAS,
    WEATHER_RAW,
    columns,
)
from stratacast.session import materialize
from stratacast.sources.tables import append, read_table

DAY = timedelta(days=1)
FIRST = date(2026, 1, 30)


def forecast(spark, made, cities="AB", base=0.0, days=3, usable=True):
    rows = []
    for city in cities:
        times = [f"{made.date() + d * DAY}T{h:02}:00" for d in range(days) for h in (0, 12)]
        temperatures = [base + ord(city) + k / 4 if usable else None for k in range(len(times))]
        doc = {"time": times, "temperature_2m": temperatures, "wind_speed_10m": [1.0] * len(times)}
        rows.append((made, city, "US", 1.0, 2.0, json.dumps({"hourly": doc})))
    append(spark.createDataFrame(rows, SCHEMAS[WEATHER_RAW]), WEATHER_RAW)


def archive(spark, run, values, cities="AB"):
    """``values`` maps observed day to mean temperature."""
    doc = {"time": [str(d) for d in values], "temperature_2m_mean": list(values.values())}
    rows = [(run, c, "US", None, None, json.dumps({"daily": doc})) for c in cities]
    append(spark.createDataFrame(rows, SCHEMAS[HISTORICAL_RAW]), HISTORICAL_RAW)


def same(found, wanted):
    wanted = wanted.select(*found.columns)
    return found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def assert_all_equal_batch(spark):
    history = silver_hourly_history(read_log(spark, WEATHER_RAW))
    actuals = silver_daily_actuals(read_log(spark, HISTORICAL_RAW))
    assert same(read_table(spark, HOURLY_HISTORY), history)
    assert same(read_table(spark, DAILY_ACTUALS), actuals)
    whole = lead_time_accuracy(history, actuals)
    assert same(read_table(spark, LEAD_TIME_ACCURACY), whole)
    curve = curve_from_states(read_table(spark, ACCURACY_STATES))
    digits = [F.round("mean_absolute_error_c", 6), "lead_time_days", "n_observations"]
    assert same(curve.select(*digits), lead_time_curve(whole).select(*digits))


def read_log(spark, log):
    spark.catalog.refreshTable(log)
    return spark.table(log)


def replace_day(spark, log, day, change):
    """Land an ingestion day anew, as a restore or a correction would."""
    rows = materialize(change(spark.table(log).filter(F.col(INGEST_DATE) == day)), "day")
    spark.sql(f"ALTER TABLE {log} DROP PARTITION ({INGEST_DATE} = DATE'{day}')")
    append(rows, log)


@pytest.fixture
def lake(clean_catalog):
    spark = clean_catalog
    for k in range(3):
        forecast(spark, datetime(2026, 1, 30 if k < 2 else 31, 6 + k), base=k)
    archive(spark, datetime(2026, 2, 3), {FIRST: 60.0, FIRST + DAY: 61.5, FIRST + 2 * DAY: None})
    assert increments.refresh_accuracy(spark) == [FIRST, FIRST + DAY]  + [
        FIRST + 2 * DAY, FIRST + 3 * DAY
    ]
    return spark


def test_new_runs_and_corrections_equal_the_batch_models(lake):
    assert_all_equal_batch(lake)
    assert increments.refresh_accuracy(lake) == []
    # A later run has the missing day and corrects another, in another month too.
    archive(lake, datetime(2026, 2, 4), {FIRST + DAY: 70.0, FIRST + 2 * DAY: 1.0})
    assert increments.refresh_accuracy(lake) == [FIRST + DAY, FIRST + 2 * DAY]
    assert_all_equal_batch(lake)
    forecast(lake, datetime(2026, 2, 1, 6), cities="A", base=9)
    assert increments.refresh_accuracy(lake) == [FIRST + k * DAY for k in (2, 3, 4)]
    assert_all_equal_batch(lake)


def test_an_old_day_that_is_landed_again_replaces_what_it_was(lake):
    hotter = F.replace("raw_response", F.lit("65."), F.lit("75."))
    replace_day(lake, WEATHER_RAW, FIRST, lambda rows: rows.withColumn("raw_response", hotter))
    assert FIRST in increments.refresh_accuracy(lake)
    assert_all_equal_batch(lake)
    # Only one city is left in it.
    replace_day(lake, WEATHER_RAW, FIRST, lambda rows: rows.filter("city = 'A'"))
    increments.refresh_accuracy(lake)
    assert_all_equal_batch(lake)
    less = F.replace("raw_response", F.lit("61.5"), F.lit("null"))
    replace_day(lake, HISTORICAL_RAW, date(2026, 2, 3), lambda rows: rows.withColumn("raw_response", less))
    assert increments.refresh_accuracy(lake) == [FIRST + DAY]
    assert_all_equal_batch(lake)
    # And a day that goes takes its rows along.
    lake.sql(f"ALTER TABLE {WEATHER_RAW} DROP PARTITION ({INGEST_DATE} = DATE'{FIRST}')")
    increments.refresh_accuracy(lake)
    assert_all_equal_batch(lake)
    assert read_table(lake, HOURLY_HISTORY).filter(F.to_date("ingested_at") == FIRST).isEmpty()


@pytest.mark.parametrize("nth", [2, 6, 11])
def test_a_killed_run_is_made_good_by_the_next(lake, monkeypatch, nth):
    forecast(lake, datetime(2026, 2, 1, 6), cities="BC", base=4)
    archive(lake, datetime(2026, 2, 5), {FIRST + k * DAY: 50.0 + k for k in range(4)}, "ABC")
    calls = []

    class Killed(Exception):
        pass

    whole = increments.overwrite_partitions

    def overwrite(df, table, scope):
        calls.append(table)
        if len(calls) == nth:
            raise Killed
        whole(df, table, scope)

    with monkeypatch.context() as patched:
        patched.setattr(increments, "overwrite_partitions", overwrite)
        with pytest.raises(Killed):
            increments.refresh_accuracy(lake)
    # Another session, which has seen nothing of it.
    increments.refresh_accuracy(lake.newSession())
    assert_all_equal_batch(lake)


def test_a_daily_run_reads_the_partitions_it_needs(lake, monkeypatch):
    for k in range(10):
        archive(lake, datetime(2026, 3, 1 + k), {date(2026, 2, 10) + k * DAY: 1.0 * k})
        forecast(lake, datetime(2026, 2, 1 + k, 6), days=2)
    increments.refresh_accuracy(lake)
    forecast(lake, datetime(2026, 2, 10, 18), days=2)
    sides = []
    compare = increments.compare_forecasts

    def compared(forecasts, actuals):
        sides.extend([forecasts, actuals])
        return compare(forecasts, actuals)

    monkeypatch.setattr(increments, "compare_forecasts", compared)
    days = increments.refresh_accuracy(lake)
    assert days == [date(2026, 2, 10), date(2026, 2, 11)]
    # Of forecasts, the two days with their runs; of actuals, one month of three.
    read = [_partitions_read(s) for s in sides]
    assert read == [3, 1]
    assert_all_equal_batch(lake)


def _partitions_read(df, table=""):
    """How many partitions of a table the plan has read."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    open_ = [plan]
    while open_:
        node = open_.pop()
        kind = node.getClass().getSimpleName()
        if node.nodeName().startswith("Scan") and table in node.nodeName():
            return node.metrics().get("numPartitions").get().value()
        if kind == "AdaptiveSparkPlanExec":
            open_.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            open_.append(node.plan())
        else:
            open_ += [node.children().apply(i) for i in range(node.children().size())]
    raise AssertionError("no scan")


def test_the_newest_view_follows_in_every_session(lake):
    other = lake.newSession()
    increments.publish_newest(lake)

    def newest(session):
        return read_table(session, HOURLY)

    assert newest(other).columns == columns(HOURLY)
    assert same(newest(other), silver_hourly(lake.table(WEATHER_RAW)))
    forecast(lake, datetime(2026, 2, 2, 6), cities="B", base=7)
    increments.refresh_history(lake)
    for session in (other, lake):
        assert same(newest(session), silver_hourly(read_log(session, WEATHER_RAW)))
    # A run without usable hours still hides older ones of its city.
    forecast(other, datetime(2026, 2, 3, 6), cities="A", usable=False)
    increments.refresh_history(other)
    for session in (other, lake):
        assert same(newest(session), silver_hourly(read_log(session, WEATHER_RAW)))
        assert {r.city for r in newest(session).collect()} == {"B"}
    # The one day of B's newest run and the days after it.
    assert _partitions_read(newest(lake), HOURLY_HISTORY.split(".")[1]) == 1


def test_states_of_any_days_give_the_metrics_of_those_days(spark):
    rows = spark.range(4000).selectExpr(
        "date_add(DATE '2026-01-01', CAST(id % 40 AS int)) AS forecast_date",
        "CAST(id % 7 AS int) AS lead_time_days",
        "CASE WHEN id % 11 > 0 THEN abs(sin(id)) * 30 END AS abs_error_c",
    )
    states = error_states(rows, ["forecast_date", "lead_time_days"], F.col("abs_error_c"))
    for days in (1, 2, 17, 40):
        upto = F.col("forecast_date") < F.date_add(F.lit(date(2026, 1, 1)), days)
        digits = [F.round("mean_absolute_error_c", 9), "lead_time_days", "n_observations"]
        found = curve_from_states(states.filter(upto)).select(*digits)
        assert same(found, lead_time_curve(rows.filter(upto)).select(*digits))
    halves = [states.filter(F.col("forecast_date") < "2026-01-15"), states.filter("forecast_date >= '2026-01-15'")]
    merged = [merge_states(h, ["lead_time_days"]) for h in halves]
    assert same(
        merge_states(merged[0].union(merged[1]), ["lead_time_days"]),
        merge_states(states, ["lead_time_days"]),
    )


def test_model_metrics_from_states(spark):
    rows = spark.range(3000).selectExpr(
        "concat('m', id % 3) AS model_name",
        "'A' AS city",
        "date_add(DATE '2026-01-01', CAST(id % 90 AS int)) AS observed_date",
        "CAST(id % 13 AS double) AS actual_c",
        "sin(id) * 20 AS predicted_c",
    ).select(*columns(MODEL_PREDICTIONS))
    error = F.col("predicted_c") - F.col("actual_c")
    states = error_states(rows, ["model_name", "observed_date"], error)
    assert same(metrics_from_states(states), evaluate(rows))
