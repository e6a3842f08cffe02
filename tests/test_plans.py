"""Plan shapes that decide whether an operator holds at scale."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from stratacast.operators.features import TARGET, build_features
from stratacast.operators.latest import dedupe_latest, latest_snapshot
from stratacast.operators.sizing import (
    broadcast_if_small,
    materialize_sized,
    measured_bytes,
)
from stratacast.operators.split import chronological_split
from stratacast.plans.gold import gold_daily, gold_hourly
from stratacast.plans.serve import first_cities, slice_hourly
from stratacast.plans.silver import silver_hourly, silver_hourly_history
from stratacast.schemas import GOLD_HOURLY, INGEST_DATE, SCHEMAS


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def _executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture
def log(spark, tmp_path):
    doc = '{"hourly":{"time":["2026-01-01T00:00"],"temperature_2m":[1],"wind_speed_10m":[2]}}'
    rows = spark.range(60).selectExpr(
        "TIMESTAMP_NTZ '2026-01-01' + make_dt_interval(CAST(id % 20 AS int)) AS ingested_at",
        "concat('city', id % 3) AS city",
        "'XX' AS country",
        "0D AS latitude",
        "0D AS longitude",
        f"'{doc}' AS raw_response",
    )
    path = str(tmp_path / "log")
    dated = rows.withColumn(INGEST_DATE, F.to_date("ingested_at"))
    dated.write.partitionBy(INGEST_DATE).parquet(path)
    return spark.read.parquet(path)


def test_payloads_are_not_shuffled_and_old_days_not_read(log):
    newest = silver_hourly(log)
    plan = _executed(newest)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "raw_response" not in line
    filters = [line for line in _plan(newest).splitlines() if "PartitionFilters" in line]
    assert any(INGEST_DATE in line and "dynamicpruning" in line for line in filters), filters


def test_a_retired_city_does_not_widen_the_scan(spark, tmp_path):
    days = spark.range(40).selectExpr(
        "explode(if(id = 3, array('left', 'stays'), array('stays'))) AS city",
        "date_add(DATE '2025-02-01', CAST(id AS int)) AS ingest_date",
    )
    log = days.selectExpr("*", "CAST(ingest_date AS timestamp_ntz) AS at", "'{}' AS body")
    log.write.partitionBy("ingest_date").parquet(str(tmp_path / "log"))
    newest = latest_snapshot(spark.read.parquet(str(tmp_path / "log")), "city", "at", "ingest_date")
    found = {(r.city, str(r.ingest_date)) for r in newest.collect()}
    assert found == {("left", "2025-02-04"), ("stays", "2025-03-12")}
    # Adaptive plan, its final plan, and what the result stage runs.
    leaves = newest._jdf.queryExecution().executedPlan().executedPlan().plan().collectLeaves()
    scans = [leaves.apply(k).metrics().get("numPartitions") for k in range(leaves.size())]
    assert [m.get().value() for m in scans if m.isDefined()] == [2]


def test_entity_sets_are_broadcast_by_measured_size_only(spark, log, monkeypatch):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        small = _executed(latest_snapshot(log, "city", "ingested_at"))
        monkeypatch.setattr("stratacast.operators.sizing.MAX_BROADCAST_BYTES", 10)
        large = _executed(latest_snapshot(log, "city", "ingested_at"))
    finally:
        spark.conf.set(threshold, before)
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in large and "Broadcast" not in large


def test_measured_size_counts_text_and_rows(spark, monkeypatch):
    small = spark.createDataFrame([("abc", 1), (None, 2)], "s string, n int")
    assert measured_bytes(small) == 2 * 2 * 16 + 3
    assert measured_bytes(small.limit(0)) == 0
    written, size = materialize_sized(small, "small")
    assert size == measured_bytes(written) == 67
    assert materialize_sized(small.limit(0), "none")[1] == 0
    monkeypatch.setattr("stratacast.operators.sizing.MAX_BROADCAST_BYTES", 66)
    assert broadcast_if_small(small) is small
    assert broadcast_if_small(small, 66) is not small


def test_history_is_a_single_stage_without_shuffle(log):
    assert "Exchange" not in _executed(silver_hourly_history(log))


def test_daily_rollup_combines_before_its_only_shuffle(log):
    plan = _executed(gold_daily(silver_hourly_history(log)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan


def test_dedupe_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v", "id AS x")
    plan = _executed(dedupe_latest(df, ["k"], "v"))
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle


@pytest.mark.parametrize("shown", [["*"], ["city", "temp_lag_1"], ["city", TARGET, "country"]])
def test_blocks_are_shuffled_once_and_reused(spark, city_series, shown):
    towns = city_series("A").unionByName(city_series("B"))
    plan = _executed(build_features(towns, chunk_days=10).select(*shown))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # the series itself, its edge rows by entity, and the borrowed rows by block
    assert len([line for line in exchanges if "Reused" not in line]) == 3, plan
    assert "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_cutoff_is_a_subquery_and_not_a_cross_join(spark, city_series):
    _, test = chronological_split(build_features(city_series()), 10)
    plan = _executed(test)
    assert "Subquery" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_slices_reach_the_file_scan(spark, log, tmp_path):
    path = str(tmp_path / "gold")
    gold_hourly(silver_hourly_history(log)).write.parquet(path)
    gold = spark.read.schema(SCHEMAS[GOLD_HOURLY]).parquet(path)
    plan = _plan(slice_hourly(gold, ["city1", "city2"], date(2026, 1, 1)))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "In(city, [city1,city2])" in pushed
    assert "GreaterThanOrEqual(forecast_time" in pushed and "LessThan(forecast_time" in pushed
    names = _plan(first_cities(gold))
    assert "ReadSchema: struct<city:string>" in names and "TakeOrderedAndProject" in names
