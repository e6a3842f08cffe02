"""Registered queries: each runs an operator over whole test tables."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracle_queries import ORACLES  # noqa: E402
from stratacast.functions.rounding import round_half_away, round_half_even  # noqa: E402
from stratacast.operators import accuracy, evaluate, quality, split, states  # noqa: E402
from stratacast.operators.boosting import Settings, fit_trees  # noqa: E402
from stratacast.operators.features import FEATURES, TARGET, build_features  # noqa: E402
from stratacast.operators.latest import dedupe_latest, latest_snapshot  # noqa: E402
from stratacast.operators.models import (  # noqa: E402
    LINEAR,
    SEED,
    feature_importance,
    fit_boosted,
    fit_linear,
    fit_models,
    top_features,
)
from stratacast.plans import gold, increments, serve, silver  # noqa: E402
from stratacast.schemas import (  # noqa: E402
    ACCURACY_STATES,
    DAILY_ACTUALS,
    GOLD_DAILY,
    GOLD_HOURLY,
    HISTORICAL_RAW,
    HOURLY,
    HOURLY_HISTORY,
    LEAD_TIME_ACCURACY,
    REJECTED_ANSWERS,
    SCHEMAS,
    WEATHER_RAW,
)
from stratacast.session import materialize, scratch_path  # noqa: E402
from stratacast.sources import landing, tables, testdata  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 3, 1, 6, 30)
SLICE_CITIES = ["1", "2", "3"]
SLICE_DAYS = (date(2024, 1, 8), date(2024, 1, 21))


# --- bronze -----------------------------------------------------------------


def attach_city(spark, sf_dir):
    answers = testdata.forecast_answers(spark, sf_dir).select("city", "ingest_day")
    return landing.attach_city(answers, testdata.event_cities(spark, sf_dir))


def _fetched(spark, sf_dir):
    """Answers of which some failed, are unreadable or of unknown cities."""
    day = F.dayofmonth("ingest_day")
    status = F.when(day % 7 == 0, 503).when(day % 5 != 0, 200)
    body = F.when(day % 9 == 0, F.lit('{"hourly":')).otherwise(F.col("raw_response"))
    answers = testdata.forecast_answers(spark, sf_dir)
    return answers.select("city", status.alias("status"), body.alias("raw_response"))


def _batch(spark, sf_dir):
    known = testdata.event_cities(spark, sf_dir).filter(F.col("city") != "4")
    return landing.snapshot_batch(_fetched(spark, sf_dir), known, RUN_TS)


def snapshot_ingest(spark, sf_dir):
    accepted, _ = _batch(spark, sf_dir)
    return accepted.groupBy("city", "country", "latitude", "longitude", "ingested_at").agg(
        F.count("*").alias("payloads")
    )


def snapshot_rejects(spark, sf_dir):
    _, rejected = _batch(spark, sf_dir)
    return rejected.groupBy("city", "status", "reason").agg(F.count("*").alias("payloads"))


def _kept(spark, work):
    """What ``work`` reads from tables of a lake of its own, which is dropped afterwards."""
    prefix = f"q{uuid.uuid4().hex}_"
    with tables.lake(spark, prefix):
        try:
            return materialize(work(), "kept")
        finally:
            tables.drop_lake(spark, prefix)


def _land_twice(spark, sf_dir, land):
    """Two runs of the same answers, each of them repeated."""
    cities = testdata.event_cities(spark, sf_dir).filter(F.col("city") != "4")
    fetched = materialize(_fetched(spark, sf_dir), "fetched")
    for run_ts in (RUN_TS, RUN_TS, RUN_TS + timedelta(days=1), RUN_TS):
        land(fetched, cities, run_ts)


def landed_forecasts(spark, sf_dir):
    def work():
        _land_twice(spark, sf_dir, landing.land_forecasts)
        rows = tables.read_table(spark, WEATHER_RAW)
        return rows.groupBy("city", "country", "latitude", "longitude", "ingested_at").agg(
            F.count("*").alias("payloads")
        )

    return _kept(spark, work)


def landed_archive(spark, sf_dir):
    def work():
        as_of = date(2024, 3, 1)
        _land_twice(spark, sf_dir, lambda *run: landing.land_archive(*run, as_of, window_days=14))
        rows = tables.read_table(spark, HISTORICAL_RAW)
        return rows.groupBy("city", "country", "ingested_at", "start_date", "end_date").agg(
            F.count("*").alias("payloads")
        )

    return _kept(spark, work)


def landed_rejects(spark, sf_dir):
    def work():
        _land_twice(spark, sf_dir, landing.land_forecasts)
        return tables.read_table(spark, REJECTED_ANSWERS)

    return _kept(spark, work)


def parsed_bodies(spark, sf_dir):
    """Answers that come parsed are landed as the whole text again."""
    body = F.struct(
        F.max("event_id").alias("last"),
        F.min("event_type").alias("first"),
        F.lit(None).cast("string").alias("none"),
    )
    events = testdata.table(spark, sf_dir, "events")
    fetched = events.groupBy(F.col("user_id").cast("string").alias("city")).agg(
        F.lit(200).alias("status"), body.alias("raw_response")
    )
    accepted, _ = landing.snapshot_batch(fetched, testdata.event_cities(spark, sf_dir), RUN_TS)
    return accepted.select("city", "raw_response")


def archive_runs(spark, sf_dir):
    return testdata.archive_bronze(spark, sf_dir).drop("raw_response")


def backfill_window(spark, sf_dir):
    last_order = (
        testdata.table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.to_date(F.max("o_orderdate")).alias("as_of"))
    )
    first, last = landing.backfill_window(F.col("as_of"), years=2)
    recent, _ = landing.backfill_window(F.col("as_of"), window_days=14)
    return last_order.select(
        "o_custkey",
        first.alias("start_date"),
        recent.alias("recent_start_date"),
        last.alias("end_date"),
    )


def request_set(spark, sf_dir):
    return landing.forecast_requests(testdata.event_cities(spark, sf_dir))


def archive_request_set(spark, sf_dir):
    cities = testdata.event_cities(spark, sf_dir)
    return landing.archive_requests(cities, F.lit(date(2024, 3, 1)), window_days=14)


# --- snapshots and silver ---------------------------------------------------


def json_zip(spark, sf_dir):
    rows = silver.hourly_rows(testdata.forecast_bronze(spark, sf_dir))
    return rows.drop("country", "latitude", "longitude")


def latest_orders(spark, sf_dir):
    orders = testdata.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey"
    )
    return latest_snapshot(orders, "o_custkey", "o_orderdate")


def dedupe_events(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events").select(
        "event_type", "user_id", "ts", "event_id", "value"
    )
    return dedupe_latest(events, ["event_type", "user_id"], "ts", ["event_id"])


def _hourly(spark, sf_dir, precipitation=False):
    return silver.silver_hourly(testdata.forecast_bronze(spark, sf_dir, precipitation))


def _history(spark, sf_dir, precipitation=False):
    return silver.silver_hourly_history(testdata.forecast_bronze(spark, sf_dir, precipitation))


def silver_daily_actuals(spark, sf_dir):
    return silver.silver_daily_actuals(testdata.archive_bronze(spark, sf_dir))


def _append_by_day(log, rows, refresh):
    """Land some days, bring the tables up to date, land the rest, and again."""
    rows = materialize(rows, "rows")
    middle = rows.agg(F.min("ingested_at") + (F.max("ingested_at") - F.min("ingested_at")) / 2)
    middle = middle.scalar()
    for part in (F.col("ingested_at") <= middle, F.col("ingested_at") > middle):
        tables.append(rows.filter(part), log)
        refresh(rows.sparkSession)


def incremental_history(spark, sf_dir):
    def work():
        rows = testdata.forecast_bronze(spark, sf_dir)
        _append_by_day(WEATHER_RAW, rows, increments.refresh_history)
        return tables.read_table(spark, HOURLY_HISTORY)

    return _kept(spark, work)


def newest_view(spark, sf_dir):
    """The view is made before the second half of the runs lands."""

    def refresh(spark):
        increments.refresh_history(spark)
        if not tables.table_exists(spark, HOURLY):
            increments.publish_newest(spark)

    def work():
        _append_by_day(WEATHER_RAW, testdata.forecast_bronze(spark, sf_dir), refresh)
        return tables.read_table(spark, HOURLY)

    return _kept(spark, work)


def incremental_actuals(spark, sf_dir):
    def work():
        rows = testdata.archive_bronze(spark, sf_dir)
        _append_by_day(HISTORICAL_RAW, rows, increments.refresh_actuals)
        return tables.read_table(spark, DAILY_ACTUALS)

    return _kept(spark, work)


def _kept_accuracy(spark, sf_dir, table):
    def work():
        tables.append(testdata.archive_bronze(spark, sf_dir), HISTORICAL_RAW)
        rows = testdata.forecast_bronze(spark, sf_dir)
        _append_by_day(WEATHER_RAW, rows, increments.refresh_accuracy)
        return tables.read_table(spark, table)

    return _kept(spark, work)


def incremental_accuracy(spark, sf_dir):
    detail = _kept_accuracy(spark, sf_dir, LEAD_TIME_ACCURACY)
    return _four_digits(detail, "forecast_temperature_c", "abs_error_c")


def incremental_curve(spark, sf_dir):
    curve = states.curve_from_states(_kept_accuracy(spark, sf_dir, ACCURACY_STATES))
    return _four_digits(curve, "mean_absolute_error_c")


# --- gold and quality -------------------------------------------------------


def gold_daily(spark, sf_dir):
    return gold.gold_daily(_hourly(spark, sf_dir))


def gold_daily_all_runs(spark, sf_dir):
    return gold.gold_daily(_history(spark, sf_dir, precipitation=True))


def gold_hourly(spark, sf_dir):
    return gold.gold_hourly(_hourly(spark, sf_dir))


def replaced_table(spark, sf_dir):
    """Gold replaced by other rows and back again."""

    def work():
        daily = materialize(gold_daily(spark, sf_dir), "daily")
        for rows in (daily, daily.limit(1), daily):
            tables.replace(rows, GOLD_DAILY, ["forecast_date", "city"])
        return tables.read_table(spark, GOLD_DAILY)

    return _kept(spark, work)


def dq_not_null(spark, sf_dir):
    rows = silver.hourly_rows(testdata.forecast_bronze(spark, sf_dir))
    return quality.not_null(rows, "hourly_rows", rows.columns)


def dq_unique(spark, sf_dir):
    every_run = gold.gold_hourly(_history(spark, sf_dir))
    return quality.unique(every_run, "all_runs", "city_hour_key")


def dq_report(spark, sf_dir):
    # Several checks read each table: parse the payloads once, as the pipelines do.
    hourly = materialize(_hourly(spark, sf_dir), "hourly")
    history = materialize(_history(spark, sf_dir), "history")
    return quality.quality_report(
        {
            GOLD_DAILY: gold.gold_daily(hourly),
            GOLD_HOURLY: gold.gold_hourly(hourly),
            HOURLY: hourly,
            HOURLY_HISTORY: history,
            DAILY_ACTUALS: silver_daily_actuals(spark, sf_dir),
        }
    )


def csv_export(spark, sf_dir):
    path = scratch_path(spark, "gold-csv")
    tables.export_csv(gold_daily_all_runs(spark, sf_dir), path)
    return spark.read.schema(SCHEMAS[GOLD_DAILY]).option("header", True).csv(path)


# --- features, split, models ------------------------------------------------


def _features(spark, sf_dir):
    return build_features(testdata.daily_actuals(spark, sf_dir))


def _feature_columns(*names, digits=None):
    def query(spark, sf_dir):
        shown = [
            round_half_away(F.col(n), digits).alias(n) if digits is not None else F.col(n)
            for n in names
        ]
        return _features(spark, sf_dir).select("city", "observed_date", *shown)

    return query


def _split(spark, sf_dir):
    return split.chronological_split(_features(spark, sf_dir))


def _split_part(part):
    def query(spark, sf_dir):
        rows = _split(spark, sf_dir)[part]
        return rows.select("city", "observed_date", "temperature_mean_c", "temp_lag_7", TARGET)

    return query


def split_summary(spark, sf_dir):
    return split.split_summary(*_split(spark, sf_dir))


def persistence_predictions(spark, sf_dir):
    return evaluate.predict_persistence(_split(spark, sf_dir)[1])


def persistence_eval(spark, sf_dir):
    return evaluate.evaluate(persistence_predictions(spark, sf_dir))


def _baselines(spark, sf_dir):
    test = _split(spark, sf_dir)[1]
    return evaluate.unpivot_predictions(
        test, {evaluate.PERSISTENCE: "temperature_mean_c", "same_day_last_week": "temp_lag_7"}
    )


def union_predictions(spark, sf_dir):
    test = _split(spark, sf_dir)[1]
    return evaluate.union_predictions(
        evaluate.predict_persistence(test),
        evaluate.predictions_of(test, "same_day_last_week", "temp_lag_7"),
    )


def baseline_eval(spark, sf_dir):
    return evaluate.evaluate(_baselines(spark, sf_dir))


def metrics_states(spark, sf_dir):
    """The metrics out of states that are kept per model and day."""
    error = F.col("predicted_c") - F.col("actual_c")
    days = states.error_states(_baselines(spark, sf_dir), ["model_name", "observed_date"], error)
    return states.metrics_from_states(days)


def best_model(spark, sf_dir):
    return serve.best_model(baseline_eval(spark, sf_dir))


def prediction_series(spark, sf_dir):
    first = persistence_predictions(spark, sf_dir).agg(F.min("city")).scalar()
    return serve.prediction_series(_baselines(spark, sf_dir), first, evaluate.PERSISTENCE)


def linear_regression_optimality(spark, sf_dir):
    """The least-squares property: residuals are orthogonal to every input."""
    train, _ = split.chronological_split(materialize(_features(spark, sf_dir), "features"))
    scored = fit_linear(train).transform(train)
    residual = F.col(TARGET) - F.col(LINEAR)
    inputs = {"intercept": F.lit(1.0)} | {name: F.col(name) for name in FEATURES}
    sums = scored.agg(
        F.count("*").alias("n_train_rows"),
        F.sqrt(F.sum(residual * residual)).alias("_residual"),
        *[F.sum(residual * x).alias(f"dot_{n}") for n, x in inputs.items()],
        *[F.sqrt(F.sum(x * x)).alias(f"norm_{n}") for n, x in inputs.items()],
    )
    checks = [
        F.struct(
            F.lit(n).alias("input"),
            (
                F.abs(F.col(f"dot_{n}")) <= F.lit(1e-6) * F.col("_residual") * F.col(f"norm_{n}")
            ).alias("orthogonal"),
        )
        for n in inputs
    ]
    return sums.select("n_train_rows", F.inline(F.array(*checks)))


def boosted_three_rounds(spark, sf_dir):
    """Three trees of one split each, of all rows and columns."""
    train, test = split.chronological_split(materialize(_features(spark, sf_dir), "features"))
    settings = Settings(
        trees=3, depth=1, rate=0.05, row_fraction=1.0, column_fraction=1.0, seed=SEED
    )
    model = fit_trees(train.select(*FEATURES, TARGET), FEATURES, TARGET, settings)
    return model.transform(test, "predicted_c").select(
        "city", "observed_date", round_half_away(F.col("predicted_c"), 4).alias("predicted_c")
    )


def _trained(spark, sf_dir):
    """The library's 300 rounds on the train half, and the test half."""
    train, test = split.chronological_split(materialize(_features(spark, sf_dir), "features"))
    return fit_models(train), test


def _predictions(spark, sf_dir):
    models, test = _trained(spark, sf_dir)
    return models.predictions(test)


def _evaluation(spark, sf_dir):
    return evaluate.evaluate(_predictions(spark, sf_dir), RUN_TS)


def _importance(spark, sf_dir):
    train, _ = split.chronological_split(materialize(_features(spark, sf_dir), "features"))
    return feature_importance(spark, fit_boosted(train))


def model_comparison(spark, sf_dir):
    return _evaluation(spark, sf_dir).orderBy("mae_c")


def model_predictions(spark, sf_dir):
    return _predictions(spark, sf_dir)


def scored_actuals(spark, sf_dir):
    """What each trained model was scored on: the whole test half, thrice."""
    return _predictions(spark, sf_dir).drop("predicted_c")


def published_baseline(spark, sf_dir):
    """The published evaluation of the one model that needs no fitting."""
    evaluation = _evaluation(spark, sf_dir)
    return evaluation.filter(F.col("model_name") == evaluate.PERSISTENCE).drop("trained_at")


def best_trained_model(spark, sf_dir):
    return serve.best_model(_evaluation(spark, sf_dir))


def feature_importances(spark, sf_dir):
    return _importance(spark, sf_dir).orderBy(F.desc("importance"))


def top_five_features(spark, sf_dir):
    return top_features(_importance(spark, sf_dir))


# --- forecast accuracy ------------------------------------------------------


def _accuracy(spark, sf_dir):
    return accuracy.lead_time_accuracy(
        testdata.forecast_history(spark, sf_dir), testdata.shipped_actuals(spark, sf_dir)
    )


def _four_digits(df, *names):
    """Means to four digits, whatever the order they were summed in.

    Means of two-digit prices often lie on a tie of the fifth digit, where the
    last bit of the sum would decide; seven digits first removes that bit.
    """
    return df.withColumns({n: round_half_away(round_half_away(F.col(n), 7), 4) for n in names})


def lead_time_accuracy(spark, sf_dir):
    return _four_digits(_accuracy(spark, sf_dir), "forecast_temperature_c", "abs_error_c")


def lead_time_curve(spark, sf_dir):
    curve = accuracy.lead_time_curve(_accuracy(spark, sf_dir))
    return _four_digits(curve, "mean_absolute_error_c").orderBy("lead_time_days")


def accuracy_ordered(spark, sf_dir):
    return lead_time_accuracy(spark, sf_dir).orderBy("forecast_date", "city", "lead_time_days")


def lead_time_curve_states(spark, sf_dir):
    """The curve out of states that are kept per day."""
    days = states.error_states(
        _accuracy(spark, sf_dir), ["forecast_date", "lead_time_days"], F.col("abs_error_c")
    )
    return _four_digits(states.curve_from_states(days), "mean_absolute_error_c")


def payload_accuracy(spark, sf_dir):
    """Both sides out of JSON payloads, instead of out of tables."""
    detail = accuracy.lead_time_accuracy(
        _history(spark, sf_dir), silver_daily_actuals(spark, sf_dir)
    )
    return _four_digits(detail, "forecast_temperature_c", "abs_error_c")


# --- serving ----------------------------------------------------------------


def _gold_of_every_run(spark, sf_dir):
    return gold.gold_daily(_history(spark, sf_dir, precipitation=True))


def slice_daily(spark, sf_dir):
    return serve.slice_daily(_gold_of_every_run(spark, sf_dir), SLICE_CITIES, *SLICE_DAYS, unit="F")


def slice_hourly(spark, sf_dir):
    hourly = gold.gold_hourly(_history(spark, sf_dir))
    return serve.slice_hourly(hourly, SLICE_CITIES, *SLICE_DAYS, unit="F")


def slice_single_day(spark, sf_dir):
    return serve.slice_daily(_gold_of_every_run(spark, sf_dir), SLICE_CITIES, SLICE_DAYS[0])


def display_table(spark, sf_dir):
    return serve.display_table(slice_daily(spark, sf_dir), unit="F")


def headline_metrics(spark, sf_dir):
    return serve.headline_metrics(_gold_of_every_run(spark, sf_dir), SLICE_CITIES)


def city_list(spark, sf_dir):
    return serve.city_list(_gold_of_every_run(spark, sf_dir))


def first_cities(spark, sf_dir):
    nations = testdata.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("city")
    )
    return serve.first_cities(nations)


def date_bounds(spark, sf_dir):
    return serve.date_bounds(_gold_of_every_run(spark, sf_dir))


def gold_daily_ordered(spark, sf_dir):
    return _gold_of_every_run(spark, sf_dir).orderBy("forecast_date", "city")


def parameterised_sql(spark, sf_dir):
    return tables.query(
        spark,
        "SELECT city, count(*) AS days FROM {gold} WHERE forecast_date >= :since GROUP BY city",
        {"since": SLICE_DAYS[0]},
        gold=_gold_of_every_run(spark, sf_dir),
    )


def rounding(spark, sf_dir):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return testdata.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        round_half_away(price, 1).alias("away_1"),
        round_half_away(price, 2).alias("away_2"),
        round_half_even(price, 1).alias("even_1"),
        round_half_even(price, 3).alias("even_3"),
    )


_QUERIES: dict[str, Query] = {
    "json_zip": json_zip,
    "latest_snapshot": latest_orders,
    "silver_hourly": _hourly,
    "silver_hourly_history": _history,
    "gold_daily": gold_daily,
    "gold_daily_all_runs": gold_daily_all_runs,
    "gold_daily_ordered": gold_daily_ordered,
    "gold_hourly": gold_hourly,
    "attach_city": attach_city,
    "dedupe_latest": dedupe_events,
    "archive_runs": archive_runs,
    "silver_daily_actuals": silver_daily_actuals,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_report": dq_report,
    "features_lag": _feature_columns(
        "temp_lag_1", "temp_lag_2", "temp_lag_3", "temp_lag_7", "precip_lag_1", "wind_lag_1"
    ),
    "features_rolling": _feature_columns("temp_rolling_mean_7", "temp_rolling_std_7", digits=4),
    "features_seasonal": _feature_columns("doy_sin", "doy_cos", digits=4),
    "features_target": _feature_columns(TARGET),
    "split_train": _split_part(0),
    "split_test": _split_part(1),
    "split_summary": split_summary,
    "lead_time_accuracy": lead_time_accuracy,
    "lead_time_curve": lead_time_curve,
    "payload_accuracy": payload_accuracy,
    "persistence_predictions": persistence_predictions,
    "persistence_eval": persistence_eval,
    "baseline_eval": baseline_eval,
    "best_model": best_model,
    "prediction_series": prediction_series,
    "union_predictions": union_predictions,
    "linear_regression_optimality": linear_regression_optimality,
    "boosted_three_rounds": boosted_three_rounds,
    "model_comparison": model_comparison,
    "model_predictions": model_predictions,
    "scored_actuals": scored_actuals,
    "published_baseline": published_baseline,
    "best_trained_model": best_trained_model,
    "feature_importance": feature_importances,
    "top_features": top_five_features,
    "slice_daily": slice_daily,
    "slice_single_day": slice_single_day,
    "slice_hourly": slice_hourly,
    "display_table": display_table,
    "headline_metrics": headline_metrics,
    "city_list": city_list,
    "first_cities": first_cities,
    "date_bounds": date_bounds,
    "backfill_window": backfill_window,
    "request_set": request_set,
    "archive_request_set": archive_request_set,
    "snapshot_ingest": snapshot_ingest,
    "landed_forecasts": landed_forecasts,
    "landed_archive": landed_archive,
    "landed_rejects": landed_rejects,
    "parsed_bodies": parsed_bodies,
    "incremental_history": incremental_history,
    "newest_view": newest_view,
    "incremental_actuals": incremental_actuals,
    "incremental_accuracy": incremental_accuracy,
    "incremental_curve": incremental_curve,
    "replaced_table": replaced_table,
    "accuracy_ordered": accuracy_ordered,
    "lead_time_curve_states": lead_time_curve_states,
    "metrics_states": metrics_states,
    "snapshot_rejects": snapshot_rejects,
    "csv_export": csv_export,
    "parameterised_sql": parameterised_sql,
    "rounding": rounding,
}


def entry(spark: SparkSession) -> DataFrame:
    """Daily gold of the newest forecast runs, from payloads to rollup."""
    return gold_daily(spark, "/root/testdata/sf0.001")


def _corpus() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries of the training-data operators, where that subpackage is installed."""
    try:
        import corpus_pipeline
        from stratacast.llm import queries as corpus
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "stratacast.llm"):
            raise
        return {}, {}
    oracles = dict(corpus.ORACLES)
    if corpus_pipeline.ORACLE_SQL is not None:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return corpus.QUERIES | {"pipeline": corpus_pipeline.run}, oracles


def queries() -> dict[str, Query]:
    return _QUERIES | _corpus()[0]


def oracle_sql() -> dict[str, str]:
    return ORACLES | _corpus()[1]
