import json
import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratacast.__main__ import main
from stratacast.operators import evaluate, models, registry
from stratacast.operators.accuracy import lead_time_accuracy_from_tables
from stratacast.operators.features import FEATURES, TARGET, build_features
from stratacast.operators.quality import EmptyResult
from stratacast.operators.split import chronological_split, split_summary
from stratacast.plans import pipelines, serve
from stratacast.schemas import (
    FEATURE_IMPORTANCE,
    GOLD_DAILY,
    GOLD_HOURLY,
    HISTORICAL_RAW,
    HOURLY,
    LEAD_TIME_ACCURACY,
    MODEL_EVALUATION,
    MODEL_PREDICTIONS,
    SCHEMAS,
    WEATHER_RAW,
)
from stratacast.sources.tables import NoData, read_table

CITIES = "city string, country string, latitude double, longitude double"
FETCHED = "city string, status int, raw_response string"
START = date(2024, 1, 1)


def _temperature(city, d):
    offset = {"North": -5.0, "South": 12.0}[city]
    return round(offset + 10 * math.sin(2 * math.pi * d / 365.25) + (d * 37 % 11) / 4, 2)


def _archive_doc(city, n_days):
    days = [(START + timedelta(days=d)).isoformat() for d in range(n_days)]
    means = [_temperature(city, d) for d in range(n_days)]
    return json.dumps(
        {
            "daily": {
                "time": days,
                "temperature_2m_mean": means,
                "temperature_2m_max": [m + 3 for m in means],
                "temperature_2m_min": [m - 3 for m in means],
                "precipitation_sum": [d % 5 / 2 for d in range(n_days)],
                "wind_speed_10m_max": [10 + d % 7 for d in range(n_days)],
            }
        }
    )


def _forecast_doc(first, days=2):
    times = [f"{first + timedelta(days=d)}T{h:02d}:00" for d in range(days) for h in range(24)]
    return json.dumps(
        {
            "hourly": {
                "time": times,
                "temperature_2m": [float(h % 24) for h in range(len(times))],
                "wind_speed_10m": [5.0] * (len(times) - 1) + [None],
            }
        }
    )


@pytest.fixture
def towns(spark):
    return spark.createDataFrame([("North", "NO", 60.0, 5.0), ("South", "IT", 40.0, 15.0)], CITIES)


@pytest.fixture
def actuals(spark):
    rows = spark.range(400).selectExpr(
        "explode(array('North', 'South')) AS city",
        "'XX' AS country",
        "date_add(DATE '2024-01-01', CAST(id AS int)) AS observed_date",
        "10 * sin(id / 58) + (id * 37 % 11) / 4 AS temperature_mean_c",
        "1D AS temperature_max_c",
        "1D AS temperature_min_c",
        "CAST(id % 5 AS double) AS precipitation_mm",
        "CAST(id % 7 AS double) AS wind_speed_max_kmh",
    )
    return rows


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(3)
    actual, predicted = rng.normal(10, 5, 500), rng.normal(10, 5, 500)
    rows = [
        ("m", "A", START, float(a), float(p)) for a, p in zip(actual, predicted)
    ] + [("n", "A", START, 1.0, 3.5)]
    frame = spark.createDataFrame(rows, SCHEMAS[MODEL_PREDICTIONS])
    got = {r.model_name: r for r in evaluate.evaluate(frame).collect()}
    error = predicted - actual
    assert got["m"].mae_c == np.round(np.mean(np.abs(error)), 3)
    assert got["m"].rmse_c == np.round(np.sqrt(np.mean(error**2)), 3)
    assert (got["m"].n_test_rows, got["n"].n_test_rows) == (500, 1)
    assert got["n"].mae_c == got["n"].rmse_c == 2.5
    assert evaluate.evaluate(frame, datetime(2024, 1, 1)).columns == list(
        SCHEMAS[MODEL_EVALUATION].fieldNames()
    )


def test_linear_model_equals_least_squares(spark, actuals):
    train, test = chronological_split(build_features(actuals), 60)
    scored = models.fit_linear(train).transform(test).orderBy("city", "observed_date").toPandas()
    known = train.toPandas()
    design = np.column_stack([np.ones(len(known)), known[FEATURES].to_numpy()])
    solution, *_ = np.linalg.lstsq(design, known[TARGET].to_numpy(), rcond=None)
    expected = np.column_stack([np.ones(len(scored)), scored[FEATURES].to_numpy()]) @ solution
    np.testing.assert_allclose(scored[models.LINEAR].to_numpy(), expected, rtol=1e-6, atol=1e-6)


def test_models_predict_save_and_load(spark, actuals, tmp_path):
    train, test = chronological_split(build_features(actuals), 60)
    summary = {r.part: (r.rows, r.cities) for r in split_summary(train, test).collect()}
    assert summary == {"train": (2 * (400 - 8 - 60), 2), "test": (120, 2)}
    fitted = models.fit_models(train, trees=5)
    predictions = fitted.predictions(test).cache()
    assert predictions.columns == SCHEMAS[MODEL_PREDICTIONS].fieldNames()
    names = {r.model_name: r["count"] for r in predictions.groupBy("model_name").count().collect()}
    assert names == dict.fromkeys([evaluate.PERSISTENCE, models.LINEAR, models.BOOSTED], 120)
    by_union = evaluate.union_predictions(
        evaluate.predict_persistence(test),
        evaluate.predictions_of(fitted.score(test), models.LINEAR, models.LINEAR),
        evaluate.predictions_of(fitted.score(test), models.BOOSTED, models.BOOSTED),
    )
    assert by_union.exceptAll(predictions).isEmpty()
    fitted.save(str(tmp_path / "models"))
    again = models.FittedModels.load(str(tmp_path / "models")).predictions(test)
    assert again.exceptAll(predictions).isEmpty()
    importance = models.feature_importance(spark, fitted.boosted)
    assert importance.count() == len(FEATURES)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    top = [r.importance for r in models.top_features(importance).collect()]
    assert len(top) == 5 and top == sorted(top, reverse=True)


def test_boosted_defaults_are_the_published_configuration():
    assert (models.TREES, models.DEPTH, models.LEARNING_RATE) == (300, 4, 0.05)
    assert (models.ROW_FRACTION, models.COLUMN_FRACTION, models.SEED) == (0.8, 0.8, 42)


def test_both_pipelines_end_to_end(clean_catalog, towns):
    spark = clean_catalog

    def fetched(docs):
        return spark.createDataFrame([(c, 200, d) for c, d in docs.items()], FETCHED)

    made = datetime(2025, 1, 10, 6)
    forecast = fetched({c: _forecast_doc(made.date()) for c in ("North", "South")})
    for run in (made, made + timedelta(days=1)):
        result = pipelines.run_forecast(spark, forecast, towns, run)
        assert result.landed == 2
        assert result.report.filter("failures > 0").isEmpty()
    assert spark.table(WEATHER_RAW).count() == 4
    assert spark.table(GOLD_HOURLY).count() == 2 * 47  # the last hour has no wind
    daily = spark.table(GOLD_DAILY)
    assert daily.count() == 4
    assert {r.last_ingested_at for r in daily.collect()} == {made + timedelta(days=1)}
    assert spark.table(HOURLY).count() == 2 * 47

    archive = fetched({c: _archive_doc(c, 400) for c in ("North", "South")})
    result = pipelines.run_ds(
        spark,
        archive,
        towns,
        datetime(2025, 2, 9, 7),
        years=1,
        trees=2,
        test_days=60,
    )
    assert result.summary == {
        "train_rows": 2 * (400 - 8 - 60),
        "train_cities": 2,
        "test_rows": 120,
        "test_cities": 2,
        "compared_days": 400,
    }
    assert result.landed == 2
    assert spark.table(HISTORICAL_RAW).count() == 2
    evaluation = spark.table(MODEL_EVALUATION)
    assert evaluation.count() == 3
    assert evaluation.schema.fieldNames() == SCHEMAS[MODEL_EVALUATION].fieldNames()
    assert spark.table(MODEL_PREDICTIONS).count() == 3 * 120
    assert spark.table(FEATURE_IMPORTANCE).count() == len(FEATURES)
    accuracy = read_table(spark, LEAD_TIME_ACCURACY)
    assert lead_time_accuracy_from_tables(spark).exceptAll(accuracy).isEmpty()
    by_lead = accuracy.groupBy("lead_time_days").count().collect()
    leads = {r.lead_time_days: r["count"] for r in by_lead}
    assert leads == {0: 4, 1: 2, -1: 2}
    best_first, predictions, importance = serve.load_models(spark)
    errors = [r.mae_c for r in best_first.collect()]
    assert errors == sorted(errors)
    weights = [r.importance for r in importance.collect()]
    assert weights == sorted(weights, reverse=True)
    first = serve.load_accuracy(spark).first()
    assert (first.city, first.forecast_date) == ("North", made.date())
    assert serve.load_daily(spark).first().city == "North"
    assert serve.load_hourly(spark).first().forecast_time == datetime(2025, 1, 10)
    check = accuracy.filter("city = 'North' AND lead_time_days = 1").first()
    day = (check.forecast_date - START).days
    assert check.actual_temperature_c == _temperature("North", day)


def test_accuracy_is_empty_but_typed_without_forecasts(clean_catalog, towns):
    spark = clean_catalog
    archive = spark.createDataFrame([("North", 200, _archive_doc("North", 120))], FETCHED)
    pipelines.run_ds(
        spark,
        archive,
        towns,
        datetime(2025, 2, 9),
        trees=1,
        test_days=20,
    )
    table = read_table(spark, LEAD_TIME_ACCURACY)
    assert table.isEmpty() and table.columns == SCHEMAS[LEAD_TIME_ACCURACY].fieldNames()
    with pytest.raises(NoData, match="still empty"):
        serve.load_accuracy(spark)
    with pytest.raises(NoData, match="does not exist yet: run the forecast pipeline"):
        serve.load_daily(spark)


def test_models_are_saved_by_run(clean_catalog, actuals, tmp_path):
    spark = clean_catalog
    with pytest.raises(NoData):
        registry.load_models(spark)
    train, test = chronological_split(build_features(actuals), 60)
    first, second = datetime(2025, 2, 9), datetime(2025, 2, 10)
    old, new = models.fit_models(train, trees=1), models.fit_models(train, trees=3)
    paths = [registry.save_models(spark, m, at) for m, at in ((old, first), (new, second))]
    assert len(set(paths)) == 2 and registry.model_runs(spark).first()["path"] == paths[1]
    scores = [m.predictions(test).toPandas() for m in (old, new)]
    again = registry.load_models(spark).predictions(test).toPandas()
    assert again.equals(scores[1]) and not again.equals(scores[0])
    assert registry.load_models(spark, first).predictions(test).toPandas().equals(scores[0])
    # A run whose files are not all written is not listed.
    half = models.FittedModels(new.linear, None)
    with pytest.raises(AttributeError):
        registry.save_models(spark, half, datetime(2025, 2, 11))
    assert registry.model_runs(spark).count() == 2
    with pytest.raises(NoData):
        registry.load_models(spark, datetime(2020, 1, 1))


def test_pipelines_stop_when_nothing_lands(clean_catalog, towns):
    spark = clean_catalog
    failed = spark.createDataFrame([("North", 500, None)], FETCHED)
    with pytest.raises(EmptyResult):
        pipelines.run_forecast(spark, failed, towns, datetime(2025, 1, 1))
    with pytest.raises(EmptyResult):
        pipelines.run_ds(spark, failed, towns, datetime(2025, 1, 1))
    assert not spark.catalog.databaseExists("gold")


def test_command_line(clean_catalog, tmp_path):
    spark = clean_catalog
    docs = [(c, 200, _forecast_doc(date(2025, 1, 10))) for c in ("London", "Tokyo")]
    spark.createDataFrame(docs, FETCHED).write.parquet(str(tmp_path / "fetched"))
    assert main(["forecast", "--fetched", str(tmp_path / "fetched")]) == 2
    assert serve.city_list(spark.table(GOLD_DAILY)).count() == 2


def test_model_queries_train_all_rounds_each(spark, monkeypatch):
    import __spark_entry__ as entry

    class Trained(Exception):
        pass

    def fit(train, *rounds):
        assert rounds in ((), (models.TREES,))
        raise Trained

    rows = spark.range(40).selectExpr("id", "id AS value")
    monkeypatch.setattr(entry, "fit_models", fit)
    monkeypatch.setattr(entry, "fit_boosted", fit)
    monkeypatch.setattr(entry.split, "chronological_split", lambda frame: (frame, frame))
    monkeypatch.setattr(entry, "_features", lambda spark, folder: rows)
    for name in ("model_comparison", "model_predictions", "feature_importance", "top_features"):
        with pytest.raises(Trained):
            entry.queries()[name](spark, "folder")
