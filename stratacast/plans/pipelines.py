"""The two end-to-end runs, each one Spark application."""

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from stratacast.operators.evaluate import evaluate
from stratacast.operators.features import build_features
from stratacast.operators.models import TREES, feature_importance, fit_models
from stratacast.operators.quality import (
    EmptyResult,
    quality_report,
    require_checks,
    require_rows,
)
from stratacast.operators.registry import save_models
from stratacast.operators.split import TEST_DAYS, chronological_split, split_summary
from stratacast.plans.gold import gold_daily, gold_hourly
from stratacast.plans.increments import (
    publish_newest,
    refresh_accuracy,
    refresh_actuals,
    refresh_history,
)
from stratacast.schemas import (
    DAILY_ACTUALS,
    FEATURE_IMPORTANCE,
    GOLD_DAILY,
    GOLD_HOURLY,
    HOURLY,
    HOURLY_HISTORY,
    MODEL_EVALUATION,
    MODEL_PREDICTIONS,
)
from stratacast.session import materialize
from stratacast.sources.landing import land_archive, land_forecasts
from stratacast.sources.tables import replace, training_columns


@dataclass
class RunResult:
    """How many answers the run has in its log, the checks, and counts of what it did."""

    landed: int
    report: DataFrame
    summary: dict[str, int] = field(default_factory=dict)


def run_forecast(
    spark: SparkSession, fetched: DataFrame, cities: DataFrame, run_ts: datetime | None = None
) -> RunResult:
    """Land a forecast run, unpack what is new, rebuild gold, and check them.

    Running it again with the same answers and instant lands nothing twice.
    """
    landed = land_forecasts(fetched, cities, run_ts)
    if not landed:
        raise EmptyResult("forecast run landed no payloads")
    # Payloads are parsed once, into the history; the newest runs are a view of it.
    refresh_history(spark)
    hourly = publish_newest(spark)
    tables = {
        HOURLY: hourly,
        GOLD_DAILY: replace(gold_daily(hourly), GOLD_DAILY, ["forecast_date", "city"]),
        GOLD_HOURLY: replace(gold_hourly(hourly), GOLD_HOURLY, ["forecast_time", "city"]),
    }
    report = materialize(quality_report(tables), "quality")
    require_checks(report)
    return RunResult(landed, report)


def train_and_publish(
    spark: SparkSession,
    actuals: DataFrame,
    trained_at: datetime,
    trees: int = TREES,
    test_days: int = TEST_DAYS,
    models_folder: str | None = None,
) -> dict[str, int]:
    """Fit, save and compare the models; replace the three model tables.

    The feature frame is written once, because fitting passes over it many
    times and the test half is scored by every model. Returns how many rows and cities
    each half has.
    """
    require_rows(actuals, DAILY_ACTUALS)
    features = materialize(build_features(training_columns(actuals)), "features")
    train, test = chronological_split(features, test_days)
    models = fit_models(train, trees)
    save_models(spark, models, trained_at, models_folder)
    predictions = replace(models.predictions(test), MODEL_PREDICTIONS)
    replace(evaluate(predictions, trained_at), MODEL_EVALUATION)
    replace(feature_importance(spark, models.boosted), FEATURE_IMPORTANCE)
    sizes = split_summary(train, test).collect()
    return {f"{r['part']}_{c}": r[c] for r in sizes for c in ("rows", "cities")}


def run_ds(
    spark: SparkSession,
    fetched: DataFrame,
    cities: DataFrame,
    run_ts: datetime | None = None,
    as_of: date | None = None,
    years: int = 2,
    window_days: int | None = None,
    trees: int = TREES,
    test_days: int = TEST_DAYS,
    models_folder: str | None = None,
) -> RunResult:
    """Land an archive run, bring the actuals up to date, train, and score forecasts.

    Only ingestion days that are new or changed are unpacked, only months of actuals that they
    touch are rebuilt, and only forecast days with new runs or new actuals are compared. Without
    any forecast run yet, the accuracy table comes out empty but typed. Models are saved with
    the run's instant, by default next to the gold tables.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    landed = land_archive(fetched, cities, run_ts, as_of or run_ts.date(), years, window_days)
    if not landed:
        raise EmptyResult("archive run landed no payloads")
    # Checks, training and scoring all read both silver models.
    actuals = refresh_actuals(spark)
    history = refresh_history(spark)
    report = materialize(
        quality_report({DAILY_ACTUALS: actuals, HOURLY_HISTORY: history}), "quality"
    )
    require_checks(report)
    summary = train_and_publish(spark, actuals, run_ts, trees, test_days, models_folder)
    summary["compared_days"] = len(refresh_accuracy(spark))
    return RunResult(landed, report, summary)
