"""Predictions in long form and their error metrics."""

from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratacast.functions.rounding import round_half_even
from stratacast.operators.features import TARGET
from stratacast.schemas import MODEL_PREDICTIONS, columns

PERSISTENCE = "persistence_baseline"


def predictions_of(scored: DataFrame, model_name: str, predicted: str) -> DataFrame:
    """One model's predictions from a scored test frame."""
    return scored.select(
        F.lit(model_name).alias("model_name"),
        "city",
        "observed_date",
        F.col(TARGET).alias("actual_c"),
        F.col(predicted).alias("predicted_c"),
    )


def predict_persistence(test: DataFrame) -> DataFrame:
    """Tomorrow is like today."""
    return predictions_of(test, PERSISTENCE, "temperature_mean_c")


def union_predictions(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unpivot_predictions(scored: DataFrame, predicted: Mapping[str, str]) -> DataFrame:
    """The union of all models' predictions from one pass over the test frame.

    ``predicted`` maps model name to the column holding its predictions.
    """
    per_model = F.array(
        *[
            F.struct(F.lit(name).alias("model_name"), F.col(column).alias("predicted_c"))
            for name, column in predicted.items()
        ]
    )
    long = scored.select(
        "city", "observed_date", F.col(TARGET).alias("actual_c"), F.inline(per_model)
    )
    return long.select(*columns(MODEL_PREDICTIONS))


def evaluate(predictions: DataFrame, trained_at: datetime | None = None) -> DataFrame:
    """MAE, RMSE and row count per model, in one aggregate."""
    error = F.col("predicted_c") - F.col("actual_c")
    metrics = predictions.groupBy("model_name").agg(
        round_half_even(F.avg(F.abs(error)), 3).alias("mae_c"),
        round_half_even(F.sqrt(F.avg(error * error)), 3).alias("rmse_c"),
        F.count(F.lit(1)).alias("n_test_rows"),
    )
    if trained_at is None:
        return metrics
    if trained_at.tzinfo is None:
        trained_at = trained_at.replace(tzinfo=timezone.utc)
    return metrics.withColumn("trained_at", F.lit(trained_at))
