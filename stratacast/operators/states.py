"""Error metrics as sums that merge: kept per day, added up for any days."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratacast.functions.rounding import round_half_even

# Errors to ten digits, so that sums are exact and the same in whatever order they are added.
_ONE = "decimal(28,10)"
_SUM = "decimal(38,10)"


def error_states(errors: DataFrame, keys: Sequence[str], error: Column) -> DataFrame:
    """Number, sum of absolute values and sum of squares of ``error`` per key.

    Null errors are not counted; keys that have only such ones have a row with n = 0.
    """
    size = F.abs(error)
    return errors.groupBy(*keys).agg(
        F.count(error).alias("n"),
        _sum(size.cast(_ONE)).alias("sum_abs"),
        _sum((size * size).cast(_ONE)).alias("sum_squares"),
    )


def _sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast(_SUM)


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of coarser keys out of states of finer ones, or of several tables' union."""
    sums = [_sum(F.col(c)).alias(c) for c in ("sum_abs", "sum_squares")]
    return states.groupBy(*keys).agg(F.sum("n").alias("n"), *sums)


def mean_absolute_error() -> Column:
    """Of a state; null without errors."""
    return F.when(F.col("n") > 0, F.col("sum_abs").cast("double") / F.col("n"))


def root_mean_squared_error() -> Column:
    return F.when(F.col("n") > 0, F.sqrt(F.col("sum_squares").cast("double") / F.col("n")))


def curve_from_states(states: DataFrame) -> DataFrame:
    """Mean error and number of comparisons per lead time, whatever days the states are of."""
    return merge_states(states, ["lead_time_days"]).select(
        "lead_time_days",
        mean_absolute_error().alias("mean_absolute_error_c"),
        F.col("n").alias("n_observations"),
    )


def metrics_from_states(states: DataFrame) -> DataFrame:
    """MAE, RMSE and row count per model."""
    return merge_states(states, ["model_name"]).select(
        "model_name",
        round_half_even(mean_absolute_error(), 3).alias("mae_c"),
        round_half_even(root_mean_squared_error(), 3).alias("rmse_c"),
        F.col("n").alias("n_test_rows"),
    )
