"""Chronological train/test split."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratacast.operators.features import FEATURES, TARGET

TEST_DAYS = 90


def chronological_split(
    features: DataFrame,
    test_days: int = TEST_DAYS,
    day: str = "observed_date",
    required: Sequence[str] = (*FEATURES, TARGET),
) -> tuple[DataFrame, DataFrame]:
    """(train, test): the last ``test_days`` calendar days are the test set.

    Rows with a missing required value go first, so the cutoff counts back
    from the last complete day. It is one date for all entities and stays in
    the plan as a scalar subquery.
    """
    complete = features.dropna(subset=list(required))
    cutoff = complete.agg(F.date_sub(F.max(day), test_days)).scalar()
    return complete.filter(F.col(day) <= cutoff), complete.filter(F.col(day) > cutoff)


def split_summary(train: DataFrame, test: DataFrame) -> DataFrame:
    """Row and city counts of both halves."""
    sizes = train.select(F.lit("train").alias("part"), "city").unionByName(
        test.select(F.lit("test").alias("part"), "city")
    )
    return sizes.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("city").alias("cities")
    )
