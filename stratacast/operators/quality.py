"""Declared checks and their failure counts."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratacast.operators.evaluate import union_predictions as union_all
from stratacast.schemas import (
    DAILY_ACTUALS,
    GOLD_DAILY,
    GOLD_HOURLY,
    HOURLY,
    HOURLY_HISTORY,
)

# The declared checks of each table.
NOT_NULL = {
    GOLD_DAILY: ["city_date_key", "city", "forecast_date", "avg_temperature_c"],
    GOLD_HOURLY: ["city_hour_key", "city", "forecast_time", "temperature_c"],
    HOURLY: ["city", "forecast_time", "temperature_c", "wind_speed_kmh"],
    HOURLY_HISTORY: ["city", "forecast_time", "ingested_at", "temperature_c"],
    DAILY_ACTUALS: ["city", "observed_date", "temperature_mean_c"],
}
UNIQUE = {GOLD_DAILY: ["city_date_key"], GOLD_HOURLY: ["city_hour_key"]}


class CheckFailed(Exception):
    """A declared check found offending rows."""


class EmptyResult(Exception):
    """A step that must produce rows produced none."""


def _null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _report(counts: DataFrame, table: str, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per check (column, kind, name of its count) from one row of counts."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(kind).alias("check"), F.col(n).alias("failures"))
            for c, kind, n in checks
        ]
    )
    return counts.select(F.lit(table).alias("table"), F.inline(rows))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Null count of every column, from a single aggregate over the table."""
    return table_report(df, table, columns, [])


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    return table_report(df, table, [], [column])


def table_report(
    df: DataFrame, table: str, required: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Null counts of ``required`` and repeated values of ``keys``, from one scan of the table.

    Rows are grouped by the first key, if there is one, with each group's null counts; adding
    up the groups gives both kinds of checks. Groups are combined before they are shuffled,
    and only keys and counts are. Every further key is a scan of its own.
    """
    checks = [(c, "not_null", f"_null_{k}") for k, c in enumerate(required)]
    nulls = [_null_count(c).alias(name) for c, _, name in checks]
    if not keys:
        return _report(df.agg(*nulls), table, checks)
    first, *others = keys
    groups = df.groupBy(F.col(first).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *nulls)
    repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("_repeated")
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for _, _, n in checks]
    report = _report(groups.agg(repeated, *sums), table, [*checks, (first, "unique", "_repeated")])
    return union_all(report, *[unique(df, table, key) for key in others])


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared check of the given tables, one row each; one scan per table."""
    return union_all(
        *[
            table_report(df, name, NOT_NULL.get(name, []), UNIQUE.get(name, []))
            for name, df in tables.items()
            if name in NOT_NULL or name in UNIQUE
        ]
    )


def require_checks(report: DataFrame) -> None:
    """Raise with the list of failed checks; the report has one row per check."""
    failed = report.filter("failures > 0").collect()
    if failed:
        lines = [f"{r['table']}.{r['column']} {r['check']}: {r['failures']}" for r in failed]
        raise CheckFailed("; ".join(lines))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyResult(f"{what} produced no rows")
    return df
