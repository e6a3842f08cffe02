from datetime import date, datetime

from stratacast.operators.accuracy import (
    lead_time_accuracy,
    lead_time_accuracy_from_tables,
    lead_time_curve,
)
from stratacast.schemas import (
    DAILY_ACTUALS,
    HOURLY_HISTORY,
    LEAD_TIME_ACCURACY,
    SCHEMAS,
    columns,
)
from stratacast.sources.tables import replace

ACTUAL_DAY = date(2024, 1, 3)


def _history(spark):
    def hour(city, made, h, temperature):
        return (city, "XX", 0.0, 0.0, made, datetime(2024, 1, 3, h), temperature, None, None, 1.0)

    return spark.createDataFrame(
        [
            hour("A", datetime(2024, 1, 1, 6), 0, 10.0),
            hour("A", datetime(2024, 1, 1, 6), 1, 12.0),
            hour("A", datetime(2024, 1, 1, 18), 0, 17.0),  # a second run of that day: pooled
            hour("A", datetime(2024, 1, 3, 6), 0, 15.0),
            hour("A", datetime(2024, 1, 4, 1), 0, 14.0),  # west of UTC: made after the local day
            hour("B", datetime(2024, 1, 1, 6), 0, 10.0),  # no actual
        ],
        SCHEMAS[HOURLY_HISTORY],
    )


def _actuals(spark):
    rows = [("A", "XX", ACTUAL_DAY, 14.0, 0.0, 0.0, 0.0, 0.0, None)]
    return spark.createDataFrame(rows, SCHEMAS[DAILY_ACTUALS])


def test_error_by_lead_time(spark):
    detail = lead_time_accuracy(_history(spark), _actuals(spark))
    assert detail.columns == columns(LEAD_TIME_ACCURACY)
    got = {r.lead_time_days: r for r in detail.collect()}
    assert {k: r.abs_error_c for k, r in got.items()} == {2: 1.0, 0: 1.0, -1: 0.0}
    assert got[2].forecast_temperature_c == 13.0
    curve = lead_time_curve(detail).orderBy("lead_time_days").collect()
    assert [tuple(r) for r in curve] == [(-1, 0.0, 1), (0, 1.0, 1), (2, 1.0, 1)]


def test_missing_or_empty_sides_give_a_typed_empty_table(clean_catalog):
    spark = clean_catalog
    expected = [(f.name, f.dataType) for f in SCHEMAS[LEAD_TIME_ACCURACY]]

    def check():
        table = lead_time_accuracy_from_tables(spark)
        assert table.isEmpty()
        assert [(f.name, f.dataType) for f in table.schema] == expected

    check()
    replace(_history(spark), HOURLY_HISTORY)
    check()
    replace(_actuals(spark).limit(0), DAILY_ACTUALS)
    check()
    replace(_actuals(spark), DAILY_ACTUALS)
    assert lead_time_accuracy_from_tables(spark).count() == 3
