from datetime import date
from random import Random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratacast.operators.features import FEATURES, LAGS, TARGET, build_features
from stratacast.operators.split import chronological_split


def _row(df, day):
    return df.filter(F.col("observed_date") == day).first()


def _parabola(day):
    return day * day / 8


def test_every_feature_of_a_parabola(city_series):
    rows = build_features(city_series()).orderBy("observed_date").collect()
    for day, row in enumerate(rows):
        for lag in LAGS:
            want = _parabola(day - lag) if day >= lag else None
            assert row[f"temp_lag_{lag}"] == want
        assert row["wind_lag_1"] == (101 - day if day else None)
        assert row[TARGET] == (_parabola(day + 1) if day < 25 else None)
        frame = [_parabola(d) for d in range(day - 7, day)] if day >= 7 else None
        assert row["temp_rolling_mean_7"] == (pytest.approx(np.mean(frame)) if frame else None)
        if frame:
            assert row["temp_rolling_std_7"] == pytest.approx(np.std(frame, ddof=1))


def test_a_series_has_the_same_features_among_others(city_series):
    lima, cusco = city_series(), city_series("Cusco", 31, depth=50.0)
    together = build_features(lima.unionByName(cusco))
    alone = build_features(lima).unionByName(build_features(cusco))
    assert together.count() == 57
    assert together.exceptAll(alone).isEmpty()


def test_null_inside_the_frame_and_gaps_between_days(observations):
    values = {d: float(d) for d in (0, 1, 2, 3, 5, 6, 7, 8, 9, 12)}
    values[6] = None
    df = build_features(observations(values)).cache()
    after_gap = _row(df, "2024-01-06")
    assert after_gap.temp_lag_1 == 3.0  # the adjacent row, across the missing day
    assert _row(df, "2024-01-10")[TARGET] == 12.0
    assert _row(df, "2024-01-09").temp_rolling_mean_7 is None  # null inside
    assert _row(df, "2024-01-13").temp_rolling_mean_7 is None
    assert _row(df, "2024-01-13")[TARGET] is None


def _pandas_features(pdf):
    out = []
    for _, g in pdf.sort_values("observed_date").groupby("city"):
        g = g.copy()
        t = g.temperature_mean_c
        for k in LAGS:
            g[f"temp_lag_{k}"] = t.shift(k)
        prior = t.shift(1).rolling(7, min_periods=7)
        g["temp_rolling_mean_7"], g["temp_rolling_std_7"] = prior.mean(), prior.std()
        g[TARGET] = t.shift(-1)
        out.append(g)
    return pd.concat(out)


@pytest.mark.parametrize("chunk_days", [1, 3, 10, 100, 100_000])
def test_blocks_of_any_size_give_the_whole_series_result(spark, chunk_days):
    random = Random(chunk_days)
    rows = []
    for city, keep in (("dense", 1.0), ("sparse", 0.05), ("holes", 0.5), ("single", 0.0)):
        for d in range(700):
            if random.random() < keep or (city == "single" and d == 13):
                temperature = None if random.random() < 0.05 else random.uniform(-10, 30)
                rows.append((city, date.fromordinal(719000 + d), temperature, 0.5 * d, 1.0 * d))
    schema = """city string, observed_date date, temperature_mean_c double,
        precipitation_mm double, wind_speed_max_kmh double"""
    frame = spark.createDataFrame(rows, schema)
    got = build_features(frame, chunk_days=chunk_days).toPandas()
    expected = _pandas_features(frame.toPandas())
    keys = ["city", "observed_date"]
    got, expected = got.sort_values(keys), expected.sort_values(keys)
    assert len(got) == len(expected) == len(rows)
    for name in [f"temp_lag_{k}" for k in LAGS] + [TARGET, "temperature_mean_c"]:
        np.testing.assert_array_equal(got[name].to_numpy(), expected[name].to_numpy(), name)
    for name in ("temp_rolling_mean_7", "temp_rolling_std_7"):
        np.testing.assert_allclose(
            got[name].to_numpy(float), expected[name].to_numpy(float), atol=1e-9, err_msg=name
        )


def test_future_rows_never_change_earlier_features(spark, city_series):
    base = city_series(n_days=60)
    changed = base.withColumn(
        "temperature_mean_c",
        F.when(F.col("observed_date") > "2024-02-10", F.lit(-99.0)).otherwise(
            F.col("temperature_mean_c")
        ),
    )
    until = F.col("observed_date") <= "2024-02-10"
    before = build_features(base, chunk_days=9).filter(until).select("observed_date", *FEATURES)
    after = build_features(changed, chunk_days=9).filter(until).select("observed_date", *FEATURES)
    assert before.exceptAll(after).isEmpty()


@pytest.mark.parametrize("test_days", [1, 6, 11])
def test_the_split_cuts_complete_rows_at_one_day(city_series, test_days):
    features = build_features(city_series())
    halves = chronological_split(features, test_days)
    train, test = ([r["observed_date"].toordinal() for r in h.collect()] for h in halves)
    first = date(2023, 3, 5).toordinal()
    # Seven days lack a lag and the last one a target.
    assert sorted(train + test) == [first + d for d in range(7, 25)]
    assert sorted(test) == [first + d for d in range(25 - test_days, 25)]
    for half in halves:
        assert half.dropna(subset=[*FEATURES, TARGET]).count() == half.count()


def test_nan_counts_as_missing(spark, observations):
    values = {d: float(d) for d in range(12)} | {9: float("nan")}
    train, test = chronological_split(build_features(observations(values)), test_days=1)
    assert test.unionByName(train).filter("isnan(temp_lag_1)").isEmpty()
