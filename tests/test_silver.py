import json
from datetime import datetime
from itertools import zip_longest
from random import Random

import pytest
from pyspark.sql import functions as F

from stratacast.functions.payloads import explode_parallel
from stratacast.operators.latest import dedupe_latest, latest_snapshot
from stratacast.plans.silver import silver_daily_actuals, silver_hourly, silver_hourly_history
from stratacast.schemas import (
    DAILY_ACTUALS,
    HISTORICAL_RAW,
    HOURLY,
    HOURLY_HISTORY,
    SCHEMAS,
    WEATHER_RAW,
    columns,
)

RUN_1, RUN_2 = datetime(2026, 9, 1), datetime(2026, 9, 2)
HOURS = ["2026-09-02T00:00", "2026-09-02T01:00"]


def _doc(root="hourly", **arrays):
    return json.dumps({root: arrays})


def _hourly_doc(temperature, wind, times=HOURS, **more):
    return _doc(time=times, temperature_2m=temperature, wind_speed_10m=wind, **more)


def _bronze(spark, *rows):
    full = [(run, city, "US", 1.0, 2.0, doc) for run, city, doc in rows]
    return spark.createDataFrame(full, SCHEMAS[WEATHER_RAW])


def _archive(spark, *rows):
    full = [(run, city, "US", None, None, doc) for run, city, doc in rows]
    return spark.createDataFrame(full, SCHEMAS[HISTORICAL_RAW])


def _zip(spark, doc, **fields):
    df = spark.createDataFrame([(1, doc)], "id int, doc string")
    return [tuple(r)[1:] for r in explode_parallel(df, "doc", "h", fields).collect()]


T = {"t": ("t", "string"), "x": ("x", "double")}


@pytest.mark.parametrize(
    ("doc", "expected"),
    [
        ('{"h":{"t":["a","b"],"x":[1.5,2]}}', [("a", 1.5), ("b", 2.0)]),
        ('{"h":{"t":["a","b"],"x":[1.5]}}', [("a", 1.5), ("b", None)]),
        ('{"h":{"t":["a"],"x":[1.5,null]}}', [("a", 1.5), (None, None)]),
        ('{"h":{"t":["a","b"]}}', [("a", None), ("b", None)]),
        ('{"h":{"t":["a"],"x":null}}', [("a", None)]),
        ('{"h":{"t":["a","b"],"x":["1.5",2]}}', [("a", 1.5), ("b", 2.0)]),
        ('{"h":{"t":[],"x":[]}}', []),
        ('{"h":{}}', []),
        ('{"h":null}', []),
        ('{"other":1}', []),
        ("[1, 2]", []),
        (None, []),
        ('{"more":{"t":["z"]},"h":{"t":["é ü"],"y":[9],"x":[-1e2]}}', [("é ü", -100.0)]),
    ],
)
def test_zip_pads_and_converts(spark, doc, expected):
    assert _zip(spark, doc, **T) == expected


@pytest.mark.parametrize(
    "doc",
    ['{"h":{"t":["a"],"x":["abc"]}}', '{"h":', "", '{"h":{"t":["a"],"x":5}}', "not json"],
)
def test_zip_raises_on_bad_data(spark, doc):
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|MALFORMED_RECORD|CAST_INVALID"):
        _zip(spark, doc, **T)


def test_random_documents_zip_like_zip_longest(spark):
    random = Random(11)

    def array(of):
        kind = random.random()
        if kind < 0.1:
            return None
        return [None if random.random() < 0.2 else of() for _ in range(random.randrange(6))]

    def number():
        value = random.choice([random.randrange(-9, 9), round(random.uniform(-99, 99), 3)])
        return str(value) if random.random() < 0.05 else value

    docs = []
    for i in range(400):
        fields = {"t": array(lambda: f"s{random.randrange(100)}"), "x": array(number)}
        fields |= {"y": array(number), "unused": array(number)}
        docs.append((i, {k: v for k, v in fields.items() if random.random() < 0.9}))
    expected = []
    for i, doc in docs:
        arrays = [doc.get(name) or [] for name in ("t", "x", "y")]
        for t, x, y in zip_longest(*arrays):
            expected.append((i, t, *(None if v is None else float(v) for v in (x, y))))
    df = spark.createDataFrame([(i, json.dumps({"h": d})) for i, d in docs], "id int, doc string")
    got = explode_parallel(df, "doc", "h", T | {"y": ("y", "double")})
    key = lambda row: [(v is not None, v) for v in row]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected, key=key)


def test_kept_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, '{"h":{"t":["a"]}}')], "`odd name.x` int, doc string")
    assert explode_parallel(df, "doc", "h", T).first().asDict() == {
        "odd name.x": 1,
        "t": "a",
        "x": None,
    }


def test_rejected_and_accepted_documents_mix(spark):
    docs = ['{"h":{"t":["a"],"x":["2.5"]}}', '{"h":{"t":["b"],"x":[3]}}']
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string")
    rows = explode_parallel(df, "doc", "h", T).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(0, "a", 2.5), (1, "b", 3.0)]


def test_history_types_filters_and_keeps_every_run(spark):
    bronze = _bronze(
        spark,
        (RUN_1, "A", _hourly_doc([14.25, 13.5], [8.6, 9.4], relative_humidity_2m=[71, None])),
        (RUN_2, "A", _hourly_doc([21.0, None], [12.0, 12.0])),
        (RUN_2, "B", _hourly_doc([21.0, 22.0], [None, 5.0])),
    )
    history = silver_hourly_history(bronze)
    assert history.columns == columns(HOURLY_HISTORY)
    rows = {(r.city, r.ingested_at, r.forecast_time): r for r in history.collect()}
    assert set(rows) == {
        ("A", RUN_1, datetime(2026, 9, 2, 0)),
        ("A", RUN_1, datetime(2026, 9, 2, 1)),
        ("A", RUN_2, datetime(2026, 9, 2, 0)),
        ("B", RUN_2, datetime(2026, 9, 2, 1)),
    }
    kept = rows["A", RUN_1, datetime(2026, 9, 2, 1)]
    assert kept.relative_humidity_pct is None and kept.precipitation_mm is None
    assert kept.temperature_c == 13.5


@pytest.mark.parametrize("text", ["2026-09-02 00:00", "2026-09-02T00:00:00", "soon"])
def test_time_in_another_format_is_an_error(spark, text):
    bronze = _bronze(spark, (RUN_1, "A", _hourly_doc([1.0], [1.0], times=[text])))
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|DateTimeParseException"):
        silver_hourly_history(bronze).collect()


def test_latest_is_per_city_and_keeps_ties(spark):
    bronze = _bronze(
        spark,
        (RUN_1, "A", _hourly_doc([1.0, 1.0], [1.0, 1.0])),
        (RUN_2, "A", _hourly_doc([2.0, 2.0], [1.0, 1.0])),
        (RUN_2, "A", _hourly_doc([3.0, 3.0], [1.0, 1.0])),
        (RUN_1, "B", _hourly_doc([4.0, 4.0], [1.0, 1.0])),
    )
    silver = silver_hourly(bronze)
    assert silver.columns == columns(HOURLY)
    got = sorted((r.city, r.temperature_c) for r in silver.collect())
    assert got == [("A", 2.0), ("A", 2.0), ("A", 3.0), ("A", 3.0), ("B", 4.0), ("B", 4.0)]


def test_latest_without_broadcast_and_with_partition_pruning_is_the_same(spark, monkeypatch):
    log = spark.range(2000).selectExpr(
        # one entity holds a third of the rows
        "IF(id % 3 = 0, 0, id % 97) AS e",
        "TIMESTAMP_NTZ '2026-01-01' + make_dt_interval(CAST(id % 11 AS int)) AS v",
        "id",
    ).withColumn("d", F.to_date("v"))
    expected = sorted(r.id for r in log.withColumn(
        "m", F.expr("max(v) OVER (PARTITION BY e)")
    ).filter("v = m").collect())
    assert sorted(r.id for r in latest_snapshot(log, "e", "v").collect()) == expected
    assert sorted(r.id for r in latest_snapshot(log, "e", "v", "d").collect()) == expected
    monkeypatch.setattr("stratacast.operators.sizing.MAX_BROADCAST_BYTES", 0)
    assert sorted(r.id for r in latest_snapshot(log, "e", "v").collect()) == expected


def test_dedupe_keeps_one_row_even_on_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 2, 20), ("a", 2, 21), ("b", 1, 30)], "k string, v int, x int"
    )
    assert dedupe_latest(df, ["k"], "v").groupBy("k").count().filter("count > 1").isEmpty()
    rows = dedupe_latest(df, ["k"], "v", ["x"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("a", 2, 21), ("b", 1, 30)]


def test_newer_null_actual_does_not_hide_an_older_value(spark):
    days = ["2024-01-01", "2024-01-02"]
    one = _doc(root="daily", time=days, temperature_2m_mean=[1.0, 2.0], wind_speed_10m_max=[5, 6])
    two = _doc(root="daily", time=days, temperature_2m_mean=[1.5, None])
    actuals = silver_daily_actuals(_archive(spark, (RUN_1, "A", one), (RUN_2, "A", two)))
    assert actuals.columns == columns(DAILY_ACTUALS)
    rows = actuals.orderBy("observed_date").collect()
    assert [(r.temperature_mean_c, r.wind_speed_max_kmh, r.ingested_at) for r in rows] == [
        (1.5, None, RUN_2),
        (2.0, 6.0, RUN_1),
    ]


def test_short_refresh_merges_with_long_backfill(spark):
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    long = _doc(root="daily", time=days, temperature_2m_mean=[float(d) for d in range(10)])
    short = _doc(root="daily", time=["2024-01-10", "2024-01-11"], temperature_2m_mean=[90.0, 91.0])
    actuals = silver_daily_actuals(_archive(spark, (RUN_1, "A", long), (RUN_2, "A", short)))
    means = [r.temperature_mean_c for r in actuals.orderBy("observed_date").collect()]
    assert means == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 90.0, 91.0]


def test_bad_date_is_an_error(spark):
    doc = _doc(root="daily", time=["yesterday"], temperature_2m_mean=[1.0])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver_daily_actuals(_archive(spark, (RUN_1, "A", doc))).collect()
