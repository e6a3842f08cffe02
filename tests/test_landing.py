import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stratacast.schemas import (
    HISTORICAL_RAW,
    INGEST_DATE,
    REJECTED_ANSWERS,
    WEATHER_RAW,
    columns,
)
from stratacast.sources import landing, tables
from stratacast.sources.cities import SCHEMA as CITY_SCHEMA
from stratacast.sources.cities import cities

DOC = json.dumps(
    {
        "hourly": {
            "time": ["2026-05-04T12:00", "2026-05-04T13:00"],
            "temperature_2m": [14.25, 13.5],
            "relative_humidity_2m": [71, 68],
            "precipitation": [1.2, 0.4],
            "wind_speed_10m": [8.6, 9.4],
        }
    }
)
RUN = datetime(2025, 11, 17, 6, 0)
FETCHED = "city string, status int, raw_response string"


@pytest.fixture
def towns(spark):
    rows = [("Quito", "EC", -0.25, -78.5), ("Elsewhere", "GB", 3.0, 4.0)]
    return spark.createDataFrame(rows, CITY_SCHEMA)


def test_one_answer_lands_unchanged(clean_catalog, towns):
    spark = clean_catalog
    fetched = spark.createDataFrame([("Quito", 200, DOC)], FETCHED)
    assert landing.land_forecasts(fetched, towns, RUN) == 1
    row = spark.table(WEATHER_RAW).first()
    assert row.asDict() == {
        "ingested_at": RUN,
        "city": "Quito",
        "country": "EC",
        "latitude": -0.25,
        "longitude": -78.5,
        "raw_response": DOC,
        INGEST_DATE: RUN.date(),
    }


def test_runs_append_and_share_one_instant(clean_catalog, towns):
    spark = clean_catalog
    fetched = spark.createDataFrame([("Quito", 200, DOC), ("Elsewhere", 200, DOC)], FETCHED)
    eastern = datetime(2025, 11, 18, 1, 0, tzinfo=timezone(timedelta(hours=-5)))
    assert landing.land_forecasts(fetched, towns, RUN) == 2
    assert landing.land_forecasts(fetched, towns, eastern) == 2
    counts = spark.table(WEATHER_RAW).groupBy("ingested_at").count().collect()
    assert {(r.ingested_at, r["count"]) for r in counts} == {(RUN, 2), (datetime(2025, 11, 18, 6), 2)}


def test_failures_do_not_stop_other_cities(clean_catalog, towns):
    spark = clean_catalog
    fetched = spark.createDataFrame(
        [
            ("Quito", 200, DOC),
            ("Elsewhere", 503, "busy"),
            ("Elsewhere", None, None),
            ("Elsewhere", 200, '{"hourly":'),
            ("Nowhere", 200, DOC),
        ],
        FETCHED,
    )
    accepted, rejected = landing.snapshot_batch(fetched, towns, RUN)
    assert [r.city for r in accepted.collect()] == ["Quito"]
    assert sorted((r.city, r.reason) for r in rejected.collect()) == [
        ("Elsewhere", "body is not JSON"),
        ("Elsewhere", "no answer"),
        ("Elsewhere", "status 503"),
        ("Nowhere", "unknown city"),
    ]
    assert landing.land_forecasts(fetched, towns, RUN) == 1
    kept = spark.table(REJECTED_ANSWERS)
    assert sorted(r.reason for r in kept.filter(F.col("log") == WEATHER_RAW).collect()) == [
        "body is not JSON",
        "no answer",
        "status 503",
        "unknown city",
    ]
    assert landing.land_archive(fetched, towns, RUN, date(2026, 9, 2)) == 1
    archive = kept.sparkSession.table(REJECTED_ANSWERS).filter(F.col("log") == HISTORICAL_RAW)
    assert archive.count() == 4 and {r.ingested_at for r in archive.collect()} == {RUN}


def test_nothing_is_written_when_every_city_fails(clean_catalog, towns):
    spark = clean_catalog
    fetched = spark.createDataFrame([("Quito", None, None)], FETCHED)
    assert landing.land_forecasts(fetched, towns, RUN) == 0
    assert not tables.table_exists(spark, WEATHER_RAW)


JSON_TEXTS = {
    '{"a": 1}': True,
    ' {"a": [1, {"b": null}]}\n': True,
    "[1, 2]": True,
    '"x"': True,
    '{"a": 1} <html>': False,
    '{"a": 1}{"b": 2}': False,
    '{"a": 1}, 2': False,
    "1], [2": False,
    '1}, {"x": 2': False,
    '1, "y": 2': False,
    "{'a': 1}": False,
    '{"a": NaN}': False,
    '{"a": Infinity}': False,
    '{"a": 1, "a": 2}': False,
    '{"a": 01}': False,
    '{"a": "\n"}': False,
    '{"a": tru}': False,
    '{"a": [1}': False,
    '\ufeff{"a": 1}': False,
    "": False,
    "  ": False,
    None: False,
}


def test_bodies_are_json_to_their_end(spark):
    texts = spark.createDataFrame([(t,) for t in JSON_TEXTS], "t string")
    found = {r[0]: r[1] for r in texts.select("t", landing.is_json(F.col("t"))).collect()}
    assert found == JSON_TEXTS


def test_a_repeated_run_lands_once(clean_catalog, towns):
    spark = clean_catalog
    answers = [("Quito", 200, DOC), ("Quito", 200, DOC), ("Elsewhere", 200, "{}"), ("Nowhere", 1, "")]
    fetched = spark.createDataFrame(answers, FETCHED)
    for _ in range(2):
        assert landing.land_forecasts(fetched, towns, RUN) == 2
        assert landing.land_archive(fetched, towns, RUN, date(2026, 9, 2)) == 2
    assert spark.table(WEATHER_RAW).count() == spark.table(HISTORICAL_RAW).count() == 2
    assert spark.table(REJECTED_ANSWERS).count() == 2
    later = RUN + timedelta(hours=1)
    assert landing.land_forecasts(fetched, towns, later) == 2
    assert spark.table(WEATHER_RAW).count() == 4


def test_a_run_that_died_half_way_lands_the_rest(clean_catalog, towns, monkeypatch):
    spark = clean_catalog
    fetched = spark.createDataFrame(
        [("Quito", 200, DOC), ("Elsewhere", 200, "{}"), ("Nowhere", 200, "{}")], FETCHED
    )

    def fails(*_):
        raise RuntimeError("killed")

    # After the rejected answers, before the accepted ones.
    with monkeypatch.context() as patched:
        appended = landing.append
        patched.setattr(
            landing,
            "append",
            lambda rows, table: fails() if table == WEATHER_RAW else appended(rows, table),
        )
        with pytest.raises(RuntimeError):
            landing.land_forecasts(fetched, towns, RUN)
    # Some of the accepted ones had been moved in place.
    landing.append(landing.snapshot_batch(fetched.limit(1), towns, RUN)[0], WEATHER_RAW)
    assert landing.land_forecasts(fetched, towns, RUN) == 2
    assert sorted(r.city for r in spark.table(WEATHER_RAW).collect()) == ["Elsewhere", "Quito"]
    assert spark.table(REJECTED_ANSWERS).count() == 1


def test_answers_are_judged_in_one_pass(clean_catalog, towns):
    spark = clean_catalog
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    fetched = spark.createDataFrame([("Quito", 200, DOC), ("Nowhere", 200, DOC)], FETCHED)
    landing.land_archive(fetched.mapInArrow(counted, FETCHED), towns, RUN, date(2026, 9, 2))
    assert read.value == 2


def test_parsed_bodies_are_written_out_whole(clean_catalog, towns):
    spark = clean_catalog
    body = "struct<hourly: struct<time: array<string>, wind: array<double>, rain: string>>"
    fetched = spark.createDataFrame(
        [("Quito", 200, ((["2026-09-02T00:00"], [1.5, None], None),))],
        f"city string, status int, raw_response {body}",
    )
    before = datetime.now(timezone.utc).replace(tzinfo=None)
    assert landing.land_forecasts(fetched, towns) == 1
    row = spark.table(WEATHER_RAW).first()
    assert json.loads(row.raw_response) == {
        "hourly": {"time": ["2026-09-02T00:00"], "wind": [1.5, None], "rain": None}
    }
    assert before <= row.ingested_at <= before + timedelta(minutes=5)


def test_archive_rows_carry_their_window(clean_catalog, towns):
    spark = clean_catalog
    fetched = spark.createDataFrame([("Quito", 200, '{"daily":{}}')], FETCHED)
    assert landing.land_archive(fetched, towns, RUN, date(2026, 9, 2), window_days=14) == 1
    row = spark.table(HISTORICAL_RAW).first()
    assert (row.start_date, row.end_date) == (date(2026, 8, 14), date(2026, 8, 28))
    assert spark.table(HISTORICAL_RAW).columns == [*columns(HISTORICAL_RAW), INGEST_DATE]


def test_window_of_whole_years(spark):
    first, last = landing.backfill_window(F.lit(date(2026, 9, 2)), years=2)
    row = spark.range(1).select(first.alias("first"), last.alias("last")).first()
    assert (row["first"], row["last"]) == (date(2024, 8, 28), date(2026, 8, 28))


def test_one_request_per_city(spark):
    known = cities(spark)
    assert known.count() == known.select("city").distinct().count() == 54
    forecast = landing.forecast_requests(known)
    assert forecast.count() == 54
    assert forecast.first().forecast_days == 16
    archive = landing.archive_requests(known, F.lit(date(2026, 9, 2)), window_days=14)
    tokyo = archive.filter("city = 'Tokyo'").first()
    assert tokyo.latitude == 35.6762
    assert (tokyo.start_date, tokyo.end_date) == ("2026-08-14", "2026-08-28")


def test_tables(clean_catalog, tmp_path):
    spark = clean_catalog
    assert tables.layer_database(" gold ") == "gold"
    assert tables.layer_database(None) == "default"
    assert not tables.table_exists(spark, "gold.numbers")
    frame = spark.range(10).selectExpr("id", "id % 3 AS g")
    assert tables.replace(frame, "gold.numbers", ["g", "id"]).count() == 10
    assert tables.replace(frame.limit(4), "gold.numbers").count() == 4
    assert tables.table_exists(spark, "gold.numbers")
    tables.publish_view(spark, "silver.lazy_numbers", "SELECT * FROM gold.numbers LIMIT 2")
    assert tables.read_table(spark, "silver.lazy_numbers").count() == 2
    tables.replace(frame.limit(3), "silver.lazy_numbers")
    assert tables.read_table(spark, "silver.lazy_numbers").count() == 3
    sql = "SELECT count(*) AS n FROM {f} WHERE id >= :least"
    assert tables.query(spark, sql, {"least": 7}, f=frame).first().n == 3
    tables.export_csv(frame, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["id", "g"] and back.count() == 10
    empty = tables.table_or_empty(spark, WEATHER_RAW)
    assert empty.columns == columns(WEATHER_RAW) and empty.isEmpty()


def test_a_replaced_table_is_whole_for_every_reader(clean_catalog, monkeypatch):
    spark = clean_catalog
    other = spark.newSession()
    tables.replace(spark.range(3).toDF("id"), "gold.numbers")
    planned = other.table("gold.numbers")
    assert planned.count() == 3
    tables.replace(spark.range(5).toDF("id"), "gold.numbers")
    # A reader that began before goes on with the old rows; the next one gets the new ones.
    assert planned.count() == 3
    assert tables.read_table(other, "gold.numbers").count() == 5
    assert tables.read_table(spark, "gold.numbers").count() == 5
    broken = spark.range(9).selectExpr("raise_error('no') AS id").selectExpr("CAST(id AS long) id")
    with pytest.raises(Exception, match="no"):
        tables.replace(broken, "gold.numbers")
    assert spark.table("gold.numbers").count() == 5


def test_old_versions_go_after_a_while(clean_catalog):
    spark = clean_catalog
    for n in (1, 2, 3):
        tables.replace(spark.range(n).toDF("id"), "gold.numbers")
    assert tables.remove_old_versions(spark, "gold.numbers") == 0
    assert tables.remove_old_versions(spark, "gold.numbers", keep_hours=0) >= 2
    assert tables.read_table(spark, "gold.numbers").count() == 3
    tables.replace(spark.range(4).selectExpr("id", "'x' AS name"), "gold.numbers")
    assert spark.table("gold.numbers").columns == ["id", "name"]


def test_one_city_name_in_two_countries(clean_catalog):
    spark = clean_catalog
    towns = spark.createDataFrame(
        [("Cordoba", "AR", -31.5, -64.25), ("Cordoba", "ES", 37.75, -4.75)], CITY_SCHEMA
    )
    asked = "city string, country string, status int, raw_response string"
    fetched = spark.createDataFrame(
        [("Cordoba", "AR", 200, DOC), ("Cordoba", "ES", 200, '{"hourly": {}}')], asked
    )
    accepted, rejected = landing.snapshot_batch(fetched, towns, RUN)
    landed = {(r.country, r.latitude, r.raw_response) for r in accepted.collect()}
    assert landed == {("AR", -31.5, DOC), ("ES", 37.75, '{"hourly": {}}')}
    assert rejected.isEmpty()
    accepted, rejected = landing.snapshot_batch(fetched.drop("country"), towns, RUN)
    assert accepted.isEmpty()
    assert [r.reason for r in rejected.collect()] == ["city of several countries"] * 2
