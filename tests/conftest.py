import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratacast.schemas import DAILY_ACTUALS, SCHEMAS  # noqa: E402
from stratacast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def clean_catalog(spark):
    """Drop the layers' tables and views before a test that publishes them."""

    def drop():
        for database in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
        for view in spark.catalog.listTables():
            spark.catalog.dropTempView(view.name)

    drop()
    yield spark
    drop()


@pytest.fixture
def city_series(spark):
    """A series whose mean temperature is a parabola over the days, see parabola()."""

    def make(city="Lima", n_days=26, depth=0.0):
        return spark.range(n_days).selectExpr(
            f"'{city}' AS city",
            "'PE' AS country",
            "date_add(DATE '2023-03-05', CAST(id AS int)) AS observed_date",
            f"id * id / 8D - {depth}D AS temperature_mean_c",
            f"id * id / 4D - {depth}D AS temperature_max_c",
            f"id / 8D - {depth}D AS temperature_min_c",
            "id % 3 / 2D AS precipitation_mm",
            "100D - id AS wind_speed_max_kmh",
        )

    return make


@pytest.fixture
def observations(spark):
    """Daily observations of given days and temperatures; None is null."""

    def make(values, city="A", first=date(2024, 1, 1)):
        """``values`` maps day offset to mean temperature."""
        rows = [
            (city, "XX", first + timedelta(days=d), t, t, t, t and t / 2, t and t + 1, None)
            for d, t in values.items()
        ]
        return spark.createDataFrame(rows, SCHEMAS[DAILY_ACTUALS])

    return make
