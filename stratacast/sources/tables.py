"""Named tables: create, append, replace, read, export."""

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratacast.schemas import HISTORICAL_RAW, INGEST_DATE, PARTITIONS, SCHEMAS, WEATHER_RAW

SNAPSHOT_LOGS = (WEATHER_RAW, HISTORICAL_RAW)
LAYERS = ("bronze", "silver", "gold")
# Session setting: what the databases' names begin with.
LAKE = "stratacast.lake"
# How long replaced rows stay for readers that are still at them.
KEEP_HOURS = 24.0


class NoData(Exception):
    """A table that a reader needs is missing or empty."""


def named(spark: SparkSession, table: str) -> str:
    """A table's name in the session's lake: LAKE is put before its database.

    Without that setting layers are databases of their own names. With it, several lakes
    share a catalog.
    """
    return f"{spark.conf.get(LAKE, '')}{table}" if "." in table else table


@contextmanager
def lake(spark: SparkSession, prefix: str) -> Iterator[None]:
    """Tables that are named inside are those of another lake of the catalog."""
    before = spark.conf.get(LAKE, "")
    spark.conf.set(LAKE, prefix)
    try:
        yield
    finally:
        spark.conf.set(LAKE, before)


def drop_lake(spark: SparkSession, prefix: str) -> None:
    """Drop all tables of a lake that has a prefix."""
    if not prefix:
        raise ValueError("only a lake with a prefix can be dropped")
    for database in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{database} CASCADE")


def layer_database(layer: str | None, default: str = "default") -> str:
    """A layer's name is its database name, without any prefix."""
    return layer.strip() if layer is not None else default


def _ensure_database(spark: SparkSession, table: str) -> None:
    if "." in table:
        database = layer_database(named(spark, table).split(".")[0])
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def ensure_table(spark: SparkSession, table: str, schema: T.StructType | None = None) -> None:
    """Create a table with its declared schema and partitions unless it exists.

    Partitions let readers of the newest snapshots, or of some days, skip the others, and let
    a run replace only those that changed.
    """
    schema = schema or SCHEMAS[table]
    _ensure_database(spark, table)
    parts = PARTITIONS.get(table, {})
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    fields += [f"`{c}` {t.simpleString()}" for c, t in parts.items() if c not in schema.names]
    layout = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {named(spark, table)} ({', '.join(fields)}) USING parquet
        OPTIONS ('partitionOverwriteMode' = 'dynamic') {layout}"""
    )


def append(df: DataFrame, table: str) -> int:
    """Append to a declared table and return the rows written, in one job."""
    spark = df.sparkSession
    ensure_table(spark, table)
    rows = df.select(*SCHEMAS[table].fieldNames())
    if table in SNAPSHOT_LOGS:
        rows = rows.withColumn(INGEST_DATE, F.to_date("ingested_at"))
    landed = Observation("landed")
    rows.observe(landed, F.count(F.lit(1)).alias("rows")).write.insertInto(named(spark, table))
    return landed.get["rows"]


def overwrite_partitions(df: DataFrame, table: str, scope: Column) -> None:
    """Make ``df`` all that a declared table holds in the partitions of ``scope``.

    ``scope`` is a condition on partition columns, and all rows of ``df`` meet it. Partitions
    outside of it are neither read nor written. A run that dies in between leaves old and new
    partitions side by side; running it again makes all of them new.
    """
    spark = df.sparkSession
    ensure_table(spark, table)
    parts, name = list(PARTITIONS[table]), named(spark, table)
    stored = spark.table(name)
    before = {tuple(r) for r in stored.filter(scope).select(*parts).distinct().collect()}
    written = Observation("written")
    seen = F.collect_set(F.struct(*parts)).alias("parts")
    # Few files per partition, and large partitions over several tasks.
    rows = df.select(*stored.columns).hint("rebalance", *parts).observe(written, seen)
    rows.write.mode("overwrite").insertInto(name)
    after = {tuple(r) for r in written.get["parts"]}
    for values in before - after:
        spec = ", ".join(f"{c} = {_literal(v)}" for c, v in zip(parts, values))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(name)


def _literal(value: Any) -> str:
    return f"DATE'{value}'" if isinstance(value, date) else f"'{value}'"


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {named(spark, table)}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def _versions(spark: SparkSession, table: str) -> str:
    """The folder that holds the versions of a replaced table."""
    database, _, name = named(spark, table).rpartition(".")
    home = spark.catalog.getDatabase(database or "default").locationUri
    return f"{home.rstrip('/')}/{name}.versions"


def replace(
    df: DataFrame, table: str, order_by: Sequence[str] = (), keep_hours: float = KEEP_HOURS
) -> DataFrame:
    """Rebuild a table in full and return it.

    The rows are written to a new folder, and then the table's location is switched, in one
    change of the catalog: readers see all old rows or all new ones, also if writing fails.
    Frames that were planned before the switch go on reading the old folder, which is
    removed by a replace that begins ``keep_hours`` or more after it was written.

    With ``order_by`` the files hold disjoint ranges of those columns, so
    readers that filter on them skip files by their statistics.
    """
    spark = df.sparkSession
    name = named(spark, table)
    _ensure_database(spark, table)
    rows = df.select(*SCHEMAS[table].fieldNames()) if table in SCHEMAS else df
    if order_by:
        rows = rows.orderBy(*order_by)
    folder = f"{_versions(spark, table)}/{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    if _is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet LOCATION '{folder}'")
    elif spark.table(name).dtypes == rows.dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    else:
        # Other columns: no single change of the catalog does it.
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    remove_old_versions(spark, table, keep_hours)
    return spark.table(name)


def remove_old_versions(spark: SparkSession, table: str, keep_hours: float = KEEP_HOURS) -> int:
    """Remove folders of replaced rows that are older than ``keep_hours``; how many were."""
    path, files = _file_system(spark, _versions(spark, table))
    if not files.exists(path):
        return 0
    current = _location(spark, table).rstrip("/").rpartition("/")[2]
    before = (time.time() - 3600 * keep_hours) * 1000
    removed = 0
    for found in files.listStatus(path):
        if found.getPath().getName() != current and found.getModificationTime() <= before:
            files.delete(found.getPath(), True)
            removed += 1
    return removed


def publish_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """Register a model as a view in the catalog, for all sessions; nothing is computed.

    Its text is planned anew at each read, so it follows the tables it names.
    """
    _ensure_database(spark, name)
    shown = named(spark, name)
    if spark.catalog.tableExists(shown) and not _is_view(spark, shown):
        spark.sql(f"DROP TABLE {shown}")
    spark.sql(f"CREATE OR REPLACE VIEW {shown} AS {sql}")
    return read_table(spark, name)


def require_table(spark: SparkSession, table: str, filled_by: str) -> DataFrame:
    """A table's rows, or an error that says which run fills it."""
    if not table_exists(spark, table):
        raise NoData(f"{table} does not exist yet: run the {filled_by} pipeline first")
    rows = read_table(spark, table)
    if rows.isEmpty():
        raise NoData(f"{table} is still empty: it is filled by the {filled_by} pipeline")
    return rows


def training_columns(actuals: DataFrame) -> DataFrame:
    """The columns of the daily actuals that models are built from."""
    return actuals.select(
        "city",
        "country",
        "observed_date",
        "temperature_mean_c",
        "temperature_max_c",
        "temperature_min_c",
        "precipitation_mm",
        "wind_speed_max_kmh",
    )


def table_exists(spark: SparkSession, table: str) -> bool:
    name = named(spark, table)
    database, _, _ = name.rpartition(".")
    if database and not spark.catalog.databaseExists(database):
        return False
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A table's or view's rows as they are now, in the declared order of columns.

    A session remembers files and folders of tables it has read; what other sessions have
    changed since is looked up again.
    """
    name = named(spark, table)
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    return rows.select(*SCHEMAS[table].fieldNames()) if table in SCHEMAS else rows


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def table_or_empty(spark: SparkSession, table: str) -> DataFrame:
    """A declared table, or its typed empty frame while it does not exist."""
    if not table_exists(spark, table):
        return empty_table(spark, SCHEMAS[table])
    return read_table(spark, table)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def query(
    spark: SparkSession,
    sql: str,
    args: dict[str, Any] | list[Any] | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """Run SQL with bound parameters; ``{name}`` in the text refers to a frame."""
    return spark.sql(sql, args=args, **frames)
