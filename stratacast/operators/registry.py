"""Trained models by run: a folder each, and a table that lists the complete ones."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.operators.models import FittedModels
from stratacast.schemas import MODEL_RUNS, SCHEMAS
from stratacast.sources.tables import NoData, append, ensure_table, named, read_table, table_exists


def models_home(spark: SparkSession) -> str:
    """The folder next to the gold tables that runs' models are saved in by default."""
    ensure_table(spark, MODEL_RUNS)
    home = spark.catalog.getDatabase(named(spark, MODEL_RUNS).split(".")[0]).locationUri
    return f"{home.rstrip('/')}/models"


def save_models(
    spark: SparkSession, models: FittedModels, trained_at: datetime, folder: str | None = None
) -> str:
    """Save a run's models in a folder of their own and list it; the folder.

    A run is listed after all its files are written, so readers never load half a run, and
    no run writes over another, also if both have the same instant.
    """
    if trained_at.tzinfo is None:
        trained_at = trained_at.replace(tzinfo=timezone.utc)
    stamp = trained_at.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    path = f"{(folder or models_home(spark)).rstrip('/')}/{stamp}-{uuid.uuid4().hex[:8]}"
    models.save(path)
    append(spark.createDataFrame([(trained_at, path)], SCHEMAS[MODEL_RUNS]), MODEL_RUNS)
    return path


def model_runs(spark: SparkSession) -> DataFrame:
    """All saved runs, newest first."""
    if not table_exists(spark, MODEL_RUNS):
        raise NoData("no models have been saved yet: run the training pipeline first")
    return read_table(spark, MODEL_RUNS).orderBy(F.desc("trained_at"), F.desc("path"))


def load_models(spark: SparkSession, as_of: datetime | None = None) -> FittedModels:
    """The models of the newest run, or of the newest one trained at ``as_of`` or before."""
    runs = model_runs(spark)
    if as_of is not None:
        if as_of.tzinfo is None:
            as_of = as_of.replace(tzinfo=timezone.utc)
        runs = runs.filter(F.col("trained_at") <= F.lit(as_of))
    newest = runs.first()
    if newest is None:
        raise NoData("no models have been saved by then")
    return FittedModels.load(newest["path"])
