"""Run a pipeline: spark-submit -m style entry point.

    python -m stratacast forecast --fetched <folder>
    python -m stratacast ds --fetched <folder> [--years 2 | --window-days 14]

``--fetched`` is a parquet folder of answers: city, status, raw_response.
"""

import argparse

from pyspark.sql import SparkSession

from stratacast.operators.models import TREES
from stratacast.plans.pipelines import run_ds, run_forecast
from stratacast.sources.cities import cities


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stratacast")
    commands = parser.add_subparsers(dest="command", required=True)
    forecast = commands.add_parser("forecast", help="land forecasts, rebuild silver and gold")
    ds = commands.add_parser("ds", help="land the archive, train, score forecasts")
    for command in (forecast, ds):
        command.add_argument("--fetched", required=True)
    ds.add_argument("--years", type=int, default=2)
    ds.add_argument("--window-days", type=int, help="ask for recent days instead of years")
    ds.add_argument("--trees", type=int, default=TREES)
    ds.add_argument("--models-folder")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.getOrCreate()
    fetched = spark.read.parquet(options.fetched)
    if options.command == "forecast":
        result = run_forecast(spark, fetched, cities(spark))
    else:
        result = run_ds(
            spark,
            fetched,
            cities(spark),
            years=options.years,
            window_days=options.window_days,
            trees=options.trees,
            models_folder=options.models_folder,
        )
    print(f"landed {result.landed} payloads; all checks passed")
    return result.landed


if __name__ == "__main__":
    main()
