"""Regressors on the feature frame."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratacast.operators.boosting import BoostedTrees, Settings, fit_trees
from stratacast.operators.evaluate import PERSISTENCE, unpivot_predictions
from stratacast.operators.features import FEATURES, TARGET
from stratacast.schemas import FEATURE_IMPORTANCE, SCHEMAS

LINEAR = "linear_regression"
BOOSTED = "boosted_trees"

# The published configuration of the boosted model.
TREES = 300
DEPTH = 4
LEARNING_RATE = 0.05
ROW_FRACTION = 0.8
COLUMN_FRACTION = 0.8
SEED = 42
PENALTY = 1.0


def fit_linear(train: DataFrame) -> PipelineModel:
    """Ordinary least squares: one distributed pass for the normal equations."""
    regressor = LinearRegression(
        featuresCol="_features",
        labelCol=TARGET,
        predictionCol=LINEAR,
        regParam=0.0,
        solver="normal",
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    vectors = assembler.transform(train.select(*FEATURES, TARGET)).select("_features", TARGET)
    return PipelineModel([assembler, regressor.fit(vectors)])


def fit_boosted(train: DataFrame, trees: int = TREES) -> BoostedTrees:
    """Boosted trees with the published rates, row and column sampling and L2 penalty."""
    settings = Settings(
        trees=trees,
        depth=DEPTH,
        rate=LEARNING_RATE,
        row_fraction=ROW_FRACTION,
        column_fraction=COLUMN_FRACTION,
        seed=SEED,
        penalty=PENALTY,
    )
    return fit_trees(train.select(*FEATURES, TARGET), FEATURES, TARGET, settings)


@dataclass
class FittedModels:
    linear: PipelineModel
    boosted: BoostedTrees

    def score(self, test: DataFrame) -> DataFrame:
        """The test frame with one prediction column per fitted model."""
        scored = self.linear.transform(test).drop("_features")
        return self.boosted.transform(scored, BOOSTED)

    def predictions(self, test: DataFrame) -> DataFrame:
        return unpivot_predictions(
            self.score(test),
            {PERSISTENCE: "temperature_mean_c", LINEAR: LINEAR, BOOSTED: BOOSTED},
        )

    def save(self, folder: str) -> None:
        self.linear.write().overwrite().save(f"{folder}/{LINEAR}")
        self.boosted.save(SparkSession.active(), f"{folder}/{BOOSTED}")

    @classmethod
    def load(cls, folder: str) -> "FittedModels":
        linear = PipelineModel.load(f"{folder}/{LINEAR}")
        return cls(linear, BoostedTrees.load(SparkSession.active(), f"{folder}/{BOOSTED}"))


def fit_models(train: DataFrame, trees: int = TREES) -> FittedModels:
    return FittedModels(fit_linear(train), fit_boosted(train, trees))


def feature_importance(spark: SparkSession, boosted: BoostedTrees) -> DataFrame:
    """One row per feature of the boosted model; importances sum to one."""
    schema: T.StructType = SCHEMAS[FEATURE_IMPORTANCE]
    rows = [(BOOSTED, name, weight) for name, weight in boosted.importance().items()]
    return spark.createDataFrame(rows, schema)


def top_features(importance: DataFrame, n: int = 5) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)
