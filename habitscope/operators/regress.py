"""Seven regressors, trained and scored on all rows of their split."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from habitscope.operators.boost import HistogramBoosting, Settings
from habitscope.operators.forest import BaggedForest
from habitscope.operators.moments import LinearFit, SharedMoments


def linear_fits(
    train: DataFrame, features: str, label: str, ridge: float = 1.0, lasso: float = 0.1
) -> dict[str, LinearFit]:
    """Three linear members, which share one scan of ``train``.

    Ridge minimises ``|y - Xw|^2 + alpha |w|^2``, lasso ``|y - Xw|^2 / 2n + alpha |w|_1``; no
    intercept is penalised. Rows without a label or vector are left out."""
    shared = SharedMoments(train, features, label)
    return {
        "Linear Regression": LinearFit(shared),
        "Ridge Regression": LinearFit(shared, "ridge", ridge),
        "Lasso Regression": LinearFit(shared, "lasso", lasso),
    }


def random_forest(
    features: str, label: str, trees: int = 100, depth: int = 10, seed: int = 42, keys: Sequence[str] = (),
) -> BaggedForest:
    """Every split looks at all features, as is usual for regression forests. Rows are
    drawn by ``keys``, so the trees are the same in any partition layout."""
    return BaggedForest(features, label, tuple(keys), trees, depth, seed=seed)


def boosted_trees(
    features: str, label: str, rounds: int = 100, depth: int = 5, rate: float = 0.1,
    bins: int = 32, min_rows: int = 1, seed: int = 42,
):
    """Boosted trees. With a checkpoint folder set on the session the running
    residuals are checkpointed every 10 rounds, so a lost executor costs few rounds."""
    return GBTRegressor(
        featuresCol=features, labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate,
        maxBins=bins, minInstancesPerNode=min_rows, seed=seed, checkpointInterval=10,
    )


def seven_regressors(
    train: DataFrame, features: str, label: str, trees: int = 100, rounds: int = 100,
    seed: int = 42, keys: Sequence[str] = (),
) -> dict[str, Estimator]:
    """The model line-up. The forest draws its rows by ``keys``. The two histogram boosters take second-order steps on binned
    features; one grows whole levels, the other its best leaf first."""
    return {
        **linear_fits(train, features, label),
        "Random Forest": random_forest(features, label, trees=trees, seed=seed, keys=keys),
        "Gradient Boosting": boosted_trees(features, label, rounds, depth=5, seed=seed),
        "Histogram Boosting": HistogramBoosting(features, label, Settings(rounds, depth=6, bins=256)),
        "Leafwise Boosting": HistogramBoosting(
            features, label, Settings(rounds, depth=6, bins=255, penalty=0.0, min_rows=20, leaves=31)),
    }


def at_once(spark: SparkSession, fits: Mapping[str, Callable[[], Model]]) -> dict[str, Model]:
    """The models of fits that do not need each other, each begun in a thread of its own. A fit of
    trees is hundreds of small jobs: while one is planned, the cores work on those of other fits."""
    with ThreadPoolExecutor(max(len(fits), 1)) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(fit)) for name, fit in fits.items()}
        return {name: future.result() for name, future in begun.items()}


def fit_all(train: DataFrame, estimators: Mapping[str, Estimator]) -> dict[str, Model]:
    return at_once(train.sparkSession, {name: partial(estimator.fit, train) for name, estimator in estimators.items()})


def predict_all(models: Mapping[str, Model], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Long (keep..., model, prediction). All models score a row in the same pass."""
    scored = df
    for i, model in enumerate(models.values()):
        scored = model.copy().setPredictionCol(f"prediction_{i}").transform(scored)
    cells = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"prediction_{i}").alias("prediction"))
        for i, name in enumerate(models)
    ])
    return scored.select(*keep, F.explode(cells).alias("cell")).select(*keep, "cell.*")


def linear_score(
    df: DataFrame, coefficients: Mapping[str, float], intercept: float, output: str = "prediction"
) -> DataFrame:
    """Prediction of a linear model from its coefficients, as a plain expression."""
    score = F.lit(float(intercept))
    for name, w in coefficients.items():
        score = score + F.col(name) * F.lit(float(w))
    return df.withColumn(output, score)
