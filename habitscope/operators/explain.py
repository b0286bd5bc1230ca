"""Which features drive a model: signed contributions and global importance."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from habitscope.functions.columns import key_fraction
from habitscope.operators.clean import column_means
from habitscope.operators.onerow import STATS, attach_one_row, stat


def linear_contributions(
    df: DataFrame, coefficients: Mapping[str, float], keep: Sequence[str]
) -> DataFrame:
    """(keep..., feature, value, contribution) with contribution = w * (x - mean).

    Exact for a linear model with independent features: a row's contributions add
    up to its prediction minus the mean prediction.
    """
    means = column_means(df, list(coefficients))
    cells = F.array(*[
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
            (F.lit(float(w)) * (F.col(f) - stat(f))).alias("contribution"),
        )
        for f, w in coefficients.items()
    ])
    return (
        attach_one_row(df, means)
        .select(*keep, F.explode(cells).alias("cell"))
        .select(*keep, "cell.*")
    )


def mean_abs_contribution(contributions: DataFrame) -> DataFrame:
    """Global importance: mean absolute contribution per feature."""
    return contributions.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("importance")
    )


def tree_importances(df: DataFrame, model: Model, names: Sequence[str]) -> DataFrame:
    """Split-gain importances of a fitted tree model, one row per feature."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray(), strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def permutation_importance(
    df: DataFrame, model: Model, names: Sequence[str], label: str, keys: Sequence[str],
    features: str = "features", buckets: int | None = None, seed: int = 42, bucket_rows: int = 1000,
) -> DataFrame:
    """Rise in RMSE when one feature's values are exchanged between rows.

    Rows are spread over ``buckets`` by the hash of their key and, inside each, every
    row takes the values of the next one in another hash order (the last takes the
    first's): a permutation of the whole table made with one shuffle. Without
    ``buckets`` there is one for about ``bucket_rows`` rows, so a task's share stays the
    same however large the table is. All features are then scored in the same pass.
    """
    if buckets is None:
        buckets = max(1, math.ceil(df.count() / bucket_rows))
    bucket = F.floor(key_fraction(*keys, seed=seed) * F.lit(buckets))
    order = Window.partitionBy("bucket").orderBy(key_fraction(*keys, seed=seed + 1), *keys)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = df.select(
        *keys, F.col(label).cast("double").alias("label"),
        vector_to_array(features).alias("own"), bucket.alias("bucket"),
    ).withColumn("other", F.coalesce(F.lead("own").over(order), F.first("own").over(whole)))

    def scored(data: DataFrame, values, index: int) -> DataFrame:
        vector, out = f"vector_{index}", f"prediction_{index}"
        ready = model.copy().setFeaturesCol(vector).setPredictionCol(out)
        return ready.transform(data.withColumn(vector, array_to_vector(values))).drop(vector)

    size = len(names)
    data = scored(rows, F.col("own"), size)
    for i in range(size):
        slots = [F.element_at("other" if i == j else "own", j + 1) for j in range(size)]
        data = scored(data, F.array(*slots), i)

    def error(i: int):
        gap = F.col("label") - F.col(f"prediction_{i}")
        return F.sqrt(F.avg(gap * gap))

    one = data.agg(*[error(i).alias(f"rmse_{i}") for i in range(size + 1)])
    cells = F.array(*[
        F.struct(
            F.lit(name).alias("feature"),
            (F.col(f"rmse_{i}") - F.col(f"rmse_{size}")).alias("importance"),
        )
        for i, name in enumerate(names)
    ])
    return one.select(F.explode(cells).alias("cell")).select("cell.*")
