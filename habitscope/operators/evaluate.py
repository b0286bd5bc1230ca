"""Regression metrics per model and the leaderboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from habitscope.functions.windows import number_asc


def rmse(label: str, prediction: str) -> Column:
    error = F.col(label) - F.col(prediction)
    return F.sqrt(F.avg(error * error))


def mae(label: str, prediction: str) -> Column:
    return F.avg(F.abs(F.col(label) - F.col(prediction)))


def mape(label: str, prediction: str) -> Column:
    """Mean absolute percentage error; rows whose label is zero do not count."""
    return F.avg(F.abs(F.try_divide(F.col(label) - F.col(prediction), F.col(label)))) * F.lit(100.0)


def r_squared(label: str, prediction: str) -> Column:
    """1 - SSE/SST; NULL when the label is constant."""
    error = F.col(label) - F.col(prediction)
    return F.lit(1.0) - F.try_divide(F.avg(error * error), F.var_pop(label))


def metrics_by_model(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction",
    model: str = "model",
) -> DataFrame:
    """RMSE, MAE, MAPE and R2 of every model in one aggregation."""
    return predictions.groupBy(model).agg(
        rmse(label, prediction).alias("rmse"),
        mae(label, prediction).alias("mae"),
        mape(label, prediction).alias("mape_pct"),
        r_squared(label, prediction).alias("r2"),
    )


def leaderboard(metrics: DataFrame, model: str = "model") -> DataFrame:
    """Models by RMSE, best first, numbered from 1 (one row per model)."""
    return metrics.withColumn("place", number_asc("rmse", [model])).orderBy("place")
