"""Predicting the stress score: split, impute, derive, encode, seven models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from habitscope.functions import columns as C
from habitscope.operators import clean, encode, evaluate, explore, regress
from habitscope.plans import fixed_values as V
from habitscope.sources.scratch import settled, use_checkpoints

NUMBERS = [*V.REGRESSION_INPUTS, V.REGRESSION_LABEL]
FEATURES, LABEL = "features", V.REGRESSION_LABEL
EXPLAINED = "Leafwise Boosting"


def numeric_inputs(users: DataFrame) -> DataFrame:
    return clean.cast_columns(users, {c: "double" for c in NUMBERS}).select(
        V.KEY, *NUMBERS, *V.REGRESSION_CATEGORIES
    )


def split(users: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """70 / 30 by user id. The inputs are settled with their side, since both parts
    and every training statistic are read from them."""
    side = explore.side_of_split([V.KEY], (0.7, 0.3), seed)
    sides = settled(numeric_inputs(users).withColumn("side", side), "regression-inputs")
    train, test = (sides.filter(F.col("side") == i).drop("side") for i in (0, 1))
    return train, test


def filled(
    train: DataFrame, test: DataFrame, impute_label: bool = False
) -> tuple[DataFrame, DataFrame]:
    """NULL inputs get the training mean. Rows without a label are left out, or
    given the mean label if ``impute_label``."""
    cols = NUMBERS if impute_label else V.REGRESSION_INPUTS
    means = clean.column_means(train, cols)
    if not impute_label:
        train, test = train.dropna(subset=[LABEL]), test.dropna(subset=[LABEL])
    return clean.fill_from(train, means), clean.fill_from(test, means)


def with_features(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Derived inputs; ``ranges`` is the training table's min/max row."""
    scaled = encode.scale_ranges(df, ranges, {
        "body_mass_index": "bmi_scaled", "blood_pressure_systolic": "bp_scaled",
    })
    return scaled.withColumns({
        "screen_to_sleep_ratio":
            C.safe_ratio("daily_active_minutes_instagram", "sleep_hours_per_night"),
        "passive_consumption": C.total_of("time_on_feed_per_day", "time_on_reels_per_day"),
        "health_composite": C.scaled_down(C.total_of("bmi_scaled", "bp_scaled"), 2),
    }).drop("bmi_scaled", "bp_scaled")


def prepared(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    train, test = filled(train, test)
    ranges = encode.column_ranges(train, ["body_mass_index", "blood_pressure_systolic"])
    return with_features(train, ranges), with_features(test, ranges)


@dataclass
class Vectors:
    """Training and test rows as (user_id, label, features), and the fitted stages."""

    train: DataFrame
    test: DataFrame
    stages: PipelineModel

    def names(self) -> list[str]:
        """Feature name per vector slot: the numbers, then category=label."""
        hot = [
            f"{c}={label}"
            for c, labels in zip(V.REGRESSION_CATEGORIES, self.stages.stages[0].labelsArray)
            for label in labels[:-1]
        ]
        return [*V.REGRESSION_FEATURES, *hot]


def vectors(users: DataFrame, seed: int = 42) -> Vectors:
    """Encode and scale with stages fitted on the training rows. Both parts are
    settled, because every model reads them many times."""
    train, test = prepared(*split(users, seed))
    stages = Pipeline(
        stages=encode.feature_stages(V.REGRESSION_FEATURES, V.REGRESSION_CATEGORIES, FEATURES)
    ).fit(train)
    train, test = (
        settled(
            stages.transform(part).select(V.KEY, F.col(LABEL).alias("label"), FEATURES), name
        )
        for part, name in ((train, "train-vectors"), (test, "test-vectors"))
    )
    return Vectors(train, test, stages)


def fit_models(
    v: Vectors, trees: int = 100, rounds: int = 100, seed: int = 42
) -> dict[str, Model]:
    use_checkpoints(v.train.sparkSession)
    line_up = regress.seven_regressors(v.train, FEATURES, "label", trees, rounds, seed, [V.KEY])
    return regress.fit_all(v.train, line_up)


def bake_off(v: Vectors, models: dict[str, Model]) -> DataFrame:
    """Leaderboard of all models over the whole test part."""
    predictions = regress.predict_all(models, v.test, [V.KEY, "label"])
    return evaluate.leaderboard(evaluate.metrics_by_model(predictions))
