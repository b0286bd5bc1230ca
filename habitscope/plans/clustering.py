"""User segmentation by K-means over behaviour features."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from habitscope.functions import columns as C
from habitscope.operators import clean, cluster
from habitscope.plans import fixed_values as V
from habitscope.sources.scratch import settled


def numeric_inputs(users: DataFrame) -> DataFrame:
    """Clustering inputs as double (they may come from an all-text file), NULLs
    filled with the column mean. Settled first: the means and the fill read it."""
    inputs = users.select(V.KEY, *V.CLUSTER_INPUTS)
    cast = clean.cast_and_move_last(inputs, {c: "double" for c in V.CLUSTER_INPUTS})
    return clean.impute_means(settled(cast, "cluster-inputs"), V.CLUSTER_INPUTS)


def wellness() -> Column:
    """Mean of four parts: distance from an ideal BMI, distance from an ideal blood
    pressure, movement, and sleep."""
    body = F.lit(100) - C.gap_from("body_mass_index", V.IDEAL_BMI, V.BMI_WEIGHT)
    pressure = (
        F.lit(100)
        - C.gap_from("blood_pressure_systolic", V.IDEAL_SYSTOLIC, V.PRESSURE_WEIGHT)
        - C.gap_from("blood_pressure_diastolic", V.IDEAL_DIASTOLIC, V.PRESSURE_WEIGHT)
    )
    movement = C.scaled_down("daily_steps_count", V.STEPS_PER_POINT) + C.weighted_sum(
        {"exercise_hours_per_week": V.EXERCISE_WEIGHT}
    )
    sleep = C.weighted_sum({"sleep_hours_per_night": V.SLEEP_WEIGHT})
    return C.scaled_down(C.total_of(body, pressure, movement, sleep), 4)


def with_features(df: DataFrame) -> DataFrame:
    """Scores first, then the ratio built on them."""
    scores = df.withColumns({
        "creator_score": C.weighted_sum(V.CREATOR_WEIGHTS),
        "consumer_score": C.weighted_sum(V.CONSUMER_WEIGHTS),
        "social_butterfly_index": C.weekly_total("dms_sent_per_week", "comments_written_per_day"),
        "dm_reciprocity": C.add_one_ratio("dms_received_per_week", "dms_sent_per_week"),
        "wellness_index": wellness(),
        "addiction_risk_score": C.weighted_sum(V.RISK_WEIGHTS),
        "usage_intensity_score":
            F.col("daily_active_minutes_instagram") * F.col("sessions_per_day"),
    })
    return scores.withColumn(
        "passive_active_ratio", C.add_one_ratio("consumer_score", "creator_score")
    )


def cluster_features(users: DataFrame) -> DataFrame:
    """(user_id, the 15 features), in the fixed order."""
    return with_features(numeric_inputs(users)).select(V.KEY, *V.CLUSTER_FEATURES)


def prepared(users: DataFrame) -> DataFrame:
    """The features settled once more: fitting runs many small jobs over them."""
    return settled(cluster_features(users), "cluster-features")


def fit(features: DataFrame, k: int = V.CLUSTERS) -> PipelineModel:
    return cluster.fit_clusters(features, V.CLUSTER_FEATURES, [V.KEY], k=k)


def clustered(features: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(features).select(V.KEY, *V.CLUSTER_FEATURES, "Cluster")


def radar_profile(with_cluster: DataFrame) -> DataFrame:
    """Mean features per cluster, each scaled over the clusters to 0..1."""
    means = cluster.group_means(with_cluster, "Cluster", V.CLUSTER_FEATURES)
    return cluster.spread_across_groups(means, V.CLUSTER_FEATURES)
