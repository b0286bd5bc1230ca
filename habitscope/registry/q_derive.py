"""F*: derived columns. B*: rule-based segments, one row per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from habitscope.functions import columns as C
from habitscope.operators.anomaly import with_abs_z
from habitscope.operators.segment import segment
from habitscope.plans import clustering, regression, reports
from habitscope.plans import fixed_values as V
from habitscope.registry.catalog import query
from habitscope.registry.dataset import (
    TYPED_SQL, USERS_SQL, clean_users, half_up, sql_rules, typed_users,
)
from habitscope.registry.q_encode import REGRESSION_SQL
from habitscope.registry.q_reports import Z_SQL

# -- on the cleaned users ------------------------------------------------------------


@query("f1_total_of_columns", USERS_SQL + """
SELECT user_id, total_time_on_instagram_per_day FROM users""")
def f1(spark, sf_dir):
    return clean_users(spark, sf_dir).select("user_id", "total_time_on_instagram_per_day")


@query("f2_guarded_ratio_zero", TYPED_SQL + """
SELECT user_id, ads_viewed_per_day, ads_clicked_per_day, CASE WHEN ads_viewed_per_day > 0
  THEN ads_clicked_per_day / ads_viewed_per_day ELSE 0.0::DOUBLE END AS ads_ctr FROM typed""")
def f2(spark, sf_dir):
    return typed_users(spark, sf_dir).select(
        "user_id", "ads_viewed_per_day", "ads_clicked_per_day",
        C.guarded_ratio("ads_clicked_per_day", "ads_viewed_per_day").alias("ads_ctr"),
    )


@query("f3_guarded_ratio_numerator", TYPED_SQL + """
SELECT user_id, CASE WHEN following_count > 0 THEN followers_count / following_count
  ELSE followers_count::DOUBLE END AS follower_following_ratio FROM typed""")
def f3(spark, sf_dir):
    ratio = C.guarded_ratio(
        "followers_count", "following_count", F.col("followers_count").cast("double")
    )
    return typed_users(spark, sf_dir).select("user_id", ratio.alias("follower_following_ratio"))


@query("f4_years_since", USERS_SQL + " SELECT user_id, account_age_years FROM users")
def f4(spark, sf_dir):
    return clean_users(spark, sf_dir).select("user_id", "account_age_years")


@query("f5_scaled_down", USERS_SQL + " SELECT user_id, stress_score_normalized FROM users")
def f5(spark, sf_dir):
    return clean_users(spark, sf_dir).select("user_id", "stress_score_normalized")


# -- clustering features --------------------------------------------------------------

CLUSTER_SQL = USERS_SQL + ", means AS (SELECT " + ", ".join(
    f"AVG({c}) AS m_{c}" for c in V.CLUSTER_INPUTS
) + " FROM users), inputs AS (SELECT user_id, " + ", ".join(
    f"COALESCE({c}::DOUBLE, m_{c}) AS {c}" for c in V.CLUSTER_INPUTS
) + """ FROM users, means), features AS (SELECT *,
  posts_created_per_week * 1.5::DOUBLE + comments_written_per_day * 0.5::DOUBLE AS creator_score,
  reels_watched_per_day * 1.0::DOUBLE + stories_viewed_per_day * 0.8::DOUBLE AS consumer_score,
  (consumer_score + 1) / (creator_score + 1) AS passive_active_ratio,
  dms_sent_per_week + comments_written_per_day * 7 AS social_butterfly_index,
  (dms_received_per_week + 1) / (dms_sent_per_week + 1) AS dm_reciprocity,
  ((100 - ABS(body_mass_index - 22) * 3)
    + (100 - ABS(blood_pressure_systolic - 120) * 0.5::DOUBLE
           - ABS(blood_pressure_diastolic - 80) * 0.5::DOUBLE)
    + (daily_steps_count / 150 + exercise_hours_per_week * 5)
    + sleep_hours_per_night * 12.5::DOUBLE) / 4 AS wellness_index,
  daily_active_minutes_instagram * 0.4::DOUBLE + sessions_per_day * 1.5::DOUBLE
    + notification_response_rate * 10 AS addiction_risk_score,
  daily_active_minutes_instagram * sessions_per_day AS usage_intensity_score
  FROM inputs)"""


def feature_query(key: str, *names: str):
    """The named clustering features, per user."""
    sql = CLUSTER_SQL + " SELECT user_id, " + ", ".join(
        f"{half_up(n, 6)} AS {n}" for n in names) + " FROM features"

    @query(key, sql)
    def run(spark, sf_dir):
        return clustering.cluster_features(clean_users(spark, sf_dir)).select(
            "user_id", *[F.round(n, 6).alias(n) for n in names]
        )
    return run


feature_query("f6_weighted_sum", "creator_score", "consumer_score")
feature_query("f7_add_one_ratio", "passive_active_ratio", "dm_reciprocity")
feature_query("f8_weekly_total", "social_butterfly_index")
feature_query("f9_wellness_index", "wellness_index")
feature_query("f10_risk_score", "addiction_risk_score")
feature_query("f11_interaction", "usage_intensity_score")
feature_query("f15_feature_list", *V.CLUSTER_FEATURES)


@query("f12_safe_ratio", USERS_SQL + """
SELECT user_id, dms_received_per_week / NULLIF(dms_sent_per_week, 0) AS received_per_sent,
  daily_active_minutes_instagram / NULLIF(sleep_hours_per_night, 0) AS screen_to_sleep_ratio
FROM users""")
def f12(spark, sf_dir):
    return clean_users(spark, sf_dir).select(
        "user_id",
        C.safe_ratio("dms_received_per_week", "dms_sent_per_week").alias("received_per_sent"),
        C.safe_ratio("daily_active_minutes_instagram", "sleep_hours_per_night")
        .alias("screen_to_sleep_ratio"),
    )


@query("f13_two_column_sum", USERS_SQL + """
SELECT user_id, time_on_feed_per_day + time_on_reels_per_day AS passive_consumption FROM users""")
def f13(spark, sf_dir):
    total = C.total_of("time_on_feed_per_day", "time_on_reels_per_day")
    return clean_users(spark, sf_dir).select("user_id", total.alias("passive_consumption"))


@query("f14_health_composite", REGRESSION_SQL + " SELECT user_id, " + ", ".join(
    f"{half_up(c, 6)} AS {c}" for c in V.REGRESSION_FEATURES) + " FROM features")
def f14(spark, sf_dir):
    """All regression features, training and test rows."""
    train, test = regression.prepared(*regression.split(clean_users(spark, sf_dir)))
    return train.unionByName(test).select(
        "user_id", *[F.round(c, 6).alias(c) for c in V.REGRESSION_FEATURES]
    )


# -- segments -----------------------------------------------------------------------------


def segment_query(key: str, rule: tuple, segmentation):
    @query(key, TYPED_SQL + f" SELECT user_id, {sql_rules(rule)} AS {rule[0]} FROM typed")
    def run(spark, sf_dir):
        return segment(typed_users(spark, sf_dir), segmentation).select("user_id", rule[0])
    return run


segment_query("b1_persona", V.PERSONA, reports.PERSONA)
segment_query("b2_session_habit", V.SESSION_HABIT, reports.SESSION_HABIT)
segment_query("b3_loyalty", V.LOYALTY, reports.LOYALTY)
segment_query("b4_response_tier", V.RESPONSE_TIER, reports.RESPONSE_TIER)
segment_query("b5_exercise_level", V.EXERCISE_LEVEL, reports.EXERCISE_LEVEL)
segment_query("b6_usage_level", V.USAGE_LEVEL, reports.USAGE_LEVEL)
segment_query("b8_age_decade", V.AGE_DECADE, reports.AGE_DECADE)
segment_query("b9_generation", V.GENERATION, reports.GENERATION)


@query("b7_anomaly_class", Z_SQL + """
SELECT user_id, nhom_phan_loai, total_anomaly_score FROM flagged""")
def b7(spark, sf_dir):
    scored = with_abs_z(clean_users(spark, sf_dir), V.ANOMALY_MEASURES)
    return segment(scored, reports.ANOMALY_CLASS).select(
        "user_id", "nhom_phan_loai",
        F.round(F.expr("z_mins + z_eng + z_flw + z_clicks"), 4).alias("total_anomaly_score"),
    )
